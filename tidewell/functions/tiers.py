"""Named classifications shared by several operators, as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The thresholds and labels of the result schema.
SPEND_TIERS = [(5000, "Platinum"), (2000, "Gold"), (500, "Silver")]
PRICE_TIERS = [(500, "Premium"), (100, "Standard")]
VALUE_TIERS = [(1000, "High Value"), (500, "Medium Value")]
LOYALTY_TIERS = [(5000, "PLATINUM"), (2000, "GOLD"), (500, "SILVER")]
COMPLEXITY_WEIGHTS = {"ELECTRONICS": 1.5, "CLOTHING": 1.0, "BOOKS": 0.8, "HOME": 1.2, "SPORTS": 1.1}
CATEGORY_MARGINS = {"ELECTRONICS": 0.15, "CLOTHING": 0.40, "BOOKS": 0.20, "HOME": 0.25}
TIER_BENEFITS = {
    "BRONZE": ["Basic support"],
    "SILVER": ["Basic support", "5% discount"],
    "GOLD": ["Priority support", "10% discount", "Free shipping"],
    "PLATINUM": ["VIP support", "15% discount", "Free shipping", "Early access"],
}


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def at_least(value, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step whose threshold ``value`` reaches."""
    value = _col(value)
    label = None
    for threshold, name in steps:
        label = (F if label is None else label).when(value >= threshold, name)
    return label.otherwise(otherwise)


def below(value, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step whose threshold lies above ``value``."""
    value = _col(value)
    label = None
    for threshold, name in steps:
        label = (F if label is None else label).when(value < threshold, name)
    return label.otherwise(otherwise)


def above(value, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step whose threshold ``value`` exceeds."""
    value = _col(value)
    label = None
    for threshold, name in steps:
        label = (F if label is None else label).when(value > threshold, name)
    return label.otherwise(otherwise)


def classify_tier(total_spent) -> Column:
    return F.when(_col(total_spent).isNull(), "Unknown").otherwise(at_least(total_spent, SPEND_TIERS, "Bronze"))


def categorize_price(price) -> Column:
    return F.when(_col(price).isNull(), "Unknown").otherwise(at_least(price, PRICE_TIERS, "Budget"))


def loyalty_tier(total_spent) -> Column:
    return at_least(total_spent, LOYALTY_TIERS, "BRONZE")


def lookup(key, values: dict[str, float], default: float) -> Column:
    key = _col(key)
    pairs = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def complexity_score(quantity, price, category) -> Column:
    """Whole part of quantity * price / 100 weighted by category; 0 when a part is missing."""
    quantity, price, category = _col(quantity), _col(price), _col(category)
    score = quantity * (price / 100) * lookup(category, COMPLEXITY_WEIGHTS, 1.0)
    missing = quantity.isNull() | price.isNull() | category.isNull()
    return F.when(missing, F.lit(0)).otherwise(score.cast("int"))


def category_margin(category) -> Column:
    return lookup(F.upper(F.trim(_col(category))), CATEGORY_MARGINS, 0.30)


def distance_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance (haversine, mean earth radius 6371 km)."""
    lat1, lon1, lat2, lon2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    half = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    return F.asin(F.sqrt(F.least(half, F.lit(1.0)))) * (2 * 6371.0)
