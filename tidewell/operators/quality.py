"""Data-quality measures, each in one pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.measures import spread
from tidewell.session import slices, stored

Rule = tuple[Column, str, str, str, Column, str]


def _long(one_row: DataFrame, ids: Sequence[str], name: str, value: str) -> DataFrame:
    rest = [c for c in one_row.columns if c not in ids]
    return one_row.unpivot(list(ids), rest, name, value)


def null_profile(df: DataFrame) -> DataFrame:
    """Count and percentage of NULLs for every column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__total"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    )
    return _long(counts, ["__total"], "column_name", "null_count").select(
        "column_name",
        "null_count",
        F.coalesce(F.round(F.try_divide("null_count", "__total") * 100, 2), F.lit(0.0)).alias("null_percentage"),
    )


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Total, distinct and surplus rows; copies are counted before the shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_records"), F.count(F.lit(1)).alias("unique_records")
    ).select(
        "*",
        (F.col("total_records") - F.col("unique_records")).alias("duplicate_count"),
        F.coalesce(
            F.round(F.try_divide(F.col("total_records") - F.col("unique_records"), "total_records") * 100, 2), F.lit(0.0)
        ).alias("duplicate_percentage"),
    )


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each named rule (the column is true for a violation)."""
    return _long(df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()]), [], "rule", "violations")


def sales_rules(categories: Sequence[str], as_of: str, max_price: float = 10000) -> dict[str, Column]:
    return {
        "positive_prices": F.col("price") <= 0,
        "positive_quantities": F.col("quantity") <= 0,
        "valid_categories": ~F.col("category").isin(*categories),
        "future_dates": F.col("timestamp") > F.lit(as_of).cast("timestamp"),
        "reasonable_prices": (F.col("price") < 1) | (F.col("price") > max_price),
    }


def table_quality(df: DataFrame, rules: Mapping[str, Column], null_limit: float = 5.0, by: Sequence[str] = ()) -> DataFrame:
    """Records and issues of one table: duplicates, rule breaks, and NULLs of columns beyond ``null_limit`` percent.

    Duplicates of a large table are counted in slices of ``by``, one after another: the count shuffles whole rows.
    """
    nulls = null_profile(df).agg(
        F.coalesce(F.sum(F.when(F.col("null_percentage") > null_limit, F.col("null_count"))), F.lit(0)).alias("null_issues")
    )
    broken = rule_counts(df, rules).agg(F.coalesce(F.sum("violations"), F.lit(0)).alias("rule_issues"))
    copies = [duplicate_profile(part) for part in (slices(df, by) if by else [df])]
    found = copies[0]
    if len(copies) > 1:
        found = stored(copies, "copies").agg(*[F.sum(c).alias(c) for c in ("total_records", "duplicate_count")])
    return found.crossJoin(broken).crossJoin(nulls).select(
        "total_records",
        F.col("duplicate_count").alias("duplicate_issues"),
        "rule_issues",
        "null_issues",
        (F.col("duplicate_count") + F.col("rule_issues") + F.col("null_issues")).alias("issues"),
    )


def quality_score(tables: Mapping[str, tuple[DataFrame, Mapping[str, Column]]], by: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """100 minus issues per 100 records over all tables, not below 0; 100 for no records. ``by`` names the columns to slice a large table by."""
    parts = [table_quality(df, rules, by=(by or {}).get(name, ())).withColumn("table_name", F.lit(name)) for name, (df, rules) in tables.items()]
    share = F.try_divide(F.sum("issues"), F.sum("total_records")) * 100
    return reduce(lambda a, b: a.unionByName(b), parts).agg(
        F.sum("total_records").alias("total_records"),
        F.sum("issues").alias("total_issues"),
        F.when(F.sum("total_records") > 0, F.round(F.greatest(F.lit(0.0), 100 - share), 2)).otherwise(100.0).alias("quality_score"),
    )


def value_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count of every value of several columns."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(pairs.alias("p")).groupBy("p.column_name", "p.value").agg(F.count(F.lit(1)).alias("n"))


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, minimum and maximum per numeric column."""
    measures = {
        "count": lambda c: F.count(c).cast("double"),
        "mean": lambda c: F.round(F.avg(c), 4),
        "stddev": lambda c: spread(c, 4),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    stats = df.agg(*[F.struct(*[m(c).alias(n) for n, m in measures.items()]).alias(c) for c in columns])
    return _long(stats, [], "column_name", "s").select("column_name", "s.*")


def first_failing_rule(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """One alert per bad row, for the first rule it breaks. Also for streams.

    A rule is (violation, issue, severity, field, value, expected form).
    """
    alerts = [
        F.when(
            broken,
            F.struct(
                F.lit(issue).alias("quality_issue"),
                F.lit(severity).alias("severity"),
                F.lit(field).alias("field_name"),
                F.coalesce(value.cast("string"), F.lit("NULL")).alias("invalid_value"),
                F.lit(expected).alias("expected_format"),
            ),
        )
        for broken, issue, severity, field, value, expected in rules
    ]
    return df.withColumn("__alert", F.coalesce(*alerts)).filter(F.col("__alert").isNotNull()).select(*keep, "__alert.*")


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


# Alert types, severities and expectations of the two rule lists below.
def user_alerts(users: DataFrame, keep: Sequence[str]) -> DataFrame:
    email = F.col("email")
    form = "valid email format (user@domain.com)"
    tiers = ("BRONZE", "SILVER", "GOLD", "PLATINUM")
    return first_failing_rule(
        users,
        [
            (_blank("email"), "MISSING_EMAIL", "HIGH", "email", email, form),
            (~email.like("%@%.%"), "INVALID_EMAIL_FORMAT", "HIGH", "email", email, form),
            (_blank("username"), "MISSING_USERNAME", "MEDIUM", "username", F.col("username"), "non-empty username"),
            (_blank("first_name"), "MISSING_FIRST_NAME", "LOW", "first_name", F.col("first_name"), "non-empty first name"),
            (~F.col("user_tier").isin(*tiers), "INVALID_USER_TIER", "LOW", "user_tier", F.col("user_tier"), "BRONZE, SILVER, GOLD, or PLATINUM"),
            (F.col("total_spent") < 0, "NEGATIVE_TOTAL_SPENT", "LOW", "total_spent", F.col("total_spent"), "non-negative value"),
        ],
        keep,
    )


def product_alerts(products: DataFrame, keep: Sequence[str]) -> DataFrame:
    price, cost = F.col("price"), F.col("cost")
    return first_failing_rule(
        products,
        [
            (_blank("product_name"), "MISSING_PRODUCT_NAME", "HIGH", "product_name", F.col("product_name"), "non-empty product name"),
            (price <= 0, "INVALID_PRICE", "HIGH", "price", price, "positive price value"),
            (cost < 0, "INVALID_COST", "LOW", "cost", cost, "non-negative cost value"),
            (cost >= price, "COST_EXCEEDS_PRICE", "HIGH", "cost", cost, "cost less than price"),
            (F.col("inventory_count") < 0, "NEGATIVE_INVENTORY", "MEDIUM", "inventory_count", F.col("inventory_count"), "non-negative inventory count"),
            (F.col("reorder_level") < 0, "NEGATIVE_REORDER_LEVEL", "LOW", "reorder_level", F.col("reorder_level"), "non-negative reorder level"),
            (_blank("category"), "MISSING_CATEGORY", "LOW", "category", F.col("category"), "non-empty category"),
        ],
        keep,
    )


def profile_drift(old: DataFrame, new: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Population stability per value range between two periods; the sum over ranges is the index.

    Empty ranges count as half a row so that the logarithm is defined.
    """
    bucket = sum((F.when(F.col(column) >= e, 1).otherwise(0) for e in edges), F.lit(0)).alias("bucket")

    def counts(df, name):
        return df.filter(F.col(column).isNotNull()).groupBy(bucket).agg(F.count(F.lit(1)).alias(name))

    both = counts(old, "old_n").join(counts(new, "new_n"), "bucket", "full_outer").fillna(0)
    sizes = both.agg(F.sum("old_n").alias("old_total"), F.sum("new_n").alias("new_total"))
    old_share = F.greatest(F.col("old_n"), F.lit(0.5)) / F.greatest(F.col("old_total"), F.lit(1))
    new_share = F.greatest(F.col("new_n"), F.lit(0.5)) / F.greatest(F.col("new_total"), F.lit(1))
    return both.crossJoin(sizes).select(
        "bucket", "old_n", "new_n", F.round((new_share - old_share) * F.log(new_share / old_share), 6).alias("stability")
    )


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose non-null key is missing in the dimension."""
    return fact.filter(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
