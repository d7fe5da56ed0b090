"""Named SQL functions and extension points."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.tiers import COMPLEXITY_WEIGHTS, PRICE_TIERS, SPEND_TIERS


def _steps(argument: str, steps, otherwise: str) -> str:
    cases = " ".join(f"WHEN {argument} >= {threshold} THEN '{name}'" for threshold, name in steps)
    return f"CASE WHEN {argument} IS NULL THEN 'Unknown' {cases} ELSE '{otherwise}' END"


def register_functions(spark: SparkSession) -> list[str]:
    """``classify_tier``, ``categorize_price`` and ``complexity_score`` as SQL functions.

    They are expressions, so Catalyst inlines them and no row leaves the JVM.
    """
    weights = " ".join(f"WHEN '{c}' THEN {w}D" for c, w in COMPLEXITY_WEIGHTS.items())
    bodies = {
        "classify_tier": ("total DOUBLE", "STRING", _steps("total", SPEND_TIERS, "Bronze")),
        "categorize_price": ("price DOUBLE", "STRING", _steps("price", PRICE_TIERS, "Budget")),
        "complexity_score": (
            "quantity INT, price DOUBLE, category STRING", "INT",
            "CASE WHEN quantity IS NULL OR price IS NULL OR category IS NULL THEN 0 "
            f"ELSE CAST(quantity * (price / 100) * CASE category {weights} ELSE 1.0D END AS INT) END",
        ),
    }
    for name, (arguments, result, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return sorted(bodies)


def register_udaf(spark: SparkSession, name: str, fn: Callable[[pd.Series], object], result: T.DataType) -> None:
    """A user's own aggregate over a pandas series. Built-in aggregates combine before the shuffle, this one cannot."""

    def aggregate(values: pd.Series) -> object:
        return fn(values)

    aggregate.__annotations__ = {"values": pd.Series, "return": object}
    spark.udf.register(name, F.pandas_udf(aggregate, result, F.PandasUDFType.GROUPED_AGG))


def register_udtf(spark: SparkSession, name: str, cls: type, result: str) -> None:
    """A user's own table function: a class with ``eval`` that yields rows."""
    spark.udtf.register(name, F.udtf(cls, returnType=result))
