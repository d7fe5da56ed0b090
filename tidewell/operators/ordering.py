"""Sorting, top-k and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _keys(order: Sequence[str]):
    return [F.col(o[1:]).desc_nulls_last() if o.startswith("-") else F.col(o).asc_nulls_last() for o in order]


def order_nulls_last(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Global sort, ``-name`` descending, NULLs last in both directions."""
    return df.orderBy(*_keys(order))


def top_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    return df.orderBy(*_keys(order)).limit(k)


def top_k_per(df: DataFrame, by: Sequence[str], order: Sequence[str], k: int, name: str = "rank") -> DataFrame:
    """First ``k`` rows per group.

    The filter on the row number makes Spark keep ``k`` rows per group before the shuffle
    (WindowGroupLimit), so a huge group reaches its task already cut.
    """
    window = Window.partitionBy(*by).orderBy(*_keys(order))
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)


def last_n_per(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """Most recent ``n`` rows per key, newest first in ``recency``."""
    newest = [o[1:] if o.startswith("-") else f"-{o}" for o in order]
    return top_k_per(df, [key], newest, n, "recency")


def labelled_counts(frames: Mapping[str, DataFrame], label: str = "source") -> DataFrame:
    """Row counts of several frames side by side for reconciliation."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(label, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def dedupe(df: DataFrame, keys: Sequence[str] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or one row per key: the first by ``order`` when given."""
    if keys is None:
        return df.dropDuplicates()
    if order is None:
        return df.dropDuplicates(list(keys))
    return top_k_per(df, keys, order, 1, "__first").drop("__first")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys added, removed or changed between two snapshots; unchanged keys are left out."""
    values = [c for c in old.columns if c not in keys]
    a = old.select(*keys, F.struct(*values).alias("old_row"))
    b = new.select(*keys, F.struct(*values).alias("new_row"))
    joined = a.join(b, list(keys), "full_outer")
    return joined.withColumn(
        "change",
        F.when(F.col("old_row").isNull(), "added")
        .when(F.col("new_row").isNull(), "removed")
        .when(~F.col("old_row").eqNullSafe(F.col("new_row")), "changed"),
    ).filter(F.col("change").isNotNull())
