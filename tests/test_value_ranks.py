"""Ranks of hot groups and large sources: equal to plain windows, and no shuffle files are left behind."""

import math
import time

import pytest
from pyspark.sql import functions as F

from tidewell import session
from tidewell.operators import scan, windows


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


@pytest.fixture
def sales(spark, tmp_path):
    n = F.col("id")
    amount = F.when(n % 13 == 0, None).when(n % 17 == 0, float("nan")).when(n % 3 == 0, 5.0).when(n % 29 == 0, -0.0).when(n % 31 == 0, 0.0)
    rows = spark.range(900).select(
        n.alias("session_id"), (n % 7).alias("line"), F.when(n % 5 > 0, n % 3).alias("category"),
        F.when(n % 11 > 0, (n % 19).cast("string")).alias("date"), amount.otherwise((n * 7919 % 101).cast("double") / 4).alias("total_amount"),
    )
    rows.union(rows.limit(60)).write.parquet(str(tmp_path / "sales"))
    return spark.read.parquet(str(tmp_path / "sales"))


def key(amount):
    """Order of Spark: NaN is the greatest, NULL comes last when falling."""
    return (2, 0.0) if amount is None else (0, 0.0) if math.isnan(amount) else (1, -amount + 0.0)


@pytest.mark.parametrize(("hot_rows", "slice_bytes"), [(20, None), (40, "8000"), (10**6, "8000")])
def test_ranks_of_hot_groups(spark, sales, hot_rows, slice_bytes):
    before = shuffle_files(spark)
    if slice_bytes:
        spark.conf.set(session.SLICE_BYTES_CONF, slice_bytes)
    try:
        got = windows.ranked_orders(sales, ["session_id", "line"], hot_rows=hot_rows)
    finally:
        spark.conf.unset(session.SLICE_BYTES_CONF)
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    # Counting the groups of a small source still leaves its own small files to the garbage.
    assert slice_bytes is None or not left
    rows = got.collect()
    assert got.columns == [*sales.columns, "category_rank", "daily_rank"] and len(rows) == sales.count()
    by_category, by_date = {}, {}
    for r in rows:
        by_category.setdefault(r["category"], []).append(key(r["total_amount"]))
        by_date.setdefault(r["date"], set()).add(key(r["total_amount"]))
    for r in rows:
        own = key(r["total_amount"])
        assert r["category_rank"] == 1 + sum(k < own for k in by_category[r["category"]])
        assert r["daily_rank"] == 1 + sum(k < own for k in by_date[r["date"]])


def test_one_dealing_serves_all_groupings(spark, sales, monkeypatch):
    """Rows of a hot group were cut into ranges, stored and shuffled again for every grouping and step."""
    monkeypatch.setattr(scan, "_blocked", None)
    assert windows.ranked_orders(sales, ["session_id", "line"], hot_rows=40).count() == sales.count()
