"""Ordered scans: the split form must equal the plain form on skewed, tied and null data."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.operators import scan as s

STEPS = (
    {"before": s.lag("v"), "third": s.lag("v", 3), "after": s.lead("v", 2), "mean3": s.moving(F.sum, "v", 3)},
    {"rn": s.row_number(), "total": s.running_sum("v"), "n": s.running_count("v"), "hi": s.running_max("v"), "lo": s.running_min("v"),
     "seen": s.latest("v"), "first": s.earliest("v")},
    {"r": s.rank("g"), "d": s.dense_rank("g")},
)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, g int, id int, v int")


def result(df, hot_rows, keys=("k",)):
    out = s.scan(df, list(keys), ["g", "id"], *STEPS, hot_rows=hot_rows)
    return sorted((tuple(r) for r in out.select(sorted(out.columns)).collect()), key=str)


@pytest.mark.parametrize("keys", [("k",), ()])
def test_split_equals_plain_on_one_hot_key(spark, keys):
    rows = [("hot", i // 7, i, None if i % 5 == 0 else i) for i in range(400)] + [(f"k{i % 9}", i % 4, i, i) for i in range(60)] + [(None, 1, 1, 5)]
    if not keys:
        rows = [(k, g, i, v) for i, (k, g, _, v) in enumerate(rows)]
    df = frame(spark, rows).repartition(6)
    assert result(df, 0, keys) == result(df, 10**9, keys)


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5))), max_size=60))
def test_split_equals_plain_on_any_rows(spark, rows):
    df = frame(spark, [(k, g, i, v) for i, (k, g, v) in enumerate(rows)])
    assert result(df, 0) == result(df, 10**9)


def test_empty_input(spark):
    assert result(frame(spark, []), 0) == []


def test_range_totals_with_ties_and_exact_edge(spark):
    rows = [("a", 0, 1), ("a", 10, 2), ("a", 10, 3), ("a", 20, 4), ("a", 21, 5), ("b", 5, 6)]
    df = spark.createDataFrame(rows, "k string, t long, id int").withColumn("v", F.lit(1).cast("long"))
    want = {1: 1, 2: 3, 3: 3, 4: 3, 5: 2, 6: 1}
    for hot in (0, 10**9):
        out = s.range_totals(df, ["k"], "t", ["id"], {"n": (F.col("v"), 10)}, hot)
        assert {r["id"]: r["n"] for r in out.collect()} == want


def test_hot_rows_come_from_the_session(spark):
    df = frame(spark, [("a", 1, 1, 1)])
    assert s.hot_limit(df) == s.HOT_ROWS_DEFAULT
    assert s.largest_group(df, ["k"]) == 1
    assert s.largest_group(frame(spark, []), ["k"]) == 0
