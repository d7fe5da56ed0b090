"""Operators that must hold for hot keys, long gaps, many searches and rows that arrive at a bound."""

import datetime as dt
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import search, timeseries, windows
from tidewell.operators.user_aggregates import UserAggregate, aggregate_by
from tidewell.session import scratch_path
from tidewell.sources import readers

START = dt.datetime(2024, 1, 1)


def moments():
    """A class of this call, so that it travels to the workers by value."""

    class Moments(UserAggregate):
        """Count, mean and variance by the merge formula, and the distinct labels."""

        def create(self):
            return 0, 0.0, 0.0, frozenset()

        def add(self, state, rows):
            values = rows["v"].dropna()
            own = (len(values), float(values.mean()) if len(values) else 0.0, float(((values - values.mean()) ** 2).sum()) if len(values) else 0.0, frozenset(rows["s"].dropna()))
            return self.merge(state, own)

        def merge(self, a, b):
            n = a[0] + b[0]
            if not n:
                return 0, 0.0, 0.0, a[3] | b[3]
            d = b[1] - a[1]
            return n, a[1] + d * b[0] / n, a[2] + b[2] + d * d * a[0] * b[0] / n, a[3] | b[3]

        def result(self, state):
            n, mean, squares, labels = state
            return n, mean if n else None, squares / n if n else None, sorted(labels)

    return Moments()


@pytest.mark.parametrize("salts", [1, 64])
def test_user_aggregate_with_a_hot_key(spark, salts):
    rng = np.random.default_rng(1)
    rows = [(0 if i % 3 == 0 else None if i % 50 == 1 else int(rng.integers(1, 40)), float("nan") if i % 11 == 0 else 1.0, float(rng.normal()) if i % 7 else None, f"s{i % 5}" if i % 4 else None) for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, g double, v double, s string").repartition(7)
    got = {(r["k"], str(r["g"])): r for r in aggregate_by(df, ["k", "g"], ["v", "s"], moments(), "n long, mean double, var double, labels array<string>", salts).collect()}
    groups = {}
    for k, g, v, s in rows:
        groups.setdefault((k, str(g)), []).append((v, s))
    assert got.keys() == groups.keys()
    for key, own in groups.items():
        values = [v for v, _ in own if v is not None]
        assert got[key]["n"] == len(values) and got[key]["labels"] == sorted({s for _, s in own if s})
        if values:
            assert abs(got[key]["mean"] - statistics.fmean(values)) < 1e-9 and abs(got[key]["var"] - statistics.pvariance(values)) < 1e-9


def test_user_aggregate_without_keys_or_rows(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, None)], "v double, s string")
    assert [tuple(r) for r in aggregate_by(df, [], ["v", "s"], moments(), "n long, mean double, var double, labels array<string>").collect()] == [(2, 2.0, 1.0, ["a"])]
    none = aggregate_by(df.limit(0), [], ["v", "s"], moments(), "n long, mean double, var double, labels array<string>")
    assert [tuple(r) for r in none.collect()] == [(0, None, None, [])]
    assert aggregate_by(df.limit(0), ["s"], ["v"], moments(), "n long, mean double, var double, labels array<string>").count() == 0


@pytest.mark.parametrize("block", [8192, 16])
def test_many_searches_in_blocks(spark, block):
    rng = np.random.default_rng(3)
    data = rng.integers(-3, 4, (90, 4)).astype(float)  # many ties, some zero vectors
    data[5] = 0
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(200, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in search.cosine_topk(vectors, vectors, 4, block=block).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    norms = np.linalg.norm(data, axis=1, keepdims=True)
    unit = np.divide(data, norms, out=np.zeros_like(data), where=norms > 0)
    near = np.round(unit @ unit.T, 10)
    assert got == {q: list(np.argsort(-near[q], kind="stable")[:4]) for q in range(90)}
    assert search.cosine_topk(vectors, vectors.limit(0), 4).count() == 0


def test_gap_fill_of_ten_years_in_seconds_is_no_array(spark):
    """315 million steps of one key: the rows are made chunk by chunk, so counting them holds none of them together."""
    ends = [("a", START, 1.0), ("a", START + dt.timedelta(days=3650), 2.0), ("b", START, None), ("b", START + dt.timedelta(seconds=3), 5.0)]
    df = spark.createDataFrame(ends, "k string, t timestamp, v double")
    short = timeseries.gap_fill(df.filter("k = 'b'"), "k", "t", "v", "1 SECOND").orderBy("t").collect()
    assert [(r["t"].second, r["is_filled"], r["v"]) for r in short] == [(0, True, None), (1, True, None), (2, True, None), (3, False, 5.0)]
    counted = timeseries.gap_fill(df, "k", "t", "v", "1 SECOND").groupBy("k", "is_filled").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    assert {(r["k"], r["is_filled"]): (r["n"], r["low"], r["high"]) for r in counted.collect()} == {
        ("a", False): (2, 1.0, 2.0), ("a", True): (3650 * 86400 - 1, 1.0, 1.0), ("b", False): (1, 5.0, 5.0), ("b", True): (3, None, None),
    }


def test_gap_fill_by_months_and_ties(spark):
    rows = [("a", dt.datetime(2023, 11, 1), 1.0), ("a", dt.datetime(2024, 3, 1), None), ("a", dt.datetime(2024, 4, 1), 3.0), (None, dt.datetime(2024, 1, 1), 7.0)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    got = timeseries.gap_fill(df, "k", "t", "v", "1 MONTH").orderBy("k", "t").collect()
    assert [(r["k"], r["t"].month, r["is_filled"], r["v"]) for r in got] == [(None, 1, False, 7.0), ("a", 11, False, 1.0), ("a", 12, True, 1.0), ("a", 1, True, 1.0), ("a", 2, True, 1.0), ("a", 3, True, 1.0), ("a", 4, False, 3.0)]


def test_daily_growth_over_a_long_gap(spark):
    rows = [("a", START, 10.0, 1), ("a", START + dt.timedelta(days=9000), 20.0, 2), ("a", START + dt.timedelta(days=9001), 30.0, 1)]
    df = spark.createDataFrame(rows, "g string, timestamp timestamp, total_amount double, quantity int")
    out = windows.daily_growth(df, ["g"])
    assert out.count() == 9002 and out.filter("revenue_count > 0").count() == 3
    assert [r["revenue_growth"] for r in out.orderBy("period").tail(2)] == [None, 0.5]


def test_incremental_load_is_exact_at_ties(spark):
    marks, table = scratch_path(spark, "ties"), []

    def source():
        return spark.createDataFrame(table, "id int, s string").select("id", F.to_timestamp("s").alias("t"))

    def load():
        fresh, commit = readers.read_incremental(source, "t", marks, "x", spark, ["id"])
        return fresh, commit

    table += [(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00"), (3, "2024-01-02 00:00:00"), (None, "2024-01-02 00:00:00")]
    fresh, _ = load()
    assert fresh.count() == 4
    fresh, commit = load()  # the first load was not committed
    table += [(4, "2024-01-02 00:00:00")]  # arrives with the bound's own time while the load runs
    assert sorted(str(r["id"]) for r in fresh.collect()) == ["1", "2", "3", "None"]
    commit()
    fresh, commit = load()
    assert [r["id"] for r in fresh.collect()] == [4]
    commit()
    assert load()[0].count() == 0
    table += [(5, "2024-01-02 00:00:00"), (6, "2024-01-03 00:00:00")]
    fresh, commit = load()
    assert sorted(r["id"] for r in fresh.collect()) == [5, 6]
    commit()
    table += [(7, "2024-01-03 00:00:00")]
    assert [r["id"] for r in load()[0].collect()] == [7]


def test_scans_of_one_frame_count_their_groups_once(spark):
    from tidewell.operators import scan as s

    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 3.0), ("b", 1, 1.0)], "k string, i int, v double")
    once = s.scan(df, ["k"], ["i"], {"n": s.row_number()})
    twice = s.scan(once, ["k"], ["i"], {"total": s.running_sum("v")})
    assert df._group_sizes == {("k",): 2} and twice._scanned is df
    by_number = s.scan(twice, ["n"], ["k"], {"m": s.row_number()})
    assert "_group_sizes" in twice.__dict__ and by_number.count() == 3
