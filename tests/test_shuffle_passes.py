"""Groups of several ordered steps are counted in one pass over their rows."""

from pyspark.sql import functions as F

from tidewell.operators import scan, windows


def test_groups_of_several_key_sets_are_counted_at_once(spark):
    rows = spark.range(100).select(F.when(F.col("id") > 9, F.col("id") % 3).alias("a"), (F.col("id") % 7).alias("b"), F.lit(0).alias("__n_of"))
    scan.count_groups(rows, ["a"], ["b"], ["b", "a"])
    assert rows._group_sizes == {("a",): 30, ("b",): 15, ("a", "b"): 5}
    for keys in (["a"], ["b"], ["a", "b"]):
        fresh = rows.select("*")
        assert scan.largest_group(fresh, keys) == rows._group_sizes[tuple(sorted(keys))]
    assert scan.count_groups(rows.limit(0), ["a"], ["b"])._group_sizes == {("a",): 0, ("b",): 0}


def test_ranked_orders_count_both_groups_in_one_pass(spark, monkeypatch):
    single = []
    monkeypatch.setattr(scan, "largest_group", lambda df, keys, was=scan.largest_group: single.append(tuple(sorted(keys)) in df.__dict__.get("_scanned", df).__dict__.get("_group_sizes", {})) or was(df, keys))
    sales = spark.range(50).select(F.col("id").alias("session_id"), (F.col("id") % 3).alias("category"), (F.col("id") % 5).alias("date"), (F.col("id") % 11 * 1.0).alias("total_amount"))
    out = windows.ranked_orders(sales, ["session_id"])
    assert out.columns == [*sales.columns, "category_rank", "daily_rank"] and out.count() == 50
    assert single == [True, True]
