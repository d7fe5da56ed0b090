"""Lookup lists are sent to the rows, not rows gathered by the few values of a list."""

from pyspark.sql import functions as F

from tidewell.operators import clean


def test_joins_with_inline_values_shuffle_no_rows(spark):
    lookup = clean.literal_rows(spark, [("O", 1), ("F", 2)], "code string, n int")
    rows = spark.range(100).select(F.when(F.col("id") % 2 == 0, "O").otherwise("F").alias("status"))
    joined = rows.join(lookup, F.col("status") == F.col("code"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert joined.count() == 100
