"""Jobs do not shuffle rows again that lie as they are written."""

import time

from pyspark.sql import functions as F

from tidewell import session
from tidewell.plans import jobs
from tidewell.sources import sinks


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {(f.getName(), f.length()) for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def test_full_dataset_is_written_as_the_ranking_left_it(spark, tables, tmp_path, monkeypatch):
    from tidewell.plans.batch_core import CLEAN_COLUMNS

    spreads = {}
    monkeypatch.setattr(sinks, "dealt", lambda df, columns, spread=1, was=sinks.dealt: spreads.update({tuple(columns): df.columns}) or was(df, columns, spread))
    paths = jobs.batch_job(tables.sales(*CLEAN_COLUMNS), str(tmp_path / "job"), {"positive": F.col("price") <= 0})
    assert ("category",) not in spreads
    stored = spark.read.parquet(paths["full_dataset"])
    assert stored.count() == tables.sales(*CLEAN_COLUMNS).count()


def test_facts_are_dealt_out_before_they_are_widened(spark, tables, tmp_path, monkeypatch):
    dealt = {}
    monkeypatch.setattr(sinks, "dealt", lambda df, columns, spread=1, was=sinks.dealt: dealt.update({tuple(columns): df.columns}) or was(df, columns, spread))
    from tidewell.plans import catalog

    from conftest import SF

    catalog.QUERIES["job_02_etl"](spark, SF)
    assert "estimated_profit" not in dealt[("sale_month",)] and "order_id" not in dealt[("sale_month",)]


def test_jobs_in_slices_give_the_same_outputs_and_leave_no_shuffle_files(spark, tables, tmp_path):
    """Large sources are worked off in slices: every output is whole, and the disk is free of what earlier steps shuffled."""
    from tidewell.plans.batch_core import AS_OF, CLEAN_COLUMNS

    def run(name):
        sales = tables.sales(*CLEAN_COLUMNS)
        # Copies of a row, NULL keys and times, and a category that differs in case alone.
        odd = sales.limit(40).withColumns({"category": F.lower("category"), "user_id": F.lit(None).cast("long")})
        late = sales.limit(9).withColumn("timestamp", F.lit(None).cast("timestamp"))
        source = str(tmp_path / name / "source")
        sales.union(sales.limit(50)).union(odd).union(late).repartition(4).write.parquet(source)
        sales = spark.read.parquet(source)
        jobs.batch_job(sales, str(tmp_path / name / "batch"), {"positive": F.col("price") <= 0})
        customers = tables.customer.select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"), F.lit("u@x").alias("email"), F.lit("1").alias("phone"),
            F.col("c_acctbal").alias("lifetime_value"), F.lit("1999-01-01").cast("date").alias("registration_date"), F.lit("2001-11-01").cast("date").alias("last_login"),
        )
        products = tables.part.select(
            F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("sku"), F.col("p_retailprice").alias("cost_price"), F.col("p_retailprice").alias("retail_price"),
            F.col("p_size").alias("stock_quantity"), F.lit("2000-01-01").cast("date").alias("created_date"), F.lit(1.0).alias("weight_kg"),
        )
        visits = tables.events.select(
            "event_id", F.col("event_time").alias("timestamp"), F.lit("direct").alias("referrer"), F.lit("mobile").alias("device_type"),
            F.lit("/a/x").alias("page_url"), F.col("price").alias("duration_seconds"),
        )
        jobs.etl_job(sales, customers, products, visits, str(tmp_path / name / "etl"), AS_OF)

    run("whole")
    before = shuffle_files(spark)
    spark.conf.set(session.SLICE_BYTES_CONF, "100000")
    try:
        run("sliced")
    finally:
        spark.conf.unset(session.SLICE_BYTES_CONF)
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert sum(size for _, size in left) < 200_000

    def read(name, path, form):
        return getattr(spark.read.option("header", True) if form == "csv" else spark.read, form)(str(tmp_path / name / path))

    for path, form in {
        "batch/category_revenue": "csv", "batch/daily_trends": "csv", "batch/hourly_patterns": "csv", "batch/top_customers": "csv", "batch/customer_segments": "csv",
        "batch/full_dataset": "parquet", "batch/quality_report": "json", "etl/fact/sales": "parquet", "etl/fact/web": "parquet", "etl/dim/customers": "parquet",
        "etl/agg/daily_sales": "parquet", "etl/agg/customer_summary": "parquet", "etl/export/business_summary": "csv", "etl/export/top_customers": "csv", "etl/report": "json",
    }.items():
        whole, sliced = read("whole", path, form), read("sliced", path, form)
        assert whole.dtypes == sliced.dtypes
        assert whole.count() > 0 and whole.exceptAll(sliced).count() == 0 and sliced.exceptAll(whole).count() == 0, path
