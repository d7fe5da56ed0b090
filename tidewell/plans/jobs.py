"""Jobs: the operators composed from source to stored result."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import udfs
from tidewell.operators import aggregates as agg
from tidewell.operators import cdc, clean, enrich, features, joins, ml, ordering, quality, windows
from tidewell.session import forget, shuffles_freed, slice_count, slices, stored, write_slices
from tidewell.sources import sinks
from tidewell.sources.readers import register_views
from tidewell.streaming import windows as stream_windows
from tidewell.streaming.run import few_stores

TIES = ["session_id", "line", "product_id", "supplier_id", "total_amount"]


def batch_job(sales: DataFrame, out: str, rules: Mapping[str, Column], tiebreak=tuple(TIES)) -> dict[str, str]:
    """Clean, aggregate, window, check and save. Returns the path of every output.

    Rows are stored between the steps, in slices, and go when the next step has stored its own: the disk holds two copies at a time.
    """
    # Equal rows are equal in the first tiebreak, so duplicates share a slice.
    cleaned = stored([clean.clean_sales(part) for part in slices(sales, tiebreak[:1])], "cleaned")
    with shuffles_freed(cleaned.sparkSession):
        reports = {
            "category_revenue": agg.revenue_by_category(cleaned),
            "daily_trends": agg.daily_trends(cleaned),
            "hourly_patterns": agg.hourly_patterns(cleaned),
            "top_customers": ordering.top_k(agg.user_totals(cleaned), ["-total_spent", "user_id"], 10),
            "customer_segments": agg.customer_segments(cleaned),
        }
        for name, df in reports.items():
            sinks.write_csv_report(df, f"{out}/{name}")
        checks = quality.rule_counts(cleaned, rules).withColumn("check", F.lit("rules")).select("check", F.col("rule").alias("name"), F.col("violations").alias("n"))
        nulls = quality.null_profile(cleaned).select(F.lit("nulls").alias("check"), F.col("column_name").alias("name"), F.col("null_count").alias("n"))
        sinks.write_report(checks.unionByName(nulls), f"{out}/quality_report")
        numbered = stored([windows.purchase_sequence(part, tiebreak) for part in slices(cleaned, ["user_id"])], "numbered")
        forget(cleaned)
        ranks = ["category_rank", "daily_rank"]
        own = [c for c in numbered.columns if c not in cleaned.columns]
        ranked = windows.ranked_orders(numbered, tiebreak[:-1]).select(*cleaned.columns, *ranks, *own)
        if not any(numbered._stored_at in file for file in ranked.inputFiles()):
            forget(numbered)
        # Rows are written as the ranking left them, sorted by category in each task.
        sinks.write_partitioned(ranked, f"{out}/full_dataset", ["category"], spread=0)
        sinks.write_sample(cleaned.sparkSession.read.parquet(f"{out}/full_dataset"), f"{out}/windowed_sample")
    return {n: f"{out}/{n}" for n in (*reports, "full_dataset", "windowed_sample", "quality_report")}


def etl_job(sales: DataFrame, customers: DataFrame, products: DataFrame, visits: DataFrame, out: str, as_of: str) -> dict[str, str]:
    """Facts, dimensions and aggregates of a star schema, with a quality score. Later steps read what earlier ones stored.

    Steps that shuffle all rows go slice by slice: facts, days and quality by month, customers by customer.
    """
    spark = sales.sparkSession
    paths = {n: f"{out}/{n}" for n in ("fact/sales", "fact/web", "dim/customers", "dim/products", "agg/daily_sales", "agg/customer_summary",
                                       "export/business_summary", "export/top_customers", "report")}
    joined = stored(slices(sales.withColumn("sale_month", F.date_format("timestamp", "yyyy-MM")), ["session_id"]), "sales")
    # Rows are dealt out before the fact's columns are derived: the shuffle carries the source's columns alone.
    facts = [clean.sales_fact(sinks.dealt(part, ["sale_month"], spread=4)) for part in slices(joined, ["sale_month"])]
    write_slices(facts, lambda part, mode: sinks.write_partitioned(part, paths["fact/sales"], ["sale_month"], mode, spread=0))
    forget(joined)
    with shuffles_freed(spark):
        sinks.write_partitioned(clean.web_fact(visits), paths["fact/web"], ["session_date"])
    clean.customer_dim(customers, as_of).write.mode("overwrite").parquet(paths["dim/customers"])
    clean.product_dim(products, as_of).write.mode("overwrite").parquet(paths["dim/products"])
    fact = spark.read.parquet(paths["fact/sales"])
    days = [agg.daily_sales_agg(part) for part in slices(fact, ["sale_month"])]
    write_slices(days, lambda part, mode: part.write.mode(mode).parquet(paths["agg/daily_sales"]))
    summaries = [agg.customer_summary(part) for part in slices(fact, ["customer_id"], -(-slice_count(fact) // 2))]
    write_slices(summaries, lambda part, mode: part.write.mode(mode).parquet(paths["agg/customer_summary"]))
    sinks.write_csv_report(agg.business_summary(spark.read.parquet(paths["agg/daily_sales"])), paths["export/business_summary"])
    summary = spark.read.parquet(paths["agg/customer_summary"]).withColumn("purchased_categories", F.array_join("purchased_categories", "|"))
    sinks.write_csv_report(ordering.top_k(summary, ["-total_spent", "customer_id"], 100), paths["export/top_customers"])
    now = F.lit(as_of).cast("timestamp")
    score = quality.quality_score(
        {
            "sales": (fact, {"negative": F.col("final_amount") < 0, "no_quantity": F.col("quantity") <= 0, "future": F.col("timestamp") > now}),
            "customers": (spark.read.parquet(paths["dim/customers"]), {"bad_email": ~F.col("email").contains("@"), "debt": F.col("lifetime_value") < 0}),
            "products": (spark.read.parquet(paths["dim/products"]), {"price": F.col("retail_price") <= 0, "cost": F.col("cost_price") > F.col("retail_price")}),
        },
        by={"sales": ["sale_month"]},
    )
    with shuffles_freed(spark):
        sinks.write_report(score, paths["report"])
    return paths


def sql_report_job(spark: SparkSession, views: Mapping[str, DataFrame], out: str, reports: Mapping[str, str]) -> dict[str, str]:
    """Register views and functions, run SQL reports and save each as CSV."""
    register_views(spark, views)
    udfs.register_functions(spark)
    for name, text in reports.items():
        sinks.write_csv_report(spark.sql(text), f"{out}/{name}")
    return {name: f"{out}/{name}" for name in reports}


def stream_job(events: DataFrame, out: str, checkpoints: str, trigger: Mapping | None = None) -> dict[str, object]:
    """Five analytics and the fraud rule over one event stream, each with its own checkpoint. Returns the running queries."""
    results = {
        "minute_counts": stream_windows.tumbling_counts(events),
        "category_revenue": stream_windows.sliding_revenue(events),
        "active_users": stream_windows.active_users(events),
        "session_analysis": stream_windows.session_sliding(events),
        "high_value_alerts": enrich.high_value_alerts(events, 200.0),
        "fraud_alerts": stream_windows.fraud_window(events),
    }
    with few_stores(events.sparkSession):
        return {
            name: sinks.file_stream_sink(df, f"{out}/{name}", f"{checkpoints}/{name}", trigger) for name, df in results.items()
        }


def event_router_job(events: DataFrame, min_value: float, actions, threshold: float) -> DataFrame:
    """Filter, enrich and route; the result is ready for a keyed topic."""
    return enrich.route_events(enrich.enrich_event(enrich.filter_events(events, min_value, actions)), threshold)


def warehouse_job(user_changes: DataFrame, product_changes: DataFrame, orders: DataFrame, items: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """Analytics and alerts from change logs."""
    registered = user_changes.groupBy("user_id").agg(F.min("updated_at").alias("registration_date"))
    users = cdc.latest_image(user_changes, ["user_id"], ["version"]).join(registered, "user_id")
    products = cdc.latest_image(product_changes, ["product_id"], ["version"])
    details = cdc.order_details(items, product_changes)
    profile = users.select("user_id", "email", "user_tier", "registration_date")
    named = user_changes.withColumns({"username": F.col("email"), "first_name": F.col("email")})
    return {
        "enhanced_orders": cdc.enhanced_orders(orders, user_changes, registered),
        "customer_analytics": cdc.customer_analytics(profile, orders, as_of),
        "product_analytics": cdc.product_analytics(products, details),
        "lifecycle_events": windows.change_events(
            user_changes, "user_id", ["version"], {"user_status": "STATUS_CHANGE", "user_tier": "TIER_CHANGE"}, "total_spent"
        ),
        "inventory_alerts": cdc.inventory_alerts(products),
        "user_alerts": quality.user_alerts(named, ["user_id", "version"]),
        "product_alerts": quality.product_alerts(product_changes, ["product_id", "version"]),
    }


def feature_job(entities: DataFrame, ts: str, views, label: Callable[[DataFrame], Column], columns, key: str) -> tuple[DataFrame, float]:
    """Point-in-time training set, a classifier and its scores for all rows."""
    training = features.historical_features(entities, ts, views).fillna(0.0)
    training = training.withColumn("label", label(training))
    model, accuracy = ml.train_tabular(training, columns, "label", "classifier", key, trees=20, depth=5)
    return model.transform(training).select(key, "label", "prediction"), accuracy


def federated_orders(files: DataFrame, other: DataFrame) -> DataFrame:
    """Orders of one source joined to users of another."""
    return joins.federated_join(files, other, ["user_id"])
