"""Batch and stream writers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ordering import top_k_per

ROWS_PER_FILE = 5_000_000


def write_csv_report(df: DataFrame, path: str) -> None:
    """One CSV file with header; for small results such as top-k reports and grouped summaries."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def dealt(df: DataFrame, columns: Sequence[str], spread: int = 1) -> DataFrame:
    """Rows of one value in one task, or in ``spread`` tasks where values may be huge."""
    if spread <= 1:
        return df.repartition(*columns)
    df = df.withColumn("__spread", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(spread)))
    return df.repartition(*columns, "__spread").drop("__spread")


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite", spread: int = 1) -> None:
    """Partitioned Parquet with one writer task per value, or ``spread`` tasks where values may be huge; 0 writes rows that are ``dealt`` already."""
    if spread:
        df = dealt(df, columns, spread)
    df.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*columns).parquet(path)


def write_sample(df: DataFrame, path: str, fraction: float = 0.1, seed: int = 42) -> None:
    df.sample(fraction=fraction, seed=seed).write.mode("overwrite").parquet(path)


def jdbc_write_options(url: str, table: str, batch_size: int = 1000) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), "isolationLevel": "READ_COMMITTED"}


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 1000, connections: int = 16) -> None:
    """Relational table through at most ``connections`` parallel writers."""
    df.repartition(connections).write.format("jdbc").options(**jdbc_write_options(url, table, batch_size)).mode(mode).save()


class UpsertSink:
    """Primary-key upsert of micro-batches into a Parquet table.

    Keys are hashed to buckets. A batch rewrites only the buckets it touches, under
    ``v=<batch id>``, and then writes a marker with their numbers; readers take the newest
    marked version of every bucket. A replayed batch id rewrites the same files, so the
    result is exactly once. Of the rows of a key the greatest by ``order`` counts, in whichever batch it came; a tie goes to either.
    """

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64):
        self.path, self.keys, self.order, self.buckets = path, list(keys), list(order), buckets

    def _newest(self, spark, before: int | None = None) -> dict[int, int]:
        """Newest version per bucket: at most ``buckets`` rows."""
        try:
            marks = spark.read.schema("bucket int, n long").parquet(f"{self.path}/done/*")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return {}
        if before is not None:
            marks = marks.filter(F.col("n") < before)
        return {r["bucket"]: r["n"] for r in marks.groupBy("bucket").agg(F.max("n").alias("n")).collect()}

    def _read(self, spark, versions: Mapping[int, int]) -> DataFrame | None:
        paths = [f"{self.path}/v={n}/bucket={b}" for b, n in sorted(versions.items())]
        return spark.read.parquet(*paths) if paths else None

    def current(self, spark) -> DataFrame | None:
        return self._read(spark, self._newest(spark))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

        def newest(rows: DataFrame) -> DataFrame:
            return top_k_per(rows, self.keys, [f"-{o}" for o in self.order], 1, "__first").drop("__first")

        updates = newest(batch).persist()
        try:
            touched = [r[0] for r in updates.select(bucket.alias("b")).distinct().collect()]
            older = {b: n for b, n in self._newest(spark, batch_id).items() if b in set(touched)}
            target = self._read(spark, older)
            # Rows of a key that came in an earlier batch may still be the newest.
            merged = newest(target.select(*updates.columns).union(updates)) if target is not None else updates
            version = f"{self.path}/v={batch_id}"
            merged.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(version)
            marks = spark.createDataFrame([(b, batch_id) for b in touched], "bucket int, n long")
            marks.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/done/v={batch_id}")
        finally:
            updates.unpersist()


def jdbc_upsert_batch(
    url: str, staging: str, keys: Sequence[str], order: Sequence[str], clear: Callable[[int], None], merge: Callable[[int], None],
    batch_size: int = 1000, write_rows: Callable = write_jdbc,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` upsert for a database: one row per key goes to a staging table tagged with the batch id, after ``clear(batch_id)``
    has removed what an earlier try left there; then ``merge(batch_id)`` runs the database's own MERGE for that id. All may be repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        clear(batch_id)
        rows = top_k_per(batch, list(keys), [f"-{o}" for o in order], 1, "__first").drop("__first")
        write_rows(rows.withColumn("batch_id", F.lit(batch_id)), url, staging, "append", batch_size)
        merge(batch_id)

    return write


def file_stream_sink(df: DataFrame, path: str, checkpoint: str, trigger: Mapping | None = None, partition_by: Sequence[str] = ()):
    """Append finished rows to Parquet; file sink and checkpoint make it exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()


def memory_sink(df: DataFrame, name: str, mode: str = "append"):
    """For tests only: the result is held by the driver."""
    return df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()


def console_sink(df: DataFrame, mode: str = "update", rows: int = 20, trigger: str = "30 seconds"):
    return (
        df.writeStream.format("console").option("numRows", rows).option("truncate", False).outputMode(mode)
        .trigger(processingTime=trigger).start()
    )


def time_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts)})


def partitioned_ingest(stream: DataFrame, ts: str, path: str, checkpoint: str, by: Sequence[str] = ("region",), trigger: Mapping | None = None):
    """Stream into folders by ``by`` and time parts."""
    return file_stream_sink(time_parts(stream, ts), path, checkpoint, trigger or {"availableNow": True}, [*by, "year", "month", "day"])


def fan_out(outputs: Mapping[str, tuple[Column, Callable[[DataFrame, int], None]]]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` that reads a batch once and hands each subset to its writer."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for condition, writer in outputs.values():
                writer(batch.filter(condition), batch_id)
        finally:
            batch.unpersist()

    return write


def raw_event_rows(df: DataFrame, keys: Sequence[str] = ("event_type", "user_id")) -> DataFrame:
    """Event rows with all other fields as a map of strings, and where the message came from."""
    position = [c for c in ("topic", "partition", "offset") if c in df.columns]
    fields = [c for c in df.columns if c not in keys and c not in position]
    pairs = [x for c in fields for x in (F.lit(c), F.col(c).cast("string"))]
    data = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
    return df.select(F.coalesce("event_type", F.lit("unknown")).alias("event_type"), "user_id", data.alias("data"), *position)


def user_activity_rows(df: DataFrame, ts: str) -> DataFrame:
    """One row per event with a known user, keyed by user and day."""
    known = df.filter(F.col("user_id").isNotNull())
    return known.select(
        "user_id", F.to_date(ts).alias("activity_date"), F.col(ts).alias("activity_time"), "event_id",
        F.col("event_type").alias("activity_type"), "session_id",
    )


def dual_write_events(events_path: str, activity_path: str, ts: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` that stores raw events by type and user activity by day; a batch id overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            raw_event_rows(batch).write.mode("overwrite").partitionBy("event_type").parquet(f"{events_path}/batch_id={batch_id}")
            user_activity_rows(batch, ts).write.mode("overwrite").partitionBy("activity_date").parquet(f"{activity_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def write_report(df: DataFrame, path: str) -> None:
    """Metrics rows as JSON lines in one file."""
    df.repartition(1).write.mode("overwrite").json(path)
