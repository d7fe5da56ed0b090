"""Run a stream over the data at hand and read the committed output."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.lake import Medallion
from tidewell.operators.scan import with_position
from tidewell.session import scratch_path, shuffles_freed

#: A replayed batch has a file for so many rows, as far as there are cores to write them.
ROWS_PER_FILE = 10_000

#: A batch of a replay in order of time has about so many rows: what its groups hold until the watermark passes them bounds the state.
ROWS_PER_BATCH = 2_000_000

#: State stores per core: each one costs files and time in every batch.
STORES_PER_CORE = 2


@contextmanager
def few_stores(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in a few stores per core, however many partitions a large shuffle has. A checkpoint keeps its number."""
    stores = min(int(spark.conf.get("spark.sql.shuffle.partitions")), STORES_PER_CORE * spark.sparkContext.defaultParallelism)
    own = {"spark.sql.shuffle.partitions": str(stores), "spark.sql.streaming.maxBatchesToRetainInMemory": "1"}
    before = {name: spark.conf.get(name, None) for name in own}
    try:
        for name, value in own.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_available(stream: DataFrame, label: str, checkpoint: str | None = None, out: str | None = None) -> DataFrame:
    """Process everything available, append finished rows to Parquet and return them."""
    spark = stream.sparkSession
    out = out or scratch_path(spark, f"{label}-out")
    schema = stream.schema
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint or scratch_path(spark, f"{label}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(out)


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], label: str, mode: str = "append",
                checkpoint: str | None = None) -> None:
    """Process everything available through ``foreachBatch``."""
    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint or scratch_path(stream.sparkSession, f"{label}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _append_batch(rows: DataFrame, path: str, files: int, part: int) -> None:
    """Batch number ``part`` of a replay as exactly so many files."""
    spark = rows.sparkSession
    rows.repartition(files).write.mode("append").parquet(path)
    # Spark writes no file for an empty task.
    for _ in range(len(spark.read.schema(rows.schema).parquet(path).inputFiles()), files * (part + 1)):
        spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(path)


def replay(table: DataFrame, ts: str, parts: int, lateness_us: Column, label: str) -> DataFrame:
    """A table as a file stream that comes out of order: a row arrives ``lateness_us`` after its time, and arrivals are cut into ``parts`` batches of
    equal length. A watermark delay above the greatest lateness loses no row. Batches are written one after another, as a stream takes files by age.

    Every batch is the same number of files, so that the stream takes it whole whatever the layout of the table: of a batch in pieces, the first
    would move the watermark past rows of the others.
    """
    spark = table.sparkSession
    path = scratch_path(spark, f"{label}-replay")
    arrival = F.unix_micros(F.col(ts).cast("timestamp")) + lateness_us
    first, last, rows = table.agg(F.min(arrival), F.max(arrival), F.count(F.lit(1))).first()
    files = max(1, min(spark.sparkContext.defaultParallelism, rows // (parts * ROWS_PER_FILE)))
    for part in range(parts):
        low, high = (first + (last + 1 - first) * k // parts for k in (part, part + 1)) if first is not None else (0, 0)
        _append_batch(table.filter((arrival >= low) & (arrival < high)), path, files, part)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(path)


def in_order(table: DataFrame, ts: str, label: str, rows_per_batch: int = ROWS_PER_BATCH) -> DataFrame:
    """A table as a file stream that comes in order of time, in batches of about ``rows_per_batch`` rows: no row is late, whatever the watermark's
    delay, and a window's state goes as soon as the batches are past it. Rows without a time come with the first batch.
    """
    spark = table.sparkSession
    path = scratch_path(spark, f"{label}-in-order")
    time = F.unix_micros(F.col(ts).cast("timestamp"))
    parts = max(1, -(-table.count() // rows_per_batch))
    cuts = sorted(set(table.agg(F.percentile_approx(time, [k / parts for k in range(1, parts)], 10_000)).first()[0] or [])) if parts > 1 else []
    files = max(1, min(spark.sparkContext.defaultParallelism, rows_per_batch // ROWS_PER_FILE))
    parted = table
    if cuts:
        # Rows are parted in one pass, however many batches there are.
        place = scratch_path(spark, f"{label}-parts")
        with shuffles_freed(spark):
            with_position(table, "__part", time, cuts).repartition(len(cuts) + 1, "__part").write.partitionBy("__part").parquet(place)
        parted = spark.read.parquet(place)
    for part in range(len(cuts) + 1):
        rows = parted.filter(F.col("__part") == part) if cuts else parted
        _append_batch(rows.select(*table.columns), path, files, part)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(path)


def medallion_stream(flow: Medallion, bronze: DataFrame, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bronze, silver and gold as tables, each written by a stream over the files of the one before.

    Each level has a checkpoint of its own under ``path``, so a later call goes on where this one ended.
    """
    spark = bronze.sparkSession

    def level(stream: DataFrame, name: str) -> DataFrame:
        return run_available(stream, name, f"{path}/{name}-checkpoint", f"{path}/{name}")

    def again(table: DataFrame, name: str) -> DataFrame:
        return spark.readStream.schema(table.schema).parquet(f"{path}/{name}")

    raw = level(bronze, "bronze")
    silver = level(flow.silver(again(raw, "bronze")), "silver")
    return raw, silver, level(flow.gold(again(silver, "silver")), "gold")
