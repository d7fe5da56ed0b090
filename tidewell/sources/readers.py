"""Batch readers with declared schemas, and what a session's catalog holds."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALES_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("is_premium", T.BooleanType()),
        T.StructField("region", T.StringType()),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True) -> DataFrame:
    """CSV with a declared schema; without one the types are inferred by an extra pass."""
    reader = spark.read.option("header", header)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet folder; partition columns are found from the folder names."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line."""
    return spark.read.text(path)


def jdbc_options(
    url: str, table: str, partition_column: str | None = None, bounds: tuple[str, str] | None = None,
    num_partitions: int = 8, fetch_size: int = 10_000, properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read, split by ranges of ``partition_column`` when bounds are known."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if partition_column and bounds:
        options |= {
            "partitionColumn": partition_column, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": str(num_partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str | None = None, num_partitions: int = 8,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Relational table; with a partition column its bounds are asked for first and the read runs in parallel."""
    bounds = None
    if partition_column:
        question = f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}) bounds"
        row = spark.read.format("jdbc").options(**jdbc_options(url, question, properties=properties)).load().first()
        if row[0] is not None:
            bounds = (str(row[0]), str(row[1]))
    options = jdbc_options(url, table, partition_column, bounds, num_partitions, properties=properties)
    return spark.read.format("jdbc").options(**options).load()


def _or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """A table, or None where its path is not there yet."""
    try:
        return read()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def read_incremental(read: Callable[[], DataFrame], ts: str, marks: str, source: str, spark: SparkSession, keys: Sequence[str] = ()) -> tuple[DataFrame, Callable[[], None]]:
    """Rows newer than the last committed high mark of ``source``, and a function that commits the new mark.

    The upper bound is fixed before the load, and a load is (last bound, bound]: rows that come in meanwhile belong to the next one. With ``keys``, which
    tell rows apart, a load is exact at its edges too: the keys of the rows that carry the bound's very timestamp are stored before the load,
    only those are loaded, and the next load overlaps by that timestamp and leaves them out. A row that arrives later with the bound's own time is
    then loaded once. Without keys such a row is lost, so the bound must lag behind the source. The filters on time are bare comparisons, which
    are pushed to the source. Commit after the rows are written; a load that failed is simply repeated.
    """
    schema = "mark timestamp, source string"
    known = _or_none(lambda: spark.read.schema(schema).parquet(f"{marks}/marks"))
    last = known.filter(F.col("source") == source).agg(F.max("mark")).first()[0] if known is not None else None
    rows = read()
    bound = rows.agg(F.max(ts).cast("timestamp")).first()[0]

    def commit_mark() -> None:
        if bound is not None:
            spark.createDataFrame([(bound, source)], schema).coalesce(1).write.mode("append").parquet(f"{marks}/marks")

    if bound is None:
        return rows.limit(0), commit_mark
    until = rows.filter(F.col(ts) <= F.lit(bound))
    if not keys:
        return until.filter(F.col(ts) > F.lit(last)) if last is not None else until, commit_mark

    edge_schema = T.StructType([T.StructField("mark", T.TimestampType()), T.StructField("source", T.StringType()), *rows.select(*keys).schema.fields])
    seen = _or_none(lambda: spark.read.schema(edge_schema).parquet(f"{marks}/edges"))

    def met(side: DataFrame, edge: DataFrame, how: str) -> DataFrame:
        named = edge.select(*[F.col(f"`{k}`").alias(f"__{i}") for i, k in enumerate(keys)])
        return side.join(named, reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]), how)

    overlap = until if last is None else until.filter(F.col(ts) >= F.lit(last))
    fresh = overlap if last is None else overlap.filter(F.col(ts) > F.lit(last))
    if last is not None and seen is not None:
        before = seen.filter((F.col("source") == source) & (F.col("mark") == F.lit(last)))
        fresh = fresh.unionByName(met(overlap.filter(F.col(ts) == F.lit(last)), before, "left_anti"))
    pending = f"{marks}/pending-{uuid.uuid4().hex}"
    fresh.filter(F.col(ts) == F.lit(bound)).select(F.lit(bound).alias("mark"), F.lit(source).alias("source"), *keys).write.parquet(pending)
    edge = spark.read.schema(edge_schema).parquet(pending)
    load = fresh.filter(F.col(ts) < F.lit(bound)).unionByName(met(fresh.filter(F.col(ts) == F.lit(bound)), edge, "left_semi"))

    def commit() -> None:
        edge.write.mode("append").parquet(f"{marks}/edges")
        commit_mark()

    return load, commit


def register_views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> list[str]:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)


def catalog_tables(spark: SparkSession) -> DataFrame:
    """Tables and views of every database of the current catalog."""
    rows = [
        (t.catalog, ".".join(t.namespace or []), t.name, t.tableType, t.isTemporary)
        for db in spark.catalog.listDatabases()
        for t in spark.catalog.listTables(db.name)
    ]
    return spark.createDataFrame(
        sorted(set(rows), key=str), "catalog string, namespace string, name string, kind string, is_temporary boolean"
    )


def describe(df: DataFrame) -> DataFrame:
    """Columns of a frame: position, name, type, nullable."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
