"""Queries by name, each with the ANSI SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain_types(df: DataFrame) -> DataFrame:
    """Times as naive UTC and decimals as DOUBLE, so that rows compare across engines."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz").alias(field.name)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def query(name: str, oracle: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_types(build(Tables(spark, sf_dir)))

        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle.strip()
        return build

    return register
