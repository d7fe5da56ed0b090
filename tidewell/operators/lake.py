"""Layout and life cycle of file-backed tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def compact(spark: SparkSession, path: str, out: str, target_mb: int = 256, partition_by: Sequence[str] = ()) -> DataFrame:
    """Rewrite small files into about ``target_mb`` each at a new path and read the result back."""
    df = spark.read.parquet(path)
    size = df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s")).groupBy("p").agg(
        F.first("s").alias("s")
    )
    total = size.agg(F.sum("s")).first()[0] or 0
    files = max(1, -(-total // (target_mb * 1024 * 1024)))
    if partition_by:
        # Rows of one partition value go to a few tasks chosen by a hash of the row, so a huge value is split too, alike after a retry.
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c not in partition_by]), F.lit(files))
        df = df.withColumn("__spread", spread).repartition(*partition_by, "__spread").drop("__spread")
        df.write.partitionBy(*partition_by).parquet(out)
    else:
        df.repartition(files).write.parquet(out)
    return spark.read.parquet(out)


def quantile_edges(df: DataFrame, columns: Sequence[str], bits: int) -> list[list[float]]:
    """``2**bits - 1`` approximate quantiles per column, from one pass."""
    steps = [i / 2**bits for i in range(1, 2**bits)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), steps).alias(c) for c in columns]).first()
    return [sorted(set(row[c] or [])) for c in columns]


def z_value(df: DataFrame, columns: Sequence[str], edges: Sequence[Sequence[float]], name: str = "z") -> DataFrame:
    """Interleave the bits of each column's bucket number; values on an edge belong to the upper bucket."""
    inf = float("inf")
    out = df
    cells = []
    for column, cut in zip(columns, edges):
        cell = f"__cell_{column}"
        out = Bucketizer(splits=[-inf, *cut, inf], inputCol=f"__in_{column}", outputCol=cell, handleInvalid="keep").transform(
            out.withColumn(f"__in_{column}", F.col(column).cast("double"))
        )
        cells.append((F.col(cell).cast("long"), max(1, len(cut).bit_length())))
    z = F.lit(0).cast("long")
    for bit in range(max(b for _, b in cells)):
        for position, (cell, _) in enumerate(cells):
            moved = F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(cells) + position)
            z = z.bitwiseOR(moved)
    return out.withColumn(name, z).drop(*[f"__{k}_{c}" for k in ("in", "cell") for c in columns])


def zorder(df: DataFrame, columns: Sequence[str], bits: int = 8, edges: Sequence[Sequence[float]] | None = None) -> DataFrame:
    """Cluster rows so that files cover small ranges of all ``columns``; equal values may span files."""
    marked = z_value(df, columns, edges or quantile_edges(df, columns, bits), "__z")
    order = ["__z", *columns]
    return marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("__z")


def retain(df: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    """Rows of the last ``days``: a bare range on the time column, so partitions and row groups are skipped."""
    return df.filter(F.col(ts) >= F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp"))


def storage_tier(df: DataFrame, ts: str, as_of: str, hot_days: int, warm_days: int) -> DataFrame:
    age = F.datediff(F.lit(as_of).cast("date"), ts)
    return df.withColumn("storage_tier", F.when(age <= hot_days, "hot").when(age <= warm_days, "warm").otherwise("cold"))


@dataclass(frozen=True)
class Medallion:
    """Bronze to silver to gold, defined once for tables and streams."""

    silver: Callable[[DataFrame], DataFrame]
    gold: Callable[[DataFrame], DataFrame]

    def apply(self, bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
        silver = self.silver(bronze)
        return silver, self.gold(silver)
