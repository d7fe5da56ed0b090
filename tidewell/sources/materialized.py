"""Named results kept as Parquet with an age limit."""

from __future__ import annotations

import fnmatch
import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "name string, path string, plan_hash long, created_at double, is_dropped boolean"


class ResultStore:
    """Results under ``root`` with a log of (name, path, plan, time). The last entry of a name counts.

    An entry is used while it is younger than ``ttl`` seconds and belongs to the same plan.
    """

    def __init__(self, spark: SparkSession, root: str, clock: Callable[[], float] = time.time):
        self.spark, self.root, self.clock = spark, root.rstrip("/"), clock

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/log")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def _append(self, name: str, path: str, plan_hash: int, dropped: bool) -> None:
        row = [(name, path, plan_hash, float(self.clock()), dropped)]
        self.spark.createDataFrame(row, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def live(self) -> DataFrame:
        latest = self._log().groupBy("name").agg(F.max_by(F.struct("path", "plan_hash", "created_at", "is_dropped"), "created_at").alias("e"))
        return latest.select("name", "e.*").filter(~F.col("is_dropped")).drop("is_dropped")

    def materialize(self, name: str, df: DataFrame, ttl: float) -> DataFrame:
        plan_hash = df.semanticHash()
        entry = self.live().filter((F.col("name") == name) & (F.col("plan_hash") == plan_hash)).first()
        if entry and self.clock() - entry["created_at"] < ttl:
            return self.spark.read.parquet(entry["path"])
        path = f"{self.root}/data/{name}/{time.time_ns()}"
        df.write.parquet(path)
        self._append(name, path, plan_hash, False)
        return self.spark.read.parquet(path)

    def invalidate(self, pattern: str) -> list[str]:
        """Forget all names that match; their files stay until the folder's own retention removes them."""
        names = [r["name"] for r in self.live().select("name").collect() if fnmatch.fnmatch(r["name"], pattern)]
        for name in names:
            self._append(name, "", 0, True)
        return names

    def warm(self, results: Mapping[str, DataFrame], ttl: float) -> None:
        for name, df in results.items():
            self.materialize(name, df, ttl)
