"""Session settings, scratch locations and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

FREE_SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Work that is stored in slices takes a slice for so many bytes of the files it reads.
SLICE_BYTES_CONF = "spark.tidewell.sliceBytes"
SLICE_BYTES_DEFAULT = 1024**3

_local_scratch: dict[str, str] = {}
_shipped: set[str] = set()


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "12g", **conf) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidewell")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """All event times are read and written as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that its functions run whatever their working folder is.

    The archive lies in a folder of the driver, whose file server hands it out.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidewell-")) / "tidewell-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall
    back to a folder of its own, since there driver and executors share a disk.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="tidewell-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for intermediate tables and stream output."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint that outlives lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the action that wrote them is over, not when the driver happens to collect its garbage."""
    before = spark.conf.get(FREE_SHUFFLES_CONF, None)
    spark.conf.set(FREE_SHUFFLES_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES_CONF) if before is None else spark.conf.set(FREE_SHUFFLES_CONF, before)


def slice_count(df: DataFrame) -> int:
    """One slice for every ``SLICE_BYTES_CONF`` bytes of the files that ``df`` reads."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(file) for file in df.inputFiles()]
    size = sum(path.getFileSystem(conf).getFileStatus(path).getLen() for path in paths)
    return max(1, -(-size // int(spark.conf.get(SLICE_BYTES_CONF, str(SLICE_BYTES_DEFAULT)))))


def slices(df: DataFrame, by: Sequence[str], count: int | None = None) -> list[DataFrame]:
    """``df`` cut by the hash of ``by`` into slices that may be computed one after another; rows equal in ``by`` share one."""
    n = slice_count(df) if count is None else count
    return [df.filter(F.pmod(F.xxhash64(*[F.col(c) for c in by]), F.lit(n)) == k) for k in range(n)] if n > 1 else [df]


def write_slices(parts: Sequence[DataFrame], write: Callable[[DataFrame, str], None]) -> None:
    """Write one part after another by ``write(part, mode)``: the disk holds the shuffle files of one part at a time."""
    with shuffles_freed(parts[0].sparkSession):
        for k, part in enumerate(parts):
            write(part, "append" if k else "overwrite")


def stored(parts: Sequence[DataFrame], label: str) -> DataFrame:
    """The rows of all parts as Parquet, written by ``write_slices``."""
    spark = parts[0].sparkSession
    path = scratch_path(spark, label)
    write_slices(parts, lambda part, mode: part.write.mode(mode).option("compression", "zstd").parquet(path))
    out = spark.read.schema(parts[0].schema).parquet(path)
    out._stored_at = path
    return out


def forget(df: DataFrame) -> None:
    """Remove the files of a ``stored`` table that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def needs_rocksdb(spark: SparkSession) -> None:
    """Keyed state with timers requires the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
