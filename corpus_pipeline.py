"""The corpus pipeline: toxicity, line dedup, MinHash near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written and read back as the next stage's docs. All stages
but the last return the columns of ``documents``. Stages on word shingles use five words and a similarity of at least 0.8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm.decontaminate import contaminated_removed
from tidewell.llm.lines import without_repeated_lines
from tidewell.llm.minhash import near_duplicates_removed
from tidewell.llm.packing import pack
from tidewell.llm.queries import table, vocabulary
from tidewell.llm.store import stored
from tidewell.llm.toxicity import toxic_removed


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxic_removed(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar lines the first stays; every document keeps its row."""
    return without_repeated_lines(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_duplicates_removed(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return contaminated_removed(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 ids, one row per piece of a document."""
    return pack(docs, vocabulary())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
