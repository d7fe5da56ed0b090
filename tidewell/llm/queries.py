"""Registered queries of the training-data operators, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle.strip()
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary())


@query("op7_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.substring import repeated_passages_removed

    return repeated_passages_removed(table(spark, sf_dir, "documents"))


@query("op6_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many lines it had and lost, and the digest of what is left."""
    from tidewell.llm.lines import lines_deduplicated

    left = lines_deduplicated(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "lines_in", "lines_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op9_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.embeddings import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op1_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.token_counts import line_token_counts

    return line_token_counts(table(spark, sf_dir, "documents"), vocabulary())


@query("op5_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.licenses import licenses

    return licenses(table(spark, sf_dir, "documents"))


@query("op4_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, ROW_NUMBER() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score QUALIFY rank <= 5""")
def hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector against all vectors; the label of every seventh vector is moved on by one first."""
    from tidewell.llm.negatives import hard_negatives

    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query("op12_source_mixing", r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, [3, 1, 2][1 + (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM d GROUP BY source),
l AS (SELECT *, (SUM(source_size) OVER () * 150 / 100 - SUM(2 * source_size) OVER w + 2 * source_size) / (SUM(weight) OVER () - SUM(weight) OVER w + weight) AS level
  FROM s WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
t AS (SELECT source, source_size, least(2 * source_size, weight * MAX(level) OVER ()) AS target FROM l),
k AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS times FROM t),
c AS (SELECT source, h, CAST(SUM(size) AS BIGINT) AS words, CAST(SUM(SUM(size)) OVER (PARTITION BY source ORDER BY h) - SUM(size) AS BIGINT) AS before FROM d GROUP BY source, h)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target, CAST(times * size + CASE WHEN before + words <= rest THEN size
  WHEN before <= rest AND words > 0 THEN CAST(size AS HUGEINT) * (rest - before) // words ELSE 0 END AS BIGINT) AS taken
FROM d JOIN (SELECT *, CAST(floor(target) AS BIGINT) - times * source_size AS rest FROM k) AS k ON d.source IS NOT DISTINCT FROM k.source
  JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h""")
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix with half as many words again as there are takes of each document."""
    from tidewell.llm.mixing import mixed

    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op13_importance_resampling")
def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn towards the texts of the benchmark."""
    from tidewell.llm.resampling import resampled

    ranks = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")
