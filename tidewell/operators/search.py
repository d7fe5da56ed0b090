"""Vector and scored search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ordering import top_k_per

BLOCK = 8192
CHUNK_CELLS = 1 << 21


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _matrix(table: pa.Table) -> np.ndarray:
    return _unit(np.array(table["vector"].to_pylist(), dtype=np.float64))


def _best_of_block(searches: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The best ``k`` rows of a block per search of a block: best score first and the smaller id on a tie."""
    if not searches.num_rows or not rows.num_rows:
        empty = pa.table({"query_id": searches["id"], "id": searches["id"], "score": pa.nulls(searches.num_rows, pa.float64())}).slice(0, 0)
        return pa.table({"query_id": empty["query_id"], "id": rows["id"].slice(0, 0), "score": empty["score"]})
    rows = rows.sort_by("id")
    left, right = _matrix(searches), _matrix(rows)
    step = max(1, CHUNK_CELLS // rows.num_rows)
    places, scores = [], []
    for low in range(0, len(left), step):
        near = np.round(left[low : low + step] @ right.T, 10)
        order = np.argsort(-near, axis=1, kind="stable")[:, :k]
        places.append(order)
        scores.append(np.take_along_axis(near, order, axis=1))
    places, scores = np.concatenate(places), np.concatenate(scores)
    at = pa.array(np.repeat(np.arange(searches.num_rows), places.shape[1]))
    return pa.table({"query_id": searches["id"].take(at), "id": rows["id"].take(pa.array(places.ravel())), "score": pa.array(scores.ravel())})


def cosine_topk(vectors: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """Exact cosine top-k: (query_id, id, score, rank), for any number of searches.

    Searches and vectors are dealt to blocks of about ``block`` rows by a hash of the id. Every block of searches meets every block of vectors in a task
    of its own, which does one matrix product a few searches at a time and keeps the best ``k`` per search; a grouped top-k merges those. A vector is
    shuffled once per block of searches and a search once per block of vectors. Rows without a vector take no part; a zero vector scores 0.
    """
    def blocks_of(df: DataFrame) -> int:
        return max(1, -(-df.count() // block))

    n_rows, n_searches = blocks_of(vectors), blocks_of(queries)

    def dealt(df: DataFrame, seed: int, own: int, others: int, cell) -> DataFrame:
        side = df.filter(F.col(vector).isNotNull()).select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        met = side.withColumns({"own": F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(own)), "other": F.explode(F.sequence(F.lit(0), F.lit(others - 1)))})
        # New names, as both sides may come from one table.
        return met.withColumn("cell", cell(F.col("own"), F.col("other")).cast("long")).select("cell", "id", "vector").toDF("cell", "id", "vector")

    searches = dealt(queries, 1, n_searches, n_rows, lambda own, other: other * n_searches + own)
    rows = dealt(vectors, 2, n_rows, n_searches, lambda own, other: own * n_searches + other)
    query_type, id_type = queries.schema[id_column].dataType.simpleString(), vectors.schema[id_column].dataType.simpleString()
    found = searches.groupBy("cell").cogroup(rows.groupBy("cell")).applyInArrow(
        lambda a, b: _best_of_block(a, b, k), f"query_id {query_type}, id {id_type}, score double"
    )
    return top_k_per(found.withColumnRenamed("id", id_column), ["query_id"], ["-score", id_column], k)


def scored_filter(df: DataFrame, must: Sequence[Column], should: Mapping[str, tuple[Column, float]], min_score: float = 0.0) -> DataFrame:
    """Rows that meet every ``must``, with the sum of the weights of the ``should`` clauses they meet."""
    for condition in must:
        df = df.filter(condition)
    score = reduce(lambda a, b: a + b, [F.when(c, w).otherwise(0.0) for c, w in should.values()], F.lit(0.0))
    matched = F.array_compact(F.array(*[F.when(c, n) for n, (c, _) in should.items()]))
    return df.withColumns({"score": score, "matched": matched}).filter(F.col("score") >= min_score)
