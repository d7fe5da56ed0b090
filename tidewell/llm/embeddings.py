"""Near-duplicate vectors by Euclidean p-stable hashing of normalised vectors.

A table's key is the cells of ``PROJECTIONS`` random projections, shifted and cut into cells of ``WIDTH``. Vectors that share a key in any
of ``TABLES`` tables are compared by exact cosine in double precision, block against block as matrix products. A pair counts in
the first table in which it shares a key, so it counts once. By the collision formula a pair at cosine 0.9 is found with a probability of 0.99,
a closer one more surely. Equal vectors are one class from the start and are counted, not compared.

Buckets are cut into blocks of ``BLOCK_ROWS`` vectors, and two blocks at a time are compared, so a hot bucket is spread over many tasks. A task
takes its block pairs in order of the key, many small ones from one Arrow batch, and holds one at a time. No list of
pairs leaves a task: per vector a number of links, and one edge per vector and block to the first vector linked there. Those edges
would not join all of a block's classes on their own, so every block also links the vectors it found similar by a spanning forest.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; so do rows without an id, which are kept. Vectors
of different lengths never link; those of each length are searched among their own. Components of any size are scaled by a power of two before the
norm, so that squares neither over- nor underflow. Other columns are not read. Rows that share an id and a vector count as links of each other's copies only once. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.store import components, discard, forest, stored
from tidewell.llm.texthash import mix

PROJECTIONS, TABLES, WIDTH = 12, 48, 2.0
BLOCK_ROWS = 1024


def units(matrix: np.ndarray) -> np.ndarray:
    """The rows at length 1, scaled by a power of two first, which changes no digit."""
    _, exponent = np.frexp(np.abs(matrix).max(axis=1, keepdims=True))
    scaled = np.ldexp(matrix, -exponent)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def keys_of(unit: np.ndarray, seed: int = 11) -> np.ndarray:
    """One 64-bit key per vector and table; it depends on the vectors' length too."""
    random = np.random.default_rng(seed)
    lines = random.standard_normal((unit.shape[1], TABLES * PROJECTIONS))
    shift = random.uniform(0, WIDTH, TABLES * PROJECTIONS)
    cells = np.floor((unit @ lines + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), TABLES, PROJECTIONS)
    keys = np.broadcast_to(np.arange(1, TABLES + 1, dtype=np.uint64) + np.uint64(unit.shape[1] << 8), cells.shape[:2]).copy()
    for k in range(PROJECTIONS):
        keys = mix(keys + np.uint64(0x9E3779B97F4A7C15)) ^ mix(cells[:, :, k] + np.uint64(k))
    return mix(keys)


def _hashed(vectors: DataFrame) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes = np.asarray(part.column(1).value_lengths())
            for size in np.unique(sizes).tolist():
                alike = np.flatnonzero(sizes == size)
                for low in range(0, len(alike), 2048):
                    piece = part.take(pa.array(alike[low : low + 2048]))
                    matrix = np.asarray(piece.column(1).flatten()).reshape(piece.num_rows, size)
                    keys = keys_of(units(matrix)).view(np.int64)
                    lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, TABLES, dtype=np.int32), pa.array(keys.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), lists], names=["rep", "v", "keys"])

    return vectors.mapInArrow(run, "rep long, v array<double>, keys array<long>")


PAIR = ["key", "table", "one", "two"]


def _links(rows: pa.Table, threshold: float) -> list[tuple]:
    """Links of one pair of blocks, as (id, None, links weighted by copies) and edges (id, other, 0)."""
    table, one, two = (rows[c][0].as_py() for c in PAIR[1:])
    block = np.asarray(rows["block"])
    ids, copies, unit = np.asarray(rows["rep"]), np.asarray(rows["copies"]), units(np.stack([np.asarray(v.values) for v in rows["v"]]))
    a, b = np.flatnonzero(block == one), np.flatnonzero(block == two)
    similar = unit[a] @ unit[b].T >= threshold
    if one == two:
        np.fill_diagonal(similar, False)
    left, right = np.nonzero(similar)
    if len(left) and table:
        keys = np.stack([np.asarray(k.values) for k in rows["keys"]])[:, :table]
        for k in range(0, len(left), 1 << 16):
            r, c = left[k : k + (1 << 16)], right[k : k + (1 << 16)]
            earlier = (keys[a[r]] == keys[b[c]]).any(axis=1)
            similar[r[earlier], c[earlier]] = False
    if not similar.any():
        return []
    sides = [(a, similar @ copies[b])] + ([] if one == two else [(b, copies[a] @ similar)])
    out = [(i, None, n) for side, counts in sides for i, n in zip(ids[side].tolist(), counts.tolist(), strict=True) if n]
    return out + [(p, q, 0) for p, q in forest(similar, ids[a], ids[b])]


def _compared(blocks: DataFrame, threshold: float) -> DataFrame:
    """(id, other, n) over all pairs of blocks."""

    def batch(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "other", "n"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for part in parts:
            rows = pa.Table.from_batches([part])
            rows = (pa.concat_tables([waiting, rows]) if waiting is not None else rows).combine_chunks()
            names = np.stack([np.asarray(rows[c]).astype(np.int64) for c in PAIR])
            starts = np.concatenate(([0], np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1)) if rows.num_rows else np.zeros(1, np.int64)
            found = []
            for low, high in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                found += _links(rows.slice(low, high - low), threshold)
            # The last block pair may go on in the next batch.
            waiting = rows.slice(int(starts[-1]))
            yield batch(found)
        if waiting is not None and waiting.num_rows:
            yield batch(_links(waiting, threshold))

    laid = blocks.repartition(*PAIR).sortWithinPartitions(*PAIR)
    return laid.mapInArrow(run, "id long, other long, n long")


def near_vectors(vectors: DataFrame, threshold: float = 0.9, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links (other rows linked directly), component_id (least id reachable by links), kept."""
    given = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # A vector with components but none other than zero has no direction.
    fits = F.coalesce(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    marked = given.withColumn("fits", fits).withColumn("print_a", F.xxhash64("v")).withColumn("print_b", F.xxhash64("v", F.lit(1)))
    once = marked.filter("fits").select("vec_id", "v", "print_a", "print_b").dropDuplicates(["vec_id", "print_a", "print_b"])
    classes = stored(once.groupBy("print_a", "print_b").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v")), "vector-classes")
    hashed = stored(_hashed(classes.select("rep", "v")).join(classes.select("rep", "copies"), "rep"), "vector-keys", free=True)
    in_table = hashed.select("rep", F.posexplode("keys").alias("table", "key"))
    sizes = in_table.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").withColumn("blocks", F.ceil(F.col("m") / BLOCK_ROWS).cast("int"))
    placed = in_table.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("one"), F.greatest("block", k).alias("two")))
    paired = placed.withColumn("pair", F.explode(others)).select("rep", "key", "table", "block", "pair.one", "pair.two")
    blocks = paired.join(hashed, "rep").select("rep", "key", "table", "block", "one", "two", "v", "keys", "copies")
    found = stored(_compared(blocks, threshold), "vector-links", free=True)
    links = found.filter("other is null").groupBy("id").agg(F.sum("n").alias("n"))
    label = components(found.filter("other is not null"), "id", "other")
    of_class = classes.select("print_a", "print_b", "rep", "copies").join(links.toDF("rep", "n"), "rep", "left").join(label.toDF("rep", "component"), "rep", "left")
    of_class = stored(of_class.select("print_a", "print_b", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("component")), "vector-result")
    discard(classes, hashed, found)
    joined = marked.join(of_class, ["print_a", "print_b"], "left")
    out = joined.select(
        "vec_id", F.when(F.col("fits"), F.col("n")).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("fits"), F.col("component")).otherwise(F.col("vec_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
