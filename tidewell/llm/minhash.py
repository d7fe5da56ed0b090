"""Near-duplicate documents by one-permutation MinHash with optimal densification.

One hash of every distinct shingle is cut into a bin number and a value; the least value of each bin is the sketch. An empty bin
borrows from the first non-empty bin of its own fixed random order, so each bin is an unbiased sample of the set. Rows of bins form
bands; documents that agree on a whole band share a bucket. A bucket proposes a star, every member with its first member, not all
pairs. Only members left outside the class of their bucket's centre are compared further. Links are confirmed on full sets.

Null or empty texts have an empty set and link with nothing. Rows with equal sets form one class before any search, so copies are
never compared. A row whose id is null is kept, without a component. Rows that share an id are told apart by their texts: each has the
component of its own text, and only those are dropped whose component has a smaller id. Texts are read whole at any length, ties of
similarity at the threshold link, and an empty table gives no rows. Other columns of the input are ignored; ``near_duplicates_removed`` returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.store import cluster, forest, stored
from tidewell.llm.texthash import WHITE, blocks, distinct, mix, per_text, shingle_hashes, sums, word_hashes, words

FINGERPRINT = ["n", "print_a", "print_b"]
BIN_BITS = 8
ROWS = 8
BLOCK_SETS = 512
COLUMNS = 1 << 14

@cache
def donors(bits: int) -> np.ndarray:
    """The fixed random order in which each of ``2 ** bits`` bins borrows."""
    return np.stack([np.random.default_rng(k).permutation(1 << bits) for k in range(1 << bits)])


def sketch(values: np.ndarray, bounds: np.ndarray, bits: int = BIN_BITS) -> np.ndarray:
    """The densified one-permutation sketch of each text's sorted distinct hashes; texts without hashes have zeros."""
    bins, order = 1 << bits, donors(bits)
    out = np.zeros((len(bounds) - 1, bins), dtype=np.uint64)
    filled = np.zeros(out.shape, dtype=bool)
    text = per_text(values, bounds)
    cell = text * bins + (values >> np.uint64(64 - bits)).astype(np.int64)
    first = np.ones(len(cell), dtype=bool)
    first[1:] = cell[1:] != cell[:-1]
    out.reshape(-1)[cell[first]] = values[first]
    filled.reshape(-1)[cell[first]] = True
    doc, empty = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for step in range(bins):
        if not len(doc):
            break
        donor = order[empty, step]
        hit = filled[doc, donor]
        out[doc[hit], empty[hit]] = out[doc[hit], donor[hit]]
        doc, empty = doc[~hit], empty[~hit]
    return out


def band_keys(sketches: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash per band of ``rows`` bins; it depends on the band's number too."""
    grouped = sketches.reshape(len(sketches), -1, rows)
    keys = np.broadcast_to(np.arange(1, grouped.shape[1] + 1, dtype=np.uint64), grouped.shape[:2]).copy()
    for k in range(rows):
        keys = mix(keys + np.uint64(0x9E3779B97F4A7C15)) ^ mix(grouped[:, :, k])
    return mix(keys)


def _sets(column, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for low, high, data, offsets in blocks(column):
        starts, ends, bounds = words(data, offsets, WHITE)
        hashes = word_hashes(data, starts, ends, lower=True)
        shingles, edges = shingle_hashes(hashes, bounds, width, whole_if_short=True)
        yield low, high, *distinct(shingles, edges)


def sketches(documents: DataFrame, width: int) -> DataFrame:
    """Per row of (doc_id, text, key): id, key, set size, a 128-bit fingerprint of the set and its band keys."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for low, high, values, bounds in _sets(part.column(1), width):
                keys = band_keys(sketch(values, bounds)).view(np.int64)
                size = np.diff(bounds)
                keys_of = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32), pa.array(keys.reshape(-1)))
                print_a = sums(mix(values ^ np.uint64(0x5851F42D4C957F2D)), bounds).view(np.int64)
                print_b = sums(mix(values ^ np.uint64(0x14057B7EF767814F)), bounds).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0)[low:high], part.column(2)[low:high], pa.array(size), pa.array(print_a), pa.array(print_b), keys_of], names=["doc_id", "key", "n", "print_a", "print_b", "bands"])

    return documents.mapInArrow(run, "doc_id long, key long, n long, print_a long, print_b long, bands array<long>")


def full_sets(documents: DataFrame, width: int) -> DataFrame:
    """Per row: id and the sorted hashes of its set."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for low, high, values, bounds in _sets(part.column(1), width):
                lists = pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0)[low:high], lists], names=["id", "members"])

    return documents.mapInArrow(run, "id long, members array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (u, v): those whose sets have 100 * intersection >= percent * union."""
    both = pairs.join(sets.toDF("u", "a"), "u").join(sets.toDF("v", "b"), "v")
    sized = both.select("u", "v", F.size("a").alias("na"), F.size("b").alias("nb"), F.size(F.array_intersect("a", "b")).alias("common"))
    return sized.filter(F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("common"))).select("u", "v")


def _settled(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that join what is similar in large groups of (grp, id, outside, m): those outside against everyone of the group.

    Groups are cut into blocks of ``BLOCK_SETS`` sets, and two blocks at a time are compared by products of their membership matrices.
    """

    def run(rows: pa.Table) -> pa.Table:
        def side(is_x: bool) -> tuple[np.ndarray, list[np.ndarray]]:
            own = rows.filter(pc.equal(rows["is_x"], is_x))
            return np.asarray(own["id"]), [np.asarray(s.values) for s in own["members"]]

        (xi, xs), (yi, ys) = side(True), side(False)
        links: list[tuple[int, int]] = []
        if len(xi) and len(yi):
            names = np.unique(np.concatenate(xs))
            nx, ny = np.array([len(s) for s in xs]), np.array([len(s) for s in ys])
            common = np.zeros((len(xi), len(yi)), dtype=np.float32)
            for low in range(0, len(names), COLUMNS):
                part = names[low : low + COLUMNS]
                a, b = (np.zeros((len(side), len(part)), dtype=np.float32) for side in (xs, ys))
                for matrix, side_sets in ((a, xs), (b, ys)):
                    for k, s in enumerate(side_sets):
                        at = np.minimum(np.searchsorted(part, s), len(part) - 1)
                        matrix[k, at[part[at] == s]] = 1
                common += a @ b.T
            similar = (100 * common >= percent * (nx[:, None] + ny[None, :] - common)) & (xi[:, None] != yi[None, :])
            links = forest(similar, xi, yi)
        return pa.table({"u": pa.array([min(p) for p in links], pa.int64()), "v": pa.array([max(p) for p in links], pa.int64())})

    blocks_of = groups.withColumn("blocks", F.ceil(F.col("m") / BLOCK_SETS).cast("int")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    xs = blocks_of.filter("outside").select("grp", "id", F.lit(True).alias("is_x"), F.col("block").alias("bx"), every.alias("by"))
    ys = blocks_of.select("grp", "id", F.lit(False).alias("is_x"), every.alias("bx"), F.col("block").alias("by"))
    placed = xs.union(ys).join(sets, "id")
    return placed.groupBy("grp", "bx", "by").applyInArrow(run, "u long, v long")


def _members(documents: DataFrame, width: int, percent: int, id_column: str, text_column: str) -> DataFrame:
    """Per row: doc_id, key, n_shingles, component_id, kept."""
    rows, classes, final = _classes(documents, width, percent, id_column, text_column)
    named = classes.join(final.toDF("rep", "component"), "rep", "left").select(*FINGERPRINT, "first.doc_id", F.coalesce("component", "rep").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = named.join(least, "component").select(*FINGERPRINT, "component_id")
    joined = rows.select("doc_id", "key", *FINGERPRINT).join(of_class, FINGERPRINT, "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = joined.select("doc_id", "key", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(documents: DataFrame, width: int = 3, percent: int = 85, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least id reachable by links), kept."""
    return _members(documents, width, percent, id_column, text_column).drop("key")


def text_key(text) -> Column:
    """What tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _classes(documents: DataFrame, width: int, percent: int, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with their fingerprints, classes of equal sets with a 64-bit name, components of class names)."""
    text = F.col(text_column)
    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), text.cast("string").alias("text"), text_key(text).alias("key"))
    rows = stored(sketches(source, width), "sketches", free=True)
    first = F.min(F.struct("doc_id", "key")).alias("first")
    grouped = rows.filter("n > 0 and doc_id is not null").groupBy(*FINGERPRINT).agg(first, F.any_value("bands").alias("bands"))
    classes = stored(grouped.withColumn("rep", F.xxhash64(*FINGERPRINT)), "classes")
    in_band = classes.select("rep", "n", F.explode("bands").alias("key"))

    def sizes_allow(a: str, b: str):
        """Sets whose sizes differ too much cannot reach the threshold."""
        return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)

    def with_sets(seen: DataFrame):
        at = classes.join(seen.select("rep"), "rep", "left_semi").select("rep", "first.doc_id", "first.key")
        near = source.join(at, ["doc_id", "key"]).select("rep", "text")
        sets = stored(full_sets(near, width).dropDuplicates(["id"]), "sets", free=True)
        return lambda pairs: _confirmed(pairs, sets, percent), [sets]

    return rows, classes, cluster(in_band, sizes_allow, with_sets, lambda groups, sets: _settled(groups, sets, percent))


def near_duplicates_removed(documents: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with one of each component: that with the least id."""
    members = _members(documents, width, percent, id_column, text_column)
    drop = members.filter("not kept").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct()
    same = (F.col(f"`{id_column}`").cast("long") == F.col("__id")) & (text_key(F.col(f"`{text_column}`")) == F.col("__key"))
    return documents.join(drop, same, "left_anti")
