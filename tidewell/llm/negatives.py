"""Hard-negative mining by slot-decomposed selection.

Anchors are compared with all rows in blocks: an anchor block and a row block meet in one call, which keeps the best few per anchor, so a
block hands on a bounded number of rows per anchor whatever it holds. The first comparison finds an anchor's positives. Their scores, as
upper limits, cut the scores below the first into disjoint slots: one slot from each limit down to the next, the last one open. The second
comparison keeps the ``negatives`` best rows of other labels per slot. A positive's window is its own slot and all below it, down to its lower limit,
so merging the slots from its own downwards answers all overlapping windows with one search.

Scores are inner products of whole numbers, computed exactly; one beyond a long counts as the nearest long. Vectors of different lengths are
compared as if the shorter had zeros. Higher scores come first, ties by smaller id. Rows without an id, label or vector, or with a null or
non-finite component, take no part. Of rows that share an id the least by label and vector takes part. An empty vector scores 0. An empty
table, or one without anchors, gives no rows. Only the named columns are read, so others never clash.

Blocks hold about ``BLOCK`` rows or anchors by hash of the id. Both sides are stored as they take part and dealt to block pairs by a
shuffle, each row once per anchor block and each anchor once per row block. Nothing is broadcast or collected but two counts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.store import discard, stored

BLOCK = 8192
CHUNK_CELLS = 1 << 21
LONG = (-(1 << 63), (1 << 63) - 1)


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros to ``width``."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def widest(column: pa.ChunkedArray) -> int:
    lengths = pc.list_value_length(column)
    return int(pc.max(lengths).as_py() or 0)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while every partial sum is exact there, else in whole numbers of any size, limited to longs."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    if float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1] < 1 << 53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return np.minimum(np.maximum(a.astype(object) @ b.astype(object).T, LONG[0]), LONG[1])


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, the earlier first among equals."""
    at = np.arange(len(scores))
    if len(scores) > 4 * k and scores.dtype != object:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.argsort(-scores[at], kind="stable")][:k]


def slots_of(scores: np.ndarray, limits: list[int]) -> np.ndarray:
    """The slot of each score: the last of the descending limits that it does not exceed."""
    rising = np.array(limits[::-1], dtype=scores.dtype)
    return len(limits) - np.searchsorted(rising, scores, side="left") - 1


def least_score(positive: int, percent: int) -> int:
    """The lower limit of a positive's window."""
    return -(-percent * positive // 100)


class BlockPair:
    """An anchor block and a row block in order of id, and their scores a few anchors at a time."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        anchors, rows = anchors.sort_by("id"), rows.sort_by("id")
        self.anchors, self.anchor_labels = anchors["id"].to_pylist(), anchors["label"].to_numpy()
        self.ids, self.labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        width = max(widest(anchors["vector"]), widest(rows["vector"]))
        self.a, self.b = matrix(anchors["vector"], width), matrix(rows["vector"], width)

    def scores(self):
        step = max(1, CHUNK_CELLS // max(len(self.ids), 1))
        for low in range(0, len(self.anchors), step):
            for k, row in enumerate(products(self.a[low : low + step], self.b)):
                yield low + k, row


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def positives_of(anchors: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The best ``k`` other rows of the same label per anchor of a block pair."""
    found = []
    if anchors.num_rows and rows.num_rows:
        pair = BlockPair(anchors, rows)
        for n, scores in pair.scores():
            own = np.flatnonzero((pair.labels == pair.anchor_labels[n]) & (pair.ids != pair.anchors[n]))
            found += [(pair.anchors[n], int(pair.ids[own[p]]), int(scores[own[p]])) for p in best(scores[own], k)]
    return _table(found, ["anchor_id", "positive_id", "positive_score"])


def negatives_of(anchors: pa.Table, rows: pa.Table, k: int, percent: int) -> pa.Table:
    """The best ``k`` rows of other labels per anchor and slot of a block pair, from the anchors' descending ``limits``."""
    found = []
    if anchors.num_rows and rows.num_rows:
        pair = BlockPair(anchors, rows)
        limits = anchors.sort_by("id")["limits"].to_pylist()
        for n, scores in pair.scores():
            open_windows = [p for p in limits[n] if p >= 0]
            if not open_windows:
                continue
            fits = (pair.labels != pair.anchor_labels[n]) & (scores <= limits[n][0]) & (scores >= least_score(open_windows[-1], percent))
            own = np.flatnonzero(fits)
            slot = slots_of(scores[own], limits[n])
            for s in np.unique(slot).tolist():
                inside = own[slot == s]
                found += [(pair.anchors[n], s, int(pair.ids[inside[p]]), int(scores[inside[p]])) for p in best(scores[inside], k)]
    return _table(found, ["anchor_id", "slot", "negative_id", "negative_score"])


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80, id_column: str = "vec_id",
                   label_column: str = "label", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for the first ``positives`` rows of an anchor's label the
    first ``negatives`` rows of other labels that score at most as high and at least ``low_percent`` per cent as high.

    ``anchor`` tells anchors by the columns of ``vectors``. Components are multiplied by ``scale`` and rounded down.
    """
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    taking = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label_column}`").cast("long").alias("label"), vector.alias("plain"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("plain")))
    whole = F.transform("plain", lambda x: F.floor(x * scale)).alias("vector")
    rows = taking.select("id", F.struct("label", whole, "anchor").alias("row")).groupBy("id").agg(F.min("row").alias("row"))
    rows = stored(rows.select("id", "row.label", "row.vector", "row.anchor"), "negatives-rows")
    counts = rows.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    row_blocks, anchor_blocks = math.ceil(counts["rows"] / BLOCK) or 1, math.ceil(counts["anchors"] / BLOCK) or 1

    def cells(side: DataFrame, own_block: Column, others: int, cell) -> DataFrame:
        # New names for the columns, as both sides come from one table.
        dealt = side.toDF(*side.columns).withColumns({"own": own_block, "other": F.explode(F.sequence(F.lit(0), F.lit(others - 1)))})
        return dealt.withColumn("cell", cell(F.col("own"), F.col("other")).cast("long")).drop("own", "other", "anchor")

    def compared(anchors: DataFrame, function, schema: str) -> DataFrame:
        left = cells(anchors, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(anchor_blocks)), row_blocks, lambda own, other: other * anchor_blocks + own)
        right = cells(rows, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(row_blocks)), anchor_blocks, lambda own, other: own * anchor_blocks + other)
        return left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(function, schema)

    def first(found: DataFrame, by: list[str], score: str, ident: str, k: int, name: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(F.col(score).desc(), ident))
        return found.withColumn(name, place).filter(F.col(name) <= k)

    anchors = rows.filter("anchor")
    near = compared(anchors, lambda a, b: positives_of(a, b, positives), "anchor_id long, positive_id long, positive_score long")
    near = stored(first(near, ["anchor_id"], "positive_score", "positive_id", positives, "place"), "negatives-positives")
    limits = near.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list("positive_score"), asc=False).alias("limits"))
    slots = compared(anchors.join(limits, "id"), lambda a, b: negatives_of(a, b, negatives, low_percent), "anchor_id long, slot long, negative_id long, negative_score long")
    slots = first(slots, ["anchor_id", "slot"], "negative_score", "negative_id", negatives, "place")
    # At most positives x negatives rows per anchor; in this order every suffix of slots is in order of score.
    entry = F.struct("slot", (-F.col("negative_score").cast("decimal(20,0)")).alias("order"), "negative_id", "negative_score")
    merged = slots.groupBy("anchor_id").agg(F.sort_array(F.collect_list(entry)).alias("all"))
    low = F.col("positive_score").cast("decimal(20,0)") * low_percent
    window = F.filter("all", lambda n: (n["slot"] >= F.col("place") - 1) & (n["negative_score"].cast("decimal(20,0)") * 100 >= low) & (n["negative_score"] <= F.col("positive_score")))
    answers = near.join(merged, "anchor_id").select("anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(window, 1, negatives)).alias("at", "n"))
    result = stored(
        answers.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.negative_id").alias("negative_id"), "positive_score", F.col("n.negative_score").alias("negative_score")),
        "negatives",
    )
    discard(rows, near)
    return result
