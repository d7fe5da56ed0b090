"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, of their beginnings, of neighbouring pairs and of pairs with one word between. Every
coordinate has a learning rate of its own, and the L1 term leaves few weights other than zero: a compact table, sent to all scoring tasks.
Training sees at most ``max_rows`` labelled rows, those whose hashed ids come first, in shards of ``SHARD_ROWS`` rows. A shard is one
group's bounded work; the shards' weights are averaged. So the weights are bounded by the sample, whatever the corpus holds.

Null and empty texts score by the intercept alone. Labels that are null, or of unknown documents, teach nothing; repeated labels of one
document count by their majority, a tie as 1. Without any label every score is 0. A row without an id is scored like the others and is
not held out. Repeated rows are scored each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.texthash import ALNUM, blocks, mix, word_hashes, words

MAX_ROWS = 6_144
SHARD_ROWS = 6_144
BEGINNINGS = (4, 5)
MIN_ROWS = 5
INTERCEPT = 0


def remainder(id_column: str, divisor: int) -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % divisor


def families(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text of each feature, 64-bit feature hash) of each kind of feature."""
    starts, ends, bounds = words(data, offsets, ALNUM)
    h = word_hashes(data, starts, ends, lower=True)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    yield text, mix(h + np.uint64(1))
    for size in BEGINNINGS:
        yield text, mix(word_hashes(data, starts, np.minimum(ends, starts + size), lower=True) + np.uint64(size))
    for step in (1, 2):
        inside = text[step:] == text[:-step] if len(h) > step else np.zeros(0, bool)
        pair = mix(h[:-step] + np.uint64(10 + step)) + h[step:] if len(h) > step else np.zeros(0, np.uint64)
        yield text[: len(pair)][inside], mix(pair[inside])


def _featurised(labelled: DataFrame) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for low, high, data, offsets in blocks(part.column(2)):
                got = list(families(data, offsets))
                text, feature = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
                order = np.argsort(text, kind="stable")
                edges = np.searchsorted(text[order], np.arange(high - low + 1)).tolist()
                feature = feature[order]
                lists = [np.unique(feature[a:b]).view(np.int64) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0)[low:high], part.column(1)[low:high], pa.array(lists, pa.list_(pa.int64()))], names=["shard", "label", "features"])

    return labelled.mapInArrow(run, "shard long, label int, features array<long>")


def ftrl(rows: list[np.ndarray], labels: np.ndarray, epochs: int, alpha: float, beta: float, l1: float, positive: float) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) other than zero; feature 0 is the intercept, free of L1. Rows hold each text's distinct features.

    Features of fewer than ``MIN_ROWS`` rows are left out. A row labelled 1 counts ``positive`` times.
    """
    seen, times = np.unique(np.concatenate(rows), return_counts=True)
    names = np.sort(np.append(seen[times >= MIN_ROWS], INTERCEPT))
    intercept = int(np.searchsorted(names, INTERCEPT))
    places = []
    for row in rows:
        at = np.minimum(np.searchsorted(names, row), len(names) - 1)
        places.append(np.append(at[names[at] == row], intercept))
    z, n, floor = np.zeros(len(names)), np.zeros(len(names)), np.full(len(names), l1)
    floor[intercept] = 0

    def weights(at) -> np.ndarray:
        return np.where(np.abs(z[at]) <= floor[at], 0.0, -(z[at] - np.sign(z[at]) * floor[at]) / (beta + np.sqrt(n[at])) * alpha)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at = places[k]
            w = weights(at)
            gradient = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w.sum()))))) - labels[k]
            gradient *= positive if labels[k] else 1.0
            grown = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    final = weights(np.arange(len(names)))
    return names[final != 0], final[final != 0]


def train(documents: DataFrame, labels: DataFrame, label_column: str, id_column: str = "doc_id", text_column: str = "text", max_rows: int = MAX_ROWS,
          epochs: int = 8, alpha: float = 2.0, beta: float = 1.0, l1: float = 24.0, positive: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """Averaged weights of all shards. ``labels`` must hold only rows that may be learnt from."""
    named = labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label_column).cast("double").alias("label")).filter("doc_id is not null and label is not null")
    named = named.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    sample = named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).collect()
    if not sample:
        return np.zeros(0, np.int64), np.zeros(0)
    shards = -(-len(sample) // SHARD_ROWS)
    chosen = documents.sparkSession.createDataFrame([(r["doc_id"], r["label"]) for r in sample], "doc_id long, label int")
    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    labelled = source.join(F.broadcast(chosen), "doc_id").select(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(shards)).alias("shard"), "label", "text")

    def fit(rows: pa.Table) -> pa.Table:
        features = [np.asarray(x.values) if len(x) else np.zeros(0, np.int64) for x in (rows.column("features")[k] for k in range(rows.num_rows))]
        name, weight = ftrl(features, np.asarray(rows.column("label")), epochs, alpha, beta, l1, positive)
        return pa.table({"feature": pa.array(name), "weight": pa.array(weight)})

    parts = _featurised(labelled).groupBy("shard").applyInArrow(fit, "feature long, weight double")
    mean = parts.groupBy("feature").agg((F.sum("weight") / shards).alias("weight")).collect()
    mean.sort(key=lambda r: r["feature"])
    return np.array([r["feature"] for r in mean], dtype=np.int64), np.array([r["weight"] for r in mean], dtype=np.float64)


class Scorer:
    """Scores of the texts of a block under sparse weights."""

    def __init__(self, weights: tuple[np.ndarray, np.ndarray]):
        names = weights[0].view(np.uint64)
        order = np.argsort(names)
        self.names, self.values = names[order], weights[1][order]
        self.known = np.zeros(1 << 16, dtype=bool)
        self.known[(self.names & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.base = float(self.values[self.names == INTERCEPT].sum())

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if not len(self.names):
            return np.zeros(n)
        texts, places = [], []
        for text, feature in families(data, offsets):
            hit = np.flatnonzero(self.known[(feature & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.names, feature[hit]), len(self.names) - 1)
            same = self.names[at] == feature[hit]
            texts.append(text[hit][same])
            places.append(at[same])
        pairs = np.unique(np.concatenate(texts) * np.int64(len(self.names)) + np.concatenate(places))
        owner, at = np.divmod(pairs, len(self.names))
        total = self.base + np.bincount(owner, weights=self.values[at], minlength=n)
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def scores(documents: DataFrame, weights: tuple[np.ndarray, np.ndarray], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, score."""
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for part in parts:
            for low, high, data, offsets in blocks(part.column(1)):
                yield pa.RecordBatch.from_arrays([part.column(0)[low:high], pa.array(scorer(data, offsets))], names=["doc_id", "score"])

    return documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def toxicity(documents: DataFrame, labels: DataFrame, fold: int = 5, held_out_remainder: int = 0) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. Labels of the held-out fold are not read by training."""
    held_out = F.coalesce(remainder("doc_id", fold) == held_out_remainder, F.lit(False))
    weights = train(documents, labels.filter(~held_out), "toxic")
    return scores(documents, weights).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxic_removed(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose score is below one half, with all their columns; decided row by row, without a shuffle."""
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    shared = documents.sparkSession.sparkContext.broadcast(train(documents, labels.filter(~held_out), "toxic"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for part in parts:
            for low, high, data, offsets in blocks(part.column(part.schema.get_field_index("text"))):
                yield part.slice(low, high - low).filter(pa.array(scorer(data, offsets) < 0.5))

    return documents.mapInArrow(run, documents.schema)
