"""Quality scores by attention-based multiple-instance learning: a document is a bag of passages, its label teaches where to look.

A passage of ``PASSAGE_WORDS`` words is encoded by shares of its bytes and words, and by the mean of its words' hashed sign vectors. A
learned layer maps it to a hidden vector; gated attention weighs a document's passages against each other, and a logistic layer scores
the weighted mean. Layer, attention and score are learned together from document labels alone, by Adam on one bounded sample of at
most ``max_rows`` labelled rows, those whose hashed ids come first. Every whole text is scored; the model is a few kilobytes.

Null and empty texts are one empty passage. Labels that are null, or of unknown documents, teach nothing; repeated labels of one document
count by their majority, a tie as 1. Without any label every score is 0. A row without an id is scored and is not held out. Repeated
rows are scored each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.texthash import WHITE, blocks, distinct, sums, word_hashes, words
from tidewell.llm.toxicity import remainder

PASSAGE_WORDS = 64
SIGNS = 16
MAX_ROWS = 4_096
HIDDEN, GATE = 16, 8

_KINDS = np.zeros((6, 256), dtype=bool)
_KINDS[0, 65:91] = True
_KINDS[1, 48:58] = True
_KINDS[2, [44, 46, 58, 59]] = True
_KINDS[3, [33, 63]] = True
_KINDS[4, 33:128] = True
_KINDS[4, [*range(48, 58), *range(65, 91), *range(97, 123), 44, 46, 58, 59, 33, 63]] = False
_KINDS[5, 10] = True
WIDTH = len(_KINDS) + 5 + SIGNS


def encoded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of a block of texts, and the bounds of each text; every text has at least one."""
    starts, ends, bounds = words(data, offsets, WHITE)
    h = word_hashes(data, starts, ends, lower=True)
    counts = np.diff(bounds)
    n = np.maximum(1, -(-counts // PASSAGE_WORDS))
    text = np.repeat(np.arange(len(counts)), n)
    first = np.minimum(bounds[text] + PASSAGE_WORDS * (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)), bounds[text + 1])
    end = np.minimum(first + PASSAGE_WORDS, bounds[text + 1])
    size = np.maximum(end - first, 1).astype(np.float64)
    place = np.append(starts, len(data))
    low = np.where(end > first, place[first], 0)
    high = np.where(end > first, ends[np.maximum(end - 1, 0)] if len(ends) else 0, 0)
    length = np.maximum(high - low, 1)
    out = np.zeros((len(text), WIDTH))
    for k, kind in enumerate(_KINDS):
        total = np.concatenate(([0], np.cumsum(kind[data])))
        out[:, k] = (total[high] - total[low]) / length
    at = len(_KINDS)
    edges = np.append(first, len(h)) if len(text) and first[0] == 0 else np.concatenate((first, [len(h)]))
    sizes = (ends - starts).astype(np.float64)
    total = np.concatenate(([0.0], np.cumsum(sizes)))
    out[:, at] = (total[end] - total[first]) / size / 10
    total = np.concatenate(([0.0], np.cumsum(sizes <= 3)))
    out[:, at + 1] = (total[end] - total[first]) / size
    _, kept = distinct(h, edges)
    out[:, at + 2] = np.diff(kept) / size
    whole, whole_bounds = distinct(h, bounds)
    out[:, at + 3] = (np.diff(whole_bounds) / np.maximum(counts, 1))[text]
    out[:, at + 4] = np.log1p(counts)[text] / 10
    bits = ((h[:, None] >> np.arange(SIGNS, dtype=np.uint64)) & np.uint64(1)).astype(np.int32)
    total = np.zeros((len(h) + 1, SIGNS), dtype=np.int64)
    np.cumsum(bits, axis=0, out=total[1:])
    out[:, at + 5 :] = (total[end] - total[first]) / size[:, None] - 0.5 * (end > first)[:, None]
    return out, np.concatenate(([0], np.cumsum(n)))


class Model:
    """Gated attention over passages. Parameters are plain arrays, so a fitted model is sent to tasks as it is."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(WIDTH), np.ones(WIDTH)
        self.p = {
            "W": r.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)), "b": np.zeros(HIDDEN),
            "V": r.normal(0, 0.3, (HIDDEN, GATE)), "U": r.normal(0, 0.3, (HIDDEN, GATE)), "w": r.normal(0, 0.3, GATE),
            "c": r.normal(0, 0.3, HIDDEN), "d": np.zeros(1),
        }

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, tuple]:
        p = self.p
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        hidden = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(hidden @ p["V"]), 1 / (1 + np.exp(-(hidden @ p["U"])))
        e = np.exp((t * g) @ p["w"])
        bag = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        weight = e / sums(e, bounds)[bag]
        z = np.add.reduceat(weight[:, None] * hidden, bounds[:-1], axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -35, 35)))
        return score, (x, hidden, t, g, bag, weight, z)

    def gradients(self, x: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        score, (x, hidden, t, g, bag, weight, z) = self.forward(x, bounds)
        error = (score - labels) / len(labels)
        dz = error[:, None] * p["c"]
        reach = (hidden * dz[bag]).sum(axis=1)
        ds = weight * (reach - np.add.reduceat(weight * reach, bounds[:-1])[bag])
        dt, dg = ds[:, None] * p["w"] * g * (1 - t * t), ds[:, None] * p["w"] * t * g * (1 - g)
        dh = (weight[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T) * (1 - hidden * hidden)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": hidden.T @ dt, "U": hidden.T @ dg, "w": ((t * g) * ds[:, None]).sum(0), "c": z.T @ error, "d": error.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = 40, batch: int = 64, rate: float = 0.01, decay: float = 1e-4) -> None:
        joined = np.concatenate(bags)
        self.mean, self.scale = joined.mean(axis=0), joined.std(axis=0) + 1e-3
        first, second, step = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        order = np.random.default_rng(1)
        for _ in range(epochs):
            shuffled = order.permutation(len(bags))
            for low in range(0, len(bags), batch):
                chosen = shuffled[low : low + batch]
                bounds = np.concatenate(([0], np.cumsum([len(bags[k]) for k in chosen])))
                step += 1
                for name, slope in self.gradients(np.concatenate([bags[k] for k in chosen]), bounds, labels[chosen]).items():
                    slope = slope + decay * self.p[name]
                    first[name] = 0.9 * first[name] + 0.1 * slope
                    second[name] = 0.999 * second[name] + 0.001 * slope * slope
                    self.p[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)


def train(documents: DataFrame, labels: DataFrame, label_column: str, max_rows: int = MAX_ROWS) -> Model | None:
    """A model from a bounded sample of ``labels``, which must hold only rows that may be learnt from."""
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_column).cast("double").alias("label")).filter("doc_id is not null and label is not null")
    named = named.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    sample = named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).collect()
    if not sample:
        return None
    spark = documents.sparkSession
    chosen = spark.createDataFrame([(r["doc_id"], r["label"]) for r in sample], "doc_id long, label int")
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for low, high, data, offsets in blocks(part.column(2)):
                rows, bounds = encoded(data, offsets)
                lists = pa.ListArray.from_arrays((bounds * WIDTH).astype(np.int32), pa.array(rows.astype(np.float32).reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0)[low:high], part.column(1)[low:high], lists], names=["doc_id", "label", "passages"])

    bags = source.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text").mapInArrow(features, "doc_id long, label int, passages array<float>")

    def fit(rows: pa.Table) -> pa.Table:
        import pickle

        rows = rows.sort_by("doc_id")
        model = Model()
        model.fit([np.asarray(x.values, dtype=np.float64).reshape(-1, WIDTH) for x in rows.column("passages")], np.asarray(rows.column("label")).astype(np.float64))
        return pa.table({"model": pa.array([pickle.dumps((model.mean, model.scale, model.p))], pa.binary())})

    import pickle

    fitted = bags.withColumn("sample", F.lit(0)).groupBy("sample").applyInArrow(fit, "model binary").first()
    if fitted is None:
        return None
    model = Model()
    model.mean, model.scale, model.p = pickle.loads(bytes(fitted["model"]))
    return model


def quality(documents: DataFrame, labels: DataFrame, fold: int = 3, held_out_remainder: int = 1, max_rows: int = MAX_ROWS) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. Labels of the held-out fold are not read by training."""
    held_out = F.coalesce(remainder("doc_id", fold) == held_out_remainder, F.lit(False))
    model = train(documents, labels.filter(~held_out), "quality", max_rows)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for low, high, data, offsets in blocks(part.column(1)):
                score = model.forward(*encoded(data, offsets))[0] if model else np.zeros(high - low)
                yield pa.RecordBatch.from_arrays([part.column(0)[low:high], pa.array(score)], names=["doc_id", "score"])

    scored = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
