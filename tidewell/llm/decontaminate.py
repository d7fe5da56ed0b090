"""Benchmark decontamination: a BM25 inverted index of test items, searched with every passage of every training text.

Units of the index are test items, cut into pieces of ``UNIT_WORDS`` words where they are longer. Impacts are BM25 weights as shares of
the unit's own total, so a score is the share of a unit that a passage covers. Passages are windows of ``PASSAGE_WORDS`` words at every
``STRIDE`` words: any run of ``UNIT_WORDS`` words lies in one of them whole. Block-max WAND decides what is scored: first by the sum of
every term's greatest impact, then by the sum of its greatest impacts in each block of units; both bound the score from above, so all
pairs at or over the threshold are found. They are verified by the share of the question's and of the answer's word trigrams that
stand around the passage. A unit's question is its leading two thirds, its answer the rest, as test items come as one text.

The index is built and sent to the tasks in parts of about ``PART_BYTES`` bytes of item text; each part is one pass, and its weights come from counts over
all items, so no score depends on how the items are dealt to parts. One part at a time is on the driver and, in a search, in the tasks. Null or empty texts match nothing, on either side. Repeated items are each reported; repeated rows of
a document count once. Rows without an id are searched, and reported under a null id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.store import discard, stored
from tidewell.llm.texthash import ALNUM, blocks, runs_hash, spans, word_hashes, words

UNIT_WORDS, PASSAGE_WORDS, STRIDE = 64, 96, 32
BLOCK_UNITS = 32
PART_BYTES = 4 << 20
SHORT_UNIT = 8
SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, passage_start long"


@dataclass
class Index:
    """BM25 impacts by term, sorted by block of units; ``ceiling`` and ``block_ceiling`` bound them."""

    items: np.ndarray
    terms: np.ndarray
    posting_start: np.ndarray
    posting_unit: np.ndarray
    posting_impact: np.ndarray
    ceiling: np.ndarray
    block_ceiling: np.ndarray
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    sizes: np.ndarray

    def term_of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of words that are terms, their terms)."""
        known = np.zeros(1 << 18, dtype=bool)
        known[(self.terms & np.uint64(0x3FFFF)).astype(np.int64)] = True
        maybe = np.flatnonzero(known[(h & np.uint64(0x3FFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, h[maybe]), len(self.terms) - 1)
        same = self.terms[at] == h[maybe]
        return maybe[same], at[same]


def _grams(h: np.ndarray) -> np.ndarray:
    """Distinct trigrams; of fewer words, the words themselves."""
    return np.unique(runs_hash(h, np.arange(len(h) - 2), 3) if len(h) >= 3 else h)


@dataclass(frozen=True)
class Statistics:
    """What BM25 needs to know of all test items: the number of units, their mean length, and in how many units each term of a part stands."""

    units: int
    mean: float
    terms: np.ndarray
    counts: np.ndarray


def _units(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of the words) of every unit."""
    for low, _, data, offsets in blocks(column):
        starts, ends, bounds = words(data, offsets, ALNUM)
        h = word_hashes(data, starts, ends, lower=True)
        for k in range(len(offsets) - 1):
            own = h[bounds[k] : bounds[k + 1]]
            pieces = max(1, -(-len(own) // UNIT_WORDS))
            yield from ((low + k, piece) for piece in np.array_split(own, pieces) if len(piece))


def build_index(items: list[tuple[int, str]], statistics: Statistics | None = None, k1: float = 1.2, b: float = 0.75) -> Index | None:
    """The index of some items, with the weights of all of which ``statistics`` tells; without, of these alone."""
    units = [(items[row][0], piece) for row, piece in _units(pa.array([text or "" for _, text in items], pa.string()))]
    if not units:
        return None
    sizes = np.array([len(u) for _, u in units])
    term = np.concatenate([u for _, u in units])
    unit = np.repeat(np.arange(len(units)), sizes)
    names, code = np.unique(term, return_inverse=True)
    pairs, tf = np.unique(code * len(units) + unit, return_counts=True)
    term, unit = np.divmod(pairs, len(units))
    if statistics is None:
        statistics = Statistics(len(units), float(sizes.mean()), names, np.bincount(term, minlength=len(names)))
    df = statistics.counts[np.searchsorted(statistics.terms, names)]
    idf = np.log1p((statistics.units - df + 0.5) / (df + 0.5))
    impact = idf[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * sizes[unit] / statistics.mean))
    impact = impact / np.bincount(unit, weights=impact, minlength=len(units))[unit]
    n_blocks = -(-len(units) // BLOCK_UNITS)
    block_ceiling = np.zeros((len(names), n_blocks), dtype=np.float32)
    np.maximum.at(block_ceiling, (term, unit // BLOCK_UNITS), impact.astype(np.float32))
    cut = [-(-2 * s // 3) for s in sizes]
    return Index(
        np.array([i for i, _ in units], dtype=np.int64), names, np.searchsorted(term, np.arange(len(names) + 1)), unit, impact, block_ceiling.max(axis=1), block_ceiling,
        [_grams(u[:c]) for (_, u), c in zip(units, cut, strict=True)], [_grams(u[c:]) for (_, u), c in zip(units, cut, strict=True)], sizes,
    )


def search(index: Index, h: np.ndarray, bounds: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end word, unit, score) of all passages and units with a score of at least ``threshold``."""
    counts = np.diff(bounds)
    n = np.where(counts > 0, 1 + -(-np.maximum(counts - PASSAGE_WORDS, 0) // STRIDE), 0)
    text = np.repeat(np.arange(len(counts)), n)
    first = bounds[text] + STRIDE * (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n))
    end = np.minimum(first + PASSAGE_WORDS, bounds[text + 1])
    place, term = index.term_of(h)
    total = np.concatenate(([0.0], np.cumsum(index.ceiling[term], dtype=np.float64)))
    low, high = np.searchsorted(place, first), np.searchsorted(place, end)
    open_ = np.flatnonzero(total[high] - total[low] >= threshold - 1e-6)
    found = [np.zeros(0, np.int64)] * 4 + [np.zeros(0)]
    out: list[list[np.ndarray]] = []
    for k in range(0, len(open_), 4096):
        chosen = open_[k : k + 4096]
        held = np.repeat(np.arange(len(chosen)), high[chosen] - low[chosen])
        pair = np.unique(held * len(index.terms) + term[spans(low[chosen], high[chosen] - low[chosen])])
        window, own = np.divmod(pair, len(index.terms))
        edges = np.searchsorted(window, np.arange(len(chosen)))
        bound = np.add.reduceat(index.block_ceiling[own], np.minimum(edges, len(own) - 1), axis=0)
        alive = bound >= threshold - 1e-4
        keep = alive.any(axis=1)[window]
        window, own = window[keep], own[keep]
        size = index.posting_start[own + 1] - index.posting_start[own]
        at = spans(index.posting_start[own], size)
        window = np.repeat(window, size)
        live = alive[window, index.posting_unit[at] // BLOCK_UNITS]
        at, window = at[live], window[live]
        cell, where = np.unique(window * len(index.items) + index.posting_unit[at], return_inverse=True)
        score = np.bincount(where, weights=index.posting_impact[at], minlength=len(cell))
        good = score >= threshold - 1e-9
        window, unit = np.divmod(cell[good], len(index.items))
        out.append([text[chosen[window]], first[chosen[window]], end[chosen[window]], unit, score[good]])
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else tuple(found)


def _verified(index: Index, data: np.ndarray, offsets: np.ndarray, threshold: float, overlap: float) -> Iterator[tuple[int, int, tuple]]:
    """(text, item, (score, question overlap, answer overlap, first word)) of every passage that holds a test item."""
    starts, ends, bounds = words(data, offsets, ALNUM)
    h = word_hashes(data, starts, ends, lower=True)
    for text, first, end, unit, score in zip(*search(index, h, bounds, threshold), strict=True):
        around = _grams(h[max(bounds[text], first - STRIDE) : min(bounds[text + 1], end + STRIDE)])
        asked, answered = (np.isin(g, around).mean() if len(g) else 1.0 for g in (index.questions[unit], index.answers[unit]))
        if min(asked, answered) >= (overlap if index.sizes[unit] >= SHORT_UNIT else 1.0):
            yield int(text), int(index.items[unit]), (float(score), float(asked), float(answered), int(first - bounds[text]))


def _part(documents: DataFrame, shared, threshold: float, overlap: float) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column(0)
            for low, _, data, offsets in blocks(part.column(1)):
                rows: dict[tuple, tuple] = {}
                for text, item, row in _verified(shared.value, data, offsets, threshold, overlap):
                    key = (ids[low + text].as_py(), item)
                    rows[key] = max(rows.get(key, row), row, key=lambda r: (r[0], -r[3]))
                if rows:
                    columns = zip(*[(*key, *row) for key, row in rows.items()], strict=True)
                    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return documents.mapInArrow(run, SCHEMA)


def _counted(items: DataFrame) -> DataFrame:
    """(part, term, units, words) of (text, part): in how many units of a part each term stands; without a term, the units and words of a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.asarray(batch.column("part"))
            rows, pieces = zip(*_units(batch.column("text")), strict=True) if batch.num_rows else ((), ())
            if not pieces:
                continue
            owner = part[list(rows)]
            terms = [np.unique(piece) for piece in pieces]
            columns = [
                np.concatenate((np.repeat(owner, [len(t) for t in terms]), owner)), np.concatenate([*terms, np.zeros(len(pieces), np.uint64)]).view(np.int64),
                np.concatenate((np.zeros(sum(map(len, terms)), np.int64), [len(p) for p in pieces])),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "term", "words"])

    found = items.select("text", "part").mapInArrow(run, "part long, term long, words long")
    term = F.when(F.col("words") == 0, F.col("term")).alias("term")
    return found.groupBy("part", term).agg(F.count("*").alias("units"), F.sum("words").alias("words"))


def _indexes(benchmark: DataFrame) -> Iterator[Index]:
    """The test items as indexes of bounded size, one after another."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id is not null and length(text) > 0")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    numbered = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("long"))
    counted = stored(_counted(numbered), "benchmark-terms")
    whole = counted.filter("term is null").agg(F.sum("units").alias("units"), F.sum("words").alias("words")).first()
    everywhere = counted.filter("term is not null").groupBy("term").agg(F.sum("units").alias("n"))
    for k in range(parts if whole["units"] else 0):
        own = sorted((r["item_id"], r["text"]) for r in numbered.filter(F.col("part") == k).select("item_id", "text").collect())
        terms = counted.filter((F.col("part") == k) & F.col("term").isNotNull()).select("term").join(everywhere, "term").toPandas()
        names = terms["term"].to_numpy(dtype=np.int64).view(np.uint64)
        order = np.argsort(names)
        statistics = Statistics(whole["units"], whole["words"] / whole["units"], names[order], terms["n"].to_numpy(dtype=np.int64)[order])
        if index := build_index(own, statistics):
            yield index
    discard(counted)


def contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document and test item found in it: the best passage's score, both overlaps and the passage's first word."""
    spark = documents.sparkSession
    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    passes = []
    for index in _indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)
        passes.append(stored(_part(source, shared, threshold, overlap), "contaminated"))
        shared.destroy()
    if not passes:
        return spark.createDataFrame([], SCHEMA)
    best = F.max_by(F.struct("score", "question_overlap", "answer_overlap", "passage_start"), F.struct("score", -F.col("passage_start"))).alias("best")
    return reduce(DataFrame.union, passes).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def contaminated_removed(documents: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.5) -> DataFrame:
    """The rows in which no test item is found, with all their columns; decided row by row, without a shuffle."""

    def clean_of(index: Index):
        shared = documents.sparkSession.sparkContext.broadcast(index)

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                for low, high, data, offsets in blocks(part.column(part.schema.get_field_index("text"))):
                    keep = np.ones(high - low, dtype=bool)
                    for text, _, _ in _verified(shared.value, data, offsets, threshold, overlap):
                        keep[text] = False
                    yield part.slice(low, high - low).filter(pa.array(keep))

        return run

    for index in _indexes(benchmark):
        documents = documents.mapInArrow(clean_of(index), documents.schema)
    return documents
