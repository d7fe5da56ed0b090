"""Target-distribution importance resampling over hashed word runs, with a head-tail vocabulary.

Features of a text are all its runs of one or two consecutive words; a feature's bucket is the CRC-32 of its bytes modulo ``buckets``. A
first pass finds the head: the most frequent words and pairs, from bounded counts per task. The head is broadcast, words with their exact
CRC state and pairs with their bucket. Any other word gets its CRC directly, and any other pair continues the CRC state of its first word
over a space and the second. Head or tail, a feature gets the same bucket, so the head changes the speed and nothing else. The second pass
sums the features of the corpus and of the target by bucket; the third scores every text by the mean log ratio of its buckets.

The draw adds Gumbel noise from a hash of the id to the weights and takes the highest scores. Scores are whole numbers in a narrow range, so
a histogram of them gives the cut; only rows at or above it are put in order, by range partitions whose lengths give the ranks.

Nulls: a null or empty text has no features, weight 0 and too few words to be drawn; a null id hashes as an empty one and comes last in ties.
Texts are read whole, in pieces of ``PIECE`` bytes that end between words. Repeated rows each have a score and a rank of their own. Ties go
to the smaller id, then to the smaller weight and fewer features. An empty table gives no rows; an empty target has no features. Only id and
text are read of the input, so other columns never clash.

Bounds: ``HEAD_WORDS`` words and ``HEAD_PAIRS`` pairs and one number per bucket are sent to the tasks, whatever the size of the corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm import texthash
from tidewell.llm.store import discard, stored

BUCKETS = 10_000
HEAD_WORDS, HEAD_PAIRS = 1 << 14, 1 << 16
TASK_HEAD = 1 << 12
OPEN_COUNTS = 1 << 17
PIECE = 1 << 20
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)


class Block:
    """The words of some texts, or of a piece of one text: hashes, lower-case bytes and places.

    ``rows`` are the texts' numbers in their batch. A later piece of a text begins with the last word of the piece before, for the pair across the
    cut; ``seen`` tells that this word has been counted.
    """

    def __init__(self, rows: np.ndarray, data: np.ndarray, offsets: np.ndarray, seen: bool):
        self.rows, self.seen = rows, int(seen)
        self.data = _LOWER[data]
        self.starts, self.ends, self.bounds = texthash.words(self.data, offsets, texthash.ALNUM)
        self.hashes = texthash.word_hashes(self.data, self.starts, self.ends, False)
        counts = np.diff(self.bounds)
        pairs = np.maximum(counts - 1, 0)
        self.firsts = texthash.spans(self.bounds[:-1], pairs)
        self.pair_bounds = np.concatenate(([0], np.cumsum(pairs)))
        self.pair_keys = pair_keys(self.hashes[self.firsts], self.hashes[self.firsts + 1])
        self.n_words = counts - self.seen
        self.n_pairs = pairs
        self._bytes = None

    def word(self, k: int) -> bytes:
        if self._bytes is None:
            self._bytes = self.data.tobytes()
        return self._bytes[self.starts[k] : self.ends[k]]


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of two words from theirs."""
    return texthash.mix(first * np.uint64(0x9E3779B97F4A7C15) + texthash.mix(second))


def word_blocks(column: pa.Array) -> Iterator[Block]:
    """The words of all texts of an Arrow column; texts longer than ``PIECE`` bytes come in pieces that end between words."""
    for low, high, data, offsets in texthash.blocks(column, PIECE):
        if high - low > 1 or len(data) <= 2 * PIECE:
            yield Block(np.arange(low, high), data, offsets, False)
            continue
        at = begin = 0
        while at < len(data):
            end = min(at + PIECE, len(data))
            while end < len(data) and texthash.ALNUM[data[end]]:
                outside = np.flatnonzero(~texthash.ALNUM[data[end : end + 4096]])
                end = end + int(outside[0]) if len(outside) else min(end + 4096, len(data))
            block = Block(np.array([low]), data[begin:end], np.array([0, end - begin]), begin < at)
            yield block
            # The next piece begins at the last word of this one, if it has any.
            begin = begin + int(block.starts[-1]) if len(block.starts) else end
            at = end


def pair_crc(state: int, second: bytes) -> int:
    """The CRC of a pair from the state after its first word."""
    return zlib.crc32(second, zlib.crc32(b" ", state))


class Lookup:
    """Values by 64-bit key, from sorted arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], values[order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, places of the keys that are not there)."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64), np.arange(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.values[at], np.flatnonzero(self.keys[at] != keys)


class Head:
    """CRC states of frequent words and buckets of frequent pairs; everything else takes its CRC directly. Words are told apart by 64-bit hashes."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int = BUCKETS):
        self.buckets = buckets
        states = np.array([zlib.crc32(w) for w in words], dtype=np.int64)
        self.states = Lookup(self._hashes(words), states)
        first, second = self._hashes([p[0] for p in pairs]), self._hashes([p[1] for p in pairs])
        self.pairs = Lookup(pair_keys(first, second), np.array([pair_crc(zlib.crc32(a), b) % buckets for a, b in pairs], dtype=np.int64))

    @staticmethod
    def _hashes(words: list[bytes]) -> np.ndarray:
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        return texthash.word_hashes(data, ends - [len(w) for w in words], ends, False) if words else np.zeros(0, np.uint64)

    def features(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of a block's words and of its pairs."""
        states, tail = self.states.find(block.hashes)
        if len(tail):
            _, one, which = np.unique(block.hashes[tail], return_index=True, return_inverse=True)
            states[tail] = np.array([zlib.crc32(block.word(k)) for k in tail[one].tolist()], dtype=np.int64)[which]
        pairs, tail = self.pairs.find(block.pair_keys)
        if len(tail):
            _, one, which = np.unique(block.pair_keys[tail], return_index=True, return_inverse=True)
            firsts = block.firsts[tail[one]].tolist()
            direct = [pair_crc(state, block.word(k + 1)) for state, k in zip(states[firsts].tolist(), firsts, strict=True)]
            pairs[tail] = np.array(direct, dtype=np.int64)[which] % self.buckets
        return states % self.buckets, pairs


def _most(keys: np.ndarray, keep: int) -> list[tuple[int, int]]:
    """(a place of the key, its count) of the most frequent keys."""
    _, one, n = np.unique(keys, return_index=True, return_counts=True)
    best = np.argpartition(n, len(n) - keep)[len(n) - keep :] if len(n) > keep else np.arange(len(n))
    return list(zip(one[best].tolist(), n[best].tolist(), strict=True))


def _pruned(counts: Counter, keep: int) -> Counter:
    return Counter(dict(counts.most_common(keep)))


def find_head(texts: DataFrame, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS) -> tuple[list[bytes], list[tuple[bytes, bytes]]]:
    """The most frequent words and pairs of a table of ``text``.

    Every block of every text counts for its most frequent ones; a task hands on its ``TASK_HEAD`` most frequent words and four times as many pairs
    from counts that are pruned when they outgrow ``OPEN_COUNTS``, and sums over the tasks decide. Which features make the head has no
    effect on any result.
    """
    schema = "width int, first binary, second binary, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, double = Counter(), Counter()
        for batch in batches:
            for block in word_blocks(batch.column("text")):
                for k, n in _most(block.hashes[block.seen :], TASK_HEAD):
                    single[block.word(k + block.seen)] += n
                for k, n in _most(block.pair_keys, 4 * TASK_HEAD):
                    first = int(block.firsts[k])
                    double[block.word(first), block.word(first + 1)] += n
                if len(single) > OPEN_COUNTS:
                    single = _pruned(single, TASK_HEAD * 4)
                if len(double) > OPEN_COUNTS:
                    double = _pruned(double, TASK_HEAD * 8)
        one, two = single.most_common(TASK_HEAD), double.most_common(4 * TASK_HEAD)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([1] * len(one) + [2] * len(two), pa.int32()), pa.array([w for w, _ in one] + [p[0] for p, _ in two], pa.binary()),
                pa.array([None] * len(one) + [p[1] for p, _ in two], pa.binary()), pa.array([n for _, n in one] + [n for _, n in two], pa.int64()),
            ],
            names=["width", "first", "second", "n"],
        )

    sums = stored(texts.mapInArrow(count, schema).groupBy("width", "first", "second").agg(F.sum("n").alias("n")), "resample-head")
    order = (F.col("n").desc(), "first", "second")
    single, double = (sums.filter(F.col("width") == w).orderBy(*order).limit(keep).collect() for w, keep in ((1, words), (2, pairs)))
    discard(sums)
    return [bytes(r["first"]) for r in single], [(bytes(r["first"]), bytes(r["second"])) for r in double]


def bucket_totals(texts: DataFrame, head, buckets: int) -> DataFrame:
    """(bucket, n): how many features of a table of ``text`` fall into each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for block in word_blocks(batch.column("text")):
                words, pairs = head.value.features(block)
                totals += np.bincount(words[block.seen :], minlength=buckets) + np.bincount(pairs, minlength=buckets)
        filled = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array(totals[filled], pa.int64())], names=["bucket", "n"])

    return texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) of every bucket from both totals: 1000 times the log ratio of smoothed shares, rounded down."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    whole = Window.partitionBy()
    both = both.withColumns({"all_s": F.sum("s").over(whole), "all_t": F.sum("t").over(whole)}).select("bucket", *[F.col(c).cast("double") for c in ("s", "t", "all_s", "all_t")])
    ratio = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def noise(ident: Column, seed: int) -> Column:
    """Gumbel noise times 1000, rounded down, from the leading 32 bits of a SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scored(documents: DataFrame, target: DataFrame, buckets: int, seed: int, id_column: str, text_column: str, target_column: str) -> DataFrame:
    """(doc_id, key, n_words, n_features, weight, score) of every document, as a stored table. ``key`` is a hash of the text."""
    spark = documents.sparkSession
    own, wanted = documents.select(F.col(f"`{text_column}`").cast("string").alias("text")), target.select(F.col(f"`{target_column}`").cast("string").alias("text"))
    head = spark.sparkContext.broadcast(Head(*find_head(own), buckets))
    totals = stored(bucket_totals(own, head, buckets), "resample-totals")
    rows = bucket_gains(totals, bucket_totals(wanted, head, buckets), buckets).collect()
    gains = np.zeros(buckets, dtype=np.int64)
    gains[[r["bucket"] for r in rows]] = [r["gain"] for r in rows]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, total = np.zeros((3, batch.num_rows), dtype=np.int64)
            for block in word_blocks(batch.column("text")):
                words, pairs = head.value.features(block)
                worth = gains[words]
                worth[: block.seen] = 0
                n_words[block.rows] += block.n_words
                n_features[block.rows] += block.n_words + block.n_pairs
                total[block.rows] += texthash.sums(worth, block.bounds) + texthash.sums(gains[pairs], block.pair_bounds)
            weights = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), *[pa.array(x, pa.int64()) for x in (n_words, n_features, weights)]],
                names=["doc_id", "key", "n_words", "n_features", "weight"],
            )

    ident, text = F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string")
    rows = documents.select(ident, F.xxhash64(text).alias("key"), text.alias("text"))
    result = rows.mapInArrow(score, "doc_id long, key long, n_words long, n_features long, weight long")
    result = stored(result.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "resample-scores")
    discard(totals)
    head.destroy()
    return result


def ranked(scores: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scores`` with ``rank``: 1, 2, 3... for the drawn rows, else null."""
    eligible = scores.filter(F.col("n_words") >= least_words)
    histogram = eligible.groupBy("score").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wanted = F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100)
    cut = histogram.withColumns({"upto": above, "wanted": wanted}).filter("upto >= wanted and upto - n < wanted").select("score", "wanted").first()
    if cut is None:
        return scores.withColumn("rank", F.lit(None).cast("long"))
    drawable = (F.col("n_words") >= least_words) & (F.col("score") >= cut["score"])
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").asc(), F.col("n_features").asc()]
    laid = scores.filter(drawable).repartitionByRange(*order).sortWithinPartitions(*order)
    # The number of a row inside its partition is in the low 33 bits, the partition above them.
    laid = stored(laid.withColumn("__place", F.monotonically_increasing_id()), "resample-order")
    block, inside = F.shiftright("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    lengths = laid.groupBy(block.alias("__block")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    starts = lengths.select("__block", before.alias("__before"))
    placed = laid.withColumn("__block", block).join(F.broadcast(starts), "__block")
    rank = F.col("__before") + inside + 1
    drawn = placed.select(*scores.columns, F.when(rank <= cut["wanted"], rank).alias("rank"))
    return drawn.union(scores.filter(~drawable).withColumn("rank", F.lit(None).cast("long")))


def resampled(documents: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, buckets: int = BUCKETS, seed: int = 7,
              id_column: str = "doc_id", text_column: str = "text", target_column: str = "text") -> DataFrame:
    """(doc_id, key, n_words, n_features, weight, score, rank) of every document: ``percent`` per cent of the documents with at least
    ``least_words`` words are drawn, towards the distribution of the texts of ``target``."""
    return ranked(scored(documents, target, buckets, seed, id_column, text_column, target_column), percent, least_words)


def drawn(documents: DataFrame, ranks: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that ``resampled`` has drawn, with all their columns."""
    taken = ranks.filter("rank is not null").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
    same = F.col(f"`{id_column}`").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(f"`{text_column}`").cast("string")) == F.col("__key"))
    return documents.join(taken, same, "left_semi")
