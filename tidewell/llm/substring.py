"""Removal of passages that occur before: exact windows of words, found behind a count-min prefilter.

Counting every window would shuffle the corpus many times over. So each window is represented by its minimiser, the least hash among its
short word runs; equal windows have equal minimisers, and neighbouring windows mostly share one, so a document has few minimiser
occurrences. A count-min sketch counts those: each task adds up its own part, the parts are merged by cell, and a window is taken
further only if the estimate of every row of the sketch is at least two. Estimates are never too low, so no repeated window is lost. The
sketch is a distributed table whose width follows the corpus; nothing of it is sent to the driver or broadcast. A second pass groups
exactly the windows that are left, by 96 bits of their words' hashes, and finds the first occurrence of each.

A null text has no words. Texts with fewer words than a window lose nothing. Copies of a whole text lose all windows without being
searched. Rows without an id are neither searched nor changed. Rows that share id and text are treated alike; of different texts under
one id one is searched and the others stay as they are. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.store import discard, stored
from tidewell.llm.texthash import WHITE, blocks, mix, runs_hash, spans, sums, word_hashes, words

SEED_WORDS = 5
CELLS_PER_ITEM = 16
DEPTH = 2


def minimiser_runs(h: np.ndarray, window: int, seed_words: int) -> tuple[np.ndarray, np.ndarray]:
    """For one text's word hashes: the minimiser of each run of windows that share one occurrence of it, and the first window of each run."""
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    a = runs_hash(h, np.arange(len(h) - seed_words + 1), seed_words)
    reach = window - seed_words + 1
    least, width = a, 1
    while width * 2 <= reach:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[reach - width : reach - width + n])
    new = np.ones(n, dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (a[: n - 1] == least[:-1])
    at = np.flatnonzero(new)
    return least[at], at


def _profiles(documents: DataFrame, window: int) -> DataFrame:
    """Per row: id, text key, fingerprint of the text's words, number of words, digest of all words, minimisers and where their runs begin."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for low, high, data, offsets in blocks(part.column(1)):
                starts, ends, bounds = words(data, offsets, WHITE)
                h = word_hashes(data, starts, ends, lower=False)
                place = np.arange(len(h), dtype=np.uint64) - np.repeat(bounds[:-1], np.diff(bounds)).astype(np.uint64)
                print_a = sums(mix(h ^ mix(place + np.uint64(1))), bounds)
                print_b = sums(mix(h + mix(place + np.uint64(7))), bounds)
                cells, at, digests = [], [], []
                edges = bounds.tolist()
                for k in range(high - low):
                    c, a = minimiser_runs(h[edges[k] : edges[k + 1]], window, SEED_WORDS)
                    cells.append(c)
                    at.append(a)
                    digests.append(hashlib.sha256(b" ".join(data[offsets[k] : offsets[k + 1]].tobytes().split())).hexdigest())
                cuts = np.concatenate(([0], np.cumsum([len(c) for c in cells]))).astype(np.int32)
                columns = [
                    part.column(0)[low:high], part.column(2)[low:high], pa.array(print_a.view(np.int64)), pa.array(print_b.view(np.int64)), pa.array(np.diff(bounds)), pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(cells).view(np.int64))),
                    pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(at).astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "print_a", "print_b", "n_words", "digest", "cells", "at"])

    return documents.mapInArrow(run, "doc_id long, key long, print_a long, print_b long, n_words long, digest string, cells array<long>, at array<int>")


def _prefiltered(runs: DataFrame, items: int) -> DataFrame:
    """Runs (cell, ...) whose minimiser may occur more than once, by every row of a count-min sketch of ``CELLS_PER_ITEM * items`` cells.

    A later row counts only what the earlier ones let pass. All occurrences of a repeated item pass together, so its count stays complete.
    """
    width = max(1, CELLS_PER_ITEM * items - 1).bit_length()
    for row in range(DEPTH):
        cell = F.shiftrightunsigned(F.xxhash64(F.col("cell"), F.lit(row)), max(0, 64 - width))
        counted = runs.withColumn("bucket", cell)
        hot = counted.groupBy("bucket").agg(F.count("*").alias("estimate")).filter("estimate > 1").select("bucket")
        runs = counted.join(hot, "bucket", "left_semi").drop("bucket")
    return runs


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """Of (doc_id, text, runs): windows still to compare, (h1, h2, doc_id, at), and windows known to be repeats, as (doc_id, at, n) without h1.

    A window that occurs twice in one block of documents is settled there, and only its first occurrence is compared with other blocks.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column(2)
            for low, high, data, offsets in blocks(part.column(1)):
                starts, ends, bounds = words(data, offsets, WHITE)
                h = word_hashes(data, starts, ends, lower=False)
                mine = lists[low:high]
                flat = mine.flatten()
                count = np.asarray(mine.value_lengths().fill_null(0))
                first, n = np.asarray(flat.field(0)).astype(np.int64), np.asarray(flat.field(1)).astype(np.int64)
                owner = np.repeat(np.arange(high - low), count)
                place = spans(bounds[owner] + first, n)
                owner = np.repeat(owner, n)
                ids = np.asarray(part.column(0)[low:high]).astype(np.int64)[owner]
                h1 = runs_hash(h, place, window, 1)
                h2 = (runs_hash(h, place, window, 2) >> np.uint64(33)).astype(np.int32)
                at = place - bounds[owner]
                order = np.lexsort((at, ids, h2, h1))
                repeat = np.zeros(len(order), dtype=bool)
                a, b = order[1:], order[:-1]
                repeat[1:] = (h1[a] == h1[b]) & (h2[a] == h2[b])
                open_ = order[~repeat]
                again = order[repeat]
                settled = np.zeros(len(order), dtype=bool)
                settled[again] = True
                # the same place of the same document, met twice through a repeated row, is no earlier place
                lead = order[np.maximum.accumulate(np.where(~repeat, np.arange(len(order)), 0))]
                same = (ids[lead] == ids[order]) & (at[lead] == at[order])
                settled[order[same]] = False
                marks = np.flatnonzero(settled)
                breaks = np.ones(len(marks), dtype=bool)
                breaks[1:] = (np.diff(place[marks]) != 1) | (np.diff(owner[marks]) != 0)
                heads = marks[breaks]
                lengths = np.diff(np.append(np.flatnonzero(breaks), len(marks)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(h1[open_].view(np.int64)), pa.nulls(len(heads), pa.int64())]),
                        pa.array(np.concatenate((h2[open_], np.zeros(len(heads), np.int32)))),
                        pa.array(np.concatenate((ids[open_], ids[heads]))),
                        pa.array(np.concatenate((at[open_], at[heads])).astype(np.int32)),
                        pa.array(np.concatenate((np.ones(len(open_), np.int32), lengths.astype(np.int32)))),
                    ],
                    names=["h1", "h2", "doc_id", "at", "n"],
                )

    return texts.mapInArrow(run, "h1 long, h2 int, doc_id long, at int, n int")


def _kept(texts: DataFrame, window: int, with_text: bool) -> DataFrame:
    """Of (doc_id, text, repeats): what is left after removing every word that a repeated window covers."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            removed, digests, left_texts = [], [], []
            for text, repeats in zip(part.column(1), part.column(2), strict=True):
                tokens = (text.as_py() or "").encode().split()
                cover = np.zeros(len(tokens) + 1, dtype=np.int64)
                for r in repeats.as_py():
                    cover[r["at"]] += 1
                    cover[r["at"] + r["n"] + window - 1] -= 1
                drop = np.cumsum(cover[:-1]) > 0
                left = b" ".join(t for t, d in zip(tokens, drop.tolist(), strict=True) if not d)
                removed.append(int(drop.sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                left_texts.append(left.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(3), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(left_texts, pa.string())],
                names=["doc_id", "key", "n_removed", "kept_sha256", "kept_text"],
            )

    return texts.mapInArrow(run, "doc_id long, key long, n_removed long, kept_sha256 string, kept_text string")


def repeated_passages_removed(documents: DataFrame, window: int = 20, id_column: str = "doc_id", text_column: str = "text", with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and, on request, kept_text (the changed texts; null where nothing changed)."""
    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    source = source.withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
    profiles = stored(_profiles(source, window), "profiles", free=True)
    fingerprint = ["print_a", "print_b", "n_words"]
    identified = profiles.filter("doc_id is not null")
    first = identified.filter(F.col("n_words") >= window).groupBy(*fingerprint).agg(F.min("doc_id").alias("first_id"))
    main = identified.groupBy("doc_id").agg(F.min("key").alias("main_key"))
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    searched = ~copy & F.coalesce(F.col("key") == F.col("main_key"), F.lit(False)) & (F.col("n_words") >= window)
    slim = profiles.select("doc_id", "key", "print_a", "print_b", "n_words", "digest", F.size("cells").alias("items"))
    status = slim.join(first, fingerprint, "left").join(main, "doc_id", "left").select("doc_id", "key", "n_words", "digest", "items", copy.alias("copy"), searched.alias("searched"))
    status = stored(status, "status", free=True)
    last = F.col("n_words") - window + 1
    ends = F.concat(F.slice("at", F.lit(2), F.greatest(F.size("at") - 1, F.lit(0))), F.array(last.cast("int")))
    keys = status.filter("searched").select("doc_id", "key").dropDuplicates(["doc_id"])
    originals = profiles.join(keys, ["doc_id", "key"], "left_semi")
    runs = originals.select("doc_id", F.explode(F.arrays_zip("cells", "at", ends.alias("upto"))).alias("r")).select(
        F.col("r.cells").alias("cell"), "doc_id", F.col("r.at").alias("at"), (F.col("r.upto") - F.col("r.at")).alias("n")
    )
    items = status.filter("searched").agg(F.sum("items")).first()[0] or 0
    likely = stored(_prefiltered(runs, items).groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).alias("runs")), "likely", free=True)
    discard(profiles)
    found = stored(_windows(source.join(likely.join(keys, "doc_id"), ["doc_id", "key"]).select("doc_id", "text", "runs"), window), "windows", free=True)
    discard(likely)
    pending = found.filter("h1 is not null").select("h1", "h2", "doc_id", "at")
    # A document is never divided between blocks, so it has at most one place left per window: the least document has the first place.
    firsts = pending.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")).filter("first_doc < last_doc").drop("last_doc")
    later = pending.join(firsts, ["h1", "h2"]).filter("doc_id > first_doc").select("doc_id", "at", F.lit(1).alias("n"))
    repeats = later.union(found.filter("h1 is null").select("doc_id", "at", "n")).groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).alias("repeats"))
    repeats = stored(repeats.join(keys, "doc_id"), "repeats", free=True)
    discard(found)
    changed = _kept(source.join(repeats, ["doc_id", "key"]).select("doc_id", "text", "repeats", "key"), window, with_text)
    changed = stored(changed.dropDuplicates(["doc_id", "key"]), "changed", free=True)
    discard(repeats)
    nothing = hashlib.sha256(b"").hexdigest()
    joined = status.select("doc_id", "key", "n_words", "digest", "copy").join(changed, ["doc_id", "key"], "left")
    out = joined.select(
        "doc_id", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )
    return out if with_text else out.drop("kept_text")
