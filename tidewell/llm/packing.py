"""Cost-balanced packing of whole texts into token sequences.

A piece's estimated cost is ``linear * n + quadratic * n^2`` for n tokens, as attention does not cross pieces. Each task packs blocks of
about ``block_tokens`` tokens: documents in descending size go to the sequence with the lowest cost so far that still has room.

Nulls and empty texts are one piece holding only the end id. Ties keep input order. Repeated rows are packed as often as they occur.
An empty table gives no rows. Other columns of the input are ignored. A document longer than a sequence is cut into whole sequences
and a rest. A rest that fits nowhere is cut at the largest gap. A block wastes less than one sequence of tokens in all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.encode import batches, encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long"
BLOCK_TOKENS = 1 << 20


def assign(sizes: np.ndarray, capacity: int, linear: float = 1.0, quadratic: float = 1.0 / 1024) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length); every token of every document is in exactly one of them."""
    sequences: list[list[tuple[int, int, int]]] = []
    rests: list[tuple[int, int, int]] = []
    for doc, size in enumerate(sizes.tolist()):
        whole = size - size % capacity
        sequences.extend([(doc, at, capacity)] for at in range(0, whole, capacity))
        if size > whole:
            rests.append((size - whole, doc, whole))
    rests.sort(key=lambda r: (-r[0], r[1]))
    n = -(-sum(r[0] for r in rests) // capacity)
    room, cost = np.full(n, capacity, dtype=np.int64), np.zeros(n)
    held: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    for size, doc, start in rests:
        while size:
            fits = room >= size
            take = size
            if fits.any():
                best = int(np.argmin(np.where(fits, cost, np.inf)))
            else:
                best = int(np.argmax(room))
                take = int(room[best])
            held[best].append((doc, start, take))
            room[best] -= take
            cost[best] += linear * take + quadratic * take * take
            start, size = start + take, size - take
    return sequences + held


def pack(documents: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text",
         linear: float = 1.0, quadratic: float = 1.0 / 1024, block_tokens: int = BLOCK_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: its document and place there, the checksum of its ids, its sequence and place there, the sequence's padded length.

    ``with_ids`` adds the piece's token ids. A sequence whose length is a power of two needs no padding.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        keys: list = []
        held: list[np.ndarray] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence, keys, held, tokens
            sizes = np.array([len(x) for x in held], dtype=np.int64)
            rows = []
            for pieces in assign(sizes, capacity, linear, quadratic):
                offset = 0
                filled = sum(p[2] for p in pieces)
                padded = filled if filled & (filled - 1) == 0 else capacity
                for doc, start, length in pieces:
                    crc = zlib.crc32(held[doc][start : start + length].tobytes())
                    rows.append((doc, start, length, crc, len(held[doc]), sequence, offset, padded))
                    offset += length
                sequence += 1
            columns = [pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)]
            documents_of = pa.array([keys[r[0]] for r in rows], pa.int64())
            out = [documents_of, *columns[1:]]
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            if with_ids:
                out.append(pa.array([held[r[0]][r[1] : r[1] + r[2]].astype(np.int32) for r in rows], pa.list_(pa.int32())))
                names.append("ids")
            keys, held, tokens = [], [], 0
            return pa.RecordBatch.from_arrays(out, names=names)

        for part in parts:
            ids = part.column(0).to_pylist()
            at = 0
            for texts in batches(x.as_py() for x in part.column(1)):
                coded, bounds = code.encode(texts)
                coded = coded.astype("<u4")
                for k in range(len(texts)):
                    held.append(np.append(coded[bounds[k] : bounds[k + 1]], np.uint32(end_id)))
                    keys.append(ids[at])
                    tokens += len(held[-1])
                    at += 1
                    if tokens >= block_tokens:
                        yield flush()
        if keys:
            yield flush()

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, schema)
