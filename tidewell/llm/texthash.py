"""Vectorised word and shingle hashing of whole texts inside Arrow batches.

Words are hashed from the UTF-8 bytes of an Arrow column without building Python strings. A word's hash is a random
polynomial over its bytes modulo 2^64, finished by an avalanche step. Work memory depends on ``CHUNK``, not on text length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
BLOCK = 1 << 21

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}


def _table(name: str, base: int) -> np.ndarray:
    if name not in _tables:
        _tables[name] = powers(base, CHUNK + 1)
    return _tables[name]


def byte_class(inside: str) -> np.ndarray:
    """A table over bytes: whether one belongs to a word. ``space``: all but ASCII white space; ``alnum``: 0-9, a-z, A-Z and above ASCII."""
    is_word = np.ones(256, dtype=bool)
    if inside == "space":
        is_word[[9, 10, 11, 12, 13, 32]] = False
    else:
        is_word[:128] = False
        for low, high in ((48, 58), (65, 91), (97, 123)):
            is_word[low:high] = True
    return is_word


WHITE = byte_class("space")
ALNUM = byte_class("alnum")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of about ``limit`` bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        high = min(high, len(column))
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each text) of all words of a block; the last has one entry more than there are texts."""
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """One 64-bit hash per word; words longer than a chunk are folded piece by piece."""
    out = np.empty(len(starts), dtype=np.uint64)
    power, inverse = _table("power", _BASE), _table("inverse", _INVERSE)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        upto = int(np.searchsorted(ends, base + CHUNK, side="right"))
        if upto <= at:
            out[at] = _long_word(data[starts[at] : ends[at]], lower, power)
            at += 1
            continue
        piece = data[base : ends[upto - 1]]
        if lower:
            piece = _LOWER[piece]
        total = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[piece] * power[: len(piece)], out=total[1:])
        s, e = starts[at:upto] - base, ends[at:upto] - base
        out[at:upto] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64) * _ODD)
        at = upto
    return out


def _long_word(piece: np.ndarray, lower: bool, power: np.ndarray) -> np.uint64:
    if lower:
        piece = _LOWER[piece]
    total, scale = 0, 1
    for k in range(0, len(piece), CHUNK):
        part = piece[k : k + CHUNK]
        total = (total + scale * int((_BYTE[part] * power[: len(part)]).sum(dtype=np.uint64))) % (1 << 64)
        scale = scale * pow(_BASE, len(part), 1 << 64) % (1 << 64)
    seed = np.array([(total + len(piece) * int(_ODD)) % (1 << 64)], dtype=np.uint64)
    return mix(seed)[0]


def shingle_hashes(h: np.ndarray, bounds: np.ndarray, width: int, whole_if_short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside each text, and their bounds per text.

    With ``whole_if_short`` a text with fewer words has its whole sequence as its one shingle.
    """
    counts = np.diff(bounds)
    n = np.maximum(counts - width + 1, 0)
    rolled = runs_hash(h, np.arange(max(len(h) - width + 1, 0)), width)
    take = spans(bounds[:-1], n)
    got = rolled[take]
    if whole_if_short:
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            extra = np.array([_fold(h[bounds[i] : bounds[i + 1]]) for i in short], dtype=np.uint64)
            got = np.insert(got, np.concatenate(([0], np.cumsum(n)))[short], extra)
            n = n.copy()
            n[short] = 1
    return got, np.concatenate(([0], np.cumsum(n)))


def runs_hash(h: np.ndarray, at: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hashes of the runs of ``width`` words that begin at the given places: a random linear form of the words' hashes, mixed."""
    factors = mix(np.arange(1 + seed * 1000, 1 + seed * 1000 + width, dtype=np.uint64) * _ODD) | np.uint64(1)
    dense = len(at) and len(at) == at[-1] - at[0] + 1
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(width):
        total += (h[at[0] + k : at[-1] + k + 1] if dense else h[at + k]) * factors[k]
    return mix(total + _ODD)


def _fold(h: np.ndarray) -> int:
    value = np.array([len(h)], dtype=np.uint64)
    for x in h:
        value = mix(value + _ODD) ^ x
    return int(mix(value)[0])


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of the given runs, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Index of the text that each value belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, and their bounds."""
    v = values.copy()
    edges = bounds.tolist()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        v[a:b].sort()
    keep = np.ones(len(v), dtype=bool)
    keep[1:] = v[1:] != v[:-1]
    firsts = bounds[:-1]
    keep[firsts[firsts < len(v)]] = True
    kept = np.concatenate(([0], np.cumsum(keep)))
    return v[keep], kept[bounds]


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each text's values, modulo 2^64 for integers."""
    total = np.zeros(len(values) + 1, dtype=values.dtype)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
