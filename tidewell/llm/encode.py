"""Byte-level BPE of whole texts: pre-token boundaries by array operations, ids by ``tokenizers``, each distinct pre-token once.

The pre-tokenizer of the vocabulary splits a text by
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``. Its pieces are encoded independently of each
other, so a piece's ids can be kept. Which class a character belongs to is asked of the tokenizer itself, once per character.
Special tokens' strings inside a text are ordinary text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

from tidewell.llm.texthash import mix, powers, spans

CACHE_PIECES = 1_500_000
BLOCK_CHARS = 1 << 19
_BASE = 0xA0761D6478BD642F
_LETTER, _NUMBER, _SPACE, _OTHER, _UNKNOWN = 0, 1, 2, 3, 255
_encoders: dict[str, Encoder] = {}


def _shown_bytes() -> dict[int, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: 256 + k for k, b in enumerate(others)}


_SHOWN = _shown_bytes()


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    """Ids of texts under one byte-level BPE vocabulary. Kept pieces are bounded by ``CACHE_PIECES`` and the pieces of
    one batch of texts; the bound changes no result."""

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind = np.full(0x110000, _UNKNOWN, dtype=np.uint8)
        self.power = powers(_BASE, BLOCK_CHARS + 1)
        self.inverse = powers(pow(_BASE, -1, 1 << 64), BLOCK_CHARS + 1)
        self._forget()

    def byte_lengths(self) -> np.ndarray:
        """How many bytes of text each id stands for: a vocabulary entry has one character per byte."""
        names = self.tokenizer.get_vocab()
        out = np.zeros(max(names.values()) + 1, dtype=np.int64)
        for name, i in names.items():
            out[i] = len(name)
        return out

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.where = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def _classify(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kind[points]
        if (kinds == _UNKNOWN).any():
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str
            for point in np.unique(points[kinds == _UNKNOWN]):
                c = chr(point)
                if len(split("a" + c)) == 1:
                    self.kind[point] = _LETTER
                elif len(split("1" + c)) == 1:
                    self.kind[point] = _NUMBER
                elif len(split("!" + c)) == 1:
                    self.kind[point] = _OTHER
                else:
                    self.kind[point] = _SPACE
            kinds = self.kind[points]
        return kinds

    def _cuts(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where pieces begin. ``first``: positions at which texts begin."""
        kinds = self._classify(points)
        start = np.ones(len(points), dtype=bool)
        start[1:] = kinds[1:] != kinds[:-1]
        begins = np.zeros(len(points), dtype=bool)
        begins[first] = True
        start |= begins
        after_space = np.flatnonzero((kinds[1:] != _SPACE) & (kinds[:-1] == _SPACE) & ~begins[1:]) + 1
        start[after_space - 1] = True
        start[after_space] = points[after_space - 1] != 32
        marks = np.flatnonzero((points == 39) & start)
        if len(marks):
            padded = np.concatenate((points, [0, 0, 0]))
            inner = np.concatenate((~begins, [False, False, False]))
            one, two = padded[marks + 1], padded[marks + 2]
            short = inner[marks + 1] & np.isin(one, [ord(c) for c in "stmd"])
            pairs = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
            long = ~short & inner[marks + 1] & inner[marks + 2] & pairs
            for hit, step in ((short, 2), (long, 3)):
                at = marks[hit]
                start[at + 1] = False
                end = at + step
                end = end[end < len(points)]
                start[end] |= kinds[end] == _LETTER
        return np.flatnonzero(start)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        tokenize = self.tokenizer.model.tokenize
        coded = [[token.id for token in tokenize(t.encode().decode("latin-1").translate(_SHOWN))] for t in texts]
        size = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        where = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate((self.pool, np.fromiter((i for ids in coded for i in ids), dtype=np.int32, count=int(size.sum()))))
        keys = np.concatenate((self.keys, keys))
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.where = np.concatenate((self.where, where))[order]
        self.size = np.concatenate((self.size, size))[order]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and the bounds of each text."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        joined = "".join(texts)
        counts = np.zeros(len(texts), dtype=np.int64)
        if not joined:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        # a lone surrogate cannot come out of Arrow, so every text is valid here
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        starts = self._cuts(points, bounds[:-1][lengths > 0])
        ends = np.append(starts[1:], len(points))
        hashes = self._hashes(points, starts, ends)
        unique, one, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        found = self._find(unique)
        if (missing := np.flatnonzero(found < 0)).size:
            if len(self.keys) + len(missing) > CACHE_PIECES:
                # All pieces of these texts are learnt anew, so that each of them is there below, however many they are.
                self._forget()
                missing = np.arange(len(unique))
            at = one[missing]
            self._learn(unique[missing], [joined[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            found = self._find(unique)
        size, where = self.size[found][inverse], self.where[found][inverse]
        ids = self.pool[spans(where, size)]
        owner = np.searchsorted(bounds, starts, side="right") - 1
        counts += np.bincount(owner, weights=size, minlength=len(texts)).astype(np.int64)
        return ids, np.concatenate(([0], np.cumsum(counts)))

    def _find(self, unique: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(unique), -1)
        at = np.minimum(np.searchsorted(self.keys, unique), len(self.keys) - 1)
        return np.where(self.keys[at] == unique, at, -1)

    def _hashes(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), dtype=np.uint64)
        at = 0
        while at < len(starts):
            base = int(starts[at])
            upto = int(np.searchsorted(ends, base + BLOCK_CHARS, side="right"))
            if upto <= at:  # one piece longer than a block
                value = 0
                for p in points[starts[at] : ends[at]].tolist():
                    value = (value * _BASE + p + 1) % (1 << 64)
                out[at] = mix(np.array([value], dtype=np.uint64))[0]
                at += 1
                continue
            piece = mix(points[base : ends[upto - 1]].astype(np.uint64) + np.uint64(1))
            total = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(piece * self.power[: len(piece)], out=total[1:])
            s, e = starts[at:upto] - base, ends[at:upto] - base
            out[at:upto] = mix((total[e] - total[s]) * self.inverse[s] + (e - s).astype(np.uint64))
            at = upto
        return out


def batches(texts: Iterable[str | None], limit: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """Lists of texts of about ``limit`` characters; a null is an empty text. A longer text stands alone."""
    out, size = [], 0
    for text in texts:
        text = text or ""
        if out and size + len(text) > limit:
            yield out
            out, size = [], 0
        out.append(text)
        size += len(text)
    if out:
        yield out
