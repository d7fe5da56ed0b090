"""Hard negatives, source mixing and importance resampling against brute force, and their defined results for odd input."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.llm import mixing, negatives, resampling

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# --- hard negatives ---------------------------------------------------------------------------

def mined(rows, every, k=5, m=5, percent=80):
    """rows: {id: (label, whole numbers)}."""
    out = set()
    for a, (label, x) in rows.items():
        if a % every:
            continue
        scored = sorted(((max(min(sum(p * q for p, q in zip(x, y, strict=False)), 2**63 - 1), -(2**63)), b, other) for b, (other, y) in rows.items() if b != a), key=lambda s: (-s[0], s[1]))
        for score, b, _ in [s for s in scored if s[2] == label][:k]:
            window = [s for s in scored if s[2] != label and percent * score <= 100 * s[0] <= 100 * score][:m]
            out |= {(a, b, rank, n, score, own) for rank, (own, n, _) in enumerate(window, 1)}
    return out


def answers(df):
    return {(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect()}


@pytest.mark.parametrize("block", [8192, 40])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((4, 12))
    # Coarse components make many ties; every third row is a copy of one vector.
    data = {i: (int(rng.integers(0, 4)), np.round(centres[0 if i % 3 == 0 else i % 4] + 0.3 * (i % 3 > 0) * rng.standard_normal(12), 1).tolist()) for i in range(300)}
    df = spark.createDataFrame([(i, label, v, "x", 1) for i, (label, v) in data.items()], "vec_id long, label int, embedding array<double>, id string, cell int").repartition(5)
    got = answers(negatives.hard_negatives(df, F.col("vec_id") % 10 == 0))
    want = mined({i: (label, [math.floor(256 * c) for c in v]) for i, (label, v) in data.items()}, 10)
    assert len(want) > 300 and got == want


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.9]), (2, 2, [0.9]), (3, 2, [0.85, 0.95, 7.0]), (4, 3, [1.0, 0.5]), (5, None, [1.0, 1.0]), (6, 1, None), (7, 1, [nan, 1.0]), (8, 2, [inf, 1.0]),
        (9, 2, [None, 1.0]), (None, 1, [1.0, 1.0]), (10, 1, [-1.0, -1.0]), (11, 2, []), (1, 1, [1.0, 0.9]), (1, 2, [5.0, 5.0]), (20, 7, [1e6, -1e6]), (21, 7, [3e15, 1.0]), (22, 8, [2.9e15, 1.0]), (30, 9, [1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = answers(negatives.hard_negatives(df, F.col("vec_id") % 10 == 0))
    plain = {0: (1, [1, 1]), 1: (1, [1, 0.9]), 2: (2, [0.9]), 3: (2, [0.85, 0.95, 7]), 4: (3, [1, 0.5]), 10: (1, [-1, -1]), 11: (2, []), 20: (7, [1e6, -1e6]), 21: (7, [3e15, 1]), 22: (8, [2.9e15, 1]), 30: (9, [1])}
    assert got == mined({i: (label, [math.floor(256 * c) for c in v]) for i, (label, v) in plain.items()}, 10)
    assert any(a == 20 and n == 22 for a, _, _, n, _, _ in got)
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(df, F.col("vec_id") < 0).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=60), st.lists(st.integers(0, 20), min_size=1, max_size=5))
def test_suffixes_of_slots_answer_every_window(scores, limits):
    limits = sorted(limits, reverse=True)
    scores = np.array(scores, dtype=np.float64)
    inside = np.flatnonzero((scores <= limits[0]) & (scores >= negatives.least_score(limits[-1], 80)))
    slot = negatives.slots_of(scores[inside], limits)
    kept = {s: scores[inside[slot == s][negatives.best(scores[inside[slot == s]], 5)]].tolist() for s in range(len(limits))}
    for n, p in enumerate(limits):
        merged = [x for s in range(n, len(limits)) for x in kept[s] if x >= negatives.least_score(p, 80)][:5]
        assert merged == sorted([x for x in scores if x <= p and 100 * x >= 80 * p], reverse=True)[:5]


def test_products_are_exact_at_any_size():
    big = np.array([[1 << 30, 3], [-(1 << 31), (1 << 31) - 1]])
    got = negatives.products(big, big)
    assert [[int(x) for x in row] for row in got] == [[sum(int(p) * int(q) for p, q in zip(a, b, strict=True)) for b in big] for a in big]


# --- mixing -----------------------------------------------------------------------------------

def reshared(sizes, weights=(3, 1, 2), percent=150, most=2):
    """Targets by repeated resharing. sizes: {source: words}."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, targets, open_sources = percent / 100 * sum(sizes.values()), {}, list(order)
    while open_sources:
        share = {s: budget * weight[s] / sum(weight[o] for o in open_sources) for s in open_sources}
        above = [s for s in open_sources if share[s] > most * sizes[s]]
        if not above:
            return targets | share
        for s in above:
            targets[s] = most * sizes[s]
            budget -= targets[s]
        open_sources = [s for s in open_sources if s not in above]
    return targets


def mixed_by_sorting(rows):
    """{row number: (size, source_size, target, taken)} for rows (doc_id, text, source)."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    h = [int(hashlib.md5(f"{'' if d is None else d}:{t or ''}".encode()).hexdigest()[:15], 16) for d, t, _ in rows]
    sizes = Counter()
    for (_, _, s), n in zip(rows, size, strict=True):
        sizes[s] += n
    targets, out = reshared(sizes), {}
    for source in sizes:
        times, rest = divmod(math.floor(targets[source] + 1e-9), sizes[source]) if sizes[source] else (0, 0)
        cells = defaultdict(list)
        for i, row in enumerate(rows):
            if row[2] == source:
                cells[h[i]].append(i)
        for _, own in sorted(cells.items()):
            words = sum(size[i] for i in own)
            for i in own:
                once = size[i] if words <= rest else size[i] * max(rest, 0) // words if words else 0
                out[i] = (size[i], sizes[source], targets[source], times * size[i] + once)
            rest -= words
    return out


def test_mixing_equals_sorting(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    third = documents.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    for table in (documents, third, documents.withColumn("source", F.lit("only"))):
        rows = [(r["doc_id"], r["text"], r["source"]) for r in table.collect()]
        want = {rows[i][0]: v for i, v in mixed_by_sorting(rows).items()}
        got = {r["doc_id"]: (r["size"], r["source_size"], r["target"], r["taken"]) for r in mixing.mixed(table).collect()}
        assert got.keys() == want.keys()
        for k, (size, source_size, target, taken) in want.items():
            assert got[k][:2] == (size, source_size) and math.isclose(got[k][2], target, abs_tol=1e-6) and abs(got[k][3] - taken) <= 1 and got[k][3] <= 2 * size
        for source in {r[2] for r in rows}:
            taken = sum(got[d][3] for d, _, s in rows if s == source)
            target = next(got[d][2] for d, _, s in rows if s == source)
            assert target - 1 <= taken <= target


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=8))
def test_targets_equal_repeated_resharing(spark, sizes):
    rows = [(None if i == 0 else f"s{i}", n) for i, n in enumerate(sizes)]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = reshared(dict(rows))
    assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-6) for s in want)


def test_mixing_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y z", None), (None, "p q", "a"), (4, "w " * 4000, "b"), (5, "é b c", "ä"), *[(6, "one two three", "b")] * 40, *[(None, "same words here now", "c")] * 30, (7, "\t\n ", "empty")]
    df = spark.createDataFrame([(*r, 9, 9.0, "x") for r in rows], "doc_id long, text string, source string, taken int, target double, cell string").repartition(4)
    mixed = mixing.mixed(df)
    assert mixed.columns == ["doc_id", "text", "source", "cell", "size", "source_size", "target", "taken"]
    got = Counter((r["doc_id"], r["text"], r["source"], r["size"], r["source_size"], r["taken"]) for r in mixed.collect())
    assert got == Counter((*rows[i], v[0], v[1], v[3]) for i, v in mixed_by_sorting(rows).items())
    assert mixing.mixed(df.limit(0)).count() == 0
    for r in mixing.mixture(mixed).groupBy("doc_id", "source", "text").agg(F.count("*").alias("n")).collect():
        assert len(WORD.findall(r["text"])) > 0
    words = sum(len(WORD.findall(r["text"])) for r in mixing.mixture(mixed).collect())
    assert words == mixed.agg(F.sum("taken")).first()[0]


# --- resampling -------------------------------------------------------------------------------

def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def drawn_by_hand(rows, target, percent=25):
    """[(doc_id, n_features, weight, score, rank)] for rows (doc_id, text)."""
    def features(text):
        w = ALNUM.findall(lower(text))
        return len(w), [zlib.crc32(f.encode()) % 10000 for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]]

    s, t = Counter(), Counter()
    found = [features(text) for _, text in rows]
    for _, f in found:
        s.update(f)
    for text in target:
        t.update(features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out = []
    for (doc, _), (n, f) in zip(rows, found, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted(tuple(r[:5]) for r in out) if all(r[0] is not None for r in out) else out


@pytest.mark.parametrize(("head", "piece"), [(None, None), (3, 64)])
def test_resampling_equals_brute_force(spark, monkeypatch, head, piece):
    """Also with a head of three words and pairs, counts flushed all the time, and texts in small pieces."""
    if head:
        monkeypatch.setattr(resampling.find_head, "__defaults__", (head, head))
        monkeypatch.setattr(resampling, "OPEN_COUNTS", 8)
        monkeypatch.setattr(resampling, "PIECE", piece)
    documents, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = resampling.resampled(documents.repartition(5), benchmark)
    want = drawn_by_hand(rows, [r["text"] for r in benchmark.collect()])
    assert sorted((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()) == want
    ids = {w[0] for w in want if w[4]}
    assert {r["doc_id"] for r in resampling.drawn(documents, got).collect()} == ids


def test_resampling_odd_rows(spark):
    text = "alpha Beta gamma-delta é日本 " * 8
    rows = [(1, None), (2, ""), (3, "--- !!"), (4, "one"), *[(5, text)] * 3, (6, "word " * 30000), (None, text), *[(10 + k, f"{text} extra{k % 3}") for k in range(60)], *[(100 + k, "alpha") for k in range(9)]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, bucket string, score int").repartition(4)
    target = spark.createDataFrame([(1, None), (2, "alpha beta"), (3, "")], "item_id long, text string")
    got = resampling.resampled(df, target).collect()
    want = drawn_by_hand(rows, [None, "alpha beta", ""])
    key = lambda r: (r[0] is None, r[0] or 0, r[4] is None, r[4] or 0)
    assert sorted([(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got], key=key) == sorted([tuple(r[:5]) for r in want], key=key)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 1 + 25 * 65 // 100))
    assert resampling.resampled(df.limit(0), target).count() == 0
    assert len(resampling.resampled(df, target.limit(0)).collect()) == len(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 é-日\n", max_size=80)), min_size=1, max_size=4), st.integers(1, 12))
def test_blocks_hold_all_features(texts, piece):
    before, resampling.PIECE = resampling.PIECE, piece
    head, found = resampling.Head([b"a"], [(b"a", b"b")]), defaultdict(list)
    try:
        for block in resampling.word_blocks(pa.array(texts, pa.string())):
            words, pairs = head.features(block)
            for n, row in enumerate(block.rows):
                found[row] += words[max(block.bounds[n], block.seen) : block.bounds[n + 1]].tolist() + pairs[block.pair_bounds[n] : block.pair_bounds[n + 1]].tolist()
                assert block.n_words[n] + block.seen == block.bounds[n + 1] - block.bounds[n]
    finally:
        resampling.PIECE = before
    for row, text in enumerate(texts):
        w = ALNUM.findall(lower(text))
        assert Counter(found[row]) == Counter(zlib.crc32(f.encode()) % 10000 for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))])
