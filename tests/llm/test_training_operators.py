"""Training-data operators against brute force on small tables, and their defined results for odd input."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.llm import decontaminate, embeddings, licenses, lines, minhash, packing, quality, store, substring, token_counts, toxicity
from tidewell.llm.encode import Encoder, encoder
from tidewell.llm.queries import vocabulary
from tidewell.llm.store import components

SF = "/root/testdata/sf0.001"
ODD = [
    (1, None, "en"), (2, "", "en"), (3, "  \n\n ", None), (4, "the the the the the", "en"), (5, "one two", "en"), (5, "one two", "en"),
    (None, "no id at all here", "en"), (6, "word " * 3000 + "end", "de"), (7, "Ünïcode 😀 日本語 's it's 12½ x", "de"), (8, "x" * 5000, "en"),
    (9, "line one is here\nline one is here\r\nLicensed under the Apache License, Version 2.0.", "en"), (10, "one two", "fr"),
]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use themselves."""
    rows = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    return rows.withColumns({"key": F.lit("k"), "n": F.lit(1), "label": F.lit(None).cast("int"), "score": F.lit("s"), "rep": F.lit(2), "place": F.lit(0)}).repartition(3)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.collect()}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


class Union:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


PIECES = st.text(alphabet=" '  \n\t\rsltrevmdDX1½!.é日😀_", max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=6))
def test_encoder_equals_the_tokenizer(texts):
    code = encoder(vocabulary())
    ids, bounds = code.encode(texts)
    want = [e.ids for e in code.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want




def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 80, (60, 2))] + [(100 + i, 101 + i) for i in range(40)] + [(300, i) for i in range(301, 360)]
    union = Union()
    for a, b in edges:
        if a != b:
            union.join(a, b)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame([*edges, (None, 3)], "u long, v long")).collect()}
    assert got == {x: union.root(x) for x in union.parent}


@pytest.mark.parametrize("rule", ["start", "largest", "share"])
def test_token_counts_add_up(spark, documents, texts, rule):
    code = Encoder(vocabulary())
    got = defaultdict(float)
    for r in token_counts.line_token_counts(documents, vocabulary(), rule).collect():
        got[r["doc_id"]] += r["tokens"]
    for doc, text in texts.items():
        assert abs(got[doc] - len(code.tokenizer.encode(text, add_special_tokens=False).ids)) < 1e-6


def test_token_allocation_rules():
    ends, sections = np.array([3, 7, 8]), np.array([4, 4, 8])
    assert token_counts.allocate(ends, sections, "start")[0].tolist() == [2, 0, 1]
    assert token_counts.allocate(ends, sections, "largest")[0].tolist() == [1, 0, 2]
    assert token_counts.allocate(ends, sections, "share")[0].tolist() == [1.25, 0, 1.75]


def test_field_counts(spark):
    rows = spark.createDataFrame([(1, "http://a", "some words"), (2, None, "")], "doc_id long, url string, html string")
    got = token_counts.field_token_counts(rows, ["url", "html"], vocabulary()).collect()
    assert sorted((r["doc_id"], r["section"]) for r in got) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    assert sum(r["length"] for r in got if r["doc_id"] == 1) == len("http://a\nsome words")


def packed_right(rows, want):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= 1024
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(want[doc])
            assert r["ids_crc32"] == zlib.crc32(want[doc][at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(want[doc])


def test_packing_round_trip(documents, texts):
    code = Encoder(vocabulary())
    want = {d: np.array([*code.tokenizer.encode(t, add_special_tokens=False).ids, 0], dtype="<u4") for d, t in texts.items()}
    rows = packing.pack(documents, vocabulary()).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    packed_right(rows, want)
    padded = {r["sequence_id"]: r["padded_length"] for r in rows}
    assert sum(padded.values()) < 1.02 * sum(len(w) for w in want.values())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=40))
def test_assignment_loses_no_token(sizes):
    seen = defaultdict(int)
    for pieces in packing.assign(np.array(sizes, dtype=np.int64), 16):
        assert sum(p[2] for p in pieces) <= 16
        for doc, start, length in pieces:
            for k in range(start, start + length):
                seen[doc, k] += 1
    assert seen == {(d, k): 1 for d, n in enumerate(sizes) for k in range(n)}


def test_decontamination_finds_whole_and_edited_items(spark, documents, texts):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r["item_id"]: r["text"] for r in benchmark.collect()}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(documents, benchmark).collect()}
    whole = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert whole and whole <= got and not {d for d, _ in got} - {d for d, _ in whole}
    item = "what does the quick brown fox jump over in the old story ? it jumps over the lazy dog near the river bank"
    docs = [(1, "noise " * 200 + item.upper() + " noise" * 200), (2, item.replace("quick", "fast")), (3, "the story of a river and a dog " * 9), (4, " ".join(item.split()[:12]) + " pad" * 50), (5, None)]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(1, 7), (2, 7)}


def test_block_max_search_equals_full_scoring():
    rng = np.random.default_rng(5)
    names = [f"w{k}" for k in range(60)]
    index = decontaminate.build_index([(k, " ".join(rng.choice(names, rng.integers(3, 30)))) for k in range(100)])
    h = index.terms[rng.integers(0, len(index.terms), 900)]
    bounds = np.array([0, 40, 40, 500, 900])
    text, first, end, unit, score = decontaminate.search(index, h, bounds, 0.5)
    got = {(int(f), int(u)): s for f, u, s in zip(first, unit, score, strict=True)}
    want = {}
    for k in range(4):
        n = bounds[k + 1] - bounds[k]
        for f in range(bounds[k], bounds[k + 1], decontaminate.STRIDE):
            if f > bounds[k] and f - decontaminate.STRIDE + decontaminate.PASSAGE_WORDS >= bounds[k] + n:
                continue
            held = set(h[f : min(f + decontaminate.PASSAGE_WORDS, bounds[k + 1])].tolist())
            for u in range(len(index.items)):
                s = sum(index.posting_impact[p] for t in range(len(index.terms)) if int(index.terms[t]) in held for p in range(index.posting_start[t], index.posting_start[t + 1]) if index.posting_unit[p] == u)
                if s >= 0.5:
                    want[int(f), u] = s
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


@pytest.mark.parametrize(("name", "build"), [("quality", quality.quality), ("toxic", toxicity.toxicity)])
def test_classifiers(spark, name, build):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = build(documents, labels).join(labels, "doc_id").collect()
    learnt = [r for r in rows if not r["held_out"]]
    assert sum(r["predicted"] == r[name] for r in learnt) >= 0.97 * len(learnt)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r[name] for r in held) >= 0.9 * len(held)


def test_held_out_labels_are_not_read(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.toxicity(documents, x).collect()} for x in (labels, other))
    assert a == b


def license_matches(w):
    """The labels of the templates that match some run of a text's words, and the greatest containment."""
    more, best = set(), 0.0
    for t in licenses.TEMPLATES:
        full, span = set(t.text.split()), 2 * len(t.text.split())
        for i in range(max(1, len(w) - span + 1)):
            run = set(w[i : i + span])
            if 100 * len(run & full) >= 80 * len(full) and set(t.holds) <= run and not set(t.lacks) & run:
                more.add(t.label)
                best = max(best, len(run & full) / len(full))
    return more, best


def test_licenses(documents, texts):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in licenses.licenses(documents).collect():
        w = word.findall(lower(texts[r["doc_id"]]))
        places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        more, best = license_matches(w)
        base = {label for _, label in places}
        starts = [i for i, _ in places]
        want = (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if places else best)
        assert tuple(r)[1:] == want


def test_near_duplicates(documents, texts):
    sets = {}
    for doc, text in texts.items():
        w = WORD.findall(lower(text))
        sets[doc] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())
    union = Union()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                    union.join(a, b)
    rows = minhash.near_duplicates(documents).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == {d: (len(s), union.root(d)) for d, s in sets.items()}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_links_off_the_centre_are_found(spark):
    """A chain of texts, each close to the next only: no star alone joins it."""
    base = [f"w{k}" for k in range(300)]
    chain = []
    for k in range(12):
        own = base.copy()
        for j in range(k * 7, k * 7 + 7):
            own[j] = f"x{j}"
        base = own
        chain.append((k, " ".join(own)))
    rows = minhash.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in rows} == {0}


def test_large_groups_are_compared_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(store, "SMALL_GROUP", 0)
    monkeypatch.setattr(minhash, "BLOCK_SETS", 4)
    rng = np.random.default_rng(1)
    texts = {}
    for k in range(40):
        own = [f"w{j}" for j in range(120)]
        for j in rng.integers(0, 120, rng.integers(0, 14)).tolist():
            own[j] = f"x{k}_{j}"
        texts[k] = " ".join(own)
    sets = {k: {tuple(t.split()[i : i + 3]) for i in range(118)} for k, t in texts.items()}
    union = Union()
    for a in sets:
        for b in range(a):
            n = len(sets[a] & sets[b])
            if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                union.join(a, b)
    rows = minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {k: union.root(k) for k in texts}


def removed_by_hand(texts, window):
    seen, out = set(), {}
    for doc in sorted(texts):
        w = WORD.findall(texts[doc])
        cover = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                cover[i : i + window] = [True] * window
            seen.add(key)
        left = " ".join(x for x, c in zip(w, cover, strict=True) if not c)
        out[doc] = (len(w), sum(cover), hashlib.sha256(left.encode()).hexdigest())
    return out


def test_repeated_passages(documents, texts):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.repeated_passages_removed(documents).collect()}
    assert got == removed_by_hand(texts, 20)


def test_repeated_passages_inside_one_text(spark):
    texts = {1: "a b c " * 60, 2: " ".join(f"w{k}" for k in range(50)), 3: "z " + " ".join(f"w{k}" for k in range(10, 45)) + " a b c" * 10, 4: "a b c " * 60}
    got = substring.repeated_passages_removed(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()} == removed_by_hand(texts, 20)


def test_vectors(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((30, 24))
    vectors = [(i, (centres[i % 30] + rng.standard_normal(24) * 0.12 * (i % 5)).tolist()) for i in range(300)] + [(1000 + i, centres[0].tolist()) for i in range(40)]
    odd = [(2000, None), (2001, [0.0] * 24), (2002, [float("nan")] * 24), (2003, [1.0]), (2004, [None] + [1.0] * 23), (2005, []), (None, centres[0].tolist())]
    rows = embeddings.near_vectors(spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))).collect()
    ids, x = np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = x @ x.T >= 0.9
    np.fill_diagonal(true, False)
    got = {r["vec_id"]: r for r in rows}
    links = sum(got[int(i)]["n_links"] for i in ids)
    assert 0.9 * true.sum() <= links <= true.sum() and all(got[int(i)]["n_links"] <= n for i, n in zip(ids, true.sum(axis=1), strict=True))
    assert all(got[1000 + i]["component_id"] == 0 for i in range(40)) and got[1000]["n_links"] >= 39
    assert all(got[k]["n_links"] == 0 and got[k]["kept"] for k in range(2000, 2006)) and len(rows) == len(vectors) + len(odd)


def test_lines(documents, texts):
    first, union = {}, Union()
    for doc in sorted(texts):
        for place, line in enumerate(texts[doc].split("\n")):
            if line.strip(lines.WHITE):
                first.setdefault(line, (doc, place))
    runs = {x: {x[i : i + 5] for i in range(len(x) - 4)} or {x} for x in first}
    holders = defaultdict(list)
    for x, own in runs.items():
        counts = defaultdict(int)
        for s in own:
            for y in holders[s]:
                counts[y] += 1
            holders[s].append(x)
        for y, n in counts.items():
            if 100 * n >= 80 * (len(own) + len(runs[y]) - n):
                union.join(first[x], first[y])
    wrong = 0
    for r in lines.lines_deduplicated(documents).collect():
        kept = [x for place, x in enumerate(texts[r["doc_id"]].split("\n")) if not x.strip(lines.WHITE) or union.root(first[x]) == (r["doc_id"], place)]
        wrong += r["text"] != "\n".join(kept)
        assert r["n_chars"] == len(r["text"])
    assert wrong <= 1  # a search by signatures may miss a link


def test_odd_rows(spark, odd):
    """Nulls, empty and very long texts, repeated rows and clashing names: every operator gives a row where its docstring says so."""
    n = len(ODD)
    labels = spark.createDataFrame([(5, 1, 1), (5, 0, 0), (4, None, None), (99, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (3, "one two")], "item_id long, text string")
    counts = token_counts.line_token_counts(odd, vocabulary()).collect()
    assert {r["doc_id"] for r in counts} == {2, 3, 4, 5, None, 6, 7, 8, 9, 10}
    pieces = packing.pack(odd, vocabulary()).collect()
    assert sum(r["start"] == 0 for r in pieces) == n
    assert {r["doc_id"] for r in decontaminate.contaminated(odd, benchmark).collect()} == {5, 10}
    for build in (quality.quality, toxicity.toxicity):
        scores = build(odd, labels).collect()
        assert len(scores) == n and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in scores)
        assert len(build(odd, labels.limit(0)).collect()) == n
    assert len(licenses.licenses(odd).collect()) == n
    near = minhash.near_duplicates(odd).collect()
    assert len(near) == n and {r["doc_id"] for r in near if not r["kept"]} == {10}
    assert minhash.near_duplicates_removed(odd).columns == odd.columns
    cut = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in substring.repeated_passages_removed(odd).collect()}
    assert cut[6, 3001] == 2980 + 20 - 1 and cut[1, 0] == 0
    kept = lines.lines_deduplicated(odd)
    assert kept.columns == [*odd.columns, "lines_in", "lines_dropped"] and kept.count() == n
    text = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert text[1] is None and text[3] == "  \n\n " and text[10] == "" and text[None] == "no id at all here"


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    empty = [
        token_counts.line_token_counts(none, vocabulary()), packing.pack(none, vocabulary()), decontaminate.contaminated(none, spark.createDataFrame([], "item_id long, text string")),
        quality.quality(none, labels), toxicity.toxicity(none, labels), licenses.licenses(none), minhash.near_duplicates(none), substring.repeated_passages_removed(none),
        embeddings.near_vectors(vectors), lines.lines_deduplicated(none),
    ]
    assert [df.count() for df in empty] == [0] * 10
