"""Cases in which a bound, a shared id, a length or an odd line must change no result."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_training_operators import ODD, PIECES, Union

import corpus_pipeline
from tidewell.llm import decontaminate, embeddings, encode, lines, minhash
from tidewell.llm.queries import vocabulary
from tidewell.session import scratch_path


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(PIECES, min_size=1, max_size=5), min_size=1, max_size=4), st.integers(1, 12))
def test_a_full_cache_changes_no_id(batches, bound):
    before, encode.CACHE_PIECES = encode.CACHE_PIECES, bound
    try:
        code = encode.Encoder(vocabulary())
        for texts in batches:
            ids, bounds = code.encode(texts)
            want = [e.ids for e in code.tokenizer.encode_batch(texts, add_special_tokens=False)]
            assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want
    finally:
        encode.CACHE_PIECES = before


def test_texts_of_one_id_are_told_apart(spark):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(3, a + " x"), (5, a), (5, b), (7, b + " y"), (5, a), (9, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("own")).repartition(3)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df).collect())
    assert got == [(3, 59, 3, True), (5, 58, 3, False), (5, 58, 3, False), (5, 58, 5, True), (7, 59, 5, False), (9, 0, 9, True), (9, 0, 9, True)]
    left = minhash.near_duplicates_removed(df, 3, 85)
    assert left.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in left.collect() if r["text"]) == [(3, a + " x"), (5, b)]


@pytest.mark.parametrize("block", [1024, 7])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    """Several lengths, sizes at which squares over- and underflow, copies, and buckets cut into blocks."""
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", block)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 16))
    vectors = [(i, (centres[i % 6] + rng.standard_normal(16) * 0.03 * (i % 4)) * [1.0, 1e200, 1e-200][i % 3]) for i in range(180)]
    vectors += [(500 + i, np.array([1.0, 2.0, 3.0]) * (1 + i)) for i in range(3)] + [(600, np.array([1e-200, 0.0])), (601, np.array([1e-200, 1e-201])), (602, np.array([0.0, 1.0]))]
    vectors += [(700 + i, vectors[0][1]) for i in range(5)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors] + [(900, [0.0, 0.0]), (901, []), (902, None)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embeddings.near_vectors(df.withColumn("key", F.lit(1)).repartition(4)).collect()}
    union, links = Union(), dict.fromkeys([i for i, _ in vectors], 0)
    for k, (i, x) in enumerate(vectors):
        for j, y in vectors[:k]:
            if len(x) == len(y):
                x1, y1 = x / np.abs(x).max(), y / np.abs(y).max()
                if x1 @ y1 / np.linalg.norm(x1) / np.linalg.norm(y1) >= 0.9:
                    links[i] += 1
                    links[j] += 1
                    union.join(i, j)
    assert {i: (got[i]["n_links"], got[i]["component_id"]) for i in links} == {i: (n, union.root(i)) for i, n in links.items()}
    assert got[601]["component_id"] == 600 and got[502]["n_links"] == 2 and got[602]["n_links"] == 0
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902))


def test_blank_lines_stay_and_columns_do_not_clash(spark):
    text = "first line of the text here\r\n\r\n\t \r\nsecond line of the text here\r\n\r\n"
    df = spark.createDataFrame([(1, text, 7, "x"), (2, text, 8, "y")], "doc_id long, text string, lines_in int, place string")
    out = lines.lines_deduplicated(df)
    assert out.columns == ["doc_id", "text", "place", "lines_in", "lines_dropped"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[1]["text"] == text and rows[2]["text"] == "\r\n\t \r\n\r\n" and (rows[2]["lines_in"], rows[2]["lines_dropped"]) == (6, 2)
    assert sorted((r["doc_id"], r["lines_in"]) for r in lines.without_repeated_lines(df).collect()) == [(1, 7), (2, 8)]


def test_long_lines_near_the_threshold_are_linked(spark):
    """Lines of 40 to 200 words with letters changed until they are just similar enough, and a third of all lines in one hot group."""
    rng = np.random.default_rng(9)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzéß"))
    texts, near = {}, 0
    for k in range(120):
        line = " ".join("".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(rng.integers(40, 200)))
        copy, runs = list(line), {line[i : i + 5] for i in range(len(line) - 4)}
        while True:
            trial = list(copy)
            trial[int(rng.integers(0, len(trial)))] = str(rng.choice(letters))
            other = {"".join(trial[i : i + 5]) for i in range(len(trial) - 4)}
            if len(runs & other) < 0.8 * len(runs | other):
                break
            copy = trial
        texts[2 * k], texts[2 * k + 1] = line, "".join(copy)
        near += copy != list(line)
    for k in range(120):
        texts[1000 + k] = f"user number {k} has logged in from the same old place in the middle of the very long night"
    rows = lines.lines_deduplicated(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    dropped = {r["doc_id"] for r in rows if r["lines_dropped"]}
    assert {d for d in dropped if d >= 1000} == set(range(1001, 1120))
    assert dropped - set(range(1001, 1120)) <= set(range(1, 240, 2)) and len(dropped) - 119 >= 0.97 * near


def test_pipeline_on_odd_rows_and_empty_tables(spark):
    path = scratch_path(spark, "odd-tables")
    rows = spark.createDataFrame([(*r, f"src{k % 3}", len(r[1] or "")) for k, r in enumerate(ODD)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = rows.withColumns({"lines_in": F.lit(3), "key": F.lit("k"), "score": F.lit("s")})
    spark.createDataFrame([(5, 1, 0), (4, None, 0), (8, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, None), (2, ""), (3, "nothing like it is in any of the texts there")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    for name, table in (("some", rows), ("none", rows.limit(0))):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, path)
            assert docs.columns == rows.columns, name
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, path)
        ids = [r["doc_id"] for r in docs.collect()]
        assert {r["doc_id"] for r in packed.collect()} == set(ids)
        assert not ids if name == "none" else {1, 2, 6, 7, 8} <= set(ids)


def test_scores_do_not_depend_on_the_parts_of_the_index(spark, monkeypatch):
    documents, benchmark = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))

    def found(size):
        monkeypatch.setattr(decontaminate, "PART_BYTES", size)
        return {(r["doc_id"], r["item_id"]): tuple(round(r[c], 9) for c in ("score", "question_overlap", "answer_overlap", "passage_start")) for r in decontaminate.contaminated(documents, benchmark).collect()}

    whole = found(4 << 20)
    assert whole and found(2000) == whole
    kept = decontaminate.contaminated_removed(documents, benchmark)
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in documents.collect()} - {d for d, _ in whole}
