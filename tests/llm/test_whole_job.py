"""What the training-data operators must find, on planted cases that a thinned search or measure loses."""

import re

import numpy as np
from test_training_operators import license_matches

from tidewell.llm import embeddings, licenses, lines

LETTERS = list("abcdefghijklmnopqrstuvwxyz")


def components_of(spark, texts):
    """Which of the one-line texts are dropped as repeats."""
    rows = lines.lines_deduplicated(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    return {r["doc_id"] for r in rows if r["lines_dropped"]}


def runs_of(line):
    return {line[i : i + 5] for i in range(len(line) - 4)} or {line}


def similarity(a, b):
    a, b = runs_of(a), runs_of(b)
    return len(a & b) / len(a | b)


def test_lines_with_one_typo_are_linked(spark):
    """Lines of 8 to 15 words against a copy with one letter changed, by all runs of five characters."""
    rng = np.random.default_rng(3)
    texts, near = {}, set()
    for k in range(600):
        line = " ".join("".join(rng.choice(LETTERS, rng.integers(2, 10))) for _ in range(rng.integers(8, 16)))
        at = int(rng.integers(0, len(line)))
        copy = line[:at] + "#" + line[at + 1 :]
        texts[2 * k], texts[2 * k + 1] = line, copy
        if similarity(line, copy) >= 0.8:
            near.add(2 * k + 1)
    got = components_of(spark, texts)
    assert len(near) > 400 and got <= near and len(got) >= 0.98 * len(near)


def test_lines_of_few_distinct_runs_are_linked(spark):
    """Rulers of very unequal lengths have one run; sets of four and five runs at 0.8 need not share three neighbours."""
    texts = {1: "-" * 16, 2: "-" * 80, 3: "ab" * 8, 4: "ab" * 60, 5: "=" * 5}
    rng = np.random.default_rng(4)
    for k in range(60):
        line = "".join(rng.choice(LETTERS, 9, replace=False))
        texts[10 + 2 * k], texts[11 + 2 * k] = line, line[:8]
    assert similarity(texts[10], texts[11]) == 0.8
    assert components_of(spark, texts) == {2, 4} | set(range(11, 131, 2))


def test_lines_need_no_python(spark, monkeypatch):
    """Lines of one family, half of them just similar enough to another and half just not, against all pairs; no step runs Python on the executors."""

    def refused(*_):
        raise AssertionError("Python on the executors")

    rng = np.random.default_rng(6)
    base = "".join(rng.choice([*LETTERS, " "], 180))
    texts = {}
    for k in range(160):
        line = list(base)
        for at in rng.choice(180, 1 + k % 5, replace=False):
            line[at] = str(rng.choice(["ß", "日", "𝄞", "#"]))
        texts[k] = "".join(line)
    texts |= {500: "日本語のテキストです", 501: "日本語のテキストですよ", 502: "日本", 503: "日本", 504: "日木"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for frame, name in ((df, "mapInArrow"), (df, "mapInPandas"), (df.groupBy(), "applyInArrow"), (df.groupBy(), "applyInPandas")):
        monkeypatch.setattr(type(frame), name, refused)
    root = {k: k for k in texts}
    for a in texts:
        for b in texts:
            if a < b and similarity(texts[a], texts[b]) >= 0.8:
                x, y = root[a], root[b]
                root = {k: min(x, y) if r in (x, y) else r for k, r in root.items()}
    expected = {k for k, r in root.items() if r != k}
    got = components_of(spark, texts)
    assert 20 < len(expected) < 160 and {501, 503} <= got and got <= expected and len(got) >= 0.97 * len(expected)


def test_blocks_of_a_large_group_meet_all_lines(spark):
    """Every line outside a class meets every line of its group, once, however the group is cut into blocks."""
    marks = "struct(0L as l0, 0L as l1, 0L as l2, 0L as l3) as n"
    groups = spark.range(1200).selectExpr("7L as grp", "id", marks, "id % 400 = 0 as outside", "1200L as m")
    pairs = {(r["u"], r["v"]) for r in lines._block_pairs(groups, 80).collect()}
    assert pairs == {(min(x, y), max(x, y)) for x in (0, 400, 800) for y in range(1200) if x != y}


NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal",
    "gpl-3": "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or",
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    "apache-2": " * you may not use this file except in compliance with the License.\n * You may obtain a copy of the License at\n *\n *     http://www.apache.org/licenses/LICENSE-2.0",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla\nPublic License, v. 2.0. If a copy of the MPL was not",
}


def test_wrapped_notices_anywhere_in_a_text(spark):
    """Canonical line breaks, at many places of long texts, against all runs by brute force; scattered words are no notice."""
    rng = np.random.default_rng(6)
    texts, want = {}, {}
    for k in range(60):
        label = list(NOTICES)[k % 5]
        before, after = (" ".join(f"p{x}" for x in rng.integers(0, 99, rng.integers(0, 160))) for _ in range(2))
        texts[k], want[k] = f"{before}\n{NOTICES[label]}\n{after}", label
    texts[100], want[100] = (" x" * 40 + " ").join("released under the mit license".split()[::-1]), ""
    texts[101], want[101] = (" x" * 4 + " ").join("released under the mit".split()), ""
    got = {r["doc_id"]: r for r in licenses.licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert {d: r["labels"] for d, r in got.items()} == want
    for doc, text in texts.items():
        labels, best = license_matches(re.findall("[0-9a-z]+", text.lower()))
        assert got[doc]["score"] == best and got[doc]["labels"] == ",".join(sorted(labels))


OTHER_LICENSES = {
    "Released under the BSD license": "", "released the work under a new license": "", "Licensed under the GPL license, version 2.0": "", "we permit the release under license": "",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License": "",
    "This library is licensed under the GNU Lesser General Public License version 3": "", "This work is licensed under the GNU Affero General Public License version 3": "",
    "This work is licensed under the GNU General Public License version 3": "gpl-3", "Released under the Apache License 2.0": "", "Licensed under the Apache License 2.0": "apache-2",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License": "", "released under the MIT license": "mit",
}


def test_other_licenses_and_versions_are_told_apart(spark):
    rows = licenses.licenses(spark.createDataFrame(list(enumerate(OTHER_LICENSES)), "doc_id long, text string")).collect()
    names = list(OTHER_LICENSES)
    assert {names[r["doc_id"]]: r["labels"] for r in rows} == OTHER_LICENSES


def test_vectors_just_above_the_threshold_are_linked(spark):
    """500 pairs planted at cosine 0.90 to 0.92, among vectors that link with nothing else."""
    rng = np.random.default_rng(7)
    first, other = rng.standard_normal((2, 500, 64))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other -= (other * first).sum(axis=1, keepdims=True) * first
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = rng.uniform(0.9001, 0.92, (500, 1))
    vectors = np.concatenate([first, cosine * first + np.sqrt(1 - cosine**2) * other])
    rows = embeddings.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")).collect()
    linked = sum(r["n_links"] for r in rows)
    assert 0.98 * 1000 <= linked <= 1000, linked
