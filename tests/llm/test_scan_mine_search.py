"""License scan, hard negatives and lexical search: against brute force, and on odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.llm import hard_negatives, lexical_search, license_scan, line_frequency, toxicity
from tests.helpers import SF

DOCS = f"{SF}/documents.parquet"
NOTICES = [
    "// Licensed under the Apache License,\n// Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "SPDX-License-Identifier: GPL-2.0-or-later; see https://www.gnu.org/licenses/gpl-2.0.html",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License, version 2.1 or later.",
    "CC BY 4.0, CC BY-NC-SA 3.0, Creative Commons Attribution-ShareAlike 4.0 International; cc  by\ncc-by",
    "MIT License mit license THE MIT LICENSE (MIT). Apache license; permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "Mitten License, mit lizenz, apaches license", "© 2020 X. All rights reserved.", "GNU GPL v3", "", " \n", None, "ǅ cc by ǅ", "cc\x00by", "gnu general public license " * 300,
]


def plain_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in license_scan.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    joined = f" {' '.join(words)} ".encode()
    found = [(m.start(), m.end(), k) for k, r in enumerate(license_scan.rules()) for m in r.pattern.finditer(joined)]
    of = license_scan.rules()

    def hidden(x):
        def covers(y):
            rank = (of[y[2]].priority, -(y[1] - y[0]), y[2]) < (of[x[2]].priority, -(x[1] - x[0]), x[2])
            return y[0] <= x[0] and x[1] <= y[1] and rank

        return any(covers(y) for y in found)

    kept = [x for x in found if not hidden(x)]
    score = max([license_scan.KINDS[of[k].kind] for _, _, k in kept] + [0.6] * bool(labels), default=0.0)
    named = labels | {of[k].label for _, _, k in kept}
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(named)), score if words else 0.0)


def test_license_scan(spark):
    """Without keywords, and with every pair of detections compared."""
    texts = [(r[0], r[1]) for r in spark.read.parquet(DOCS).select("doc_id", "text").collect()]
    texts += [(-1 - k, t) for k, t in enumerate(NOTICES)]
    rows = [(i, t, "x", "y", 1) for i, t in texts]
    out = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, labels string, __scan string, score int"))
    assert len(set(out.columns)) == len(out.columns)
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in out.collect()}
    assert got == {i: plain_scan(t) for i, t in texts}


def test_license_spans():
    *_, found = license_scan.scan("x Licensed under CC BY-NC 4.0. and the MIT License")
    assert [(d.label, d.start, d.end) for d in found] == [("cc-by-nc-4.0", 3, 8), ("mit", 9, 12)]


def test_license_pieces(monkeypatch):
    text = " ".join(t or "" for t in NOTICES)
    whole = license_scan.as_words(text)
    for size in (1, 3, 50):
        monkeypatch.setattr(license_scan, "PIECE", size)
        assert license_scan.as_words(text) == whole


@settings(max_examples=3, deadline=None)
@given(st.data())
def test_license_keywords(data):
    """A rule's keyword stands in whatever its pattern matches."""
    assert len(license_scan.rules()) > 300
    for r in license_scan.rules():
        inner = r.pattern.pattern.decode().removeprefix("(?<= )").removesuffix("(?= )")
        assert r.keyword.decode() in f" {data.draw(st.from_regex(inner, fullmatch=True))} ", r


def plain_negatives(rows, anchor, top=5):
    rows = sorted(set(rows), key=str)
    out = []
    for a in (r for r in rows if r[0] is not None and anchor(r[0])):
        scored = sorted(((-sum(x * y for x, y in zip(a[2], r[2], strict=True)), r[0] is None, r[0] or 0, r) for r in rows if r != a and len(r[2]) == len(a[2])), key=lambda x: x[:3])
        for score, _, _, p in [x for x in scored if x[3][1] == a[1]][:top]:
            fit = [x for x in scored if x[3][1] != a[1] and 80 * -score <= 100 * -x[0] <= 100 * -score][:top]
            out += [(a[0], p[0], k, x[3][0], -score, -x[0]) for k, x in enumerate(fit, 1)]
    return Counter(out)


def test_hard_negatives_in_cells(spark):
    """Ties, repeated rows, ids that repeat or are null, vectors of other lengths and of none, in many small cells."""
    rng = random.Random(5)
    rows = [(i % 40 if i % 11 else None, rng.randrange(3), tuple(rng.randrange(-3, 6) for _ in range(4))) for i in range(160)]
    rows += rows[:20] + [(20, 1, ()), (30, 1, ()), (40, 2, ()), (10, 0, (5, 5)), (11, 0, (5, 5)), (12, 1, (5, 4)), (13, 1, (6, 4)), (10, 0, (5, 7))]
    df = spark.createDataFrame(rows, "id long, label int, v array<long>")
    out = hard_negatives.mine_negatives(df.distinct(), F.col("id") % 10 == 0, cell_rows=17, cell_anchors=3)
    assert Counter(map(tuple, out.collect())) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_integer_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001], 1), (1, [0.5, -0.001], 1), (2, [nan, 0.0], 1), (3, [inf, 0.0], 1), (4, [None, 0.0], 1), (5, None, 1), (6, [0.1, 0.2], None), (None, [1.0, -1.0], 2), (7, [], 3)]
    out = hard_negatives.integer_rows(spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, v string"))
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 1, [128, -1]), (7, 3, []), (None, 2, [256, -256])]
    empty = hard_negatives.mine_negatives(out.filter("id > 99"), F.col("id") % 100 == 0)
    assert empty.collect() == []


@pytest.mark.parametrize("size", [1, 100, 40_000, 1 << 27])
def test_packed_scores(size):
    rng = np.random.default_rng(size)
    rows, anchors = rng.integers(-size, size + 1, (50, 9)), rng.integers(-size, size + 1, (7, 9))
    packed = hard_negatives.Packed(rows, int(np.abs(anchors).max()))
    for a in anchors:
        assert packed.scores(a).tolist() == [sum(int(x) * int(y) for x, y in zip(a, r, strict=True)) for r in rows]
    with pytest.raises(ArithmeticError):
        hard_negatives.Packed(rows + (1 << 40), 1 << 40)


def plain_ranks(docs, items, top):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))

    docs = [(i, Counter(terms(t))) for i, t in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = Counter()
    for item, text in set(items):
        scored = []
        for i, c, n in docs:
            m = 75 + 25 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out.update((item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1))
    return out


@pytest.mark.parametrize("first", [1, 50])
def test_lexical_search(spark, first):
    """Small segments and blocks; ties, repeated documents and items, null ids, texts without terms, one very long text."""
    rng = random.Random(9)
    words = ["the", "The", "of", "été", "x1", "longer", "日本", "rare"]
    docs = [(k if k % 13 else None, " ".join(rng.choices(words, weights=[9, 9, 5, 3, 2, 2, 1, 0.2], k=rng.choice([1, 2, 3, 3, 3, 8, 40])))) for k in range(120)]
    docs += docs[:15] + [(500, None), (501, ""), (502, " .,-\n"), (503, "the rare " * 5_000)]
    items = [(1, "the rare of"), (1, "the rare of"), (1, "x1 x1 été"), (2, "日本, Longer-the!"), (3, None), (4, "..."), (None, "of the"), (5, "unknown"), (6, "rare")]
    frame = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, m string").repartition(3)
    index = lexical_search.build_index(frame, segment_bytes=300, segment_docs=4)
    got = lexical_search.search(index, spark.createDataFrame(items, "item_id long, text string"), top=7, first=first, block_items=2, block_terms=4)
    assert Counter(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect())) == plain_ranks(docs, items, 7)


def test_lexical_search_empty(spark):
    some, none = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(lexical_search.build_index(none), items).collect() == []
    assert lexical_search.search(lexical_search.build_index(some), items.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in lexical_search.search(lexical_search.build_index(some), items).collect()] == [(1, 1, 1)]


def test_pieces_of_terms(monkeypatch):
    monkeypatch.setattr(lexical_search, "PIECE", 5)
    text = "Ab c9\x00d—é" * 40
    own = [w.decode() for part in lexical_search._split(text) for w in part]
    assert own == re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.lower()) and lexical_search.count_terms(text) == len(own)


def test_very_long_texts():
    """Some 20 MB: words are numbered and looked up in pieces."""
    text = " ".join(f"w{k % 1_000_000}" for k in range(2_500_000))
    n, chars, *_, repeat = line_frequency.base_stats([text, "a b c d e a b c d e"])[0]
    assert n == 2_500_000 and chars == len(text) - n + 1 and repeat == n
    assert len(toxicity.distinct_words("Ab, " * 3_000_000 + "ça")) == 2


def test_toxicity_of_text_ids(spark):
    docs = spark.createDataFrame([(f"d{k}", "bad words here" if k % 2 else "good words there") for k in range(60)], "doc_id string, text string")
    labels = docs.select("doc_id", F.col("text").startswith("bad").cast("int").alias("toxic"))
    out = toxicity.predict(docs, toxicity.train(docs, labels, ("toxic",))).collect()
    assert all(r.is_toxic == r.text.startswith("bad") for r in out)
