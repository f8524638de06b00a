"""Leaked items against brute force over word windows."""

from __future__ import annotations

import numpy as np
import pytest

from citeloom.llm.leakage import MASKS, WINDOW, SeedIndex, leaked_items, overlap
from citeloom.llm.queries import p7_found
from citeloom.llm.words import words

LONG = " ".join(f"w{i}" for i in range(40))
SHORT = "only five words are here"


def test_words():
    assert words("ＦＵＬＬ-width, “Quoted”\n it’s ﬁne") == words("full width quoted it s fine")
    assert words("so\xadft hy​phen⁠s") == ["soft", "hyphens"]
    assert words("Jürgen") == words("JÜRGEN") and words(None) == words("") == words("...") == []


def test_masks_leave_any_single_word_out():
    assert all(len(m) == WINDOW for m in MASKS)
    assert all(any(m[p] == "0" for m in MASKS) for p in range(WINDOW))


@pytest.mark.parametrize("n", range(5, WINDOW + 1))
def test_two_replaced_words_are_found_anywhere(n):
    index = SeedIndex([(1, " ".join(f"w{i}" for i in range(n)))])
    for p in range(n):
        for q in range(p):
            own = index.words[0].copy()
            own[[p, q]] = 0
            assert any(len(where) for where, _, _ in index.hits(own)), (p, q)


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "1 AS item_id", "'x' AS t", "2 AS i")


def _items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string").selectExpr("*", "1 AS doc_id")


def test_overlaps(spark):
    w = LONG.split()
    texts = [
        "before " + " ".join(w[3:15]).upper() + " after", " ".join(w[3:14]), "x, ".join(w[:20]), " ".join(w[:6] + ["new"] + w[7:20]), "say: Only five words, are here!", "only five words are there", None, "", LONG, LONG,
        " ".join(w[:11]), " ".join(w[11:20]), "w3 " * 100,
    ]
    got = {(r.doc_id, r.item_id): (r.overlap_words, r.equal_words, r.exact_words) for r in leaked_items(_docs(spark, texts), _items(spark, [LONG, SHORT, None, "", "!"])).collect()}
    assert got[(0, 0)][2] == 12 and got[(3, 0)] == (20, 19, 13) and got[(4, 1)] == (5, 5, 5) and got[(8, 0)] == got[(9, 0)] == (40, 40, 40)
    assert {k for k, v in got.items() if v[2] >= (12 if k[1] == 0 else 5)} == {(0, 0), (3, 0), (4, 1), (8, 0), (9, 0)}
    assert not any(k[1] > 1 for k in got)


def test_blocks_give_the_same(spark):
    texts = [f"{i} " + " ".join(f"a{i}b{k}" for k in range(15)) for i in range(60)]
    docs, items = _docs(spark, [t + " tail" for t in texts]), _items(spark, texts)
    one = sorted(map(tuple, leaked_items(docs, items).collect()))
    assert len(one) == 60 and sorted(map(tuple, leaked_items(docs, items, block_chars=900).collect())) == one


def test_empty(spark):
    docs, items = _docs(spark, [LONG]), _items(spark, [LONG])
    assert leaked_items(docs.limit(0), items).count() == 0 and leaked_items(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize(("doc", "item", "shift", "want"), [([1, 2, 3], [1, 2, 3], 0, (3, 3, 3)), ([1, 2, 3], [1, 2, 3], 1, None), ([0, 1, 2, 3], [1, 2, 3], 1, (3, 3, 3)), ([], [1], 0, None)])
def test_overlap(doc, item, shift, want):
    assert overlap(np.array(doc), np.array(item), shift) == want


def test_long_and_repetitive_texts(spark):
    texts = ["ha " * 30_000, "x " * 20_000 + LONG + " y" * 20_000, LONG + " z" * 30_000, "z " * 30_000 + LONG]
    got = {(r.doc_id, r.item_id): r.exact_words for r in leaked_items(_docs(spark, texts), _items(spark, ["ha " * 40, LONG])).collect()}
    assert got == {(0, 0): 40, (1, 1): 40, (2, 1): 40, (3, 1): 40}


def test_index_of_short_items():
    index = SeedIndex([(1, "a b c"), (2, None), (3, "a")])
    assert index.ids == [1, 3] and {n for n, _ in index.tables} == {1, 3}


def test_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{data}/eval_items.parquet").select("item_id", "text").collect()
    windows = {}
    for i, text in items:
        w = words(text)
        n = min(WINDOW, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    want = set()
    for d, text in docs:
        w = words(text)
        want |= {(d, i) for n in {len(x) for x in windows} for k in range(len(w) - n + 1) for i in windows.get(tuple(w[k : k + n]), ())}
    assert {tuple(r) for r in p7_found(spark, data).collect()} == want and want
