"""Ranked lexical search against a full ranking in Python, and the treap against its grid."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sparkwatch.llm import lexical

DOCS = "doc_id long, text string, item_id long, term string, score long, id long, rank int"
ITEMS = "item_id long, text string, doc_id long, score long"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {ord(a): b for a, b in zip(lexical.UPPER, lexical.LOWER)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def ranking(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counted for t in c)
    by_item: dict = {}
    for i, t in items:
        by_item.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in by_item.items():
        scored = []
        for (doc, c), n in zip(counted, lengths):
            m = 10 + (90 * n * n_docs) // n_terms if n_terms else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted if t in c
            )
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(120)] + ["Ünï", "漢字", "Größe"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 60)))) for i in range(700)]
    docs += [(1000 + i, docs[3][1]) for i in range(60)]  # copies: equal scores
    docs += [(2000, None), (2001, ""), (2002, " ..."), (None, "w1 w50 w90"), (None, None), (2003, "w7 " * 30_000), (5, "w1 w2"), (5, "w1 w2"), (2004, "W1-w2_W3 ÜNÏ")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(25)]
    items += [(50, None), (51, ""), (52, "unheard-of"), (53, "W1 w1, w1"), (54, docs[3][1]), (54, "w119"), (None, "w90"), (55, "w1"), (55, "w1")]
    return docs, items


def found(spark, docs, items, **options):
    left = spark.createDataFrame([(i, t, 1, "x", 2, 3, 4) for i, t in docs], DOCS).repartition(5)
    right = spark.createDataFrame([(i, t, 9, 9) for i, t in items], ITEMS)
    rows = lexical.rank_documents(left, right, **options).select("item_id", "rank", "doc_id", "score").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_ranking_agrees_with_brute_force(spark, tables):
    assert found(spark, *tables) == ranking(*tables, 10)


def test_items_in_blocks_and_small_ranges(spark, tables, monkeypatch):
    """The same rows if the items come in many blocks, whatever k."""
    assert found(spark, *tables, k=3, block_pairs=40) == ranking(*tables, 3)


def test_more_than_there_are(spark):
    docs, items = [(1, "a b"), (2, "b"), (3, "c")], [(7, "a b"), (8, "z")]
    assert found(spark, docs, items) == ranking(docs, items, 10)


def test_empty_tables(spark, tables):
    docs, items = tables
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []


def test_treap_against_grid():
    rng = np.random.default_rng(4)
    flat = rng.choice(40 * 300, 1500, replace=False)
    rows, columns, impacts = flat // 300, flat % 300, rng.integers(1, 50, len(flat))
    grid = np.zeros((40, 300), np.int64)
    grid[rows, columns] = impacts
    treap = lexical.Treap(rows, columns, impacts)
    assert treap.best[0] == grid.max() and len(treap.best) < 2 * len(flat) * treap.height
    for k in (1, 5, 400):
        asked, weights = np.array([3, 17, 39]), np.array([5, 1, 9])
        got, scores = lexical.best_columns(treap, asked, weights, k, (0, 0))
        exact = (grid[asked] * weights[:, None]).sum(axis=0)
        best = sorted((-s, c) for c, s in enumerate(exact.tolist()) if s > 0)[:k]
        assert sorted(zip((-scores).tolist(), got.tolist()))[:k] == best
        if k <= 5:
            assert len(got) < 150  # most of the range was never opened
        # a floor from other ranges: only what comes before it is found
        if k == 5:
            score, column = -best[2][0], best[2][1]
            got, scores = lexical.best_columns(treap, asked, weights, k, (score, column))
            assert sorted(zip((-scores).tolist(), got.tolist()))[:2] == best[:2]


def test_ranges_closed_early_change_nothing(spark, tables, monkeypatch):
    docs, items = tables
    vocabulary = {t.encode(): i for i, t in enumerate(sorted({t for _, x in items for t in terms(x)}))}
    monkeypatch.setattr(lexical, "RANGE_DOCS", 16)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"id": pa.array([i for i, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs])})
    index = list(lexical.indexer(vocabulary)(iter([batch])))
    assert len(index) == -(-len(docs) // 16)
    counts = {r["term"]: r["n"] for b in lexical.statistics(iter(index)) for r in b.to_pylist()}
    asked = []
    names = sorted({i for i, _ in items if i is not None})
    for item in names:
        t = sorted(vocabulary[x.encode()] for x in {x for i, text in items if i == item for x in terms(text)})
        asked.append((np.array(t, np.int64), np.array([math.floor(1000 * math.log((2 * counts[-1] + 2) / (2 * counts.get(x, 0) + 1))) for x in t], np.int64)))
    schema = pa.schema([("q", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    rows = [r for b in lexical.searcher(asked, counts[-1], counts[-2], 10, schema)(iter(index)) for r in b.to_pylist()]
    expected = [(i, d, s) for i, _, d, s in ranking(docs, items, 10) if i is not None]
    assert sorted(((names[r["q"]], r["doc_id"], r["score"]) for r in rows), key=repr) == sorted(expected, key=repr)
