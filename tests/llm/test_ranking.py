"""Ranked search against scoring every document, its stopping rule, blocks and segments, defined cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from waybill.llm import ranking

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS, ITEMS = "doc_id long, text string, score long, n int", "item_id string, text string, rank int"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k=20):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n, words = len(counted), sum(s for _, _, s in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for item, text in {x for x in items if None not in x}:
        asked.setdefault(item, Counter()).update(terms(text))
    rows = []
    for item, query in asked.items():
        scores = []
        for doc_id, c, size in counted:
            m = 75 + 25 * size * n // words
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, q in query.items() if t in c)
            if doc_id is not None and score > 0:
                scores.append((-score, doc_id))
        rows += [(item, rank, doc_id, -score) for rank, (score, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows)


def words(rnd, n):
    return " ".join(rnd.choice(["The", "stone", "é", "9x", "rare%d" % rnd.randint(0, 40), "w%d" % rnd.randint(0, 9)]) for _ in range(n))


@pytest.fixture(scope="module")
def tables():
    rnd = random.Random(3)
    docs = [(i, words(rnd, rnd.randint(1, 60))) for i in range(700)]
    docs += [(1000 + i, "same text rare1 rare2") for i in range(60)] + [(5, "rare3"), (5, "rare3"), (None, "rare4 rare4"), (None, None), (9, None), (8, ""), (7, "., -")]
    docs.append((2000, "The " * 50_000 + "rare7"))
    items = [(f"i{k}", words(rnd, rnd.randint(1, 12))) for k in range(30)]
    items += [("same", "same TEXT, rare1!"), ("none", "absent word"), ("blank", ""), ("null", None), (None, "rare1"), ("two", "rare3"), ("two", "rare3"), ("two", "rare4 rare5"), ("all", "the")]
    return docs, items


@pytest.mark.parametrize("segment, block, k", [(1_000_000, 1024, 20), (300, 5, 3)])
def test_ranked_as_brute_force(spark, tables, monkeypatch, segment, block, k):
    docs, items = tables
    monkeypatch.setattr(ranking, "BLOCK_QUERIES", block)
    monkeypatch.setattr(ranking, "SHARDS", 2)
    documents = spark.createDataFrame([(*d, 0, 0) for d in docs], DOCS).repartition(5)
    queries = spark.createDataFrame([(*i, 0) for i in items], ITEMS)
    out = ranking.ranked(documents, queries, k=k, segment=segment)
    assert out.dtypes == [("item_id", "string"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, out.collect())) == brute(docs, items, k)


def test_segments_carry_the_best_on(tables, monkeypatch):
    rnd = np.random.default_rng(1)
    for trial in range(60):
        size, n = int(rnd.integers(1, 60)), int(rnd.integers(1, 400))
        rows = [np.unique(rnd.integers(0, size, rnd.integers(1, 12))) for _ in range(n)]
        impacts = [rnd.integers(1, rnd.integers(2, 900), len(r)) for r in rows]
        query = ranking.Query(np.unique(rnd.integers(0, size, 6)), None)
        query.weights = rnd.integers(1, 50, len(query.terms))
        weight = dict(zip(query.terms.tolist(), query.weights.tolist()))
        scores = [sum(weight.get(int(t), 0) * int(x) for t, x in zip(r, v)) for r, v in zip(rows, impacts)]
        wanted = sorted((-s, i) for i, s in enumerate(scores) if s)[:5]
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        monkeypatch.setattr(ranking, "FIRST_READ", int(rnd.integers(1, 8)))
        for part in np.array_split(rnd.permutation(n), int(rnd.integers(1, 4))):
            if len(part):
                segment = ranking.Segment(part, np.array([len(rows[i]) for i in part]), np.concatenate([rows[i] for i in part]),
                                          np.concatenate([impacts[i] for i in part]))
                best = segment.search(query, best, 5)
                assert not segment.marked.any() and not segment.seen.any() and not segment.weight.any()
        assert [(-s, i) for s, i in zip(*map(np.ndarray.tolist, best))] == wanted


def test_search_stops_early_and_only_strictly_below(monkeypatch):
    n = 20_000
    impacts = np.concatenate([np.full(30, 1000), np.arange(n - 30) % 500 + 1])
    segment = ranking.Segment(np.arange(n), np.ones(n, np.int64), np.zeros(n, np.int64), impacts)
    scored = []
    real = ranking.Segment._scored
    monkeypatch.setattr(ranking.Segment, "_scored", lambda self, d, b, k: scored.append(len(d)) or real(self, d, b, k))
    query = ranking.Query(np.array([0]), np.array([2]))
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    scores, ids = segment.search(query, none, 20)
    assert ids.tolist() == list(range(20)) and sum(scored) <= ranking.FIRST_READ
    ids = np.arange(n)[::-1].copy()  # equal scores: smaller ids lie last in the list
    level = ranking.Segment(ids, np.ones(n, np.int64), np.zeros(n, np.int64), np.full(n, 7))
    assert level.search(query, none, 20)[1].tolist() == list(range(20))


def test_empty_tables(spark, tables):
    docs, items = tables
    documents = spark.createDataFrame([(*d, 0, 0) for d in docs[:50]], DOCS)
    queries = spark.createDataFrame([(*i, 0) for i in items], ITEMS)
    for d, q in ((documents.limit(0), queries), (documents, queries.limit(0)), (documents.limit(0), queries.limit(0))):
        out = ranking.ranked(d, q)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0
