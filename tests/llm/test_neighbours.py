"""Graph search against brute force."""

import os

import numpy as np
import pytest

from waybill.llm import neighbours

SF = "/root/testdata/sf0.1"


def brute(ids, x, is_query, count=5):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero([is_query(v) for v in ids]):
        score = unit @ unit[i]
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if j != i][:count]
        out[ids[i]] = [(ids[j], score[j]) for j in order]
    return out


def found(rows):
    got = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
def test_recall_on_the_given_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    data = table.toPandas()
    want = brute(data.vec_id.to_numpy(), np.array(data.embedding.tolist(), float), lambda v: v % 50 == 0)
    got = found(neighbours.nearest(table, lambda v: v % 50 == 0).collect())
    hits = sum(len({v for v, _ in want[q]} & {v for v, _ in got[q]}) for q in want)
    assert got.keys() == want.keys() and hits / sum(map(len, want.values())) > 0.95
    assert all(s == pytest.approx(dict(want[q]).get(v, s), abs=1e-12) for q in want for v, s in got[q])


def test_cases(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 8))
    x[100:220] = x[100]  # a large group of equal vectors
    x[230] = 2 * x[229]  # the same direction
    rows = [(i, v.tolist(), i, "n") for i, v in enumerate(x)]
    odd = [(1000, None), (1050, [0.0] * 8), (1100, [1.0] * 7 + [None]), (1150, [float("nan")] * 8), (1200, [1.0] * 7 + [float("inf")]),
           (None, x[5].tolist()), (1250, [1.0, 2.0]), (1300, [])]
    schema = "vec_id long, embedding array<double>, id int, node string"
    table = spark.createDataFrame(rows + [(i, v, 0, "n") for i, v in odd] + [(7, x[7].tolist(), 0, "n")], schema)
    got = found(neighbours.nearest(table, lambda v: v % 50 == 0).collect())
    want = brute(np.arange(300), x, lambda v: v % 50 == 0)
    assert {q: [v for v, _ in g] for q, g in got.items()} == {q: [v for v, _ in w] for q, w in want.items()}
    assert [v for v, _ in got[150]] == [100, 101, 102, 103, 104]


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e-310])
def test_very_large_and_small_components(spark, size):
    x = np.random.default_rng(3).standard_normal((60, 6))
    table = spark.createDataFrame([(i, (v * size).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = neighbours.nearest(table, lambda v: v % 50 == 0).collect()
    want = brute(np.arange(60), x, lambda v: v % 50 == 0)
    assert {q: [v for v, _ in g] for q, g in found(rows).items()} == {q: [v for v, _ in w] for q, w in want.items()}
    assert all(r["score"] == pytest.approx(dict(want[r["query_id"]])[r["vec_id"]], abs=1e-9 if size > 1e-300 else 1e-6) for r in rows)


@pytest.mark.parametrize("size", [0, 1, 2, 4])
def test_few_vectors(spark, size):
    x = np.eye(4)[:size] + 0.1 * np.arange(4)
    table = spark.createDataFrame([(50 * i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = found(neighbours.nearest(table, lambda v: v % 50 == 0).collect())
    assert {q: len(g) for q, g in got.items()} == ({50 * i: size - 1 for i in range(size)} if size > 1 else {})


def test_rounds_go_on_until_settled(spark):
    x = np.random.default_rng(4).standard_normal((900, 32))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    changed = neighbours.build(table).changed
    assert changed[-1] < neighbours.SETTLED and all(c >= neighbours.SETTLED for c in changed[:-1])
    with pytest.warns(RuntimeWarning, match="not settled"):
        assert len(neighbours.build(table, rounds=1).changed) == 1


def test_blocks_stay_as_fine_on_large_tables():
    assert [neighbours._bits(n) for n in (2, 1 << 14, 1 << 20, 1 << 30)] == [1, 7, 13, 23]


def test_search_goes_on_until_nothing_is_left(spark):
    """On a path of nodes each step reaches one more; the query is at the far end of it."""
    turn = np.linspace(0, np.pi / 2, 28)
    units = [v.tobytes() for v in np.column_stack([np.cos(turn), np.sin(turn)]).astype(np.float32)]
    short = [np.rint(127 * np.frombuffer(u, np.float32)).astype(np.int8).tobytes() for u in units]
    nodes = spark.createDataFrame([(i, u, short[i]) for i, u in enumerate(units)], "node long, unit binary, short binary")
    edges = spark.createDataFrame([(a, b) for a in range(28) for b in (a - 1, a + 1) if 0 <= b < 28], "node long, other long")
    index = neighbours.Index(nodes, nodes.limit(0), edges, 1 << 40, [])  # so many that no node is an entry
    queries = spark.createDataFrame([(0, units[-1], 0)], "q long, unit binary, own long")
    assert max((r["sim"], r["node"]) for r in neighbours.search(index, queries).collect())[1] == 27
