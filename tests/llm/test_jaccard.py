"""The heavy-light join against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.llm import components, jaccard

SCHEMA = "doc_id long, text string, n long, key string, id string, root int"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    root = {i: i for i, _ in docs if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    named = [(i, s) for i, s in sets if i is not None and s]
    for x, (i, a) in enumerate(named):
        for j, b in named[:x]:
            both = len(a & b)
            if 100 * both >= 75 * (len(a) + len(b) - both):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    out = []
    for i, s in sets:
        if i is not None:
            out.append((i, len(s), find(i)))
        else:
            same = [find(j) for j, b in named if b == s]
            out.append((None, len(s), min(same) if same and s else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def docs():
    rnd = random.Random(11)
    say = lambda n: [rnd.choice("abcdefghijklmnopqrstuvwxyz") + str(rnd.randint(0, 30)) for _ in range(n)]
    common = say(30)  # a passage in many texts
    rows = []
    for size in (1, 3, 5, 6, 7, 8, 9, 12, 16, 20, 24, 40, 90, 300):
        for _ in range(3):
            base = say(size) + (common if rnd.random() < 0.5 else [])
            for _ in range(rnd.randint(1, 9)):  # copies with a few changes, at the threshold and around it
                text = list(base)
                for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                    at = rnd.randrange(len(text))
                    text[at : at + rnd.randint(0, 1)] = say(rnd.randint(0, 2))
                rows.append((len(rows) * 3 % 997 + len(rows), " ".join(text)))
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "One Two"), (5004, "one  two"), (rows[4][0], rows[60][1]),
             (rows[9][0], rows[9][1]), (None, rows[20][1]), (None, "nowhere else to be found at all"), (5005, "x " * 4000), (5006, "x " * 4100)]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k", "i", 2) for i, t in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("boundary", [None, 0, 64])
def test_equals_all_pairs(spark, docs, boundary, monkeypatch):
    if boundary is not None:
        monkeypatch.setattr(jaccard, "_boundary", lambda prefixes: boundary)
    rows = jaccard.similarity_groups(frame(spark, docs)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str) == brute(docs)


def test_one_of_each_group_stays(spark, docs):
    rows = [*docs, (5001, ""), (70, None), (None, docs[3][1]), (5010, docs[5][1] + " more"), (5010, "two texts of one id, both judged")]
    kept = jaccard.one_of_each_group(frame(spark, rows))
    assert set(kept.columns) == {"doc_id", "text", "n", "key", "id", "root"}
    root = {i: r for i, _, r in brute([(k, t) for k, (_, t) in enumerate(rows)])}
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    groups = {}
    for k, row in enumerate(rows):
        groups.setdefault(root[k], set()).add(row)
    for group in groups.values():
        stays = [row for row in group if row in found]
        first = min(group, key=lambda row: (row[0] is None, row[0] or 0))[0]
        assert len(stays) == 1 and stays[0][0] == first, group
    assert len(found) == len(set(found)) == len({row for group in groups.values() for row in found if row in group})


def chain_of_long_lists(lists, members):
    """Every list's members hold its element; each list shares one document with the next. Sets are far apart."""
    return [(f"list{k}", k * (members - 1) + m) for k in range(lists) for m in range(members)]


def test_chained_long_lists_are_compared_less_than_quadratically(spark, monkeypatch):
    from waybill.llm.jaccard import _block_links

    compared = []
    for lists in (13, 130):
        rows = chain_of_long_lists(lists, 80)
        ids = sorted({i for _, i in rows})
        texts = [(i, " ".join(f"t{i // 2}w{k}" for k in range(40)) + (" odd" if i % 2 else "")) for i in ids]  # linked two by two
        long = spark.createDataFrame([(hash(key) & 0xFFFFFFFF, i, 36, 80) for key, i in rows], "key long, id long, n long, c long")
        seen = []
        real = jaccard.keep
        monkeypatch.setattr(jaccard, "keep", lambda df, name: seen.append((name, out := real(df, name))) or out)
        monkeypatch.setattr(jaccard, "forget", lambda *kept: None)
        links = _block_links(frame(spark, texts), long)
        found = {tuple(sorted((r["a"], r["b"]))) for r in links.collect()}
        met = {frozenset(p) for key in {k for k, _ in rows} for p in [(2 * i, 2 * i + 1) for i in range(len(ids) // 2)]}
        wanted = {(i, i + 1) for i in ids[::2] if frozenset((i, i + 1)) in met and i + 1 in ids}
        assert found == wanted
        placed, sides = dict(seen)["blocks"], dict(seen)["sides"]
        sizes = placed.groupBy("block").count()
        a, b = sizes.withColumnsRenamed({"block": "i", "count": "x"}), sizes.withColumnsRenamed({"block": "j", "count": "y"})
        compared.append(sides.select("i", "j").distinct().join(a, "i").join(b, "j").selectExpr("sum(x * y)").first()[0])
        monkeypatch.undo()
    assert compared[1] < 12 * compared[0]  # of ten times the documents: 10,000


def test_group_of_many_near_copies(spark):
    """Hundreds of different near copies are one group, without comparing all pairs."""
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[: i % 110] + [f"x{i}"] + base[i % 110 + 1 :])) for i in range(400)]
    got = jaccard.similarity_groups(frame(spark, rows)).select("component_id").distinct().collect()
    assert [r[0] for r in got] == [0]


def test_empty_table(spark, docs):
    assert jaccard.similarity_groups(frame(spark, docs).limit(0)).count() == 0


def test_components_of_chain_star_and_ring(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    got = {r["node"]: r["root"] for r in found.collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 160)}, 201: 200, 202: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).agg(F.count("*")).first()[0] == 0


def test_hot_elements_and_documents_that_may_be_copies(spark, docs, monkeypatch):
    """Elements of more than two documents aren't counted, and the filter of copies is full: the links stay."""
    monkeypatch.setattr(jaccard, "HOT_LIST", 2)
    monkeypatch.setattr(jaccard, "membership", lambda ids: np.full(1 << 21, 255, np.uint8))
    rows = jaccard.similarity_groups(frame(spark, docs)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str) == brute(docs)


def test_postings_are_moved_once(spark):
    prefixes = spark.createDataFrame([(1, 3, [7, 8, 9], 1, 2), (2, 3, [7, 5, 9], 1, 2)], "id long, n long, prefix array<long>, entries long, rare int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shared = jaccard._shared_postings(prefixes, 0)
        found = sorted((r["key"], r["id"]) for r in shared.collect())
        plan = shared._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == [(7, 1), (7, 2)] and plan.count("Exchange hashpartitioning") == 1


def test_bitmaps_lose_no_link_and_spare_moving_sets(spark, monkeypatch):
    """Of pairs, all that link pass the bitmaps, and most that are far from it don't."""
    rnd = random.Random(3)
    texts, pairs = [], []
    for k in range(120):
        size = rnd.choice([1, 7, 20, 31, 32, 33, 60, 130, 300])
        words = [f"w{rnd.randrange(10**6)}" for _ in range(size + 4)]
        near = list(words)
        for _ in range(rnd.choice([0, 1, 2, size // 40, size // 20])):
            near[rnd.randrange(len(near))] = f"x{rnd.randrange(10**6)}"
        far = words[: size // 3] + [f"y{rnd.randrange(10**6)}" for _ in range(size + 4 - size // 3)]
        texts += [(3 * k, " ".join(words)), (3 * k + 1, " ".join(near)), (3 * k + 2, " ".join(far))]
        pairs += [(3 * k, 3 * k + 1, 3 * k, 3 * k + 1), (3 * k, 3 * k + 2, 3 * k, 3 * k + 2)]
    moved, real = [], jaccard._only
    monkeypatch.setattr(jaccard, "_only", lambda sets, ids: moved.append(ids.count()) or real(sets, ids))
    found = {tuple(r) for r in jaccard._verified(frame(spark, texts), spark.createDataFrame(pairs, "id long, other long, a long, b long")).collect()}
    sets = {i: shingles(t) for i, t in texts}
    wanted = {(a, b) for a, b, _, _ in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert found == wanted and len(wanted) > 40
    assert moved[0] < 2.3 * len(wanted) < len(texts)
