"""Runs of words: brute force over all stretches, the registered alteration, defined cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from waybill.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def brute_runs(words):
    """By start, then period: all maximal stretches of at least 4 periods, from the definition."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(
                    q % p == 0 and all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                found.append((i, length, q))
            i = max(i + 1, j)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    dropped = {k for start, length, q in runs for k in range(start + q, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in dropped)


def sequences(count, seed):
    rnd = random.Random(seed)
    for _ in range(count):
        out = []
        while len(out) < rnd.randint(0, 70):
            unit = [rnd.choice("aAbé"[: rnd.randint(1, 4)]) for _ in range(rnd.randint(1, 9))]
            out += (unit * 12)[: rnd.choice([1, 3, len(unit) * 4, len(unit) * 4 - 1, len(unit) * 5 + 1])]
        yield out


def test_runs_of_sequences():
    for words in sequences(1500, 1):
        assert sorted(periodic.runs_of([ord(w) for w in words]), key=lambda r: (r[0], r[2])) == brute_runs(words), words
    for words in (["a"] * 5, ["a"] * 6, ["a", "b"] * 4, (["a", "b"] * 4)[:7], []):
        assert periodic.runs_of([ord(w) for w in words]) == brute_runs(words)


def test_fibonacci_and_long_words():
    a, b = [1], [1, 2]
    for _ in range(10):
        a, b = b, b + a
    assert sorted(periodic.runs_of(b)) == sorted(brute_runs(b))
    assert periodic.runs_of([7] * 20_000) == [(0, 20_000, 1)]
    assert periodic.runs_of(list(range(3000)) * 5) == [(0, 15_000, 3000)]


def test_stretches_lose_no_run():
    texts = list(sequences(400, 2))
    words = np.array([ord(w) for t in texts for w in t], np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ranges = periodic.stretches(words, owner)
    assert all(owner[a] == owner[b - 1] for a, b in ranges)
    for i, text in enumerate(texts):
        for start, length, _ in brute_runs(text):
            low = first[i] + start
            assert any(a <= low and low + length <= b for a, b in ranges)


def test_rows(spark):
    texts = [" ".join(t) for t in sequences(300, 3)]
    texts += [None, "", "  \n", "a a a a a a", "A a A a A a", "x\t" * 6 + "y", " a\n\nb " * 4, "end end end end end end"]
    texts += ["no repeat " + " ".join(map(str, range(30_000))), "é à " * 20_000, "z" * 100_000]
    docs = spark.createDataFrame([(i, t, "r", "c") for i, t in enumerate(texts)] + [(None, "b b b b b b", "r", "c"), (3, "b b b b b b", "r", "c")],
                                 "doc_id long, text string, runs string, collapsed string").repartition(3)
    out = periodic.with_runs(docs)
    assert out.columns == ["doc_id", "runs", "collapsed"]
    rows = {(r["doc_id"], r["collapsed"]): [tuple(x) for x in r["runs"]] for r in out.collect()}
    assert rows[None, "b"] == rows[3, "b"] == [(0, 6, 1)]
    for i, text in enumerate(texts):
        words = [w.decode() for w in (text or "").encode().split()]
        runs = brute_runs(words) if len(words) < 1000 else [(0, 40_000, 2)] if "é" in words else []
        assert rows[i, collapsed(words, runs)] == runs, text
    assert periodic.with_runs(docs.limit(0)).count() == 0


@pytest.mark.parametrize("extra", [False, True])
def test_the_registered_query(spark, tmp_path, extra):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    if extra:
        ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0]
        rows = [(i, " ".join(f"w{k}" for k in range(n))) for n, i in enumerate(ids)] + [(None, "a " * 9), (ids[0], None), (ids[1], ""), (ids[2], " \n")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    wanted = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        wanted.append((doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
                       hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest()))
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got.columns == names and {t for n, t in got.dtypes if "sha" not in n} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)
    assert sum(r[1] > 0 for r in wanted) > 5
