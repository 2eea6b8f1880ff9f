"""Winnowing against a search for every window."""

import random
import re

import pytest

from waybill.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, uid string, words string, grams int"
ITEMS = "item_id string, text string, iid int"


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, span=10):
    windows = {}
    for item, text in items:
        w = words_of(text)
        if item is not None and w:
            m = min(span, len(w))
            for i in range(len(w) - m + 1):
                windows.setdefault(tuple(w[i : i + m]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words_of(text), set(), set()
        for m in {len(k) for k in windows}:
            for i in range(len(w) - m + 1):
                if named := windows.get(tuple(w[i : i + m])):
                    found |= named
                    hit.update(range(i, i + m))
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)] + ["É1", "Ωmega", "the", "The", "a-b"]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(str(i), say(rnd.choice([1, 3, 7, 9, 10, 11, 25, 60]))) for i in range(40)]
    items += [("same", items[7][1]), ("7", say(30)), (None, say(20)), ("empty", ""), ("null", None), ("dots", "... !")]
    docs = [(i, say(rnd.choice([0, 2, 9, 10, 40, 300]))) for i in range(60)]
    for i in range(60, 100):  # a whole item, or a part of it, in other text
        text = words_of(rnd.choice(items[:40])[1])
        cut = text[rnd.randint(0, 3) :]
        docs.append((i, f"{say(20)}, {' '.join(cut).upper()}\n{say(5)}"))
    docs += [(5, docs[70][1]), (5, docs[70][1]), (None, docs[80][1]), (200, None), (201, ""), (202, "the " * 5000), (203, "x" * 3_000_000)]
    return docs, items


def test_equals_search_for_every_window(spark, case):
    docs, items = case
    frame = spark.createDataFrame([(*d, "u", "w", 1) for d in docs], DOCS)
    bench = spark.createDataFrame([(*i, 0) for i in items], ITEMS)
    rows = decontamination.contamination(frame, bench).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in rows), key=str)
    assert got == brute(docs, items)
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in rows)


def test_dropping_goes_by_text(spark, case):
    docs, items = case
    hit = {d for d, (_, _, n, _) in zip(sorted(docs, key=str), brute(docs, items)) if n}
    frame = spark.createDataFrame([(*d, "u", "w", 1) for d in docs], DOCS)
    kept = decontamination.drop_contaminated(frame, spark.createDataFrame([(*i, 0) for i in items], ITEMS))
    clean = [d for d in docs if not brute([d], items)[0][2]]
    assert hit and sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(clean, key=str)
    assert kept.columns == frame.columns


def test_empty_tables(spark, case):
    docs, items = case
    frame, bench = spark.createDataFrame([(*d, "u", "w", 1) for d in docs[:9]], DOCS), spark.createDataFrame([], ITEMS)
    assert [r["n_hit"] for r in decontamination.contamination(frame, bench).collect()] == [0] * 9
    assert decontamination.contamination(frame.limit(0), bench).count() == 0
