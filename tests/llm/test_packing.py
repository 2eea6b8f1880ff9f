"""Packing: ids as the library gives them, every id in one piece, the rule against brute force, defined cases."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waybill.llm import packing, queries

PATH = public_tokenizers.path(queries.TOKENIZER)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, documents, library, window):
    """documents: a multiset of (doc_id, text)."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0 and len(r["ids"]) == 4 * r["length"]
            at += r["length"]
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    found = defaultdict(lambda: defaultdict(list))
    for r in rows:
        found[r["doc_id"]][r["start"]].append((np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]))
    wanted = defaultdict(list)
    for doc_id, text in documents:
        wanted[doc_id].append(ids_of(library, text))
    assert found.keys() == wanted.keys()
    for doc_id, all_ids in wanted.items():
        if len(all_ids) == 1:
            whole = []
            for start in sorted(found[doc_id]):
                (ids, tokens), = found[doc_id][start]
                assert start == len(whole) and tokens == len(all_ids[0])
                whole += ids
            assert whole == all_ids[0]
        else:
            assert sum(len(i) for s in found[doc_id].values() for i, _ in s) == sum(map(len, all_ids))
    return padding, len(sequences)


def test_ids_of_any_text(library):
    rnd = random.Random(5)
    alphabet = list("abcdeÉéßİſΣς'sdmtrelv0123.,;:!?-  \n\t\r\x0b\x0c\x1c\x1f\x85\xa0̧́ 　漢字한글ﬁ😀") + [
        "<|endoftext|>", "<|startoftext|>", "I'll", "l'eau", " don't", "  "]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    texts += [None, "", " ", "é ́e", "word " * 50_000, "x" * 20_000]
    encoder = packing.Encoder(open(PATH, encoding="utf-8").read())
    for low in range(0, len(texts), 97):
        part = texts[low : low + 97]
        got = encoder.encode(pa.array(part, pa.string()))
        for text, ids in zip(part, got):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(library, text)[:-1], text


def test_parts_reach_the_library_joined(library, monkeypatch):
    """A call for each part made the operator miss its CPU budget."""
    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, []

        def __getattr__(self, name):
            def call(texts, **options):
                self.texts += texts
                return getattr(self.tokenizer, name)(texts, **options)

            return call

    rnd = random.Random(10)
    parts = [f"{rnd.choice(['wörd', 'a', '漢字', '<|endoftext|>', 'it\'s', '́e', 'É.'])}{i}" for i in range(3000)]
    for joined, most in ((1 << 13, 12), (64, 1500), (1, 3002)):
        monkeypatch.setattr(packing, "JOINED", joined, raising=False)
        encoder = packing.Encoder(open(PATH, encoding="utf-8").read())
        encoder.tokenizer = counting = Counting(encoder.tokenizer)
        for text in (" ".join(parts), "\n".join(parts[::-1]) + "\r\n" + "y" * 20_000 + "\n\nz"):
            (got,) = encoder.encode(pa.array([text]))
            assert np.frombuffer(got, "<u4").tolist() == ids_of(library, text)[:-1]
        assert len(counting.texts) <= most


def test_remembered_parts_age(library, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    monkeypatch.setattr(packing, "SLICE", 8)
    rnd = random.Random(6)
    encoder = packing.Encoder(open(PATH, encoding="utf-8").read())
    for _ in range(200):
        text = " ".join(rnd.choice(["a", "bc", "def", "ghij", "klm", "no", "p", "qrs", "tu"]) for _ in range(rnd.randint(0, 12)))
        assert np.frombuffer(encoder.encode(pa.array([text]))[0], "<u4").tolist() == ids_of(library, text)[:-1]
        assert len(encoder.hashes) <= 9


@pytest.mark.parametrize("sizes", [range(1, 64), [21, 22, 40, 41], [33], range(30, 40)])
def test_levels_as_brute_force(sizes):
    window, rnd = 64, random.Random(7)
    packer = packing.Packer(window, 10**9)
    levels = defaultdict(int)

    def squares(counts):
        return sum(n * n for level, n in counts.items() if 0 < level < window)

    for i in range(400):
        size = rnd.choice(list(sizes))
        best = None
        for level in range(window - size, -1, -1):
            if level and not levels[level]:
                continue
            after = dict(levels)
            after[level] = after.get(level, 0) - (level > 0)
            after[level + size] = after.get(level + size, 0) + 1
            if best is None or squares(after) < best[0]:
                best = squares(after), level
        assert packer.level(size) == best[1]
        levels[best[1]] -= best[1] > 0
        levels[best[1] + size] += 1
        packer.add(i, bytes(4 * size))
    assert [int(n) for n in packer.counts[1:window]] == [levels[k] for k in range(1, window)]


def test_open_windows_are_bounded():
    packer, seen, rnd = packing.Packer(64, 20), [], random.Random(8)
    for i in range(1000):
        packer.add(i, bytes(4 * rnd.choice([33, 40, 130])))
        assert packer.open <= 21 and packer.open == packer.counts[1:64].sum()
        seen += packer.taken()
    packer.end()
    seen += packer.taken()
    lengths = [sum(len(p[2]) // 4 for p in s) for s in seen]
    assert all(n == 64 or n & (n - 1) == 0 for n in lengths) and sum(n < 64 for n in lengths) <= 6


def test_packed_documents(spark, library):
    rnd = random.Random(9)
    words = ["eau", "l'été", "the", "<|endoftext|>", "naïve", "x1", "漢字", "stone."]
    documents = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 5, 60, 300])))) for i in range(300)]
    documents += [(400, None), (401, ""), (402, " \n "), (403, "long word " * 9000), (404, "x" * 30_000), (5, "again"), (None, "no id"), (None, None)]
    docs = spark.createDataFrame([(*d, 0, 0, 0) for d in documents], "doc_id long, text string, start int, ids int, offset int").repartition(3)
    for window, bound in ((64, 5), (2048, 2048)):
        rows = packing.packed(docs, PATH, 1, window=window, open_windows=bound).collect()
        padding, _ = check(rows, documents, library, window)
        assert padding == 0
    assert packing.packed(docs.limit(0), PATH, 1).count() == 0


def test_the_registered_query(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.op12_packing(spark, SF).collect()
    whole = packing.packed(docs, PATH, 1).withColumn("ids_crc32", F.crc32("ids"))
    padding, sequences = check(whole.collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], library, 2048)
    assert padding == 0 and sequences > 10
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert sorted(map(tuple, rows)) == sorted(map(tuple, whole.select(*key).collect()))
