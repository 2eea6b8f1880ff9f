"""Piece encoding against the library."""

import hashlib
import struct

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from waybill.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
VOCABULARY = pieces.load(PATH)
ENCODER = pieces._Encoder(VOCABULARY)
EDGES = ["", " ", "  a b", "a▁b", "a\nb\tc", "\x00a", "é é ﬁ", "日本😀", "a  ", "<s>hi</s>", "﻿x", "\r\n", " " * 40, "a" * 3000,
         "ab" * 200, " " * 33 + "x", "\n\n\n a", "▁▁x", "hello" * 50, "<unk>", "ñ" * 99, "‍\U0001f468‍"]


def agrees(text):
    ids, decoded = ENCODER.text(text)
    expected = LIBRARY.encode(text, add_bos=True, add_eos=True)
    assert pieces.ids_of(ids) == expected
    assert decoded == LIBRARY.decode(expected)


@pytest.mark.parametrize("text", EDGES)
def test_edges(text):
    agrees(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aeiourstnlhd  \n.,'-▁0129éñß€日😀"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    agrees(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(VOCABULARY.pieces[259:6000]), max_size=12))
def test_texts_of_pieces(parts):
    agrees("".join(parts).replace("▁", " "))


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    fresh = pieces._Encoder(VOCABULARY)
    text = "one two three four five six seven eight nine ten " * 3
    assert fresh.text(text) == ENCODER.text(text)


def test_what_is_remembered_is_bounded_and_keeps_what_is_met_again(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 60)
    fresh, encoded = pieces._Encoder(VOCABULARY), []
    encode = fresh.encode
    monkeypatch.setattr(fresh, "encode", lambda part: encoded.append(part) or encode(part))
    for a in "bdfgkmprst" * 2:
        text = " ".join(["always", *(f"{a}{b}{c}rold" for b in "aeiou" for c in "xy")])
        ids, decoded = fresh.text(text)
        assert pieces.ids_of(ids) == LIBRARY.encode(text, add_bos=True, add_eos=True) and decoded == text
        assert len(fresh.known) + len(fresh.older) <= 60
    assert encoded.count(" always") == 1 and len(encoded) > 120


def test_remembered_pieces_take_little_memory():
    assert pieces.REMEMBERED * 400 + pieces.REMEMBERED_PAIRS * 160 <= 100 << 20  # two workers beside a full heap

def test_slices_of_a_long_text(monkeypatch):
    monkeypatch.setattr(pieces, "SLICE", 7)
    text = "  one, two▁▁three\n four  é日😀   five\t six" * 9 + "a" * 50 + "   "
    texts = [text, None, "", " ", "short"]
    ids, decoded = ENCODER.texts(pa.array(texts))
    expected = [LIBRARY.encode(t or "", add_bos=True, add_eos=True) for t in texts]
    assert [pieces.ids_of(i) for i in ids.to_pylist()] == expected
    assert decoded.to_pylist() == [LIBRARY.decode(e) for e in expected]


def test_a_word_is_encoded_once_whatever_signs_surround_it(monkeypatch):
    fresh, encoded = pieces._Encoder(VOCABULARY), []
    encode = fresh.encode
    monkeypatch.setattr(fresh, "encode", lambda part: encoded.append(part) or encode(part))
    words = [f"un{a}worbl{b}ig" for a in "aeiou" for b in "rstlnk"]
    texts = [f"{w} {w}, {w}... {w}日 {w}* {w}| {w}; {w}" for w in words for _ in range(3)]
    ids, _ = fresh.texts(pa.array(texts))
    assert [pieces.ids_of(i) for i in ids.to_pylist()] == [LIBRARY.encode(t, add_bos=True, add_eos=True) for t in texts]
    assert len(encoded) == len(set(encoded)) and len(encoded) < len(words) + 10


def test_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(EDGES)] + [(1, EDGES[2], "x"), (None, "null id", "y"), (77, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(queries.token_digests(docs, PATH).collect(), key=str)
    expected = []
    for i, text, _ in rows:
        ids = LIBRARY.encode(text or "", add_bos=True, add_eos=True)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        expected.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert queries.token_digests(docs.limit(0), PATH).count() == 0
