"""Exact encoding and decoding with a SentencePiece model of the merge type.

The result of merging is found without merging: a sequence of pieces is the encoding of its text just
when every two neighbours stay as they are if their joint text is merged again. So the longest
piece that matches (Aho-Corasick) and suits its left neighbour is taken; where none does, the last
piece is given up for a shorter one. The chain that reaches a position is the encoding of the
text so far, hence unique, so a position that can't be continued is marked in a bitfield and never
tried again.

Two characters that are neighbours in no piece are never merged, so texts are cut there, also around
characters that occur in no piece; those become byte pieces. The parts, words and signs, are found in numpy for
whole Arrow batches, the distinct ones of a batch are encoded once per worker and remembered in two bounded dictionaries: when one
is full it becomes the older, from which what is met again is taken over. Arrow puts their ids and texts together. Texts beyond ``SLICE`` are worked through in slices that end before a space.

Merges of equal score go to the leftmost pair. Pieces that merging never yields from their own text
are not matched.

Defined cases: a null text is empty; empty text has only the begin and end ids and decodes to empty.
Other columns pass through unchanged. Rows are encoded one by one. Only models with identity
normalisation, kept white space, a space before the text and byte pieces are accepted.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from waybill.llm.tables import remembered
from waybill.llm.words import flat_bytes, row_chunks

SPACE = "▁"
REMEMBERED = 150_000  # parts, of some 250 bytes each
REMEMBERED_PAIRS = 250_000  # of some 100 bytes each
SLICE = 1 << 20  # bytes of a longer text encoded at a time, about
_BEFORE_SPACE = re.compile(rb"[^ ](?= )")
NORMAL, USER_DEFINED, BYTE = 1, 4, 6


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    begin: int
    end: int
    matched: tuple[int, ...]  # ids of pieces that merging yields from their own text

    @property
    def ids(self) -> dict[str, int]:
        return {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, USER_DEFINED)}

    @property
    def bytes(self) -> list[int]:
        return [self.pieces.index(f"<0x{b:02X}>") for b in range(256)]


def load(path: str) -> Vocabulary:
    """The vocabulary in a model file; ``path`` is read on the driver only."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules, trainer = model.normalizer_spec, model.trainer_spec
    if trainer.model_type != 2 or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
        raise ValueError("only merge-type models with byte pieces are supported")
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix or not rules.escape_whitespaces:
        raise ValueError("only identity normalisation with a space before the text is supported")
    if any(p.type not in (1, 2, 3, 6) for p in model.pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    vocabulary = Vocabulary(
        tuple(p.piece for p in model.pieces), tuple(p.score for p in model.pieces), tuple(p.type for p in model.pieces),
        trainer.bos_id, trainer.eos_id, ())
    order = merge_order(vocabulary)
    matched = tuple(i for p, i in vocabulary.ids.items() if merged(p, order) == [p])
    return Vocabulary(vocabulary.pieces, vocabulary.scores, vocabulary.kinds, trainer.bos_id, trainer.eos_id, matched)


def merge_order(vocabulary: Vocabulary) -> dict[str, int]:
    """For every piece when it is merged: the best score is 0, equal scores are equal."""
    places = {score: i for i, score in enumerate(sorted(set(vocabulary.scores), reverse=True))}
    return {p: places[vocabulary.scores[i]] for p, i in vocabulary.ids.items()}


def merged(text: str, order: dict[str, int]) -> list[str]:
    """Merging as defined: the best-scored adjacent pair first, of equals the leftmost."""
    never = len(order) + 1
    parts = list(text)
    ranks = [order.get(a + b, never) for a, b in zip(parts, parts[1:])]
    while ranks and (best := min(ranks)) != never:
        i = ranks.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del ranks[i]
        if i:
            ranks[i - 1] = order.get(parts[i - 1] + parts[i], never)
        if i < len(ranks):
            ranks[i] = order.get(parts[i] + parts[i + 1], never)
    return parts


def _slices(text: bytes) -> Iterator[bytes]:
    """A text cut before spaces that follow another character into slices of about ``SLICE`` bytes, or one longer part."""
    start = 0
    while len(text) - start > SLICE and (found := _BEFORE_SPACE.search(text, start + SLICE)):
        yield text[start : found.end()]
        start = found.end()
    yield text[start:]


def _joined(values: list[bytes], codes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """For every row the values of its codes, which lie between two bounds, as one."""
    taken = pa.array(values, pa.large_binary()).take(pa.array(codes))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :][bounds]
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), taken.buffers()[2]])


class _Encoder:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.vocabulary, self.ids, self.bytes = vocabulary, vocabulary.ids, vocabulary.bytes
        self.order = merge_order(vocabulary)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece holds a space after another character")
        self.matched = {vocabulary.pieces[i].replace(SPACE, " "): i for i in vocabulary.matched if " " not in vocabulary.pieces[i]}
        self.longest = max(map(len, self.matched), default=0)
        self.matcher = ahocorasick.Automaton()
        for piece in self.matched:
            self.matcher.add_word(piece, len(piece))
        neighbours = {pair for p in self.ids for pair in zip(p.replace(SPACE, " "), p.replace(SPACE, " ")[1:])}
        signs = sorted({c for pair in neighbours for c in pair})
        if not self.matched.keys() >= set(signs):
            raise ValueError("a character of a longer piece is no piece")
        self.sign = np.zeros(max(map(ord, signs), default=0) + 2, np.int16)  # 0: never beside another in a piece
        self.sign[[ord(c) for c in signs]] = np.arange(1, len(signs) + 1)
        self.beside = np.zeros((len(signs) + 1, len(signs) + 1), bool)
        for a, b in neighbours:
            self.beside[self.sign[ord(a)], self.sign[ord(b)]] = True
        self.byte_of = {i: b for b, i in enumerate(self.bytes)}
        self.shown = [None if k == BYTE else p.replace(SPACE, " ") if k == NORMAL else "" for p, k in zip(vocabulary.pieces, vocabulary.kinds)]
        self.width = len(vocabulary.pieces)
        self.suits: dict[int, bool] = {}  # by left * width + right
        self.known: dict[bytes, tuple[bytes, bytes]] = {}
        self.older: dict[bytes, tuple[bytes, bytes]] = {}  # what was known before ``known`` was begun

    def compatible(self, left: int, right: int) -> bool:
        found = self.suits.get(left * self.width + right)
        if found is None:
            if len(self.suits) >= REMEMBERED_PAIRS:
                self.suits.clear()
            a, b = self.vocabulary.pieces[left], self.vocabulary.pieces[right]
            found = self.suits[left * self.width + right] = merged(a + b, self.order) == [a, b]
        return found

    def encode(self, part: str) -> list[int]:
        """Ids of a part that no piece extends beyond, spaces written as such."""
        matched, reach, suits, width = self.matched, self.matcher.longest_prefix, self.suits, self.width
        if len(part) == 1 and part not in matched:
            return [self.bytes[b] for b in part.encode("utf-8", "surrogatepass")]
        taken: list[int] = []
        ends = [0]  # of what is taken
        failed = at = 0
        stop = None
        while at < len(part):
            if stop is None:
                stop = at + reach(part[at : at + self.longest])
            while stop > at:
                i = matched.get(part[at:stop])
                if i is not None and not failed >> stop & 1:
                    suit = suits.get(taken[-1] * width + i) if taken else True
                    if self.compatible(taken[-1], i) if suit is None else suit:
                        break
                stop -= 1
            if stop > at:
                taken.append(i)
                ends.append(stop)
                at, stop = stop, None
            else:
                failed |= 1 << at
                taken.pop()
                stop = ends.pop() - 1
                at = ends[-1]
        return taken

    def decode(self, ids) -> str:
        """Text of ids, the first space included."""
        shown = [self.shown[i] for i in ids]
        if None not in shown:
            return "".join(shown)
        out, raw = [], bytearray()
        for i, piece in zip(ids, shown):
            if piece is None:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(piece)
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    def _parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The parts of all texts, and the index of each text's first part (one more entry than texts)."""
        data, offsets = flat_bytes(texts)
        if not len(data):
            return pa.array([], pa.large_binary()), np.zeros(len(offsets), np.int64)
        characters = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        sign = self.sign[np.minimum(characters, len(self.sign) - 1)]
        cut = np.ones(len(characters), bool)
        cut[1:] = ~self.beside[sign[:-1], sign[1:]]
        places = np.flatnonzero(data & 0xC0 != 0x80)  # bytes that begin a character
        cut[np.searchsorted(places, offsets[:-1][np.diff(offsets) > 0])] = True
        starts = places[cut]
        bounds = np.append(starts, len(data)).astype(np.int64)
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        return parts, np.searchsorted(starts, offsets)

    def _found(self, words: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Ids, as little-endian 32-bit integers, and decoded text of distinct parts."""
        missing = [w for w in words if w not in self.known]
        if missing and len(self.known) + len(missing) > REMEMBERED // 2:
            self.known, self.older, missing = {}, self.known, words
        known, older = self.known, self.older
        for word in missing:
            found = older.get(word)
            if found is None:
                ids = self.encode(word.decode("utf-8"))
                shown = self.decode(ids).encode("utf-8")
                found = struct.pack(f"<{len(ids)}I", *ids), word if shown == word else shown
            known[word] = found
        return [known[w] for w in words]

    def _pieces(self, texts: pa.Array, begin: bytes, end: bytes) -> tuple[pa.Array, pa.Array]:
        """Ids of whole texts between those of ``begin`` and ``end``, and their decoding."""
        parts, first = self._parts(texts)
        coded = parts.dictionary_encode()
        found = self._found(coded.dictionary.to_pylist())
        edges = np.stack([first[:-1], first[1:]], axis=1).ravel()
        codes = np.insert(coded.indices.to_numpy().astype(np.int64), edges, np.tile([len(found), len(found) + 1], len(texts)))
        bounds = first + 2 * np.arange(len(first))
        return (_joined([*(f[0] for f in found), begin, end], codes, bounds),
                _joined([*(f[1] for f in found), b"", b""], codes, bounds))

    def texts(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Ids of whole texts as little-endian 32-bit integers, begin and end included, and their decoding."""
        begin, end = (struct.pack("<I", i) for i in (self.vocabulary.begin, self.vocabulary.end))
        texts = pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), SPACE, " ")
        space, nothing = (pa.scalar(t, pa.large_string()) for t in (" ", ""))
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), nothing, pc.binary_join_element_wise(space, texts, nothing))
        if (pc.sum(pc.binary_length(texts)).as_py() or 0) <= 4 * SLICE:
            ids, decoded = self._pieces(texts, begin, end)
        else:
            rows = [[self._pieces(pa.array([part], pa.large_binary()), b"", b"") for part in _slices(t)] for t in texts.cast(pa.large_binary()).to_pylist()]
            ids = pa.array([b"".join([begin, *(i[0].as_py() for i, _ in row), end]) for row in rows], pa.large_binary())
            decoded = pa.array([b"".join(d[0].as_py() for _, d in row) for row in rows], pa.large_binary())
        decoded = pc.replace_substring_regex(decoded.cast(pa.large_string()), r"\A ", "", max_replacements=1)
        return ids.cast(pa.binary()), decoded.cast(pa.string())

    def text(self, text: str | None) -> tuple[bytes, str]:
        """The same for one text."""
        ids, decoded = self.texts(pa.array([text], pa.string()))
        return ids[0].as_py(), decoded[0].as_py()


def _encoder(vocabulary: Vocabulary) -> _Encoder:
    """One per worker process, so that what it remembers serves all its tasks."""
    return remembered(vocabulary, lambda: _Encoder(vocabulary))


def encoded(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the ids of the whole text (binary, little-endian 32-bit integers, begin and end
    included) and the text that decoding those ids gives."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = StructType(docs.schema.fields + [StructField(ids, BinaryType()), StructField(decoded, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for whole in batches:
            for batch in row_chunks(whole, text):
                yield pa.RecordBatch.from_arrays([*batch.columns, *encoder.texts(batch.column(text))], [*batch.schema.names, ids, decoded])

    return docs.withColumn(text, F.col(text).cast("string")).mapInArrow(run, schema)


def ids_of(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()
