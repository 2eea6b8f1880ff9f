"""Sum-of-squares packing of tokenized documents into training windows.

A document's tokens are its ids plus one end id. Whole windows of it are cut off first; the rest goes,
in one piece, to the fill level at which the sum of squared counts of partly filled windows becomes
smallest. A level array counts the open windows at each fill level; one new window competes as level 0,
full windows count no more, and of equals the fullest level wins. So windows spread over all levels and
nearly every rest finds one that it fills up.

Every Spark task packs its own documents: nothing is shuffled, and a task's windows hold its documents
only. Open windows left at a task's end are joined and cut at window ends; what then remains, less than
one window, becomes sequences of falling powers of two, which need no padding. The same joining
happens whenever ``open_windows`` are open, so memory is bounded by that many windows (of their ids) and
one document, whatever the task's size.

Texts are cut at ASCII white space, across which the tokenizer merges and composes nothing; each
part is encoded once by the library and remembered, up to a fixed number of parts. The library gets
many new parts as one text, a special token between them, as a call and a result for each part would
cost more than its encoding.

Defined cases: a null or empty text has the end id only. Rows are packed one by one: repeated rows and ids
are packed as often as they occur, a null id stays null. An empty table gives no pieces. Other
columns are ignored. Sequence ids are unique, not gapless: the task's number and a count within it. Equality of
parts is equality of 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from waybill.llm.words import WHITE_SPACE, exact_words, flat_bytes, row_chunks

WINDOW = 2048
OPEN_WINDOWS = 2048
REMEMBERED = 2_000_000  # parts, of some 40 bytes each
ROWS_OUT = 2048
SLICE = 1 << 20  # bytes of text encoded at a time, about
JOINED = 1 << 13  # bytes of parts in one call of the library, or one longer part
BETWEEN = "\n"  # in no part; as a special token it keeps parts in one call apart
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _slices(text: bytes) -> Iterator[bytes]:
    """A text cut at white space into slices of about ``SLICE`` bytes, or one longer word."""
    start = 0
    while len(text) - start > SLICE:
        found = _SPACE.search(text, start + SLICE)
        if not found:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:] if start else text


class Encoder:
    """Ids of whole texts as little-endian 32-bit integers, by a tokenizer given as JSON text.

    Parts are known by their hash, in sorted arrays; when ``REMEMBERED`` are known, all are forgotten.
    """

    def __init__(self, tokenizer: str):
        from tokenizers import AddedToken, Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.add_special_tokens([AddedToken(BETWEEN, normalized=False)])
        self.between = self.tokenizer.token_to_id(BETWEEN)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts one after the other, and how many each has."""
        lengths = ends - starts + 1
        after = np.cumsum(lengths)
        found, low = [], 0
        while low < len(starts):
            done = int(after[low] - lengths[low])
            high = max(low + 1, int(np.searchsorted(after, done + JOINED, "right")))
            shift = np.repeat(starts[low:high] - after[low:high] + lengths[low:high] + done, lengths[low:high])
            # a part's last place is BETWEEN, which stands for the byte after the part
            joined = data[np.minimum(shift + np.arange(len(shift)), len(data) - 1)]
            joined[after[low:high] - done - 1] = ord(BETWEEN)
            text = joined.tobytes().decode("utf-8", "replace")
            # one text a call: several would be dealt over threads, which cost CPU beside the other tasks
            (encoding,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            found.append(np.array(encoding.ids, np.uint32))
            low = high
        ids = np.concatenate(found)
        cuts = np.flatnonzero(ids == self.between)
        return ids[ids != self.between], np.diff(cuts, prepend=-1) - 1

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """``hashes`` are in order and not known yet."""
        ids, sizes = self._encoded(data, starts, ends)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.begins = np.insert(self.begins, at, len(self.ids) + np.cumsum(sizes) - sizes)
        self.sizes = np.insert(self.sizes, at, sizes)
        self.ids = np.concatenate([self.ids, ids])

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hashes, hashes)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == hashes[known]
        return at, known

    def encode(self, texts: pa.Array) -> list[bytes]:
        """One after the other where they are long together."""
        if (pc.sum(pc.binary_length(texts)).as_py() or 0) <= 4 * SLICE:
            return self._encode(texts)
        slices = ((_slices(t) if t else ()) for t in texts.cast(pa.binary()).to_pylist())
        return [b"".join(self._encode(pa.array([part], pa.binary()))[0] for part in parts) for parts in slices]

    def _encode(self, texts: pa.Array) -> list[bytes]:
        data, offsets = flat_bytes(texts)
        words, starts, ends, first = exact_words(data, offsets, WHITE_SPACE)
        distinct, example, which = np.unique(words, return_index=True, return_inverse=True)
        at, known = self._places(distinct)
        if not known.all() and len(self.hashes) + len(distinct) - known.sum() > REMEMBERED:
            self._forget()
            known[:] = False
        if not known.all():
            new = example[~known]
            self._learn(distinct[~known], data, starts[new], ends[new])
            at, _ = self._places(distinct)
        sizes = self.sizes[at][which]
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.begins[at][which] - before[:-1], sizes) + np.arange(before[-1])]
        packed, bounds = ids.astype("<u4").tobytes(), (4 * before[first]).tolist()
        return [packed[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


_ENCODERS: dict[int, Encoder] = {}


def _encoder(tokenizer: str) -> Encoder:
    """One per worker process, so that what it remembers serves all its tasks."""
    key = hash(tokenizer)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer)
    return _ENCODERS[key]


class Packer:
    """Windows of one task. A piece is (document, start, ids, tokens of the document)."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS):
        self.window, self.limit = window, open_windows
        self.counts = np.zeros(window + 1, np.int64)  # open windows at each fill level
        self.at: list[list[list[tuple]]] = [[] for _ in range(window + 1)]
        self.full: list[list[tuple]] = []
        self.open = 0

    def level(self, size: int) -> int:
        """Where a piece of ``size``, less than a window, adds least to the sum of squared counts; 0 is a new window."""
        counts = self.counts
        # count x at the new level becomes x + 1, count y at the old one y - 1
        growth = 2 * counts[size:] + 2
        growth[-1] = 1  # a full window isn't counted any more
        growth -= 2 * counts[: self.window - size + 1]
        growth[counts[: self.window - size + 1] == 0] = np.iinfo(np.int64).max
        growth[0] = 2 * counts[size] + 1
        return self.window - size - int(np.argmin(growth[::-1]))

    def add(self, document, ids: bytes) -> None:
        tokens = len(ids) // 4
        start = 0
        while tokens - start >= self.window:
            self.full.append([(document, start, ids[4 * start : 4 * (start + self.window)], tokens)])
            start += self.window
        if start == tokens:
            return
        size = tokens - start
        level = self.level(size)
        if level:
            window = self.at[level].pop()
            self.counts[level] -= 1
        else:
            window = []
            self.open += 1
        window.append((document, start, ids[4 * start :], tokens))
        self._put(window, level + size)
        if self.open > self.limit:
            self.join()

    def _put(self, window: list[tuple], level: int) -> None:
        if level == self.window:
            self.full.append(window)
            self.open -= 1
        else:
            self.at[level].append(window)
            self.counts[level] += 1

    def join(self) -> None:
        """Lays the open windows end to end and cuts at window ends; one stays open at most."""
        waiting = [piece for level in self.at for window in level for piece in window]
        self.counts[:] = 0
        self.at = [[] for _ in self.at]
        self.open = 0
        window, level = [], 0
        for document, start, ids, tokens in waiting:
            while ids:
                taken = ids[: 4 * (self.window - level)]
                window.append((document, start, taken, tokens))
                ids, start, level = ids[len(taken) :], start + len(taken) // 4, level + len(taken) // 4
                if level == self.window:
                    self.full.append(window)
                    window, level = [], 0
        if window:
            self.open = 1
            self._put(window, level)

    def end(self) -> None:
        """Joins, and cuts the last open window into falling powers of two."""
        self.join()
        for level in np.flatnonzero(self.counts):
            pieces, left = self.at[level].pop(), int(level)
            while left:
                power, sequence = 1 << (left.bit_length() - 1), []
                left -= power
                while power:
                    document, start, ids, tokens = pieces.pop(0)
                    taken = ids[: 4 * power]
                    sequence.append((document, start, taken, tokens))
                    power -= len(taken) // 4
                    if len(taken) < len(ids):
                        pieces.insert(0, (document, start + len(taken) // 4, ids[len(taken) :], tokens))
                self.full.append(sequence)
        self.counts[:] = 0
        self.open = 0

    def taken(self) -> list[list[tuple]]:
        done, self.full = self.full, []
        return done


def packed(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text", window: int = WINDOW,
           open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """Pieces of all documents: where each begins in its document, its ids (little-endian 32-bit integers),
    the document's tokens with ``end_id``, its sequence and place there. ``tokenizer`` is a file the
    driver reads; its text goes to the tasks, whatever the number of documents."""
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    last = np.array([end_id], "<u4").tobytes()
    names = [part.split()[0] for part in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = _encoder(shared.value), Packer(window, open_windows)
        number = TaskContext.get().partitionId() << 40

        def rows(sequences: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            columns: list[list] = [[] for _ in names]
            for sequence in sequences:
                offset = 0
                for document, start, ids, tokens in sequence:
                    for column, value in zip(columns, (document, start, len(ids) // 4, ids, tokens, number, offset)):
                        column.append(value)
                    offset += len(ids) // 4
                number += 1
                if len(columns[0]) >= ROWS_OUT:
                    yield _batch(columns)
                    columns = [[] for _ in names]
            if columns[0]:
                yield _batch(columns)

        def _batch(columns: list[list]) -> pa.RecordBatch:
            arrays = [pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, columns)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for whole in batches:
            for batch in row_chunks(whole, "text", 2 * SLICE):
                for document, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                    packer.add(document, ids + last)
                yield from rows(packer.taken())
        packer.end()
        yield from rows(packer.taken())

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(run, PIECES)
