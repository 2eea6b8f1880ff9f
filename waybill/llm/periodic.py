"""Periodic runs of words, by a suffix automaton whose link tree is accessed as a link-cut tree.

A run is a stretch of words with smallest period q that is ``EXPONENT`` * q words long at least, has
``SHORTEST`` words at least and can't be extended on either side with that period.

Every appended word accesses the path from its prefix's state to the root and colours it with its own
place. What was coloured by one earlier place e is one segment of that path; its deepest state has
the longest string that ends both there and here. With distance d = here - e and that length m, the
last m + d words have period d. If m is (``EXPONENT`` - 1) * d or more, that is a repetition which can't be
extended to the left (the string is the longest), d is its smallest period (an earlier end would have
coloured the segment later) and it is a run unless the next word continues it. Every run shows up at its last
word: there the string that is one period shorter than the run ended last one period before.

Words without a run are ruled out first, for whole Arrow batches: within a run every ``GRAM`` words occur again
one period further on or back. So words stay only where such a gram recurs within a quarter of the stretch
of words that such grams cover without a break. This rules out what can't be part of a run and nothing else;
only the stretches left, each far shorter than a text as a rule, get an automaton.

Defined cases: a null text, an empty one and one of white space only have no words, no runs and an empty
``collapsed``. Rows are looked at one by one, so repeated ids repeat and null ids stay. An empty table gives
an empty result. Other columns pass through unchanged; columns named like the added ones are replaced. Memory follows the
longest stretch of repetition, else a batch slice or one longer text. Equality of words is equality of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from waybill.llm.words import WHITE_SPACE, exact_words, flat_bytes, gram_hashes, mix, row_chunks, text_of

EXPONENT = 4
SHORTEST = 6
GRAM = 5  # a run has this many words besides one period
RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])


def _automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Longest length and suffix link of every state, and the state of every prefix."""
    longest, link, ends = [0], [-1], []
    follow: list[dict[int, int]] = [{}]
    last = 0
    for i, word in enumerate(words):
        state = len(longest)
        longest.append(i + 1)
        link.append(0)
        follow.append({})
        at = last
        while at >= 0 and word not in follow[at]:
            follow[at][word] = state
            at = link[at]
        if at >= 0:
            target = follow[at][word]
            if longest[at] + 1 == longest[target]:
                link[state] = target
            else:
                clone = len(longest)
                longest.append(longest[at] + 1)
                link.append(link[target])
                follow.append(follow[target].copy())
                while at >= 0 and follow[at].get(word) == target:
                    follow[at][word] = clone
                    at = link[at]
                link[target] = link[state] = clone
        ends.append(state)
        last = state
    return longest, link, ends


def runs_of(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence, in the order of their ends."""
    longest, link, ends = _automaton(words)
    # preferred paths are splay trees; the root of each holds its colour, 1 + the place that accessed it last.
    # States too short for any run hang on no tree: 0 stands for nothing.
    least = SHORTEST - 1
    parent = [up if up > 0 and longest[up] >= least else 0 for up in link]
    left, right, colour = ([0] * len(link) for _ in range(3))

    def rotate(x: int) -> None:
        y = parent[x]
        z = parent[y]
        if left[y] == x:
            moved = left[y] = right[x]
            right[x] = y
        else:
            moved = right[y] = left[x]
            left[x] = y
        if moved:
            parent[moved] = y
        if left[z] == y:
            left[z] = x
        elif right[z] == y:
            right[z] = x
        else:  # y was the root
            colour[x] = colour[y]
        parent[x], parent[y] = z, x

    def splay(x: int) -> None:
        y = parent[x]
        while y and (left[y] == x or right[y] == x):
            z = parent[y]
            if z and (left[z] == y or right[z] == y):
                rotate(y if (left[z] == y) == (left[y] == x) else x)
            rotate(x)
            y = parent[x]

    found, n = [], len(words)
    for i, state in enumerate(ends):
        if longest[state] < least:
            continue
        below, at = 0, state
        while at:
            splay(at)
            seen = colour[at]
            if seen:
                distance, length = i + 1 - seen, longest[at]
                if length >= (EXPONENT - 1) * distance and length + distance >= SHORTEST and (
                        i + 1 == n or words[i + 1] != words[i + 1 - distance]):
                    found.append((i + 1 - length - distance, length + distance, distance))
            deeper = right[at]
            if deeper:
                colour[deeper] = seen
            right[at] = below
            below, at = at, parent[at]
        colour[below] = i + 1
    return found


def stretches(words: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of words outside which there is no run; ``owner`` tells texts apart."""
    n = len(words) - GRAM + 1
    if n <= 0:
        return []
    at = np.flatnonzero(owner[:n] == owner[GRAM - 1 :])
    keys = (gram_hashes(words, GRAM) ^ mix(owner[:n].astype(np.uint64) + np.uint64(1)))[at]
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    again = (keys[1:] == keys[:-1]) & (owner[at[1:]] == owner[at[:-1]])
    gap = np.where(again, np.diff(at), len(words))
    none = np.array([len(words)])
    nearest = np.minimum(np.concatenate([none, gap]), np.concatenate([gap, none]))
    at, nearest = at[nearest < len(words)], nearest[nearest < len(words)]
    while len(at):
        cover = np.zeros(len(words) + 1, np.int32)
        cover[at] += 1
        cover[at + GRAM] -= 1
        covered = np.cumsum(cover[:-1]) > 0
        begins = covered.copy()
        begins[1:] &= ~covered[:-1] | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(begins)
        stops = covered.copy()
        stops[:-1] &= ~covered[1:] | (owner[1:] != owner[:-1])
        ends = np.flatnonzero(stops) + 1
        size = (ends - starts)[np.searchsorted(starts, at, "right") - 1]
        near = nearest * EXPONENT <= size
        if near.all():
            return [(int(a), int(b)) for a, b in zip(starts, ends) if b - a >= SHORTEST]
        at, nearest = at[near], nearest[near]
    return []


def _collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, kept: np.ndarray) -> pa.Array:
    """Kept words of every text, joined by one space each."""
    owner = text_of(first)[kept]
    starts, ends = starts[kept], ends[kept]
    more = np.zeros(len(starts), bool)  # another kept word follows, so a white-space byte does too
    more[:-1] = owner[1:] == owner[:-1]
    step = np.zeros(len(data) + 2, np.int8)
    step[starts] += 1
    step[ends + more] -= 1
    chosen = np.cumsum(step[: len(data)], dtype=np.int8).astype(bool)
    out = data.copy()
    out[ends[more]] = 0x20
    lengths = np.bincount(owner, ends - starts + more, minlength=len(first) - 1).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(first) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out[chosen].tobytes()))


def _found(batch: pa.RecordBatch, text: str) -> tuple[pa.Array, pa.Array]:
    data, offsets = flat_bytes(batch.column(text))
    words, starts, ends, first = exact_words(data, offsets, WHITE_SPACE)
    owner = text_of(first)
    kept = np.ones(len(words), bool)
    runs: list[tuple[int, int, int, int]] = []
    for low, high in stretches(words, owner):
        of = int(owner[low])
        shift = low - int(first[of])
        _, ids = np.unique(words[low:high], return_inverse=True)
        for start, length, period in runs_of(ids.tolist()):
            kept[low + start + period : low + start + length] = False
            runs.append((of, start + shift, period, length))
    table = np.array(sorted(runs), np.int64).reshape(-1, 4)
    counts = np.bincount(table[:, 0], minlength=len(batch))
    places = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    values = pa.StructArray.from_arrays([pa.array(table[:, k]) for k in (1, 3, 2)], RUN.names)
    return pa.ListArray.from_arrays(places, values), _collapsed(data, starts, ends, first, kept)


def with_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``docs`` without ``text`` but with ``runs`` (start, length, period; by start, then period) and
    ``collapsed``: the words that no run has after its first period, joined by one space."""
    others = [c for c in docs.columns if c not in (text, runs, collapsed)]
    docs = docs.select(*others, F.col(text).cast("string").alias(text))
    schema = StructType([*(docs.schema[c] for c in others), StructField(runs, ArrayType(RUN)), StructField(collapsed, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_chunks(whole, text):
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *_found(batch, text)], [*others, runs, collapsed])

    return docs.mapInArrow(run, schema)
