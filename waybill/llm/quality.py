"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is a bag of hashed byte trigrams and of a few marks of its shape (``_shape``: how varied its words are, how
much of it is letters, capitals, repeated lines), with logarithmic counts, inverse document
frequencies in all documents and unit length. A truncated singular value decomposition of a bounded sample of
labelled documents gives the latent space. The sample's latent vectors and labels, at most
``bound`` rows of ``RANK`` numbers, are broadcast. Every document's cosines with all of them are
computed exactly, block by block; the ``VOTERS`` nearest vote with weights that rise with
similarity.

A label's vote counts by how rare it is in the sample, so that the commoner label doesn't win by its
number; the score is the share of the weighted votes for label 1.

Defined cases: null and empty texts have a zero vector and no voters; they get 0.5. When the sample
lacks one label every score is the other's value; with no sample at all it is 1.0, so that
nothing is rejected unlearned. Ties among neighbours go to the earlier one. Rows are scored one by one; other
columns pass through ``scored`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from waybill.llm.labelled import training_sample
from waybill.llm.tables import remembered, small_batches, summed
from waybill.llm.words import flat_bytes, row_chunks

BUCKETS = 4096
SHAPES = 64
RANK = 64
VOTERS = 25
SHARPNESS = 4
STEP = 32  # counts are kept as log(1 + n) in steps of 1 / STEP, in a byte
_U = np.uint64


def _shape(text: bytes, marks: np.ndarray) -> None:
    """Sets marks for the eighth in which each measure of the text's shape lies."""
    words, lines = text.split(), text.split(b"\n")
    letters = sum(map(text.count, (b"e", b"a", b"n", b"t", b"i", b"o")))
    measures = (
        len(set(words)) / len(words),
        sum(a == b for a, b in zip(words, words[1:])) / len(words),
        len(set(lines)) / len(lines),
        letters / len(text) * 2,
        sum(w[:1].isupper() for w in words) / len(words),
        sum(w[-1:] in b"!$%&*#|" for w in words) / len(words),
        min(len(text) / len(words) / 16, 1),
        min(np.log1p(len(words)) / 10, 1),
    )
    for i, value in enumerate(measures):
        marks[8 * i + min(7, int(8 * value))] = 3 * STEP


def bags(column: pa.Array) -> np.ndarray:
    """One row of ``BUCKETS + SHAPES`` bytes a text."""
    data, offsets = flat_bytes(column)
    out = np.zeros((len(column), BUCKETS + SHAPES), np.uint8)
    for row, low, high in zip(out, offsets[:-1], offsets[1:]):
        text = data[low:high]
        counts = np.zeros(BUCKETS)
        for at in range(0, len(text) - 2, 1 << 20):
            piece = text[at : at + (1 << 20) + 2].astype(np.uint32)
            grams = (piece[:-2] | piece[1:-1] << np.uint32(8) | piece[2:] << np.uint32(16)) * np.uint32(2654435761)
            counts += np.bincount(grams >> np.uint32(20), minlength=BUCKETS)
        row[:BUCKETS] = np.minimum(255, np.log1p(counts) * STEP)
        whole = text.tobytes()
        if whole.strip():
            _shape(whole, row[BUCKETS:])
    return out


@dataclass
class Space:
    weights: np.ndarray  # inverse document frequencies
    basis: np.ndarray  # terms by RANK
    vectors: np.ndarray  # unit latent vectors of the labelled sample
    labels: np.ndarray

    def project(self, bag: np.ndarray) -> np.ndarray:
        return _unit((_unit(bag.astype(np.float32) * self.weights)) @ self.basis)

    def score(self, bag: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.ones(len(bag))
        rate = float(self.labels.mean())
        if rate in (0.0, 1.0):
            return np.full(len(bag), rate)
        out = np.full(len(bag), 0.5)
        voters = min(VOTERS, len(self.labels))
        for low in range(0, len(bag), 256):
            latent = self.project(bag[low : low + 256])
            near = latent @ self.vectors.T
            best = np.argpartition(-near, voters - 1, axis=1)[:, :voters]
            weight = np.maximum(np.take_along_axis(near, best, 1), 0) ** SHARPNESS
            voted = self.labels[best]
            one = (weight * voted).sum(1) / rate
            zero = (weight * (1 - voted)).sum(1) / (1 - rate)
            known = (np.abs(latent).sum(1) > 0) & (one + zero > 0)
            out[low : low + 256] = np.divide(one, one + zero, out=np.full(len(best), 0.5), where=known)
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def frequencies(docs: DataFrame, text: str = "text") -> np.ndarray | None:
    """In how many of all documents each bucket and shape occurs; the number of documents comes last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("quality")
        total = np.zeros(BUCKETS + SHAPES + 1, np.int64)
        for whole in batches:
            for batch in row_chunks(whole, "text"):
                total[:-1] += (bags(batch.column("text")) > 0).sum(0)
                total[-1] += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    return summed(docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "part binary"), np.int64)


def fit(bag: np.ndarray, labels: np.ndarray, seen: np.ndarray, rank: int = RANK, passes: int = 4) -> Space:
    """The latent space of a labelled sample, by subspace iteration; ``seen`` as ``frequencies`` gives it."""
    if not len(bag):
        return Space(np.zeros(0, np.float32), np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32), labels)
    weights = np.log((1 + seen[-1]) / (1 + seen[:-1])).astype(np.float32) + np.float32(0.1)
    x = _unit(bag.astype(np.float32) * weights)
    q = np.random.default_rng(0).standard_normal((x.shape[1], min(rank + 16, *x.shape))).astype(np.float32)
    for _ in range(passes):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, rotation = np.linalg.svd(x @ q, full_matrices=False)
    basis = np.ascontiguousarray((q @ rotation.T)[:, :rank], dtype=np.float32)
    return Space(weights, basis, _unit(x @ basis), labels)


def learn(sample: DataFrame, seen: np.ndarray) -> Space:
    """The space of a bounded training sample (text, y); its bags are collected, 4 KB a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_chunks(whole, "text"):
                rows = [r.tobytes() for r in bags(batch.column("text"))]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column("y")], ["bag", "y"])

    rows = sorted((bytes(r["bag"]), r["y"]) for r in sample.mapInArrow(run, "bag binary, y int").collect())
    bag = np.frombuffer(b"".join(r[0] for r in rows), np.uint8).reshape(len(rows), BUCKETS + SHAPES)
    return fit(bag, np.array([r[1] for r in rows], np.float32), seen)


def scored(docs: DataFrame, space: Space, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with column ``name``: 0 to 1, higher for likelier label 1. A column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(space)
    docs = docs.drop(name)
    schema = StructType(docs.schema.fields + [StructField(name, DoubleType())])
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("quality")
        for whole in batches:
            for batch in row_chunks(whole, text):
                scores = shared.value.score(bags(batch.column(place).cast(pa.string())))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores.astype(np.float64))], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def quality_model(docs: DataFrame, labels: DataFrame, learn_from: Column, bound: int = 4_000) -> Space:
    """Learned from about ``bound`` labelled documents at most, whose vectors are the neighbours; terms are
    weighted by their frequencies in all documents."""
    sample = training_sample(docs, labels, "quality", learn_from, bound)
    seen = frequencies(docs)
    with small_batches(docs.sparkSession):
        return learn(sample, np.zeros(BUCKETS + SHAPES + 1, np.int64) if seen is None else seen)
