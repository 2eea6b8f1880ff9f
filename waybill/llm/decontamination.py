"""Benchmark decontamination by winnowing.

Texts become word sequences. Of each run of consecutive ``GRAM``-word hashes the smallest is kept as
a fingerprint. With a run of ``span - GRAM + 1`` hashes, two texts that share ``span`` words share
that run and so a fingerprint at the same place in it: no shared span of that length is missed.
Fingerprints of the documents are joined with those of the benchmark, and every hit is extended
word by word along its alignment.

An item shorter than ``span`` is one window, looked up by one hash of all its words.

Before the join, documents' fingerprints pass a Bloom filter of the benchmark's fingerprints. The
filter has a fixed size, so the benchmark may have any size; both sides of the join are shuffled.
Only documents in which a fingerprint passes carry their word hashes on.

Defined cases: null, empty and separator-only texts have no words and no hits. Rows of the
documents are answered one by one, so repeated ids give repeated rows, and a null id stays null.
Items without words or with a null id are not part of the benchmark; items of one id that occur in
several rows count once. Further columns of either table are ignored. An empty benchmark leaves
every document clean. Equality of words is equality of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from waybill.llm.tables import keep, may_contain, membership
from waybill.llm.words import (NOT_ALPHANUMERIC, flat_bytes, gram_hashes, lists, mix, row_chunks, text_of,
                               word_hashes)

GRAM = 5
_MARKED = "uid long, doc_id long, n_words long, words array<long>, grams array<long>, places array<int>"
_SPANS = "uid long, item string, start long, stop long"


def winnow(grams: np.ndarray, run: int) -> np.ndarray:
    """Marks the last smallest of every ``run`` consecutive hashes."""
    kept, n = np.zeros(len(grams), bool), len(grams) - run + 1
    if n <= 0:
        return kept
    least, at = grams[:n].copy(), np.arange(n)
    for i in range(1, run):
        smaller = grams[i : n + i] <= least
        least[smaller] = grams[i : n + i][smaller]
        at[smaller] = np.flatnonzero(smaller) + i
    kept[at] = True
    return kept


def _fingerprints(words: np.ndarray, first: np.ndarray, span: int, short: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint values and the words where they begin, in all texts of a buffer. Hashes across
    two texts are computed too: they can't take a place from a run that lies within one text."""
    owner = text_of(first)
    values, places = [], []
    for k, run in [(GRAM, span - GRAM + 1), *((m, 1) for m in short)]:
        grams = gram_hashes(words, k)
        at = np.flatnonzero(winnow(grams, run)) if run > 1 else np.arange(len(grams))
        at = at[owner[at] == owner[at + k - 1]]
        values.append(grams[at] if run > 1 else mix(grams[at] + np.uint64(k)))
        places.append(at)
    return np.concatenate(values), np.concatenate(places)


def _benchmark(items: DataFrame, span: int) -> DataFrame:
    """Per row of the benchmark: item, its word hashes, fingerprints and their places."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_chunks(whole, "text"):
                words, first = word_hashes(*flat_bytes(batch.column("text")), NOT_ALPHANUMERIC)
                grams, places = [], []
                for low, high in zip(first[:-1], first[1:]):
                    own, whole_item = words[low:high], high - low < span
                    values, at = _fingerprints(own, np.array([0, len(own)]), span, [len(own)] if whole_item and len(own) else [])
                    chosen = slice(-1, None) if whole_item else slice(None)  # short: the hash of all words
                    grams.append(values[chosen].astype(np.int64) if len(own) else [])
                    places.append(at[chosen] if len(own) else [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item"), lists(words.view(np.int64), np.diff(first), pa.int64()),
                     pa.array(grams, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
                    ["item", "words", "grams", "places"])

    rows = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    encoded = rows.dropna().mapInArrow(encode, "item string, words array<long>, grams array<long>, places array<int>")
    return encoded.filter(F.size("words") > 0).withColumn("iid", F.monotonically_increasing_id())


def _mark(docs: DataFrame, bitmap, span: int, short: list[int]) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bitmap.value
        for whole in batches:
            for batch in row_chunks(whole, "text"):
                words, first = word_hashes(*flat_bytes(batch.column("text")), NOT_ALPHANUMERIC)
                values, at = _fingerprints(words, first, span, short)
                passing = np.flatnonzero(may_contain(known, values))
                passing = passing[np.argsort(at[passing], kind="stable")]
                values, at = values[passing], at[passing]
                owner = text_of(first)[at]
                found = np.bincount(owner, minlength=len(batch))
                counts = np.diff(first)
                carried = np.repeat(found > 0, counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("uid"), batch.column("doc_id"), pa.array(counts.astype(np.int64)),
                     lists(words[carried].view(np.int64), np.where(found > 0, counts, 0), pa.int64()),
                     lists(values.view(np.int64), found, pa.int64()),
                     lists((at - first[owner]).astype(np.int32), found, pa.int32())],
                    ["uid", "doc_id", "n_words", "words", "grams", "places"])

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(encode, _MARKED)


def _extend(aligned: DataFrame, span: int) -> DataFrame:
    """Of each alignment, the runs of equal words that are long enough, as document word ranges."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"uid": [], "item": [], "start": [], "stop": []}
            for row in batch.to_pylist():
                equal = np.array(row["d_part"]) == np.array(row["i_part"])
                edges = np.flatnonzero(np.diff(np.concatenate([[0], equal.astype(np.int8), [0]])))
                for start, stop in zip(edges[::2], edges[1::2]):
                    if stop - start >= min(span, row["i_len"]):
                        for name, value in zip(out, (row["uid"], row["item"], row["d_from"] + start, row["d_from"] + stop)):
                            out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("uid", pa.int64()), ("item", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    return aligned.mapInArrow(runs, _SPANS)


def shared_spans(docs: DataFrame, items: DataFrame, span: int = 10) -> tuple[DataFrame, DataFrame]:
    """(documents with uid, doc_id, n_words; word ranges uid, item, start, stop that they share with
    an item, at least ``span`` words long or a whole shorter item). Both are stored tables."""
    spark = docs.sparkSession
    bench = keep(_benchmark(items, span), "benchmark")
    short = [r[0] for r in bench.filter(F.size("words") < span).select(F.size("words")).distinct().collect()]
    fingerprints = bench.select("iid", F.explode(F.arrays_zip("grams", "places")).alias("f")).select(
        "iid", F.col("f.grams").alias("gram"), F.col("f.places").alias("i_at"))
    bitmap = spark.sparkContext.broadcast(membership(fingerprints.select("gram")))
    marked = keep(_mark(docs, bitmap, span, sorted(short)), "marked")

    hits = marked.select("uid", F.explode(F.arrays_zip("grams", "places")).alias("f")).select(
        "uid", F.col("f.grams").alias("gram"), F.col("f.places").alias("d_at"))
    aligned = hits.join(fingerprints, "gram").select("uid", "iid", (F.col("d_at") - F.col("i_at")).alias("shift")).distinct()
    start = F.greatest(F.col("shift"), F.lit(0))
    pairs = (
        aligned.join(bench.select("iid", "item", F.col("words").alias("i_words")), "iid")
        .join(marked.filter(F.size("grams") > 0).select("uid", "words"), "uid")
        .select("uid", "item", F.size("i_words").alias("i_len"), start.cast("long").alias("d_from"),
                F.least(F.size("i_words") + F.least(F.col("shift"), F.lit(0)), F.size("words") - start).alias("n"),
                "words", "i_words", "shift")
        .filter("n > 0")
        .select("uid", "item", "i_len", "d_from", F.slice("words", F.col("d_from").cast("int") + 1, F.col("n")).alias("d_part"),
                F.slice("i_words", F.greatest(-F.col("shift"), F.lit(0)) + 1, F.col("n")).alias("i_part"))
    )
    return marked.select("uid", "doc_id", "n_words"), keep(_extend(pairs, span), "spans")


def contamination(docs: DataFrame, items: DataFrame, span: int = 10) -> DataFrame:
    """Per document row: uid, doc_id, n_words, n_hit, n_items, items (sorted ids), contaminated."""
    marked, spans = shared_spans(docs, items, span)
    before = Window.partitionBy("uid").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        spans.select("uid", "start", "stop").distinct()
        .withColumn("reached", F.coalesce(F.max("stop").over(before), F.lit(0)))
        .groupBy("uid").agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "reached"))).alias("n_hit"))
    )
    named = spans.select("uid", "item").distinct().groupBy("uid").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return (
        marked.join(covered.join(named, "uid"), "uid", "left")
        .select("uid", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items"))
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, span: int = 10) -> DataFrame:
    """The rows of ``docs`` whose text shares no span with the benchmark; all columns stay.

    Decisions go by the text, so rows with null or repeated ids are judged as well.
    """
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    hit = contamination(texts, items, span).filter("contaminated").select(F.col("doc_id").alias("__hit")).distinct()
    return docs.join(hit, F.xxhash64(docs["text"]) == F.col("__hit"), "left_anti")
