"""Ranked lexical search: the best documents for every query text, by the Best Position Algorithm.

The documents are turned once into stored rows of term hashes and counts, of those terms only that pass a
fixed-size filter of all query terms. Counts over all documents give the terms' weights. A task then
reads its part of the rows in segments of bounded size. A segment keeps, per term, an impact list (its
documents, highest impact first) and, per document, its terms with their places in those lists.

For a query the lists of its terms are read in parallel from the top. Every new document is scored
at once by direct access to all its terms, which also marks its places in the lists. The best position of a
list is the last of the unbroken marked places from its top: at or beyond the place read. No document that
is still unseen can score more than the sum of impacts at the best positions; the search ends when that is
strictly below the k-th score, as an equal score with a smaller id would still count. The k best so far
carry over to a task's next segments. A task returns at most k rows a query; they are ranked in two steps, so
that the rows that meet in one task don't grow with the number of tasks.

Queries are answered in blocks of bounded size: one block is broadcast at a time, whatever their number.

A document scores the sum, over the query's terms with repeats, of
``weight * ((10**9 * tf) div (1000 * tf + 12 * m))`` in 64-bit integers, with
``m = 75 + ((25 * n * N) div L)`` and ``weight = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``.

Defined cases: null, empty and separator-only texts have no terms: such documents count nowhere, such
queries get no rows. Documents with a null id count in the statistics and are not ranked; rows that repeat an id
are documents of their own. Queries with a null id are left out; equal query rows count once, different rows
of one id are one query with the terms of all. Other columns are ignored. Equality of terms is equality of
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from waybill.llm.tables import forget, keep, may_contain, membership
from waybill.llm.words import NOT_ALPHANUMERIC, flat_bytes, lists, row_chunks, text_of, word_hashes

BEST = 20
SEGMENT = 1_000_000  # terms of documents in memory at a time
BLOCK_QUERIES = 1024
BLOCK_TERMS = 100_000
FIRST_READ = 64
SHARDS = 256  # parts in which the tasks' rows of a query are ranked first
_VECTORS = "doc_id long, n long, terms array<long>, counts array<long>"


def _counted(texts: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every text the number of words; then, text by text, its distinct words (in ``known``) and their counts."""
    words, first = word_hashes(*flat_bytes(texts), NOT_ALPHANUMERIC)
    owner = text_of(first)
    if known is not None:
        passing = may_contain(known, words)
        words, owner = words[passing], owner[passing]
    order = np.lexsort((words, owner))
    words, owner = words[order], owner[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    return np.diff(first), words[starts].view(np.int64), np.diff(np.append(starts, len(words))), np.bincount(owner[starts], minlength=len(texts))


def _query_terms(queries: DataFrame, item: str, text: str) -> DataFrame:
    """Stored (item, term, c): how often a query has a term."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_chunks(whole, "text"):
                _, terms, counts, sizes = _counted(batch.column("text"))
                rows = pa.array(np.repeat(np.arange(len(batch)), sizes))
                yield pa.RecordBatch.from_arrays([batch.column("item").take(rows), pa.array(terms), pa.array(counts)], ["item", "term", "c"])

    rows = queries.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text")).dropna().distinct()
    kind = dict(rows.dtypes)["item"]
    found = rows.mapInArrow(encode, f"item {kind}, term long, c long")
    return keep(found.groupBy("item", "term").agg(F.sum("c").alias("c")), "query_terms")


def _vectors(docs: DataFrame, known: np.ndarray, text: str) -> DataFrame:
    """Stored rows of the documents that have a term: id, number of terms, query terms and their counts."""
    bitmap = docs.sparkSession.sparkContext.broadcast(known)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_chunks(whole, "text"):
                n, terms, counts, sizes = _counted(batch.column("text"), bitmap.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n.astype(np.int64)), lists(terms, sizes, pa.int64()),
                     lists(counts, sizes, pa.int64())], ["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return keep(rows.mapInArrow(encode, _VECTORS).filter("n > 0"), "vectors")


@dataclass
class Query:
    terms: np.ndarray  # sorted
    weights: np.ndarray


class Segment:
    """Some documents' terms: by document, and by term with the highest impact first."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        self.ids, self.impacts = ids, impacts
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.names, self.term = np.unique(terms, return_inverse=True)
        document = np.repeat(np.arange(len(ids)), sizes)
        order = np.lexsort((-impacts, self.term))
        self.listed, self.listed_impacts = document[order], impacts[order]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.starts = np.searchsorted(self.term[order], np.arange(len(self.names) + 1))
        self.weight = np.zeros(len(self.names), np.int64)
        self.marked = np.zeros(len(order), bool)
        self.seen = np.zeros(len(ids), bool)

    def search(self, query: Query, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """``best`` (scores, ids; best first) with what this segment adds."""
        at = np.searchsorted(self.names, query.terms)
        inside = at < len(self.names)
        inside[inside] = self.names[at[inside]] == query.terms[inside]
        at, weights = at[inside], query.weights[inside]
        lows, highs = self.starts[at], self.starts[at + 1]
        self.weight[at] = weights
        read, size = lows.copy(), FIRST_READ  # all before are seen
        touched = []
        limit = self.listed_impacts[lows] @ weights
        while len(at) and not (len(best[0]) == k and limit < best[0][-1]) and (read < highs).any():
            stops = np.minimum(read + size, highs)
            documents = np.unique(np.concatenate([self.listed[a:b] for a, b in zip(read, stops)]))
            documents = documents[~self.seen[documents]]
            if len(documents):
                self.seen[documents] = True
                touched.append(documents)
                best = self._scored(documents, best, k)
            for i, stop in enumerate(stops):  # marked ones go on behind what was read
                rest = self.marked[stop : highs[i]]
                gap = int(np.argmin(rest)) if len(rest) else 0
                read[i] = stop + (gap if len(rest) and not rest[gap] else len(rest))
            # at a list's end no unseen document is in it
            limit = np.where(read < highs, self.listed_impacts[np.maximum(read - 1, 0)], 0) @ weights
            size *= 2
        self.weight[at] = 0
        for a, b in zip(lows, highs):
            self.marked[a:b] = False
        for documents in touched:
            self.seen[documents] = False
        return best

    def _scored(self, documents: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Direct access: scores of documents, their places marked; the best ``k`` with those known."""
        sizes = self.bounds[documents + 1] - self.bounds[documents]
        begins = np.cumsum(sizes) - sizes
        of = np.arange(sizes.sum()) + np.repeat(self.bounds[documents] - begins, sizes)
        weights = self.weight[self.term[of]]
        self.marked[self.place[of[weights > 0]]] = True
        scores = np.add.reduceat(weights * self.impacts[of], begins)
        good = scores > (best[0][-1] - 1 if len(best[0]) == k else 0)
        scores, ids = np.concatenate([best[0], scores[good]]), np.concatenate([best[1], self.ids[documents[good]]])
        order = np.lexsort((ids, -scores))[:k]
        return scores[order], ids[order]


def _segments(batches: Iterator[pa.RecordBatch], known: np.ndarray, documents: int, words: int, size: int) -> Iterator[Segment]:
    """Segments of about ``size`` terms of the sorted ``known`` ones, or one document's."""
    parts: list[tuple[np.ndarray, ...]] = []

    def joined() -> Segment:
        whole = Segment(*(np.concatenate(p) for p in zip(*parts)))
        parts.clear()
        return whole

    held = 0
    for whole in batches:
        for low in range(0, len(whole), 256):
            batch = whole.slice(low, 256)
            terms, counts = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("terms", "counts"))
            owner = np.repeat(np.arange(len(batch)), batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
            at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
            chosen = known[at] == terms
            terms, counts, owner = terms[chosen], counts[chosen], owner[chosen]
            n = batch.column("n").to_numpy()
            m = 75 + (25 * n * documents) // words
            impacts = (1_000_000_000 * counts) // (1000 * counts + 12 * m[owner])
            sizes = np.bincount(owner, minlength=len(batch))
            used = sizes > 0
            parts.append((batch.column("doc_id").to_numpy(zero_copy_only=False)[used], sizes[used], terms, impacts))
            held += len(terms)
            if held >= size:
                yield joined()
                held = 0
    if held:
        yield joined()


def _found(vectors: DataFrame, block: list[Query], documents: int, words: int, k: int, size: int) -> DataFrame:
    """(query, shard, doc_id, score): the best of every task."""
    shared = vectors.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        known = np.unique(np.concatenate([q.terms for q in queries]))
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries]
        for segment in _segments(batches, known, documents, words, size):
            best = [segment.search(q, b, k) for q, b in zip(queries, best)]
        sizes = [len(b[0]) for b in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), sizes)), pa.array(np.full(sum(sizes), TaskContext.get().partitionId() % SHARDS)),
             pa.array(np.concatenate([b[1] for b in best])), pa.array(np.concatenate([b[0] for b in best]))],
            ["query", "shard", "doc_id", "score"])

    return vectors.filter("doc_id is not null").mapInArrow(run, "query long, shard long, doc_id long, score long")


def ranked(docs: DataFrame, queries: DataFrame, item: str = "item_id", text: str = "text", k: int = BEST,
           segment: int = SEGMENT) -> DataFrame:
    """(item, rank, doc_id, score): every query's ``k`` highest scores above 0, equal ones by doc_id."""
    spark = docs.sparkSession
    asked = _query_terms(queries, item, text)
    vectors = _vectors(docs, membership(asked.select("term").distinct()), text)
    documents, words = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    empty = spark.createDataFrame([], f"{item} {dict(asked.dtypes)['item']}, rank int, doc_id long, score long")
    if not documents:
        return empty
    frequent = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * documents + 2) / (2.0 * F.col("df") + 1))).cast("long") * F.col("c")
    weighted = keep(asked.join(frequent, "term").select("item", "term", weight.alias("weight")).filter("weight > 0"), "weighted")
    forget(asked)
    held, terms = weighted.agg(F.countDistinct("item"), F.count(F.lit(1))).first()
    blocks = max(-(-held // BLOCK_QUERIES), -(-terms // BLOCK_TERMS))
    answers = []
    for number in range(blocks):
        chosen = weighted if blocks == 1 else weighted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number)
        rows = chosen.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("t")).collect()
        if not rows:
            continue
        block = [Query(*(np.array([p[i] for p in r["t"]], np.int64) for i in (0, 1))) for r in rows]
        names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(rows)], f"query long, {item} {dict(asked.dtypes)['item']}")
        first = Window.partitionBy("query", "shard").orderBy(F.desc("score"), "doc_id")
        last = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
        best = (
            _found(vectors, block, documents, words, k, segment)
            .withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k)
            .withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
        )
        answers.append(keep(best.join(F.broadcast(names), "query").select(item, "rank", "doc_id", "score"), "ranked"))
    forget(vectors, weighted)
    for more in answers[1:]:
        answers[0] = answers[0].union(more)
    return answers[0] if answers else empty
