"""Approximate nearest neighbours by cosine: an NN-descent graph and greedy graph search.

Equal vectors are one node. A node's first neighbours are the best in small blocks of vectors with like
signs under random projections. Then rounds of NN-descent: every node introduces its neighbours,
and those it is a neighbour of, to each other; pairs of which one is new are compared, and each node
keeps its ``DEGREE`` best. A round is a join of edges with vectors, a local comparison per node, and
a join of what improves. Rounds go on until fewer than ``SETTLED`` of the edges change; a caller's limit
on them that ends them sooner is warned of. Along edges travel vectors of 8-bit integers: they only choose what is
compared exactly in the end. Sign bits grow with the number of vectors, so that blocks stay as fine.

A search keeps the best ``BEAM`` nodes found for each query, starting from a bounded, broadcast sample
of entry nodes and from the query's own node if it is in the index. Each step expands the best
nodes not yet expanded, over edges in both directions, until no query has any left. Scores of what was found are
computed again from the original vectors in double precision.

A hub is the neighbour of very many nodes: of its incoming edges each round uses its ``INCOMING`` best,
the others still work from their own end. Blocks are split by hash to about ``BLOCK`` rows; the codes of
those that need it are a stored table, joined to rows without their vectors.

Defined cases: vectors that are null, zero, hold null or non-finite components or don't have the commonest
length take no part, nor do null ids. Rows that repeat an id are candidates for each of its vectors
and rank by the best; as queries they are searched with the vector of the first such row. Other
columns are ignored. Empty tables give empty results; with fewer candidates than asked for, all are found.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from waybill.llm.tables import forget, keep, release

DEGREE = 45
INCOMING = 45
BLOCK = 256
TABLES = 4
SETTLED = 0.01
ENTRIES = 1024
BEAM = 192
WIDTH = 16


def _stack(column: pa.Array) -> np.ndarray:
    """Equally long float32 vectors of a binary column as rows."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float32).reshape(len(rows), -1)


def _short(column: pa.Array) -> np.ndarray:
    """Unit float32 vectors from a binary column of 8-bit ones, as rows."""
    rows = column.to_pylist()
    x = np.frombuffer(b"".join(rows), np.int8).reshape(len(rows), -1).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _prepared(vectors: DataFrame, vector: str) -> DataFrame:
    """(id, raw, unit, short): original doubles, unit float32 and 8-bit integers, for vectors that take part."""
    values = F.transform(F.col(vector), lambda v: v.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), values.alias("v")).filter("id is not null and size(v) > 0")
    sound = F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists("v", lambda v: v != 0)
    rows = rows.filter(F.coalesce(sound, F.lit(False)))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("v") == (common["n"] if common else -1))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            raw = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            scaled = raw / np.abs(raw).max(1, keepdims=True)
            unit = (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)
            short = np.rint(127 * scaled).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([r.tobytes() for r in x], pa.binary()) for x in (raw, unit, short))], ["id", "raw", "unit", "short"])

    return rows.mapInArrow(encode, "id long, raw binary, unit binary, short binary")


def _best(a: np.ndarray, b: np.ndarray, sim: np.ndarray, count: int) -> np.ndarray:
    """Indices of the ``count`` best rows of each ``a``, without repeated (a, b)."""
    order = np.lexsort((b, -sim, a))
    first = np.ones(len(order), bool)
    first[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    order = order[first]
    begins = np.flatnonzero(np.concatenate([[True], a[order][1:] != a[order][:-1]])) if len(order) else np.zeros(0, int)
    place = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    return order[place < count]


def _top(edges: DataFrame, count: int = DEGREE) -> DataFrame:
    """The ``count`` best neighbours of every node; an edge that was there before isn't fresh."""
    one = edges.repartition("node").groupBy("node", "other").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "other"))
    return one.withColumn("rank", rank).filter(F.col("rank") <= count).drop("rank")


def _bits(total: int) -> int:
    """Sign bits of a code: about half a block of vectors share one, however many there are."""
    return max(1, int(np.log2(max(total, 2) / (BLOCK / 2))))


def _first_edges(nodes: DataFrame, total: int, size: int) -> DataFrame:
    bits = _bits(total)
    planes = np.random.default_rng(5).standard_normal((TABLES, size, bits)).astype(np.float32)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            signs = np.einsum("nd,tdb->tnb", _stack(batch.column("unit")), planes) > 0
            codes = signs @ (1 << np.arange(bits, dtype=np.int64))
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(batch), t, np.int32)), pa.array(codes[t]), batch.column("node")], ["t", "code", "node"])

    def compare(key, table):
        ids, x = table.column("node").to_numpy(), _short(table.column("short"))
        near = x @ x.T
        np.fill_diagonal(near, -2)
        count = min(DEGREE, len(ids) - 1)
        best = np.argpartition(-near, count - 1, axis=1)[:, :count] if count > 0 else np.zeros((len(ids), 0), int)
        return pa.table({"node": np.repeat(ids, count), "other": ids[best].reshape(-1).astype(np.int64),
                         "sim": np.take_along_axis(near, best, 1).reshape(-1).astype(np.float32)})

    coded = keep(nodes.select("unit", "node").mapInArrow(code, "t int, code long, node long"), "codes")
    parts = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int")
    large = keep(coded.groupBy("t", "code").agg(parts.alias("parts")).filter("parts > 1"), "large")
    part = F.pmod(F.xxhash64("node", "t"), F.coalesce("parts", F.lit(1))).cast("int")
    placed = coded.join(large, ["t", "code"], "left").select("t", "code", "node", part.alias("part"))
    split = placed.join(nodes.select("node", "short"), "node")
    found = split.groupBy("t", "code", "part").applyInArrow(compare, "node long, other long, sim float")
    graph = keep(_top(found.withColumn("fresh", F.lit(True))), "graph")
    forget(coded, large)
    return graph


def _both_ways(graph: DataFrame) -> DataFrame:
    """Edges with the best incoming ones turned round: (node, other, fresh)."""
    rank = F.row_number().over(Window.partitionBy("other").orderBy(F.desc("sim"), "node"))
    incoming = graph.withColumn("rank", rank).filter(F.col("rank") <= INCOMING)
    turned = incoming.select(F.col("other").alias("node"), F.col("node").alias("other"), "fresh")
    return graph.select("node", "other", "fresh").union(turned).groupBy("node", "other").agg(F.max("fresh").alias("fresh"))


def _introduced(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidate edges: neighbours of a node that are closer than what one of them has."""
    worst = graph.groupBy("node").agg(
        F.when(F.count(F.lit(1)) >= DEGREE, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
    known = nodes.join(worst, "node", "left").select(
        F.col("node").alias("other"), "short", F.coalesce("worst", F.lit(-2.0)).cast("float").alias("worst"))
    met = _both_ways(graph).join(known, "other").repartition("node").sortWithinPartitions("node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def candidates(table: pa.Table) -> pa.RecordBatch:
            center, other = table.column("node").to_numpy(), table.column("other").to_numpy()
            fresh, worst_of = table.column("fresh").to_numpy(zero_copy_only=False), table.column("worst").to_numpy()
            x = _short(table.column("short"))
            cuts = np.flatnonzero(np.concatenate([[True], center[1:] != center[:-1], [True]])) if len(center) else [0]
            parts = []
            for low, high in zip(cuts[:-1], cuts[1:]):
                near = x[low:high] @ x[low:high].T
                good = (near > worst_of[low:high, None]) & (fresh[low:high, None] | fresh[None, low:high])
                np.fill_diagonal(good, False)
                i, j = np.nonzero(good)
                parts.append((other[low + i], other[low + j], near[i, j]))
            a, b, sim = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in range(3))
            best = _best(a, b, sim, DEGREE)
            return pa.RecordBatch.from_arrays(
                [pa.array(a[best], pa.int64()), pa.array(b[best], pa.int64()), pa.array(sim[best], pa.float32())], ["node", "other", "sim"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            last = batch.column("node")[len(batch) - 1].as_py()
            ids = batch.column("node").to_numpy()
            cut = int(np.searchsorted(ids, last))  # the last node may go on in the next batch
            if cut:
                yield candidates(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            elif held and held[0].column("node")[0].as_py() != last:
                yield candidates(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield candidates(pa.Table.from_batches(held))

    return met.select("node", "other", "fresh", "worst", "short").mapInArrow(compare, "node long, other long, sim float")


class Index:
    """A stored neighbour graph over a stored table of vectors."""

    def __init__(self, nodes: DataFrame, members: DataFrame, edges: DataFrame, total: int, changed: list[float]):
        self.nodes, self.members, self.edges, self.total = nodes, members, edges, total
        self.changed = changed  # share of the edges that each round changed


def build(vectors: DataFrame, vector: str = "embedding", rounds: int | None = None, settled: float = SETTLED) -> Index:
    """Graph of all vectors (vec_id, ``vector``) that take part; ``rounds`` may limit the rounds."""
    spark = vectors.sparkSession
    rows = keep(_prepared(vectors, vector), "vectors")
    values = rows.groupBy("raw").agg(F.first("unit").alias("unit"), F.first("short").alias("short"))
    nodes = keep(values.withColumn("node", F.monotonically_increasing_id()), "nodes")
    members = keep(rows.select("id", "raw").join(nodes.select("node", "raw"), "raw").select("node", "id").distinct(), "members")
    forget(rows)
    total = nodes.count()
    size = len(nodes.first()["unit"]) // 4 if total else 0
    graph = _first_edges(nodes, total, size)
    changed: list[float] = []
    while total > 1 and (not changed or changed[-1] >= settled):  # ends: a node's edges only ever get better
        if len(changed) == rounds:
            warnings.warn(f"neighbour graph not settled: {rounds} rounds done, the last changed {changed[-1:]} of the edges", RuntimeWarning)
            break
        release(spark)
        found = _introduced(graph, nodes).withColumn("fresh", F.lit(True))
        after = keep(_top(found.unionByName(graph.withColumn("fresh", F.lit(False)))), "graph")
        forget(graph)
        graph = after
        changed.append(graph.filter("fresh").count() / (DEGREE * total))
    edges = keep(_both_ways(graph).select("node", "other"), "edges")
    forget(graph)
    release(spark)
    return Index(nodes, members, edges, total, changed)


def _starts(queries: DataFrame, entries: list) -> DataFrame:
    ids = np.array([r["node"] for r in entries], np.int64)
    points = np.array([np.frombuffer(bytes(r["unit"]), np.float32) for r in entries], np.float32)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch) or not len(ids):
                continue
            near = _stack(batch.column("unit")) @ points.T
            count = min(BEAM, len(ids))
            best = np.argpartition(-near, count - 1, axis=1)[:, :count]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("q").to_numpy(), count)), pa.array(ids[best].reshape(-1)),
                 pa.array(np.take_along_axis(near, best, 1).reshape(-1))], ["q", "node", "sim"])

    own = queries.filter("own is not null").select("q", F.col("own").alias("node"), F.lit(1.0).cast("float").alias("sim"))
    return queries.select("q", "unit").mapInArrow(nearest, "q long, node long, sim float").union(own).withColumn("done", F.lit(False))


def _cosines(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                sim = np.einsum("nd,nd->n", _stack(batch.column("x")), _short(batch.column("y")))
                yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("node"), pa.array(sim)], ["q", "node", "sim"])

    return pairs.select("q", "node", "x", "y").mapInArrow(run, "q long, node long, sim float")


def _beam(found: DataFrame) -> DataFrame:
    one = found.repartition("q").groupBy("q", "node").agg(F.max("sim").alias("sim"), F.max("done").alias("done"))
    kept = one.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("sim"), "node"))).filter(
        F.col("rank") <= BEAM)
    turn = F.row_number().over(Window.partitionBy("q", "done").orderBy("rank"))
    return kept.withColumn("now", ~F.col("done") & (turn <= WIDTH)).drop("rank")


def search(index: Index, queries: DataFrame) -> DataFrame:
    """(q, node, sim) of the best nodes found for queries (q, unit, own); ``own`` may be null."""
    share, steps = min(1.0, ENTRIES / max(1, index.total)), 1 << 24
    chosen = index.nodes.filter(F.pmod(F.xxhash64("node", F.lit("entry")), F.lit(steps)) < int(share * steps) + (share == 1.0))
    beam = keep(_beam(_starts(queries, chosen.select("node", "unit").collect())), "beam")
    vectors, asked = index.nodes.select("node", F.col("short").alias("y")), queries.select("q", F.col("unit").alias("x"))
    while not beam.filter("now").isEmpty():
        met = beam.filter("now").select("q", "node").join(index.edges, "node").select("q", F.col("other").alias("node")).distinct()
        unseen = met.join(beam.select("q", "node"), ["q", "node"], "left_anti")
        found = _cosines(unseen.join(vectors, "node").join(asked, "q")).withColumn("done", F.lit(False))
        before = beam.select("q", "node", "sim", (F.col("done") | F.col("now")).alias("done"))
        after = keep(_beam(found.unionByName(before)), "beam")
        forget(beam)
        release(beam.sparkSession)
        beam = after
    return beam.select("q", "node", "sim")


def nearest(vectors: DataFrame, is_query, count: int = 5, vector: str = "embedding", index: Index | None = None) -> DataFrame:
    """For each row of ``vectors`` that ``is_query`` (a column over ``vec_id``) holds for, its ``count``
    nearest other rows found: query_id, rank, vec_id, score (cosine in double precision)."""
    index = index or build(vectors, vector)
    own = index.members.filter(is_query(F.col("id"))).groupBy("id").agg(F.min("node").alias("node"))
    asked = keep(own.join(index.nodes, "node").select(F.col("id").alias("q"), "unit", "raw", F.col("node").alias("own")), "asked")
    found = search(index, asked.select("q", "unit", "own"))
    smallest = F.row_number().over(Window.partitionBy("node").orderBy("id"))
    # of equal vectors only the smallest ids can be among the nearest; one more, as the query's own isn't asked for
    members = index.members.withColumn("place", smallest).filter(F.col("place") <= count + 1).select("node", "id")
    pairs = found.join(index.nodes.select("node", F.col("raw").alias("y")), "node").join(
        asked.select("q", F.col("raw").alias("x")), "q")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.float64).reshape(len(batch), -1) for c in ("x", "y"))
            # by powers of two, which rounds nothing: squares of very large or small components stay finite
            x, y = (np.ldexp(v, -np.frexp(np.abs(v).max(1, keepdims=True))[1]) for v in (x, y))
            score = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("node"), pa.array(score)], ["q", "node", "score"])

    scored = pairs.select("q", "node", "x", "y").mapInArrow(exact, "q long, node long, score double")
    each = scored.join(members, "node").filter("id != q").groupBy("q", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= count).select(
        F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
