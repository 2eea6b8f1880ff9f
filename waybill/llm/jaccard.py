"""Size-aware heavy-light Jaccard join on word shingles, and the groups its links form.

A document's set holds the 64-bit hashes of its distinct ``SHINGLE``-word shingles. With threshold t,
two linked sets share at least ceil(t * n) elements of either, so in one global order of elements
(rare first) the first n - ceil(t * n) + k elements of both share k. Two ways find candidates:

* light: sets of at most ``boundary`` elements enumerate all ``SUBSET``-element subsets of that
  prefix (k = SUBSET); linked sets share a subset.
* heavy: pairs with a larger set meet in the inverted lists of single prefix elements (k = 1). Sets
  a little below the boundary are in both, as they may link across it.

The boundary minimises the estimated number of postings and list entries read (``_boundary``).
Element frequencies come from a fixed-size count sketch over all documents. They only order the
elements: any order gives the same links.

Links are not listed pair by pair. Equal sets are one class. Every document is first compared with
two chosen among those of like size in its lists; what links falls together. Only then are members of
*different* groups in a list compared, all of them, so no link between groups is lost. Pairs are
enumerated in lists of up to ``LONG_LIST`` members only; the documents of longer lists are compared
block by block inside tasks, blocks that share such a list with each other, and return links that connect, not pairs.
Every comparison is exact on whole sets.

Defined cases: a null, empty or separator-only text has an empty set, links with nothing and is its own
component. Fewer words than a shingle make one element of the whole sequence. Rows that repeat a
doc_id are one document for linking, and each is answered. A row with a null doc_id takes the
component of documents with the same set, else null; it doesn't link. Other columns are ignored.
An empty table gives an empty result. Equality of shingles is equality of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from waybill.llm.components import components
from waybill.llm.tables import forget, keep, may_contain, membership, release, remembered, summed
from waybill.llm.words import WHITE_SPACE, flat_bytes, gram_hashes, lists, mix, row_chunks, text_of, word_hashes

SHINGLE = 5
SUBSET = 2
PERCENT = 75
SKETCH_BITS = 20
STAR_SHARE = 4  # one list in so many serves the first comparisons
HOT_LIST = 100_000  # an element that may be in so many documents is taken for shared without counting
LONG_LIST = 64  # beyond so many members a list's documents are compared block by block
BLOCK_SETS = 1024
BLOCK_ELEMENTS = 500_000
LIGHT_LIMIT = 64  # sizes for which a boundary is considered
_U = np.uint64


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct elements of all texts of a batch, and how many each has."""
    words, first = word_hashes(*flat_bytes(batch.column("text")), WHITE_SPACE)
    sizes, owner = np.diff(first), text_of(first)
    grams = gram_hashes(words, SHINGLE)
    at = np.flatnonzero(owner[: len(grams)] == owner[len(owner) - len(grams) :])
    values, of = grams[at], owner[at]
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        whole = np.array([gram_hashes(words[first[i] : first[i + 1]], sizes[i])[0] for i in short], np.uint64)
        values, of = np.concatenate([values, whole]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        values, of = values[order], of[order]
    bounds = np.searchsorted(of, np.arange(len(batch) + 1))
    for low, high in zip(bounds[:-1], bounds[1:]):
        values[low:high].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    return values[new], np.bincount(of[new], minlength=len(batch))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _slot(values: np.ndarray) -> np.ndarray:
    return (values & _U((1 << SKETCH_BITS) - 1)).astype(np.int64)


def _digests(docs: DataFrame) -> DataFrame:
    """Per document its set's size and 128-bit digest; per partition one row with its sketch."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("jaccard")
        names = ["doc_id", "n", "high", "low", "sketch"]
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for whole in batches:
            for batch in row_chunks(whole, "text"):
                values, counts = _sets(batch)
                np.add.at(sketch, _slot(values), np.uint32(1))
                bounds = np.concatenate([[0], np.cumsum(counts)])
                sums = []
                for salt in (1, 2):
                    running = np.zeros(len(values) + 1, np.uint64)
                    np.cumsum(mix(values + _U(salt)), out=running[1:])
                    sums.append((running[bounds[1:]] - running[bounds[:-1]]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums[0]), pa.array(sums[1]),
                     pa.nulls(len(batch), pa.binary())], names)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
             pa.array([sketch.tobytes()], pa.binary())], names)

    return _rows(docs).mapInArrow(encode, "doc_id long, n long, high long, low long, sketch binary")


def needed(n):
    """Elements that a linked set of size ``n`` shares at least."""
    return -(-PERCENT * n // 100)


def _prefixes(docs: DataFrame, sketch: np.ndarray, others: np.ndarray, sure: bool) -> DataFrame:
    """Per document: size, its first elements in the global order, how many of them are not hot, list entries behind them.

    The sketch counts an element at least as often as documents hold it, so one that is not hot is in at most
    ``HOT_LIST`` documents, plus the sketch's usual noise. Only documents that are surely not among ``others``, a
    membership filter, or only the rest."""
    noise = int(np.median(sketch))
    ranks = (np.log2(sketch.astype(np.float64) + 1) * 1000).astype(np.uint16)
    hot = int(np.log2(HOT_LIST + noise + 1) * 1000)
    shared = docs.sparkSession.sparkContext.broadcast((sketch, ranks, others))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("jaccard")
        counted, rank, bitmap = shared.value
        for whole in batches:
            hashes = whole.column("h").to_numpy(zero_copy_only=False)
            picked = whole.filter(pa.array(may_contain(bitmap, hashes) != sure))
            for batch in row_chunks(picked, "text"):
                values, counts = _sets(batch)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                slots = _slot(values)
                order, chosen = rank[slots], []
                for low, n in zip(bounds[:-1], counts):
                    length = min(n, n - needed(n) + SUBSET)
                    chosen.append(low + np.argsort(order[low : low + n], kind="stable")[:length])
                kept = np.concatenate(chosen) if chosen else np.zeros(0, np.int64)
                lengths = np.array([len(c) for c in chosen], np.int64)
                entries = np.maximum(counted[slots[kept]].astype(np.int64) - noise, 1)
                ends = np.concatenate([[0], np.cumsum(entries)])
                rare = np.concatenate([[0], np.cumsum(order[kept] < hot)])
                cuts = np.concatenate([[0], np.cumsum(lengths)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), lists(values[kept].view(np.int64), lengths, pa.int64()),
                     pa.array(ends[cuts[1:]] - ends[cuts[:-1]]), pa.array((rare[cuts[1:]] - rare[cuts[:-1]]).astype(np.int32))],
                    ["id", "n", "prefix", "entries", "rare"])

    named = _rows(docs).filter("doc_id is not null").withColumn("h", F.xxhash64("doc_id"))
    return named.mapInArrow(encode, "id long, n long, prefix array<long>, entries long, rare int")


def _boundary(prefixes: DataFrame) -> int:
    """The largest light size. A light set costs its subsets, a set in the lists the entries it reads."""
    sizes = prefixes.filter(F.col("n").between(1, LIGHT_LIMIT)).groupBy("n").agg(F.count("*"), F.sum("entries")).collect()
    counts = {row[0]: (row[1], row[2]) for row in sizes}

    def subsets(n: int) -> int:
        length = min(n, n - needed(n) + SUBSET)
        return length * (length - 1) // 2 * counts.get(n, (0, 0))[0]

    def cost(limit: int) -> int:
        listed = range(needed(limit + 1), LIGHT_LIMIT + 1)
        return sum(subsets(n) for n in range(1, limit + 1)) + sum(sum(counts.get(n, (0, 0))) for n in listed)

    return min(range(LIGHT_LIMIT + 1), key=cost)


def _postings(prefixes: DataFrame, boundary: int, hot: bool = False) -> DataFrame:
    """(key, id, n): subsets of light sets, single elements of sets that may link with a heavy one; those of hot
    elements only, or those with an element that is not hot."""
    mine = lambda x: F.slice(x, F.col("rare") + 1, F.size("prefix")) if hot else F.slice(x, F.lit(1), F.col("rare"))
    single = mine(F.slice("prefix", 1, (F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1).cast("int")))
    # the first of two elements is the rarer one
    pairs = F.flatten(mine(F.transform("prefix", lambda x, i: F.transform(
        F.slice("prefix", i + 2, F.size("prefix")), lambda y: F.xxhash64(x, y)))))
    nothing = F.array().cast("array<long>")
    keys = F.concat(F.when(F.col("n") >= needed(boundary + 1), single).otherwise(nothing),
                    F.when(F.col("n") <= boundary, pairs).otherwise(nothing))
    some = F.col("rare") < F.size("prefix") if hot else F.col("rare") > 0
    return prefixes.filter((F.col("n") > 0) & some).select("id", "n", F.explode(keys).alias("key"))


def _shared_postings(prefixes: DataFrame, boundary: int) -> DataFrame:
    """Postings of keys that more than one document has, moved once. Those of hot elements stay where they are,
    shared or not: the others' lists are bounded, so no task counts a very long one."""
    counted = _postings(prefixes, boundary).withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("key")))
    return counted.filter("c > 1").drop("c").unionByName(_postings(prefixes, boundary, hot=True))


def _bits(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Per set a bitmap of its elements' last bits: as many 64-bit words, a power of two, as give an element two to four places."""
    words = 1 << np.ceil(np.log2(np.maximum(2 * counts / 64, 1))).astype(np.int64)
    begins = np.cumsum(words) - words
    flags = np.zeros(64 * int(words.sum()), bool)
    flags[np.repeat(64 * begins, counts) + (values & np.repeat(64 * words - 1, counts).astype(np.uint64)).astype(np.int64)] = True
    return lists(np.packbits(flags, bitorder="little").view("<i8"), words, pa.int64())


def _candidate_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, n, bits, elements) of the documents that may be in ``ids``; a fixed-size filter spares the others."""
    bitmap = docs.sparkSession.sparkContext.broadcast(membership(ids.select(F.xxhash64("id"))))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("jaccard")
        for whole in batches:
            hashes = whole.column("h").to_numpy(zero_copy_only=False)
            picked = whole.filter(pa.array(may_contain(bitmap.value, hashes)))
            for batch in row_chunks(picked, "text"):
                values, counts = _sets(batch)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), _bits(values, counts),
                     lists(values.view(np.int64), counts, pa.int64())], ["id", "n", "bits", "elements"])

    rows = _rows(docs).filter("doc_id is not null").withColumn("h", F.xxhash64("doc_id"))
    return rows.mapInArrow(encode, "id long, n long, bits array<long>, elements array<long>")


def _only(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``sets`` that may be in ``ids``, chosen before anything is moved."""
    bitmap = sets.sparkSession.sparkContext.broadcast(membership(ids.select(F.xxhash64("id"))))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("jaccard")
        for batch in batches:
            hashes = batch.column("h").to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(may_contain(bitmap.value, hashes))).drop_columns(["h"])

    return sets.withColumn("h", F.xxhash64("id")).mapInArrow(pick, sets.schema)


def _alike(a: str, b: str) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _may_link(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose bitmaps don't rule a link out.

    A bit that only one set has stands for an element that the other lacks, so no link is lost. Bitmaps take
    a sixteenth to a thirty-second of their sets. Sizes of a pair are alike, so one bitmap is at most twice as long as the other.
    """
    first = sets.select("id", F.col("n").alias("nx"), F.col("bits").alias("x"))
    second = sets.select(F.col("id").alias("other"), F.col("n").alias("ny"), F.col("bits").alias("y"))
    size = F.least(F.size("x"), F.size("y"))

    def folded(bits: str) -> Column:
        halves = F.zip_with(F.slice(bits, F.lit(1), size), F.slice(bits, size + 1, size), lambda p, q: p.bitwiseOR(q))
        return F.when(F.size(bits) > size, halves).otherwise(F.col(bits)).alias(bits)

    def alone(mine: str, others: str) -> Column:
        return F.aggregate(F.zip_with(mine, others, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda s, c: s + c)

    common = F.least(F.col("nx") - alone("x", "y"), F.col("ny") - alone("y", "x"))
    return (
        pairs.join(first, "id").join(second, "other")
        .select("id", "other", "a", "b", "nx", "ny", folded("x"), folded("y"))
        .filter(common * 100 >= PERCENT * (F.col("nx") + F.col("ny") - common))
        .select("id", "other", "a", "b")
    )


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of pairs (id, other, a, b), the stored (a, b) whose sets link. Only sets in a pair are stored, and of
    those only the ones whose bitmaps leave a link possible are moved."""
    pairs = keep(pairs, "pairs")
    sets = keep(_candidate_sets(docs, pairs.select("id").union(pairs.select("other")).distinct()), "sets")
    likely = keep(_may_link(pairs, sets), "likely")
    chosen = _only(sets.select("id", "elements"), likely.select("id").union(likely.select("other")).distinct())
    first = chosen.select("id", F.col("elements").alias("x"))
    second = chosen.select(F.col("id").alias("other"), F.col("elements").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    links = keep(
        likely.join(first, "id").join(second, "other")
        .filter(common * 100 >= PERCENT * (F.size("x") + F.size("y") - common))
        .select("a", "b").distinct(), "links")
    forget(pairs, sets, likely)
    release(docs.sparkSession)
    return links


def _star_pairs(members: DataFrame) -> DataFrame:
    """Every document against two others, chosen by hash among those of like size in its lists.

    Members of a group of near copies choose the same few, so most of the group falls together. This
    only spares later comparisons, so a part of the lists (``STAR_SHARE``) is enough.
    """
    lists_used = members.filter(F.pmod(F.xxhash64("key", F.lit("star")), F.lit(STAR_SHARE)) == 0)
    banded = lists_used.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))))
    picks = [F.min(F.struct(F.xxhash64("id", F.lit(seed)).alias("h"), "id", "n")) for seed in (1, 2)]
    chosen = banded.groupBy("key", "band").agg(F.count(F.lit(1)).alias("c"), F.array(*picks).alias("picks")).filter("c > 1")
    chosen = chosen.select("key", "band", F.explode("picks").alias("p")).select(
        "key", "band", F.col("p.h").alias("h"), F.col("p.id").alias("other"), F.col("p.n").alias("m")).distinct()
    met = banded.select("key", "band", "id", "n").join(chosen, ["key", "band"]).filter((F.col("id") != F.col("other")) & _alike("n", "m"))
    # linked sets share more than a tenth of their elements in their lists; few shared lists are a passage
    shared = met.groupBy("id", "other", "n", "h").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") * 20 * STAR_SHARE >= F.col("n"))
    return (
        shared.groupBy("id").agg(F.max_by("other", F.struct("c", "h")).alias("p1"), F.min_by("other", "h").alias("p2"))
        .select("id", F.explode(F.array_distinct(F.array("p1", "p2"))).alias("other"))
        .select("id", "other", F.col("id").alias("a"), F.col("other").alias("b"))
    )


def _cross_pairs(short: DataFrame, boundary: int) -> DataFrame:
    """Pairs from different groups that meet in lists of at most ``LONG_LIST`` members and share enough."""
    short = short.select("key", "id", "n", "root").repartition("key")  # moved once for both sides
    one = short.select("key", "id", "n", F.col("root").alias("a"))
    two = short.select("key", F.col("id").alias("other"), F.col("n").alias("m"), F.col("root").alias("b"))
    larger = F.greatest("n", "m")
    # a pair shares at most its common list elements and what lies behind the longer prefix; one that
    # shares a long list too is compared there
    enough = (larger <= boundary) | (
        F.col("shared") + F.ceil(larger * PERCENT / 100) - 1 >= F.ceil((F.col("n") + F.col("m")) * PERCENT / (100 + PERCENT)))
    return (
        one.join(two, "key").filter((F.col("id") < F.col("other")) & (F.col("a") != F.col("b")) & _alike("n", "m"))
        .groupBy("id", "other", "a", "b", "n", "m").agg(F.count(F.lit(1)).alias("shared"))
        .filter(enough).select("id", "other", "a", "b")
    )


def _linked_in_block(table: pa.Table) -> pa.Table:
    """Links (a, b) that connect what is linked among the documents of one or two blocks."""
    ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
    if len(ids) < 2:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    elements = table.column("elements").combine_chunks()
    sizes = np.diff(elements.offsets.to_numpy())
    _, element = np.unique(elements.flatten().to_numpy(), return_inverse=True)
    owner = np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(element, kind="stable")
    holders, begins = owner[order], np.searchsorted(element[order], np.arange(element.max(initial=-1) + 2))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    across = len(np.unique(block)) > 1
    root, links = np.arange(len(ids)), []
    for i in np.flatnonzero(block == block.max()) if across else range(len(ids)):
        mine = element[bounds[i] : bounds[i + 1]]
        met = np.concatenate([holders[begins[e] : begins[e + 1]] for e in mine]) if len(mine) else np.zeros(0, np.int64)
        common = np.bincount(met, minlength=len(ids))
        linked = common * 100 >= PERCENT * (sizes[i] + sizes - common)
        if across:
            linked &= block != block[i]
        for j in np.flatnonzero(linked & (root != root[i])):
            if root[j] != root[i]:
                links.append((ids[i], ids[j]))
                root[root == root[j]] = root[i]
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _block_links(docs: DataFrame, long: DataFrame) -> DataFrame:
    """Stored links among the members of long lists (key, id, n, c with ``c`` members).

    A document's home is the longest of its lists; the documents of one home are dealt over blocks of bounded
    size. Two blocks meet in one task if some long list has members in both, so lists that only hang
    together in a chain are not compared with each other. A task returns no more links than it has documents.
    """
    homes = long.groupBy("id").agg(F.max(F.struct("c", "key")).alias("home"), F.max("n").alias("n"))
    homes = keep(homes, "homes")
    sizes = keep(homes.groupBy("home").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_ELEMENTS)).cast("int").alias("blocks")), "home_sizes")
    placed = keep(homes.join(sizes, "home").select(
        "id", F.xxhash64("home.key", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks"))).alias("block")), "blocks")
    touched = keep(long.join(placed, "id").select("key", "block").distinct(), "touched")
    pairs = touched.join(touched.withColumnRenamed("block", "other"), "key").filter("block <= other").select(
        F.col("block").alias("i"), F.col("other").alias("j")).distinct()
    sides = keep(pairs.withColumn("block", F.explode(F.array_distinct(F.array("i", "j")))), "sides")
    sets = keep(_candidate_sets(docs, placed.select("id")), "sets")
    links = keep(
        placed.join(sets.select("id", "elements"), "id").join(sides, "block").groupBy("i", "j")
        .applyInArrow(lambda table: _linked_in_block(table), "a long, b long"), "links")
    forget(homes, sizes, placed, touched, sides, sets)
    release(docs.sparkSession)
    return links


def _grouped(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with their group so far and the number of members of their list; lists that lie within one group are left out."""
    rooted = members.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    found = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("c"))
    mixed = keep(found.filter("x < y").select("key", "c"), "keys")
    return rooted.join(mixed, "key").select("key", "id", "n", "root", "c")


def similarity_groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest linked doc_id)."""
    spark = docs.sparkSession
    digests = keep(_digests(docs), "digests")
    sketch = summed(digests.filter("sketch is not null").select("sketch"), np.uint32)
    rows = digests.filter("sketch is null").drop("sketch")
    classes = rows.filter("n > 0").groupBy("n", "high", "low").agg(F.min("doc_id").alias("rep"))

    # of equal sets one is enough; only documents that may not be that one are moved to find out
    reps = keep(classes.select(F.col("rep").alias("id")).distinct(), "reps")
    others = membership(rows.select(F.col("doc_id").alias("id")).dropna().join(reps, "id", "left_anti").select(F.xxhash64("id")))
    counted = np.zeros(1 << SKETCH_BITS, np.uint32) if sketch is None else sketch
    unsure = _prefixes(docs, counted, others, sure=False).join(reps, "id", "left_semi")
    prefixes = keep(_prefixes(docs, counted, others, sure=True).unionByName(unsure), "prefixes")
    release(spark)
    boundary = _boundary(prefixes)
    members = keep(_shared_postings(prefixes, boundary), "members")
    forget(prefixes, reps)
    release(spark)
    edges = _verified(docs, _star_pairs(members))
    grouped = keep(_grouped(members, components(edges)), "grouped")
    forget(members)
    short_links = _verified(docs, _cross_pairs(grouped.filter(F.col("c") <= LONG_LIST), boundary))
    long_links = _block_links(docs, grouped.filter(F.col("c") > LONG_LIST))
    forget(grouped)
    roots = components(edges.union(short_links).union(long_links))
    named = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n", "high", "low", F.coalesce("root", "rep").alias("component_id"))
    return rows.join(named, ["n", "high", "low"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """One document of every group; all columns stay.

    Rows are told apart by id and text, so texts that share an id, or have none, are judged each for itself. Of a group
    the row with the smallest id stays, of equal ids that with the smaller hash; null ids come last. Rows equal in id and
    text are one document, of which one row stays. Equality of id and text is equality of a 64-bit hash.
    """
    key = F.xxhash64("doc_id", F.col("text").cast("string"))
    groups = similarity_groups(docs.select(key.alias("doc_id"), "text")).select(F.col("doc_id").alias("__key"), "component_id").distinct()
    named = docs.select(key.alias("__key"), "doc_id").distinct()
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__key")
    first = groups.join(named, "__key").groupBy("component_id").agg(F.min(order).alias("first")).select("first.__key")
    return docs.withColumn("__key", key).join(keep(first, "firsts"), "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
