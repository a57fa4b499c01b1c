"""Near-duplicate classes by Order MinHash with verified links, and an exact rest.

A document is the sequence of its five-word shingles, each labelled with its occurrence
number. A sketch takes the shingles with the least hashes and keeps their order in the
text. Equal texts are one node. Documents that share a sketch meet in a bucket, and
there every member is compared with a leader that a hash elects. What these links leave
in different classes is compared exactly: all distinct shingles have one order, those
in many texts last, and two sets of the wanted similarity share one of their first
shingles in that order, wherever these stand in the texts and however often. All pairs
of different classes that share such a shingle at a place where the similarity can still be
reached are compared, so none is missed; texts that only share a passage seldom meet, as
the passage comes last. Links are verified by banded alignment of the shingle sequences,
then by the exact Jaccard similarity of the shingle sets where blocks have moved. Classes
are the connected components of the links.
"""

from __future__ import annotations

import functools
import hashlib
import math
import operator
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.llm.common import discard, map_batches, short_batches, stored, text_or_empty
from recurra.llm.textarrays import BASE, mix, run_hashes, runs, utf8, window_hashes

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: copies of a leader, so that the members of a large star spread over tasks
SALTS = 16
#: pieces in which the counts of shingles are added up
CHUNKS = 64
#: 64-bit words of the parities of a document, a power of two
WORDS = 16
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Params:
    shingle: int = 5
    similarity: float = 0.8
    sketches: int = 24
    #: shingles of one sketch
    chosen: int = 4
    #: positions that an aligned shingle may be off the diagonal, beside the difference in length
    band: int = 256
    #: cells in which the texts of all shingles are counted, a power of two; the counts only order the shingles
    cells: int = 1 << 22


def shingles(texts: pa.Array, size: int) -> tuple[list[bytes], list[np.ndarray]]:
    """Key of the word sequence and shingle hashes of each text; texts of fewer words have one shingle, without words none."""
    data, offsets = utf8(texts)
    start, end, doc = runs((~SPACES[data]).astype(np.uint8), offsets)
    words = run_hashes(data, start, end)
    grams, owner = window_hashes(words, doc, size)
    word_at, gram_at = np.searchsorted(doc, np.arange(len(texts) + 1)), np.searchsorted(owner, np.arange(len(texts) + 1))
    keys, out = [], []
    for i in range(len(texts)):
        own = words[word_at[i] : word_at[i + 1]]
        keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
        few = gram_at[i] == gram_at[i + 1] and len(own)
        out.append(np.frombuffer(keys[-1][:8], np.uint64) if few else grams[gram_at[i] : gram_at[i + 1]])
    return keys, out


def labelled(grams: np.ndarray) -> np.ndarray:
    """Hash of each shingle with the number of its occurrence so far."""
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    place = np.arange(len(grams))
    first = np.maximum.accumulate(np.where(np.append(True, ranked[1:] != ranked[:-1]), place, 0)) if len(grams) else place
    nth = np.empty(len(grams), np.uint64)
    nth[order] = (place - first).astype(np.uint64)
    return mix(grams + nth * BASE)


def sketch(grams: np.ndarray, params: Params) -> np.ndarray:
    """Order MinHash: for each sketch the least labelled shingles, hashed in the order of the text."""
    if not len(grams):
        return np.zeros(0, np.int64)
    marks = labelled(grams)
    seeds = mix(np.arange(1, params.sketches + 1, dtype=np.uint64) * BASE) | np.uint64(1)
    if len(marks) > params.chosen:
        at = np.sort(np.argpartition(seeds[:, None] * marks[None, :], params.chosen - 1, axis=1)[:, : params.chosen], axis=1)
    else:
        at = np.tile(np.arange(len(marks)), (params.sketches, 1))
    out = seeds.copy()
    for k in range(at.shape[1]):
        out = out * BASE + marks[at[:, k]]
    return mix(out).view(np.int64)


def once(grams: np.ndarray) -> np.ndarray:
    """Distinct shingles in the order of their first occurrence, 32 bits each."""
    small = (grams >> np.uint64(32)).astype(np.uint32)
    return small[np.sort(np.unique(small, return_index=True)[1])]


def cell(marks: np.ndarray, params: Params) -> np.ndarray:
    """Cell of each shingle: the first bits of its hash."""
    return (marks >> np.uint64(65 - params.cells.bit_length())).astype(np.int64)


def rarest(grams: np.ndarray, common: np.ndarray, params: Params) -> tuple[np.ndarray, int]:
    """The first distinct shingles in the order of (texts in their cell, hash), and the number of all distinct ones.

    A set of the wanted similarity lacks at most the other distinct shingles, so it holds one of these.
    """
    marks = np.unique(grams)
    n = len(marks)
    marks = marks[np.argsort(common[cell(marks, params)], kind="stable")]
    return marks[: n - math.ceil(params.similarity * n - 1e-6) + 1].view(np.int64), n


def parities(grams: np.ndarray) -> np.ndarray:
    """Bits that tell for each class of hashes whether the number of distinct shingles in it is odd.

    A shingle that only one of two sets holds changes one bit, so the sets differ in at least as many shingles as bits.
    """
    odd = np.bincount((np.unique(grams) & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


class Leader:
    """A shingle sequence against which others are aligned."""

    def __init__(self, grams: np.ndarray):
        self.order = np.argsort(grams)
        self.ranked = grams[self.order]

    def similar(self, other: np.ndarray, params: Params) -> bool:
        """Whether at least ``similarity`` of all distinct shingles are shared."""
        n, m = len(self.ranked), len(other)
        if min(n, m) < params.similarity * max(n, m) or not n:
            return not n and not m
        at = np.minimum(np.searchsorted(self.ranked, other), n - 1)
        both = self.ranked[at] == other
        place, own = self.order[at[both]], np.flatnonzero(both)
        near = place[np.abs(place - own) <= params.band + abs(n - m)]
        aligned = len(near)
        if aligned and (np.diff(near) <= 0).any():
            tails: list[int] = []  # longest ascending chain: the alignment of sequences without repeats
            for p in near.tolist():
                k = bisect_left(tails, p)
                tails[k : k + 1] = [p]
            aligned = len(tails)
        shared = aligned if aligned >= params.similarity * (n + m - aligned) else int(both.sum())
        return shared >= params.similarity * (n + m - shared)


def common_shingles(docs: DataFrame, params: Params) -> np.ndarray:
    """How many texts hold the shingles of each cell, over all texts: shingles are dealt to a fixed number of cells by their hash.

    Tasks count on their own and send their cells in chunks, which are added up chunk by chunk; so what
    reaches the driver has a fixed size.
    """
    short_batches(docs.sparkSession)
    width = params.cells // CHUNKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(params.cells, np.uint32)
        for batch in batches:
            own = [np.unique(g) for g in shingles(batch.column(0), params.shingle)[1]]
            at, n = np.unique(cell(np.concatenate(own), params), return_counts=True) if own else ([], [])
            counts[at] += np.asarray(n, np.uint32)
        used = [i for i in range(CHUNKS) if counts[i * width : (i + 1) * width].any()]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([counts[i * width : (i + 1) * width].tobytes() for i in used], pa.binary())], ["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(*[c.to_pylist() for c in batch.columns]):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["chunk", "counts"])

    kind = "chunk int, counts binary"
    parts = docs.select(text_or_empty().alias("text")).mapInArrow(count, kind)
    found = parts.repartition("chunk").mapInArrow(add, kind).toArrow()
    total = np.zeros(params.cells, np.uint32)
    for chunk, counts in zip(found["chunk"].to_pylist(), found["counts"].to_pylist()):
        total[chunk * width : (chunk + 1) * width] = np.frombuffer(counts, np.uint32)
    return total


def keyed(docs: DataFrame, params: Params) -> DataFrame:
    """(doc, mark, key, sketch, rare, size, odd) of every row, without texts; ``mark`` is a hash of the text as it is."""
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, params))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, grams = shingles(batch.column(2), params.shingle)
        known: dict[bytes, tuple] = {}
        for k, g in zip(keys, grams):
            if k not in known:
                known[k] = sketch(g, params), *rarest(g, common.value, params), parities(g)
        marks = [pa.array([known[k][c] for k in keys], pa.list_(pa.int64())) for c in (0, 1, 3)]
        return pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array([k.hex() for k in keys]), *marks, pa.array([known[k][2] for k in keys], pa.int32())], ["doc", "mark", "key", "sketch", "rare", "odd", "size"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text_or_empty()).alias("mark"), text_or_empty().alias("text"))
    return map_batches(rows, run, "doc long, mark long, key string, sketch array<long>, rare array<long>, odd array<long>, size int")


def gram_rows(docs: DataFrame, nodes: DataFrame, params: Params) -> DataFrame:
    """(id, grams) of the documents that stand for ``nodes`` (id, doc, mark).

    Rows of one id are told apart by the hash of their texts, so many rows without an id meet only those they equal.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), text_or_empty().alias("text")).withColumn("mark", F.xxhash64("text"))
    wanted = nodes.select("id", F.coalesce("doc", F.lit(NO_ID)).alias("doc"), "mark")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams = shingles(batch.column(1), params.shingle)[1]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([once(g).tobytes() for g in grams], pa.binary())], ["id", "grams"])

    found = map_batches(wanted.join(rows, ["doc", "mark"]).select("id", "text"), run, "id long, grams binary")
    return found.dropDuplicates(["id"])  # repeated rows of one document


def verified(pairs: DataFrame, grams: DataFrame, params: Params) -> DataFrame:
    """``pairs`` (id, least) with ``linked``. Members meet their leader in a sorted stream; a leader has up to SALTS copies."""
    short_batches(pairs.sparkSession)
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    members = salted.join(grams, "id").select("least", "salt", F.lit(1).alias("role"), "id", "grams")
    leaders = salted.select("least", "salt").distinct().join(grams.withColumnRenamed("id", "least"), "least").select(
        "least", "salt", F.lit(0).alias("role"), F.col("least").alias("id"), "grams")
    rows = leaders.unionByName(members).repartition("least", "salt").sortWithinPartitions("least", "salt", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, name = None, None
        for batch in batches:
            ids, leasts, links = [], [], []
            for least, _, role, i, g in zip(*[c.to_pylist() for c in batch.columns]):
                seq = np.frombuffer(g, np.uint32)
                if not role:
                    leader, name = Leader(seq), least
                elif name == least:
                    ids.append(i)
                    leasts.append(least)
                    links.append(leader.similar(seq, params))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(leasts, pa.int64()), pa.array(links, pa.bool_())], ["id", "least", "linked"])

    return rows.mapInArrow(run, "id long, least long, linked boolean")


def met(rows: DataFrame) -> DataFrame:
    """Rows (bucket, id) of buckets with at least two members, each with the leader that a hash elects in its bucket."""
    stars = rows.groupBy("bucket").agg(F.min_by("id", F.xxhash64("bucket", "id")).alias("least"), F.count("*").alias("n")).where("n > 1")
    return rows.join(stars.select("bucket", "least"), "bucket")


def needed(sizes: Column, params: Params) -> Column:
    """Shingles that two similar sets with ``sizes`` distinct ones together share at least."""
    return F.ceil(params.similarity / (1 + params.similarity) * sizes - 1e-6)


def mixed_rows(nodes: DataFrame, params: Params) -> DataFrame:
    """(bucket, id, size, nth, root, main) of the first shingles of ``nodes`` (id, size, rare, root) that stand in documents of several classes.

    In one of the documents the shingle must stand early enough for a set of its size or more.
    ``main`` is the class with the most rows in the bucket. One shuffle serves all of it.
    """
    rows = nodes.select("id", "size", "root", F.posexplode("rare").alias("nth", "bucket"))
    bucket, own = Window.partitionBy("bucket"), Window.partitionBy("bucket", "root")
    early = F.col("nth") + needed(2 * F.col("size"), params) <= F.col("size")
    seen = rows.repartition("bucket").withColumn("n", F.count("*").over(own)).withColumns({
        "main": F.max(F.struct("n", "root")).over(bucket), "least": F.min("root").over(bucket), "most": F.max("root").over(bucket), "early": F.max(early).over(bucket)})
    return seen.where("least <> most AND early").select("bucket", "id", "size", "nth", "root", F.col("main.root").alias("main"))


def rare_pairs(rows: DataFrame, params: Params) -> DataFrame:
    """All pairs (id, least) of different classes that share a shingle of ``rows`` (see :func:`mixed_rows`) with enough others behind it.

    One of a pair is outside the largest class of its bucket, so that class is not joined with itself.
    Pairs whose parities ``odd`` show that they differ in too many shingles are left out.
    """
    rest = rows.where("root <> main").select("bucket", *[F.col(c).alias(f"other_{c}") for c in ("id", "size", "nth", "root", "odd")])
    least = needed(F.col("size") + F.col("other_size"), params)
    differ = functools.reduce(operator.add, [F.bit_count(F.col("odd")[i].bitwiseXOR(F.col("other_odd")[i])) for i in range(WORDS)])
    pairs = rest.join(rows.drop("main"), "bucket").where((F.col("root") != F.col("other_root")) & (F.col("nth") + least <= F.col("size")) & (F.col("other_nth") + least <= F.col("other_size"))
                                                       & (differ + 2 * least <= F.col("size") + F.col("other_size")))
    return pairs.select(F.greatest("id", "other_id").alias("id"), F.least("id", "other_id").alias("least")).distinct()


def with_roots(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` with the root of their ``id``; an id without edges is its own."""
    roots = components(edges)
    roots = stored(roots.unionByName(roots.select(F.col("root").alias("id"), "root").distinct()), "near-roots")
    return rows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))


def compared(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, params: Params) -> DataFrame:
    """The links among ``pairs`` (id, least), stored."""
    wanted = pairs.select("id").unionByName(pairs.select(F.col("least").alias("id"))).distinct()
    grams = stored(gram_rows(docs, nodes.join(wanted, "id", "left_semi"), params), "near-grams")
    found = stored(verified(pairs, grams, params).where("linked").select("id", "least"), "near-links")
    discard(grams)
    return found


def links(docs: DataFrame, nodes: DataFrame, params: Params) -> DataFrame:
    """Verified links (id, least) between ``nodes`` (id, doc, mark, sketch, rare, size).

    First stars in the buckets of sketches; then all pairs that share a rare shingle and
    that the first links left in different classes.
    """
    single = nodes.select("id", F.posexplode("sketch").alias("nth", "value")).select(F.xxhash64("nth", "value").alias("bucket"), "id")
    stars = stored(met(single).where("id <> least").select("id", "least").distinct(), "near-met")
    first = compared(docs, nodes, stars, params)
    mixed = stored(mixed_rows(with_roots(nodes.select("id", "size", "rare"), first), params), "near-mixed")
    pairs = stored(rare_pairs(mixed.join(nodes.select("id", "odd"), "id"), params), "near-pairs")
    discard(stars, mixed)
    rest = compared(docs, nodes, pairs, params)
    discard(pairs)
    return first.unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of all nodes of ``edges`` (id, least): alternating large and small stars until all edges end at a root."""

    def stars(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        if not large:
            both = both.where("v < u")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        joined = both.join(least, "u")
        if large:
            return joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        return joined.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()

    now = stored(edges.select(F.greatest("id", "least").alias("a"), F.least("id", "least").alias("b")).where("a <> b").distinct(), "near-edges")
    state = None
    while True:
        now = stored(stars(stars(now, True), False), "near-stars")
        # converged when no further round changes the set: number and checksum of its edges
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
        state = seen


def classes(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """Class of every row: (doc_id, class_id, least_id, class_key, n_links, key).

    ``least_id`` is the least id of the class and ``class_key`` with it names the one document that
    stands for the class. ``class_id`` names a class alone: it is the least id where no other class has
    the same one, and otherwise, as for null and repeated ids, a negative hash of the class
    key. ``n_links`` counts the verified links of the row's text to different texts; more may hold
    inside a class. Documents with equal words in equal order are one class, those without any
    word too. Null texts are empty; null and repeated ids are kept, a null id comes before
    others. An empty table gives an empty result. Other columns are ignored.
    """
    rows = stored(keyed(docs, params), "near-rows")
    first = F.min(F.struct(F.coalesce("doc", F.lit(NO_ID)).alias("doc"), "mark")).alias("home")
    nodes = rows.groupBy("key").agg(first, F.first(F.struct("sketch", "rare", "odd", "size")).alias("marks"))
    nodes = stored(nodes.select("key", F.nullif(F.col("home.doc"), F.lit(NO_ID)).alias("doc"), "home.mark", "marks.*").withColumn("id", F.monotonically_increasing_id()), "near-nodes")
    light = stored(rows.select("doc", "key"), "near-keys")
    names = stored(nodes.select("key", "doc", "id"), "near-names")
    discard(rows)
    edges = links(docs, nodes, params)
    discard(nodes)
    roots = components(edges)
    roots = stored(roots.unionByName(roots.select(F.col("root").alias("id"), "root").distinct()), "near-roots")
    chosen = roots.join(names, "id").groupBy("root").agg(F.min(F.struct("doc", "key")).alias("first"))
    pairs = edges.select(F.greatest("id", "least").alias("id"), F.least("id", "least").alias("least")).distinct()  # two may have led each other
    counts = pairs.select("id").unionAll(pairs.select(F.col("least").alias("id"))).groupBy("id").agg(F.count("*").alias("n_links"))
    homes = names.join(roots.join(chosen, "root").select("id", "first"), "id", "left").join(counts, "id", "left").select(
        "key", F.when(F.col("first").isNull(), F.col("doc")).otherwise(F.col("first.doc")).alias("least_id"), F.coalesce("first.key", "key").alias("class_key"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    homes = stored(homes, "near-homes")
    own = homes.where("least_id IS NOT NULL").select("least_id", "class_key").distinct().groupBy("least_id").agg(F.count("*").alias("n")).where("n = 1").select("least_id", F.lit(True).alias("alone"))
    hashed = -1 - F.xxhash64("class_key").bitwiseAND(F.lit((1 << 62) - 1))
    named = homes.join(own, "least_id", "left").withColumn("class_id", F.when(F.col("alone"), F.col("least_id")).otherwise(hashed))
    return light.join(named, "key").select(F.col("doc").alias("doc_id"), "class_id", "least_id", "class_key", "n_links", "key")


def keep_one(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents that stand for their class, all columns as they are; of equal rows one stays."""
    kept = classes(docs, params).select(F.coalesce("least_id", F.lit(NO_ID)).alias("_near_doc"), F.col("class_key").alias("_near_key")).distinct()
    short_batches(docs.sparkSession)

    @F.arrow_udf("string")
    def key(texts: pa.Array) -> pa.Array:
        return pa.array([k.hex() for k in shingles(texts, params.shingle)[0]])

    rows = docs.withColumns({"_near_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_near_key": key(text_or_empty())})
    return rows.join(kept, ["_near_doc", "_near_key"], "left_semi").dropDuplicates(["_near_doc", "_near_key"]).select(*[F.col(f"`{c}`") for c in docs.columns])
