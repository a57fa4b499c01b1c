"""Balanced shards by Karmarkar-Karp differencing over indivisible groups.

A partial partition is a vector of shard sums. The two with the largest spread
(largest minus smallest sum) are laid over each other in opposite order, again and
again. The largest groups, a bounded number, are differenced together. All others are
dealt to parts; each part takes an equal share of the sums that the large groups left
as one more partial partition and differences its own groups with it, in blocks of
bounded size. Only sums travel to the parts, never rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from recurra.llm.common import short_batches, stored, text_or_empty


@dataclass(frozen=True)
class Params:
    shards: int = 40
    #: fixed bytes of a document beside its text
    overhead: int = 16
    #: groups that one differencing holds at a time
    block: int = 4096
    #: groups of one part; a part is differenced on its own
    part: int = 8192
    #: parts of a shard for numbering its rows
    slices: int = 256


def difference(vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions of equal width into one.

    Returns the sums of the result and, for each input vector and place, the place of
    the result it went to. Ties of spread go to the earlier vector.
    """
    width = len(vectors[0])
    nodes = list(vectors)
    parts: list[tuple[int, np.ndarray, int, np.ndarray] | None] = [None] * len(nodes)
    heap = [(-int(v.max() - v.min()), i) for i, v in enumerate(nodes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        down, up = np.argsort(-nodes[a], kind="stable"), np.argsort(nodes[b], kind="stable")
        made = nodes[a][down] + nodes[b][up]
        parts.append((a, down, b, up))
        nodes.append(made)
        heapq.heappush(heap, (-int(made.max() - made.min()), len(nodes) - 1))
        if a >= len(vectors):
            nodes[a] = None
        if b >= len(vectors):
            nodes[b] = None
    place: dict[int, np.ndarray] = {len(nodes) - 1: np.arange(width)}
    for i in range(len(nodes) - 1, len(vectors) - 1, -1):
        a, down, b, up = parts[i]
        here = place.pop(i)
        for child, order in ((a, down), (b, up)):
            place[child] = np.empty(width, np.int64)
            place[child][order] = here
    return nodes[-1], np.array([place[i] for i in range(len(vectors))])


def seats(before: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Shard of each group when all groups and the sums so far are differenced together."""
    vectors = [before]
    for s in sizes:
        v = np.zeros(len(before), np.int64)
        v[0] = s
        vectors.append(v)
    place = difference(vectors)[1]
    label = np.empty(len(before), np.int64)  # the sums so far keep their shards, which names the places
    label[place[0]] = np.arange(len(before))
    return label[place[1:, 0]]


def local_parts(groups: DataFrame, parts: int, before: np.ndarray, params: Params) -> DataFrame:
    """(key, shard) of groups dealt to ``parts`` parts.

    A part streams through one task in order of size, a block at a time, and starts from
    its share of the sums in ``before``, so that small groups level what large ones left.
    """
    share = before // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, int, int]] = []
        sums: dict[int, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            part, sizes = held[0][2], np.array([x[1] for x in held])
            so_far = sums.get(part, share)
            shard = seats(so_far, sizes)
            sums.clear()
            sums[part] = so_far + np.bincount(shard, sizes, params.shards).astype(np.int64)
            out = pa.RecordBatch.from_arrays([pa.array([x[0] for x in held]), pa.array(shard.astype(np.int32))], ["key", "shard"])
            held.clear()
            return out

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (held[0][2] != row[2] or len(held) >= params.block):
                    yield flush()
                held.append(row)
        if held:
            yield flush()

    dealt = groups.select("key", "size", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int").alias("part"))
    dealt = dealt.repartition("part").sortWithinPartitions("part", F.desc("size"), "key")
    return dealt.mapInArrow(run, "key string, shard int")


def assign(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """Shard of every document: (doc_id, size, text_crc32, shard, slot), bytes of the shards near equal.

    Documents of equal text are one group and stay together, null with empty texts;
    so a group that is larger than a shard's share makes its shard that large. Every
    row is kept, null and repeated ids included. Slots number the rows of a shard from
    0 without gaps, in no order that means anything. Other columns are ignored.
    """
    spark = docs.sparkSession
    short_batches(spark, 4096)
    text = text_or_empty()
    rows = docs.select(F.col("doc_id"), (F.octet_length(text) + params.overhead).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("key"))
    rows = stored(rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", F.spark_partition_id(), F.monotonically_increasing_id()), F.lit(params.slices)).cast("int")), "shard-rows")
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    # the largest groups, ``block`` at most, are differenced first and all together
    large = groups.orderBy(F.desc("size"), "key").limit(params.block).collect()
    sizes = np.array([r["size"] for r in large], np.int64)
    shard = seats(np.zeros(params.shards, np.int64), sizes)
    first = spark.createDataFrame([(r.key, int(k)) for r, k in zip(large, shard)], "key string, shard int")
    rest = groups.join(F.broadcast(first.select("key")), "key", "left_anti")
    before = np.bincount(shard, sizes, params.shards).astype(np.int64)
    parts = 1 + max(0, groups.count() - len(large)) // params.part
    homes = stored(local_parts(rest, parts, before, params).unionByName(first), "shard-homes-of-groups")
    out = stored(rows.join(homes, "key").select("doc_id", "size", "text_crc32", "shard", "slice"), "shard-homes")
    # rows of (shard, slice) are numbered apart; the counts, shards * slices at most, give the starts
    counts = out.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size")
    return (out.withColumn("rank", F.row_number().over(inside)).join(F.broadcast(starts), ["shard", "slice"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("rank") - 1).alias("slot")))
