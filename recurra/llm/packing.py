"""Bulk-synchronous best-fit packing of documents into sequences of bounded length.

Each round sorts the open documents and the gaps of all sequences by size over the
cluster. In that order a gap takes the largest waiting document that fits, which is
the matching of opening and closing brackets: documents open, gaps close. A task needs
only the number of brackets that tasks before it left open, so one pass counts them,
the counts (two for each task) are combined, and a second pass names the partners.
Gaps shrink by what they took, and the next round begins. A gap that could hold
several of the longest open documents takes part as several equal places.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from recurra.llm.bpe import bpe
from recurra.llm.common import give_back, map_batches, short_batches, stored, text_or_empty
from recurra.session import reliable_checkpoint

OPEN, GAP = 0, 1


@dataclass(frozen=True)
class Params:
    length: int = 4096
    #: id that ends every document
    end: int = 1


def pieces(docs: DataFrame, tokenizer: str, params: Params = Params(), with_ids: bool = False) -> DataFrame:
    """Token pieces of every document: (doc_id, piece, start, length, ids_crc32[, ids]).

    Only documents longer than a sequence are cut. Null texts are empty: one piece with
    the end id. Null and repeated ids are kept as they are; other columns are ignored.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
    width = 4 * params.length

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ends = params.end.to_bytes(4, "little")
        cut = [(d, k, raw[k * width : (k + 1) * width]) for d, raw in zip(batch.column(0).to_pylist(), (x + ends for x in bpe(tokenizer).encode(batch.column(1).to_pylist())))
               for k in range((len(raw) + width - 1) // width)]
        columns = [pa.array([d for d, _, _ in cut], pa.int64()), pa.array([k for _, k, _ in cut], pa.int32()), pa.array([k * params.length for _, k, _ in cut], pa.int64()),
                   pa.array([len(x) // 4 for _, _, x in cut], pa.int64()), pa.array([zlib.crc32(x) for _, _, x in cut], pa.int64())]
        if with_ids:
            columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for _, _, x in cut], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def done() -> None:
        bpe(tokenizer).forget()
        give_back()

    return map_batches(rows, run, schema, done)


def left_over(kinds: np.ndarray) -> tuple[int, int]:
    """Gaps and documents of one task that find no partner inside it."""
    level = np.cumsum(np.where(kinds == OPEN, 1, -1))
    gaps = max(0, -int(level.min(initial=0)))
    return gaps, int(level[-1]) + gaps if len(level) else 0


def partners(counts: dict[int, tuple[int, int]]) -> dict[int, list[tuple[int, int, int]]]:
    """For each task the runs (task, last, number) of waiting documents that its gaps take, last one first."""
    stack: list[list[int]] = []
    out: dict[int, list[tuple[int, int, int]]] = {}
    for task in sorted(counts):
        gaps, docs = counts[task]
        while gaps and stack:
            owner, top = stack[-1]
            take = min(gaps, top)
            out.setdefault(task, []).append((owner, top - 1, take))
            gaps -= take
            stack[-1][1] -= take
            if not stack[-1][1]:
                stack.pop()
        if docs:
            stack.append([task, docs])
    return out


def sweep(docs: DataFrame, slots: DataFrame) -> DataFrame:
    """Matches of one round as (pid, size, bin), each slot at most once and each document at most once."""
    spark = docs.sparkSession
    events = docs.select("size", F.lit(OPEN).alias("kind"), F.col("pid").alias("key"), F.lit(0).alias("slot")).unionByName(
        slots.select("size", F.lit(GAP).alias("kind"), F.col("bin").alias("key"), "slot"))
    # a hot size spreads over tasks by the key
    events = events.repartitionByRange("size", "kind", "key", "slot").sortWithinPartitions("size", "kind", "key", "slot")
    events = reliable_checkpoint(events.withColumn("task", F.spark_partition_id()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, task = [], 0
        for b in batches:
            if b.num_rows:
                kinds.append(b.column(0).to_numpy())
                task = b.column(1)[0].as_py()
        if kinds:
            gaps, waiting = left_over(np.concatenate(kinds))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((task, pa.int32()), (gaps, pa.int64()), (waiting, pa.int64()))], ["task", "gaps", "docs"])

    counts = {r.task: (r.gaps, r.docs) for r in events.select("kind", "task").mapInArrow(count, "task int, gaps long, docs long").collect()}
    takes = partners(counts)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[int, int]] = []
        pid, bins, size, owner, place = [], [], [], [], []
        runs: Iterator[tuple[int, int]] | None = None
        task = None

        def add(p: int | None, b: int | None, s: int | None, o: int | None, k: int | None) -> None:
            for column, value in zip((pid, bins, size, owner, place), (p, b, s, o, k)):
                column.append(value)

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in ((pid, pa.int64()), (bins, pa.int64()), (size, pa.int64()), (owner, pa.int32()), (place, pa.int64()))],
                                               ["pid", "bin", "size", "owner", "place"])
            for column in (pid, bins, size, owner, place):
                column.clear()
            return batch

        for b in batches:
            if not b.num_rows:
                continue
            if task is None:
                task = b.column(4)[0].as_py()
                runs = iter([(o, last - i) for o, last, n in takes.get(task, ()) for i in range(n)])
            for s, kind, key in zip(*[b.column(i).to_pylist() for i in range(3)]):
                if kind == OPEN:
                    stack.append((key, s))
                elif stack:
                    p, own = stack.pop()
                    add(p, key, own, None, None)
                elif (far := next(runs, None)) is not None:
                    add(None, key, None, *far)
            yield out()
        for k, (p, s) in enumerate(stack):
            add(p, None, s, task, k)
        if stack:
            yield out()

    schema = "pid long, bin long, size long, owner int, place long"
    matched = stored(events.mapInArrow(match, schema), "pack-sweep")
    near = matched.where("pid IS NOT NULL AND bin IS NOT NULL").select("pid", "size", "bin")
    waiting = matched.where("bin IS NULL").select("owner", "place", "pid", "size")
    far = matched.where("pid IS NULL").select("owner", "place", "bin").join(waiting, ["owner", "place"]).select("pid", "size", "bin")
    return near.unionByName(far)


def fit(items: DataFrame, params: Params = Params()) -> DataFrame:
    """Place of every item: (pid, bin, offset). ``items`` has unique ``pid`` and ``size`` from 1 to the sequence length - 1."""
    spark = items.sparkSession
    short_batches(spark, 8192)
    open_docs, bins, opened, placed = items.select("pid", F.col("size").cast("long").alias("size")), None, 0, []
    while True:
        left = open_docs.agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.max("size").alias("longest")).first()
        if not left.n:
            break
        room = bins.agg(F.max("gap")).first()[0] if bins is not None else None
        if room is None or room < left.longest:
            # no sequence can take the longest one: open as many as the open documents fill at least
            more = -(-left.total // params.length)
            fresh = spark.range(opened, opened + more).select(F.col("id").alias("bin"), F.lit(params.length).cast("long").alias("gap"))
            bins, opened = (bins.unionByName(fresh) if bins is not None else fresh), opened + more
        shares = F.greatest(F.lit(1).cast("long"), F.floor(F.col("gap") / left.longest))
        slots = bins.where("gap > 0").select("bin", F.explode(F.sequence(F.lit(1), shares.cast("int"))).alias("slot"), F.floor(F.col("gap") / shares).alias("size"))
        taken = stored(sweep(open_docs, slots), "pack-round")
        gaps = bins.join(taken.groupBy("bin").agg(F.sum("size").alias("took")), "bin", "left")
        before = Window.partitionBy("bin").orderBy(F.desc("size"), "pid").rowsBetween(Window.unboundedPreceding, -1)
        offset = params.length - F.col("gap") + F.coalesce(F.sum("size").over(before), F.lit(0))
        # a sequence takes no more items than it has tokens
        placed.append(stored(taken.join(bins, "bin").select("pid", "bin", offset.alias("offset")), "pack-placed"))
        open_docs = stored(open_docs.join(taken.select("pid"), "pid", "left_anti"), "pack-open")
        bins = stored(gaps.select("bin", (F.col("gap") - F.coalesce("took", F.lit(0))).alias("gap")).where("gap > 0"), "pack-gaps")
    out = spark.createDataFrame([], "pid long, bin long, offset long")
    for p in placed:
        out = out.unionByName(p)
    return out


def pack(docs: DataFrame, tokenizer: str, params: Params = Params(), with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their ``sequence_id`` and ``offset``; see :func:`pieces`.

    Pieces of full length are sequences of their own. An empty table gives an empty result.
    """
    cut = stored(pieces(docs, tokenizer, params, with_ids).withColumn("pid", F.monotonically_increasing_id()), "pack-pieces")
    whole = cut.where(F.col("length") >= params.length).withColumns({"sequence_id": -1 - F.col("pid"), "offset": F.lit(0).cast("long")})
    rest = cut.where(F.col("length") < params.length)
    homes = fit(rest.select("pid", F.col("length").alias("size")), params)
    placed = rest.join(homes, "pid").withColumnRenamed("bin", "sequence_id")
    return placed.unionByName(whole).drop("pid")


def sequences(packed: DataFrame) -> DataFrame:
    """Token ids of each sequence, (sequence_id, ids), from :func:`pack` with ids; a sequence has a bounded number of them."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
