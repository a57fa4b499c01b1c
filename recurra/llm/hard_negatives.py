"""Hard negatives by a vertical scan of vector blocks (BOND).

Vectors are integers, packed into blocks that hold one array for each dimension. An
anchor reads the dimensions of a block in descending order of its own magnitudes. After
each few dimensions the least and the greatest contribution that the rest can add, from
the block's minimum and maximum of each dimension, bound the score of every row; rows
that can no longer enter a result leave the candidate bitmap, and later dimensions are
read for the rest only. The last bounds are the exact scores.

Two scans: the first finds an anchor's positives among rows of its label, the second the
negatives in the score windows that the positives give. A scan keeps its best rows
while it walks the blocks of a slab, so its bounds become tighter; slabs are merged by
a ranking in Spark.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.llm.common import short_batches, stored
from recurra.llm.vectors import PACKED_ROWS, common_length, met, numbers, packed, slab_of, tasks

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
FOUND = "anchor long, wanted long, score long, id long"


@dataclass(frozen=True)
class Params:
    positives: int = 5
    negatives: int = 3
    #: a negative has at least and at most so many hundredths of the positive's score
    least: int = 50
    most: int = 95
    #: components become floor(scale * x)
    scale: float = 256.0
    #: dimensions that are read between two cuts of the candidates, and before the first
    stride: int = 8
    first: int = 24
    #: anchors of one chunk
    chunk: int = 256


class Block:
    """Columns of one block with their minima and maxima."""

    def __init__(self, row: dict, dim: int):
        self.number, self.ids, self.nulls = row["block"], numbers(row["ids"]), numbers(row["nulls"], np.uint8)
        self.labels, self.asked = numbers(row["labels"]), numbers(row["asked"], np.uint8)
        self.columns = numbers(row["matrix"]).reshape(dim, -1)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        self.reach = int(np.maximum(np.abs(self.low.astype(np.float64)), np.abs(self.high.astype(np.float64))).max())

    def exact(self, reach: int) -> Block:
        """For anchors of magnitudes up to ``reach``: sums of products below 2**24 are exact as floats, below 2**53 as doubles, below 2**63 as integers; beyond, a score is no long."""
        most = reach * self.reach * len(self.columns)
        if most >= 1 << 63:
            raise OverflowError("an inner product of these vectors can exceed a long")
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        if self.columns.dtype != kind:
            self.columns, self.low, self.high = (x.astype(kind) for x in (self.columns, self.low, self.high))
        return self


def scan(block: Block, anchor: np.ndarray, rows: np.ndarray, cut: Callable[[np.ndarray, np.ndarray], np.ndarray], params: Params) -> tuple[np.ndarray, np.ndarray]:
    """Rows that ``cut`` leaves after the last dimension, and their scores.

    ``rows`` are the candidates; ``cut`` gets the lower and the upper bound of each and tells which may stay.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    q = anchor[order].astype(block.columns.dtype)
    ends = np.sort(np.stack([q * block.low[order], q * block.high[order]]), axis=0)
    rest = np.cumsum(ends[:, ::-1], axis=1)[:, ::-1]
    score, at = np.zeros(len(rows), q.dtype), 0
    while at < len(q) and len(rows):
        to = min(len(q), max(at + params.stride, params.first))
        own = block.columns[order[at:to]]
        # columns are read whole while most rows are candidates
        score = score + ((q[at:to] @ own)[rows] if 2 * len(rows) > own.shape[1] else q[at:to] @ own[:, rows])
        low, high = (rest[0, to], rest[1, to]) if to < len(q) else (0, 0)
        stay = cut(score + low, score + high)
        if not stay.all():
            rows, score = rows[stay], score[stay]
        at = to
    return rows, score.astype(np.int64)


class Best:
    """The first ``n`` rows by score descending, then id, null last."""

    def __init__(self, n: int):
        self.n, self.rows = n, []

    @property
    def least(self) -> int | None:
        return -self.rows[-1][0] if len(self.rows) == self.n else None

    def add(self, block: Block, rows: np.ndarray, scores: np.ndarray) -> None:
        # rows of a block are in the order of ties
        for k in np.argsort(-scores, kind="stable")[: self.n]:
            insort(self.rows, (-int(scores[k]), int(block.nulls[rows[k]]), int(block.ids[rows[k]])))
        del self.rows[self.n :]


def nearest(block: Block, anchor: np.ndarray, label: int, place: int | None, best: Best, params: Params) -> None:
    """The anchor's best rows of its label in ``block``, without its own row at ``place``."""
    same = block.labels == label
    if place is not None:
        same[place] = False

    def cut(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        least = best.least
        if len(low) > best.n:
            sure = np.partition(low, -best.n)[-best.n]
            least = sure if least is None else max(least, sure)
        return high >= least if least is not None else np.ones(len(low), bool)

    best.add(block, *scan(block, anchor, np.flatnonzero(same), cut, params))


def between(block: Block, anchor: np.ndarray, label: int, windows: dict[int, Best], params: Params) -> None:
    """For each positive score of ``windows`` the best rows of another label inside its window."""

    def open_windows() -> list[tuple[int, int]]:
        # 100 * score between least and most times the positive's; whole numbers, so both ends are exact
        return [(max(-(-params.least * p // 100), b.least if b.least is not None else -(1 << 63)), params.most * p // 100) for p, b in windows.items()]

    ends = [(low, high) for low, high in open_windows() if low <= high]
    if not ends:
        return

    def cut(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if len(low) > 64:  # between the outer ends first, cheap
            return (high >= min(e[0] for e in ends)) & (low <= max(e[1] for e in ends))
        return np.any([(high >= e[0]) & (low <= e[1]) for e in ends], axis=0)

    rows, scores = scan(block, anchor, np.flatnonzero(block.labels != label), cut, params)
    for (low, high), best in zip(open_windows(), windows.values()):
        inside = (scores >= low) & (scores <= high)
        best.add(block, rows[inside], scores[inside])


def anchor_chunks(blocks: DataFrame, dim: int, params: Params) -> DataFrame:
    """Anchors in chunks: (chunk, members, ids, labels, matrix); an anchor is named by its block and place."""
    columns = "chunk long, members array<long>, ids array<long>, labels array<long>, matrix binary"
    short_batches(blocks.sparkSession, PACKED_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, parts = TaskContext.get().partitionId() << 32, []

        def chunks(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal number, parts
            if not parts:
                return
            values = [np.concatenate(x) for x in zip(*parts)]
            at = 0
            while len(values[0]) - at >= least:
                *lists, matrix = [v[at : at + params.chunk] for v in values]
                number, at = number + 1, at + params.chunk
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.array([x], pa.list_(pa.int64())) for x in lists], pa.array([matrix.tobytes()], pa.binary())], [c.split()[0] for c in columns.split(", ")])
            parts = [[v[at:] for v in values]]

        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, dim)
                place = np.flatnonzero(block.asked)
                parts.append([named(block.number, place), block.ids[place], block.labels[place], np.ascontiguousarray(block.columns[:, place].T)])
            yield from chunks(params.chunk)
        yield from chunks(1)

    return stored(blocks.mapInArrow(run, columns), "negatives-anchors")


def named(block: int, place: np.ndarray) -> np.ndarray:
    """Number of a row from its block and place; blocks of one task are numbered from 1, a block has at most 2**16 rows."""
    return (np.int64(block >> 32) << 40) + (np.int64(block & 0xFFFFFFFF) << 16) + place


def scanned(chunks: DataFrame, blocks: DataFrame, dim: int, params: Params, label: str) -> DataFrame:
    """Best rows (anchor, wanted, score, id) of each anchor and slab.

    Without a column ``windows`` in ``chunks`` these are the rows nearest to the anchor of its label;
    with it, for each positive score in it (``wanted``) the rows inside its window.
    """
    slabs = 2 * tasks(blocks)
    dealt = chunks.withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))))
    pairs = met(dealt.withColumnsRenamed({c: f"chunk_{c}" for c in chunks.columns}), blocks.withColumn("slab", slab_of(F.col("block"), slabs)), "slab", slabs)
    windowed = "windows" in chunks.columns
    short_batches(blocks.sparkSession, PACKED_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, states, anchors, known = None, [], np.zeros(0, np.int64), None

        def result() -> pa.RecordBatch:
            found = [(int(a), wanted, -s, None if null else i) for a, state in zip(anchors, states) for wanted, best in state.items() for s, null, i in best.rows]
            return pa.RecordBatch.from_pylist([dict(zip(("anchor", "wanted", "score", "id"), f)) for f in found], pa.schema([(c, pa.int64()) for c in ("anchor", "wanted", "score", "id")]))

        for batch in batches:
            for row in batch.to_pylist():
                if now != (row["slab"], row["chunk_chunk"]):
                    if states:
                        yield result()
                    now, anchors = (row["slab"], row["chunk_chunk"]), np.array(row["chunk_members"])
                    labels, matrix = np.array(row["chunk_labels"]), numbers(row["chunk_matrix"]).reshape(len(anchors), dim)
                    reach = int(np.abs(matrix.astype(np.float64)).max())
                    if windowed:
                        asked: dict[int, dict[int, Best]] = {int(a): {} for a in anchors}
                        for w in row["chunk_windows"]:
                            asked[w["anchor"]][w["score"]] = Best(params.negatives)
                        states = list(asked.values())
                    else:
                        states = [{0: Best(params.positives)} for _ in anchors]
                if known is None or known.number != row["block"]:
                    known = Block(row, dim)
                block = known.exact(reach)
                own = named(block.number, np.arange(len(block.ids)))
                places = np.searchsorted(own, anchors)
                for k, state in enumerate(states):
                    if windowed:
                        between(block, matrix[k], labels[k], state, params)
                    else:
                        here = places[k] < len(own) and own[places[k]] == anchors[k]
                        nearest(block, matrix[k], labels[k], int(places[k]) if here else None, state[0], params)
        if states:
            yield result()

    return stored(pairs.mapInArrow(run, FOUND), label)


def first(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first ``n`` rows for each of ``keys`` by score descending, then id, null last, with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(rows: DataFrame, anchor: Column, params: Params = Params(), id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Hard negatives (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows that ``anchor`` marks.

    An anchor's positives are its ``positives`` nearest other rows of its label by the inner product
    of floor(scale * x); for each positive the first ``negatives`` rows of another label whose score
    lies between ``least`` and ``most`` hundredths of the positive's are returned, best first. Ties go
    to smaller ids, null ids last.

    Rows with a null label, a null vector, a null or non-finite component or a vector of another
    than the most frequent length take no part. A row with a null id is no anchor, but may be a
    positive or a negative. Rows with one id are rows of their own, so a repeated anchor returns its rows
    once for each. A table without rows gives an empty result. Other columns are ignored. Scores beyond a
    long raise an error.
    """
    source = rows.select(
        F.col(id_column).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        (F.coalesce(anchor, F.lit(False)) & F.col(id_column).isNotNull()).alias("asked"), F.col(vector).cast("array<double>").alias("vector")).where("label IS NOT NULL")
    spark, dim, scale = rows.sparkSession, common_length(source, "vector"), params.scale
    if not dim:
        return spark.createDataFrame([], RESULT)

    def whole(matrix: np.ndarray) -> np.ndarray:
        found = np.floor(scale * matrix)
        if len(found) and np.abs(found).max() >= 2.0**62:
            raise OverflowError("a component is too large for scores that are longs")
        return found.astype(np.int64)

    blocks = packed(source, dim, whole, lambda m: np.ones(len(m), bool), "negatives-blocks")
    chunks = anchor_chunks(blocks, dim, params)
    near = scanned(chunks, blocks, dim, params, "negatives-near")
    positives = stored(first(near, ["anchor"], params.positives).select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("place")), "negatives-positives")

    names = chunks.select("chunk", F.explode(F.arrays_zip("members", "ids")).alias("m")).select("chunk", F.col("m.members").alias("anchor"), F.col("m.ids").alias("anchor_id"))
    windows = positives.select("anchor", F.col("positive_score").alias("score")).distinct().join(names, "anchor").groupBy("chunk").agg(F.collect_list(F.struct("anchor", "score")).alias("windows"))
    found = scanned(chunks.join(windows, "chunk"), blocks, dim, params, "negatives-found")
    negatives = first(found, ["anchor", "wanted"], params.negatives).select("anchor", F.col("wanted").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    joined = positives.join(names, "anchor").join(negatives, ["anchor", "positive_score"])
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
