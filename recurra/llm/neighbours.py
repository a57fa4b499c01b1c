"""Approximate nearest neighbours by learned partitions.

A sample of the vectors gets its exact neighbour graph. The graph is cut into partitions of
equal size with few edges between them: a start by balanced centres, then rounds in which
vertices move to the partition that holds most of their neighbours, as far as it has room. A
softmax classifier learns from each vector the share of its neighbours in every
partition. All rows are indexed in their most probable partition; a query is routed to its
most probable partitions and reranked there with exact scores. How many it takes is
learned too: on vectors that the classifier has not seen, the least number that finds the
wanted share of their true neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.llm.common import short_batches, stored
from recurra.llm.vectors import PACKED_ROWS, checked, common_length, met, tasks

RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass(frozen=True)
class Params:
    nearest: int = 20
    #: rows from which the partitions are learned, those with the least hashes
    sample: int = 8192
    partitions: int = 32
    #: rows of the sample for each partition, at least
    members: int = 32
    #: neighbours of a vertex of the graph, rounds of moves, and what a partition may exceed its share by
    degree: int = 20
    rounds: int = 12
    slack: float = 0.05
    epochs: int = 30
    #: share of the true neighbours that the routed partitions hold on unseen vectors; one of ``unseen`` is held out
    recall: float = 0.95
    unseen: int = 5
    #: queries of one chunk, rows of one block, blocks of one slab
    chunk: int = 512
    block: int = 1024
    slab: int = 4


def unit(matrix: np.ndarray) -> np.ndarray:
    """Vectors for centres and classifier, all at one scale, so a common factor changes no route."""
    return (matrix / np.abs(matrix).max(axis=1, initial=1e-300, keepdims=True)).astype(np.float32)


def graph(queries: np.ndarray, rows: np.ndarray, degree: int, own: int | None) -> np.ndarray:
    """Places in ``rows`` of the ``degree`` greatest inner products of each query; query k is row ``own + k`` itself."""
    out = []
    for at in range(0, len(queries), 512):
        score = queries[at : at + 512] @ rows.T
        if own is not None:
            score[np.arange(len(score)), own + at + np.arange(len(score))] = -np.inf
        out.append(np.argpartition(-score, degree - 1, axis=1)[:, :degree])
    return np.concatenate(out)


def roomy(wish: np.ndarray, room: int) -> np.ndarray:
    """Each row's best column of ``wish`` that has room; where too many want one, the strongest wishes win."""
    wish, home, left = wish.copy(), np.full(len(wish), -1), np.full(wish.shape[1], room)
    open_rows = np.arange(len(wish))
    while len(open_rows):
        want = wish[open_rows].argmax(axis=1)
        order = np.lexsort((-wish[open_rows, want], want))
        rows, want = open_rows[order], want[order]
        place = np.arange(len(rows)) - np.searchsorted(want, want)
        won = place < left[want]
        home[rows[won]] = want[won]
        left -= np.bincount(want[won], minlength=len(left))
        wish[:, left <= 0] = -np.inf
        open_rows = rows[~won]
    return home


def partitioned(vectors: np.ndarray, near: np.ndarray, count: int, params: Params, rng: np.random.Generator) -> np.ndarray:
    """Partition of each vertex of the neighbour graph ``near``: equal sizes, few edges between partitions."""
    room = math.ceil(len(vectors) / count * (1 + params.slack))
    centre = vectors[rng.permutation(len(vectors))[:count]]
    for _ in range(params.rounds // 2):
        home = roomy(vectors @ centre.T, room)
        centre = np.stack([vectors[home == p].mean(axis=0) if (home == p).any() else centre[p] for p in range(count)])
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
    own, other = np.repeat(np.arange(len(near)), near.shape[1]), near.ravel()
    for _ in range(params.rounds):
        votes = np.zeros((len(vectors), count), np.float32)
        np.add.at(votes, (own, home[other]), 1)
        np.add.at(votes, (other, home[own]), 1)
        votes += 1e-3 * (vectors @ centre.T)
        # half of the vertices keep their place, so neighbours don't swap for ever
        still = np.flatnonzero(rng.random(len(vectors)) < 0.5)
        votes[still, home[still]] += 1e6
        home = roomy(votes, room)
    return home


def learned(vectors: np.ndarray, share: np.ndarray, params: Params, rng: np.random.Generator) -> np.ndarray:
    """Weights of a softmax classifier (dimensions and a constant, partitions), fitted to ``share`` by Adam."""
    x = np.concatenate([vectors, np.ones((len(vectors), 1), np.float32)], axis=1)
    w, mean, square = (np.zeros((x.shape[1], share.shape[1]), np.float32) for _ in range(3))
    step = 0
    for epoch in range(params.epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            k = order[at : at + 256]
            z = x[k] @ w
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            slope, step = x[k].T @ (p - share[k]) / len(k), step + 1
            mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
            rate = 0.05 * (1 - epoch / params.epochs) + 1e-3
            w = w - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w


def shares(near: np.ndarray, home: np.ndarray, count: int) -> np.ndarray:
    out = np.zeros((len(near), count), np.float32)
    np.add.at(out, (np.repeat(np.arange(len(near)), near.shape[1]), home[near].ravel()), 1 / near.shape[1])
    return out


def scores(vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return vectors @ weights[:-1] + weights[-1]


@dataclass(frozen=True)
class Router:
    """A classifier over partitions, and the number of partitions that a query is routed to."""

    weights: np.ndarray
    probes: int

    def routes(self, matrix: np.ndarray) -> np.ndarray:
        """Partitions of each vector, most probable first."""
        return np.argsort(-scores(unit(matrix), self.weights), axis=1, kind="stable")


def fit(matrix: np.ndarray, params: Params) -> Router:
    """Router from a sample. Too few rows make one partition, which is a full search."""
    count = min(params.partitions, len(matrix) // params.members)
    if count < 2:
        return Router(np.zeros((matrix.shape[1] + 1, 1), np.float32), 1)
    rng = np.random.default_rng(7)
    vectors, degree = unit(matrix), min(params.degree, len(matrix) - 1 - len(matrix) // params.unseen)
    # neighbours are those of the inner product on the vectors as they are
    raw = (matrix / max(np.abs(matrix).max(), 1e-300)).astype(np.float32)
    held = np.arange(len(matrix)) < len(matrix) // params.unseen
    seen = graph(raw[~held], raw[~held], degree, 0)
    home = partitioned(vectors[~held], seen, count, params, rng)
    weights = learned(vectors[~held], shares(seen, home, count), params, rng)
    # a held-out vector's neighbours among all, each where the index puts it
    near = graph(raw[held], raw, min(params.nearest, len(matrix) - 1), 0)
    placed = scores(vectors, weights).argmax(axis=1)
    order = np.argsort(-scores(vectors[held], weights), axis=1, kind="stable")
    rank = np.argsort(order, axis=1)
    found = np.sort(np.take_along_axis(rank, placed[near], axis=1).ravel())
    probes = int(found[math.ceil(params.recall * len(found)) - 1]) + 1
    return Router(weights, probes)


def trained(rows: DataFrame, dim: int, params: Params) -> Router:
    """Router fitted in one task on the ``sample`` rows (vector) with the least hashes; only its weights leave the task."""
    # copies of one vector have hashes of their own
    sample = rows.orderBy(F.xxhash64("vector", "id", F.monotonically_increasing_id())).limit(params.sample).select("vector").coalesce(1)
    short_batches(rows.sparkSession, 4096)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [x[np.abs(x).max(axis=1) > 0] for x in (checked(b.column(0), dim)[1] for b in batches)]
        router = fit(np.concatenate(found) if found else np.zeros((0, dim)), params)
        yield pa.RecordBatch.from_arrays([pa.array([router.weights.astype(np.float32).tobytes()], pa.binary()), pa.array([router.probes], pa.int32())], ["weights", "probes"])

    model = stored(sample.mapInArrow(run, "weights binary, probes int"), "neighbours-model").first()
    return Router(np.frombuffer(model.weights, np.float32).reshape(dim + 1, -1), model.probes)


def indexed(rows: DataFrame, dim: int, router: Router) -> DataFrame:
    """(row, id, asked, vector, routes): every row that takes part with its partitions, the first its own; written as a table."""
    shared = rows.sparkSession.sparkContext.broadcast(router)
    short_batches(rows.sparkSession, 2048)
    columns = "id long, asked boolean, vector binary, routes array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, matrix = checked(batch.column(2), dim)
            real = np.abs(matrix).max(axis=1, initial=0) > 0
            place, matrix = place[real], matrix[real]
            routes = shared.value.routes(matrix)
            asked = batch.column(1).take(pa.array(place))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(place)), asked, pa.array([v.tobytes() for v in matrix], pa.binary()),
                pa.array([r[: shared.value.probes if a else 1].tolist() for r, a in zip(routes, asked.to_pylist())], pa.list_(pa.int32()))], [c.split()[0] for c in columns.split(", ")])

    found = rows.select("id", "asked", "vector").mapInArrow(run, columns)
    return stored(found.select(F.monotonically_increasing_id().alias("row"), "*"), "neighbours-rows")


def gathered(rows: DataFrame, name: str) -> DataFrame:
    """Rows (partition, piece, row, id, vector) of one piece as one row of arrays (partition, piece, ..rows, ..ids, ..vectors), written as a table."""
    dealt = rows.repartition(2 * tasks(rows), "partition", "piece").groupBy("partition", "piece").agg(F.sort_array(F.collect_list(F.struct("row", "id", "vector"))).alias("all"))
    columns = [("rows", F.col("all.row")), ("ids", F.col("all.id")), ("vectors", F.col("all.vector"))]
    return stored(dealt.select("partition", "piece", *[c.alias(f"{name}_{n}") for n, c in columns]), f"neighbours-{name}")


def best(query: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Mark of the rows that may be among the ``n`` nearest of each query, from products that can differ in the last bits."""
    product = query @ rows.T
    if len(rows) <= n:
        return np.ones(product.shape, bool)
    least = np.partition(product, -n, axis=1)[:, -n]
    # rounding of a sum of d products, in whatever order
    slip = 4 * rows.shape[1] * np.finfo(float).eps * np.sqrt((query**2).sum(axis=1) * (rows**2).sum(axis=1).max())
    return product >= (least - slip)[:, None]


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up in the order of the dimensions, so equal vectors have equal scores."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def search(rows: DataFrame, asked: Column, params: Params = Params(), id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``nearest`` rows found for each row that ``asked`` marks: (query_id, rank, vec_id, score).

    Score is the inner product of the vectors as they are, in double precision; greater ones come
    first, ties go to smaller ids, null ids last. A query finds every row but itself.

    Null and zero vectors, those with a null or non-finite component and those of another than the most frequent
    length take no part. A row with a null id is no query, but may be found. Rows with one id
    are rows of their own, so a repeated query returns its rows once for each. A table without
    rows gives an empty result. Other columns are ignored.
    """
    spark = rows.sparkSession
    source = rows.select(F.col(id_column).cast("long").alias("id"), (F.coalesce(asked, F.lit(False)) & F.col(id_column).isNotNull()).alias("asked"), F.col(vector).cast("array<double>").alias("vector"))
    dim = common_length(source, "vector")
    if not dim:
        return spark.createDataFrame([], RESULT)
    router = trained(source, dim, params)
    index = indexed(source, dim, router)

    # blocks of a partition hold a bounded number of rows, however many the partition has
    sizes = index.groupBy(F.col("routes")[0].alias("partition")).agg(F.ceil(F.count("*") / params.block).alias("blocks"))
    homes = index.select("row", "id", "vector", F.col("routes")[0].alias("partition")).join(F.broadcast(sizes), "partition")
    blocks = gathered(homes.withColumn("piece", F.pmod(F.xxhash64("row"), F.col("blocks"))), "block")
    calls = index.where("asked").select("row", "id", "vector", F.explode("routes").alias("partition"))
    loads = calls.groupBy("partition").agg(F.ceil(F.count("*") / params.chunk).alias("chunks"))
    chunks = gathered(calls.join(F.broadcast(loads), "partition").withColumn("piece", F.pmod(F.xxhash64("row"), F.col("chunks"))), "query")

    slabs = blocks.withColumn("slab", F.floor(F.col("piece") / params.slab)).drop("piece")
    dealt = chunks.join(F.broadcast(sizes), "partition").withColumn("slab", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / params.slab)))).select("partition", "slab", "piece", "query_rows", "query_ids", "query_vectors")
    place = lambda df: df.withColumn("place", F.xxhash64("partition", "slab")).drop("partition", "slab")
    pairs = met(place(dealt), place(slabs), "place", 2 * tasks(rows))
    short_batches(spark, PACKED_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                query, held = (np.frombuffer(b"".join(r[c])).reshape(-1, dim) for c in ("query_vectors", "block_vectors"))
                asked_rows, rows_ = np.array(r["query_rows"]), np.array(r["block_rows"])
                may = best(query, held, params.nearest + 1)
                may[asked_rows[:, None] == rows_[None, :]] = False
                q, b = np.nonzero(may)
                score = inner(query[q], held[b])
                ids = pa.array(r["block_ids"], pa.int64())
                null, value = ids.is_null().to_numpy(zero_copy_only=False)[b], ids.fill_null(0).to_numpy(zero_copy_only=False)[b]
                order = np.lexsort((value, null, -score, q))
                place_of = np.arange(len(q)) - np.searchsorted(q[order], q[order])
                keep = order[place_of < params.nearest]
                yield pa.RecordBatch.from_arrays([
                    pa.array(asked_rows[q[keep]]), pa.array(np.array(r["query_ids"])[q[keep]]), ids.take(pa.array(b[keep])), pa.array(score[keep])], ["row", "query_id", "vec_id", "score"])

    found = stored(pairs.mapInArrow(run, "row long, query_id long, vec_id long, score double"), "neighbours-found")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.nearest).select("query_id", "rank", "vec_id", "score")
