"""Quality classifier: logistic regression over hashed word n-grams, trained by
follow-the-regularised-leader and applied as sparse dot products.

A word is a run of letters, of digits or of other signs. A document's vector holds
each unigram and bigram with weight count / words; two equal neighbours share one
feature of their own, which lets the model see repetition of any word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import in_fold, map_batches, short_batches, stored, text_or_empty
from recurra.llm.textarrays import BASE, mix, run_hashes, runs, utf8


@dataclass(frozen=True)
class Params:
    bits: int = 18
    #: the model is fitted on at most this many labelled documents, those with the least hash of their id
    sample: int = 12_000
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    scale: float = 8.0
    threshold: float = 0.3


KINDS = np.full(256, 3, np.uint8)
KINDS[[9, 10, 11, 12, 13, 32]] = 0
KINDS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KINDS[48:58] = 2
REPEATED = np.uint64(0x1234567)


def features(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, document) of all n-grams in order of their document, and the number of words of each document."""
    data, offsets = utf8(texts)
    start, end, doc = runs(KINDS[data], offsets)
    words = run_hashes(data, start, end)
    pair = mix(words[:-1] * BASE + words[1:])
    pair[words[:-1] == words[1:]] = REPEATED
    same = doc[:-1] == doc[1:]
    grams = np.concatenate([words, pair[same]])
    owner = np.concatenate([doc, doc[:-1][same]])
    order = np.argsort(owner, kind="stable")
    return (grams[order] >> np.uint64(64 - bits)).astype(np.int64), owner[order], np.bincount(doc, minlength=len(texts))


def vectors(batch: pa.RecordBatch, params: Params) -> pa.RecordBatch:
    """Sparse vector of each labelled text: distinct features and their weights."""
    idx, owner, n = features(batch.column(1), params.bits)
    key, count = np.unique(owner << params.bits | idx, return_counts=True)
    doc = key >> params.bits
    cuts = pa.array(np.searchsorted(doc, np.arange(len(n) + 1)), pa.int32())
    weights = params.scale * count / np.maximum(n[doc], 1)
    return pa.RecordBatch.from_arrays([
        batch.column(0), batch.column(2),
        pa.ListArray.from_arrays(cuts, pa.array((key & ((1 << params.bits) - 1)).astype(np.int32))),
        pa.ListArray.from_arrays(cuts, pa.array(weights, pa.float64())),
    ], ["place", "quality", "idx", "weight"])


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], params: Params) -> tuple[np.ndarray, float]:
    """Weights and bias after ``epochs`` passes of follow-the-regularised-leader (proximal, per coordinate)."""
    size = 1 << params.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last place is the bias

    def weight(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - params.l1, 0)
        return -shrunk / ((params.beta + np.sqrt(n[at])) / params.alpha + params.l2)

    for _ in range(params.epochs):
        for label, idx, x in rows:
            w = weight(idx)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            step = (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / params.alpha
            z[idx] += g - step * w
            n[idx] += g * g
    w = weight(np.arange(size + 1))
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> tuple[np.ndarray, float]:
    """Fit on labelled documents outside the held-out fold.

    The sample is chosen among the labels (lowest id hash first, contradicting labels
    count as the lower one), so its ids are few and known before a text is read. One
    task sees at most ``sample`` sparse vectors. Without labels every score is 0.5.
    """
    short_batches(docs.sparkSession)
    truth = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~in_fold(F.col("doc_id")))
    truth = truth.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    chosen = truth.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(params.sample)
    texts = docs.select(F.col("doc_id"), text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    seen = map_batches(texts.select("place", "text", "quality"), lambda b: vectors(b, params),
                       "place long, quality int, idx array<int>, weight array<double>")
    # repeated documents of an id count once, so that the bound holds
    seen = seen.groupBy("place").agg(F.min_by(F.struct("quality", "idx", "weight"), F.hash("idx")).alias("row")).select("place", "row.*")
    bits = params.bits

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for place, label, idx, x in zip(*batch.columns):
                own = np.append(idx.values.to_numpy(), np.int32(1 << bits)), np.append(x.values.to_numpy(), 1.0).astype(np.float32)
                rows.append((place.as_py(), label.as_py(), *own))
        rows.sort(key=lambda r: r[0])
        w, bias = ftrl([r[1:] for r in rows], params)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(w[at], bias))], ["idx", "weight"])

    model = stored(seen.coalesce(1).mapInArrow(fit, "idx long, weight double"), "quality-model")
    weights, bias = np.zeros(1 << bits), 0.0
    for r in model.collect():  # at most 2**bits + 1 rows
        if r.idx < 0:
            bias = r.weight
        else:
            weights[r.idx] = r.weight
    return weights, bias


def score(docs: DataFrame, model: tuple[np.ndarray, float], params: Params = Params()) -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1) of each text; null texts are empty and get the bias alone.

    Columns that have the name of the new one are replaced.
    """
    short_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits numbers

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, bias = held.value
        for texts in batches:
            idx, owner, n = features(texts, params.bits)
            margin = params.scale * np.bincount(owner, weights[idx], len(texts)) / np.maximum(n, 1) + bias
            yield pa.array(1 / (1 + np.exp(-np.clip(margin, -35, 35))))

    return docs.withColumn("quality_score", scored(text_or_empty()))


def classify(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, null and repeated ids included."""
    rows = docs.select(F.col("doc_id"), F.col("text"))
    scored = score(rows, train(rows, labels, params), params)
    return scored.select(
        "doc_id", in_fold(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= params.threshold).cast("int").alias("predicted"))
