"""Hard negatives and nearest neighbours against full scans."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recurra.llm import hard_negatives, neighbours, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int, id long, block long, asked string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, 0.5, 3, 9, 8, "x") for i, v, l in rows], SCHEMA).repartition(3)


def random_rows(n, dim, seed, hot=0):
    rng = np.random.default_rng(seed)
    found = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.2, dim)], int(rng.integers(4))) for i in range(n)]
    return found + [(n + k, found[7][1], 1) for k in range(hot)]  # copies of one vector


ODD = [(None, [0.5] * 6, 1), (None, [0.4] * 6, 2), (50, None, 1), (100, [0.1] * 5 + [None], 1), (100, [0.1] * 5 + [math.nan], 1), (100, [0.1] * 5 + [math.inf], 2), (150, [0.0] * 6, 1), (150, [], 1), (150, [0.1] * 7, 1), (200, [0.3] * 6, None), (250, [0.3] * 6, 3), (250, [0.3] * 6, 3)]


def real(v):
    return v is not None and len(v) == 6 and all(x is not None and math.isfinite(x) for x in v)


def plain_negatives(rows, params=hard_negatives.Params()):
    live = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows if l is not None and real(v)]
    out = Counter()
    for k, (a, v, label) in enumerate(live):
        if a is None or a % 50:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), i is None, i or 0, lab, j) for j, (i, w, lab) in enumerate(live)))
        for p, null, pid, lab, j in [s for s in scored if s[3] == label and s[4] != k][: params.positives]:
            inside = [s for s in scored if s[3] != label and params.least * -p <= 100 * -s[0] <= params.most * -p][: params.negatives]
            for r, s in enumerate(inside):
                out[(a, None if null else pid, r + 1, None if s[1] else s[2], -p, -s[0])] += 1
    return out


@pytest.mark.parametrize("rows", [random_rows(700, 6, 1, hot=250) + ODD, random_rows(60, 6, 2), ODD, [(0, [0.25] * 6, 1)], [(0, [0.5] * 6, 1), (1, [0.5] * 6, 1), (2, [0.3] * 6, 2)]])
def test_negatives_against_a_full_scan(spark, rows):
    got = hard_negatives.mine(table(spark, rows), F.col("vec_id") % 50 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, got.collect())) == plain_negatives(rows)


def test_negatives_with_small_blocks_and_strides(spark, monkeypatch):
    monkeypatch.setattr(vectors.packed, "__defaults__", (64,))
    params = hard_negatives.Params(stride=1, first=1, chunk=3, positives=4, negatives=2)
    rows = random_rows(500, 6, 3)
    assert Counter(map(tuple, hard_negatives.mine(table(spark, rows), F.col("vec_id") % 50 == 0, params).collect())) == plain_negatives(rows, params)


def test_negatives_of_large_components(spark):
    """Sums beyond the exact range of doubles stay exact as longs; beyond a long they are an error."""
    rows = [(i, [x * 3.0e4 for x in v], l) for i, v, l in random_rows(200, 6, 4)]
    rows = [(i, [float(np.float32(x)) for x in v], l) for i, v, l in rows]
    assert Counter(map(tuple, hard_negatives.mine(table(spark, rows), F.col("vec_id") % 50 == 0).collect())) == plain_negatives(rows)
    with pytest.raises(Exception, match="exceed a long|too large"):
        hard_negatives.mine(table(spark, [(i, [1e30 * x for x in v], l) for i, v, l in rows]), F.col("vec_id") % 50 == 0).collect()


def test_a_scan_reads_later_dimensions_for_candidates_only():
    rng = np.random.default_rng(0)
    matrix = np.zeros((64, 1000), np.int64)
    matrix[:8] = rng.integers(-100, 100, (8, 1000))
    matrix[:, :5] = 100
    row = {"block": 1, "ids": np.arange(1000).tobytes(), "nulls": np.zeros(1000, np.uint8).tobytes(), "labels": np.ones(1000, np.int64).tobytes(), "asked": np.zeros(1000, np.uint8).tobytes(), "matrix": matrix.tobytes()}
    anchor, seen = np.r_[np.full(8, 100), np.ones(56, np.int64)], []
    best = hard_negatives.Best(3)
    block = hard_negatives.Block(row, 64).exact(100)

    def cut(low, high):
        seen.append(len(low))
        return high >= np.sort(low)[-3]

    rows, scores = hard_negatives.scan(block, anchor, np.arange(1000), cut, hard_negatives.Params())
    assert seen[0] == 1000 and max(seen[1:]) < 50 and len(seen) == 6
    assert (scores == (anchor @ matrix)[rows]).all() and set(range(5)) <= set(rows.tolist()) and best.least is None


def plain_neighbours(rows, n):
    live = [(i, v) for i, v, _ in rows if real(v) and any(v)]
    out = {}
    for k, (q, v) in enumerate(live):
        if q is not None and q % 20 == 0:
            near = sorted((-sum(x * y for x, y in zip(v, w)), i is None, i or 0) for j, (i, w) in enumerate(live) if j != k)[:n]
            out.setdefault(q, []).append([(r + 1, None if null else i, s) for r, (s, null, i) in enumerate(near)])
    return out


def test_neighbours_of_few_rows_are_exact(spark):
    """Below two partitions the search is a full one: odd rows, ties, repeated queries, fewer candidates than asked for."""
    for rows in (ODD + [(20, [0.2] * 6, 1), (40, [0.2] * 6, 1), (60, [-0.2] * 6, None)], random_rows(50, 6, 5, hot=5) + ODD, [(20, [0.1] * 6, 1)], []):
        got = neighbours.search(table(spark, rows), F.col("vec_id") % 20 == 0).collect() if rows else []
        want = plain_neighbours(rows, 20)
        assert Counter((r.query_id, r["rank"], r.vec_id) for r in got) == Counter((q, r, i) for q, lists in want.items() for rows_ in lists for r, i, _ in rows_)
    empty = spark.createDataFrame([], SCHEMA)
    assert neighbours.search(empty, F.col("vec_id") % 20 == 0).count() == 0 and hard_negatives.mine(empty, F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("seed,hot", [(6, 0), (7, 700)])
def test_recall_of_routed_queries(spark, seed, hot):
    rows = random_rows(2400, 6, seed, hot)
    params = neighbours.Params(sample=1500, partitions=12, block=100, chunk=16)
    got = neighbours.search(table(spark, rows), F.col("vec_id") % 20 == 0, params).collect()
    want = plain_neighbours(rows, 20)
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert found.keys() == want.keys() and all(sorted(f) == list(range(1, 21)) for f in found.values())
    exact = dict((i, v) for i, v, _ in rows)
    for q, f in found.items():
        assert [f[k] for k in sorted(f)] == sorted(f.values(), key=lambda x: (-x[1], x[0]))
        assert all(math.isclose(s, sum(x * y for x, y in zip(exact[q], exact[i])), abs_tol=1e-12) for i, s in f.values())
    # scores, not ids: copies of one vector are equally near
    recall = [sum(f[k][1] >= -want[q][0][-1][2] - 1e-12 for k in f) / 20 for q, f in found.items()]
    assert np.mean(recall) >= 0.9


def test_partitions_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.2, (200, 2)) for c in ((0, 0), (5, 0), (0, 5), (5, 5))]).astype(np.float32)
    near = np.argsort(((points[:, None] - points[None]) ** 2).sum(axis=2), axis=1)[:, 1:11]
    home = neighbours.partitioned(points, near, 4, neighbours.Params(rounds=30), np.random.default_rng(2))
    sizes = np.bincount(home, minlength=4)
    assert sizes.max() <= math.ceil(200 * 1.05)
    assert (home[near] != home[:, None]).mean() < 0.3 < (rng.integers(0, 4, 800)[near] != home[:, None]).mean()


def test_router_takes_more_partitions_where_neighbours_spread():
    rng = np.random.default_rng(3)
    tight = np.concatenate([rng.normal(c, 0.02, (100, 16)) for c in rng.normal(0, 1, (20, 16))])
    loose = rng.normal(0, 1, (2000, 16))
    assert neighbours.fit(tight, neighbours.Params()).probes < neighbours.fit(loose, neighbours.Params()).probes / 2
