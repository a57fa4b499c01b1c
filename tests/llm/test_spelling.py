"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from recurra.llm import spelling
from recurra.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def distance_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(counts, params=spelling.Params()):
    counts = {w: n for w, n in counts.items() if n >= params.repeats and len(w) >= params.least}
    by_size = defaultdict(list)
    for w in counts:
        by_size[len(w)].append(w)
    near = {w: [x for d in (-1, 0, 1) for x in by_size[len(w) + d] if distance_one(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= params.factor * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def rows_of(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def vocabulary(seed, n, letters):
    rng = random.Random(seed)
    out = Counter()
    for _ in range(n):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(5, 13)))
        for _ in range(rng.randint(1, 6)):
            out[w] += rng.choice([1, 2, 5, 20, 60, 700])
            k, c = rng.randrange(len(w) + 1), rng.choice(letters)
            w = rng.choice([w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :], w])
    return out


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "aàé×z", "漢字ab🎉é"])
def test_variants_against_all_pairs(spark, letters):
    counts = vocabulary(len(letters), 250, letters)
    table = spark.createDataFrame([(w, n, "x", 1) for w, n in counts.items()], "word string, n long, form string, id int").repartition(4)
    assert rows_of(spelling.variants(table)) == plain(counts)


@pytest.mark.parametrize("params", [spelling.Params(least=4, shortest=1, longest=3, nodes=5), spelling.Params(least=9, shortest=3, longest=5, nodes=40, factor=3), spelling.Params(least=7, shortest=2, longest=2), spelling.Params(nodes=1)])
def test_variants_with_other_grams(spark, params):
    counts = vocabulary(9, 200, "abcd")
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variants(table, params)) == plain(counts, params)


def test_every_near_pair_shares_a_key():
    rng = random.Random(4)
    params = spelling.Params()
    words = list(vocabulary(4, 400, "abc"))
    frequent = np.unique(np.concatenate([spelling.gram_marks(c, q).ravel()[::2] for _, c in spelling.by_length(words) for q in (2, 3) if c.shape[1] > q]))

    def keys(word):
        (_, codes), = spelling.by_length([word])
        ends = spelling.gram_ends(codes, frequent, params)
        found = spelling.cuts(ends, codes.shape[1], params)
        assert all((b > a - 1) for a, b in zip(*found[1:])) and (found[1] > 0).any() and (found[2] < codes.shape[1]).any()
        return set(zip(spelling.keys(codes, *found, spelling.BASE).tolist(), spelling.keys(codes, *found, spelling.OTHER).tolist()))

    for w in (w for w in words if len(w) >= 7):
        k, c = rng.randrange(len(w)), rng.choice("abcx")
        for other in (w[:k] + c + w[k:], w[:k] + c + w[k + 1 :], w[:k] + w[k + 1 :], w + c, c + w):
            assert keys(w) & keys(other), (w, other)


def test_chains_ties_nulls_and_long_words(spark):
    long = "x" * 20_000
    counts = {"abcdefgh": 2, "abcdefgi": 30, "abcdefgj": 30, "abcdefgk": 5, "abcdefik": 400, "abcdefikk": 5000, long: 3, long + "y": 40, long[:-1]: 2, "short": 99, "oncewords": 1}
    rows = [*counts.items(), (None, 9), ("nullcount", None), ("abcdefgh", 1)]
    got = rows_of(spelling.variants(spark.createDataFrame(rows, "word string, n long")))
    assert got == plain(counts | {"abcdefgh": 3})
    assert got["abcdefgh"][:2] == ("abcdefgi", "abcdefgi") and got[long][0] == long + "y"
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0
    assert spelling.variants(spark.createDataFrame([("seldomword", 1)], "word string, n long")).count() == 0
    with pytest.raises(ValueError):
        spelling.Params(least=4)


def plain_counts(rows, changed):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if changed and doc is not None and h % changed == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                out[run] += 1
    return out


def test_words_of_odd_texts(spark, edge, edge_rows, none):
    extra = [(20, "ÀÉÎabcde ÀÉÎABCDE×÷ wordabc1wordabc Straße-straßen ſeventeen"), (-3, "Seventeen seventeen SEVENTEEN " * 9), (None, "Seventeen")]
    docs = edge.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    for changed in (None, 2, 31):
        got = {r.word: r.n for r in spelling.count_words(docs, changed=changed).collect()}
        assert got == plain_counts([(r[0], r[1]) for r in edge_rows] + extra, changed)
    assert spelling.variants(spelling.count_words(none)).count() == 0


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(QUERIES["op13_spelling_variants"](spark, SMALL)) == plain(plain_counts(docs, 31))
