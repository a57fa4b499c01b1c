"""Quality rules by brute force and the exact binomial sum; the classifier on its held-out fold."""

import math
import re
from collections import Counter

from recurra.llm import quality_model, quality_rules as rules

MIDDLE = "/root/testdata/sf0.01"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places, covered = {}, set()
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in places.values():
        if len(at) > 1:
            covered.update(k for p in at for k in range(p, p + 8))
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_by_brute_force(spark, edge, edge_rows):
    more = [(100 + i, t) for i, t in enumerate(["a b c d e f g h " * 3, "x y\nx y\n\nx y ", "|#|<>$ %&*", "w " * 19, "w" + " v w" * 40, " ".join("abcdefghij") + " " + " ".join("abcdefghij")])]
    docs = edge.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(*r, "xx") for r in more], "doc_id long, text string, lang string"))
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rules.measures(docs).collect())
    assert got == Counter((i, *counts(t)) for i, t in [*[r[:2] for r in edge_rows], *more])


def test_allowed_losses_is_the_exact_binomial_bound(spark):
    def exact(n, risk, failure):
        k, total = -1, 0.0
        while True:
            total += math.comb(n, k + 1) * risk ** (k + 1) * (1 - risk) ** (n - k - 1)
            if total > failure:
                return k
            k += 1

    ns = [1, 10, 299, 767, 768, 2076, 5000]
    df = spark.createDataFrame([(n,) for n in ns], "n long")
    got = {r.n: r.k for r in df.select("n", rules.allowed_losses(df.n, 0.01, 0.002).alias("k")).collect()}
    assert got == {n: exact(n, 0.01, 0.002) for n in ns}


def test_cutoffs_keep_the_promise_and_need_enough_labels(spark):
    rows = [(i, "en", 0.0 if i % 100 else 0.5, 1) for i in range(4000)] + [(5000 + i, "en", 0.4, 0) for i in range(300)] + [(9000 + i, "de", 0.0, 1) for i in range(50)] + [(9100, "de", 0.9, 0)]
    data = spark.createDataFrame([(i, s, v, *[0.0] * 4, q) for i, s, v, q in rows], "doc_id long, stratum string, " + ", ".join(f"{r} double" for r in rules.RULES) + ", quality int")
    found = {(r.stratum, r.rule): r for r in rules.cutoffs(data.drop("quality"), data.select("doc_id", "quality")).collect()}
    assert set(found) == set()  # one good document in a hundred exceeds every useful cutoff: too many for a risk of 0.05 / 5
    loose = rules.Params(risk=0.15)
    found = {(r.stratum, r.rule): r for r in rules.cutoffs(data.drop("quality"), data.select("doc_id", "quality"), loose).collect()}
    assert set(found) == {("en", "symbol_share")}  # 50 labels certify nothing
    r = found["en", "symbol_share"]
    assert r.losses == 40 <= r.allowed and r.cutoff < 0.4


def test_rules_on_edge_rows(edge, edge_rows, none, no_labels):
    rows = rules.apply_rules(edge, no_labels).collect()
    assert len(rows) == len(edge_rows)
    assert all(r.kept != r.base_failed for r in rows)
    assert {r.doc_id for r in rows if r.kept} == {4, 5, 6, 7}
    kept = rules.keep_good(edge, no_labels)
    assert kept.schema == edge.schema and kept.count() == sum(r.kept for r in rows)
    assert rules.apply_rules(none, no_labels).count() == 0 and rules.keep_good(none, no_labels).count() == 0


def test_classifier_on_its_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_model.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    order = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert order > 0.95 and sum(s >= 0.3 for s in good) / len(good) > 0.98
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_classifier_on_edge_rows(edge, edge_rows, none, no_labels):
    rows = quality_model.classify(edge, no_labels).collect()
    assert len(rows) == len(edge_rows) and {r.score for r in rows} == {0.5}
    labels = edge.selectExpr("doc_id", "cast(doc_id % 2 as int) quality").unionByName(edge.selectExpr("doc_id", "cast(null as int) quality"))
    scores = quality_model.classify(edge, labels).collect()
    assert len(scores) == len(edge_rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in scores)
    assert quality_model.classify(none, no_labels).count() == 0


def test_batched_features_equal_single_ones():
    import pyarrow as pa

    texts = ["a b a", "", "x!! y!!", "é é é 12"]
    idx, owner, n = quality_model.features(pa.array(texts), 18)
    for k, t in enumerate(texts):
        one, _, m = quality_model.features(pa.array([t]), 18)
        assert sorted(idx[owner == k]) == sorted(one) and n[k] == m[0]
