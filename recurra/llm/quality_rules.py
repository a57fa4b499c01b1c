"""Quality rules whose cutoffs carry a statistical guarantee.

Each rule rejects a document when a share exceeds a cutoff. Labelled documents give,
for each stratum, rule and cutoff of a fixed grid, the number of good documents that
would be lost. Walking from the loosest cutoff to stricter ones, a cutoff is allowed
while the exact binomial bound says that at most ``risk`` of good documents is lost;
the confidence is divided by the number of strata times rules (Bonferroni), and the
risk by the number of rules, so the bound holds for all rules of a stratum together.
Everything is a DataFrame expression.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from recurra.llm.common import stored, text_or_empty

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
#: cutoffs are i / GRID
GRID = 128
RULES = ("symbol_share", "duplicate_line_share", "repeated_word_share", "repeated_window_share", "long_word_share")


@dataclass(frozen=True)
class Params:
    risk: float = 0.05
    failure: float = 0.05
    min_words: int = 20
    max_repeat_percent: int = 30
    #: a cutoff must reject junk this many times as often as good documents
    lift: float = 10.0
    long_word: int = 20
    #: strata by language; every other one, null included, is the stratum "other"
    strata: tuple[str, ...] = ("en", "de", "fr", "es")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also if ``use`` reads it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def covered(hashes: Column) -> Column:
    """Number of words in windows that occur twice or more, from the hashes of all words."""

    def count(windows: Column) -> Column:
        ranked = F.array_sort(F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("p"))))
        repeated = let(ranked, lambda s: F.filter(s, lambda x, i: (
            F.coalesce(F.get(s, i - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["g"] == x["g"], F.lit(False)))))
        places = F.array_sort(F.transform(repeated, lambda x: x["p"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        total = F.aggregate(places, start, lambda s, p: F.struct(
            (s["n"] + p + WINDOW - F.greatest(s["end"], p)).alias("n"), (p + WINDOW).alias("end")))["n"]
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(total)

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    return F.when(F.size(hashes) >= WINDOW, let(hashes, lambda h: let(windows(h), count))).otherwise(0)


def measures(docs: DataFrame, params: Params = Params(), text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, stratum, counts, rule shares) of every row.

    Null texts are empty texts with counts and shares of 0; ids may be null or repeat;
    a missing or unknown language is the stratum "other"; other columns are ignored.
    """
    language = F.col(lang).cast("string") if lang in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text).alias("text"),
                       F.when(language.isin(*params.strata), language).otherwise("other").alias("stratum"))
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id", "stratum",
        (F.size(F.split("text", SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("lines"),
        let(words, lambda w: F.struct(
            F.size(w).alias("n"),
            F.aggregate(w, F.struct(F.lit(0).cast("long").alias("c"), F.lit(0).alias("l")), lambda s, x: F.struct(
                (s["c"] + F.length(x)).alias("c"), (s["l"] + (F.length(x) > params.long_word).cast("int")).alias("l"))).alias("s"),
            let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.struct(
                F.size(F.array_distinct(h)).alias("distinct"), covered(h).alias("repeat"))).alias("h"))).alias("words"),
    )
    n = F.col("words.n")
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    return rows.select(
        "doc_id", "stratum", n.cast("long").alias("n_words"), F.col("words.s.c").alias("word_chars"), "n_symbols",
        F.col("lines.dup").cast("long").alias("n_dup_lines"), F.col("words.h.repeat").cast("long").alias("n_repeat_words"),
        share(F.col("n_symbols"), F.col("words.s.c")).alias("symbol_share"),
        share(F.col("lines.dup"), F.col("lines.n")).alias("duplicate_line_share"),
        share(n - F.col("words.h.distinct"), n).alias("repeated_word_share"),
        share(F.col("words.h.repeat"), n).alias("repeated_window_share"),
        share(F.col("words.s.l"), n).alias("long_word_share"),
    )


def allowed_losses(n: Column, risk: float, failure: float) -> Column:
    """Largest k with P(X <= k) <= failure for X ~ Binomial(n, risk); -1 if there is none.

    With at most k good documents of n lost, the exact (Clopper-Pearson) upper bound of
    the loss rate stays at or below ``risk``. The sum runs over logarithms.
    """
    odds, log_failure = F.log(F.lit(risk / (1 - risk))), F.log(F.lit(failure))
    first = n * F.log(F.lit(1 - risk))
    start = F.struct(first.alias("term"), first.alias("sum"), F.when(first <= log_failure, 0).otherwise(-1).cast("long").alias("k"))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + odds
        total = F.greatest(s["sum"], term) + F.log1p(F.exp(-F.abs(s["sum"] - term)))
        return F.struct(term.alias("term"), total.alias("sum"), F.when(total <= log_failure, i).otherwise(s["k"]).alias("k"))

    upto = F.greatest(F.lit(1).cast("long"), F.ceil(n * risk))
    return F.aggregate(F.sequence(F.lit(1).cast("long"), upto), start, step)["k"]


def cutoffs(measured: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per stratum and rule: (stratum, rule, cutoff, n_good, losses, allowed); no row where no cutoff is both safe and useful.

    ``labels`` has (doc_id, quality); of contradicting labels the lower one counts, null labels none.
    At most (strata + 1) * rules rows.
    """
    truth = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    shares = F.array(*[F.struct(F.lit(r).alias("rule"), F.ceil(F.least(F.col(r), F.lit(1.0)) * GRID).cast("int").alias("bucket")) for r in RULES])
    rows = measured.join(truth, "doc_id").select("stratum", "quality", F.explode(shares).alias("x"))
    counts = rows.groupBy("stratum", "x.rule", "x.bucket").agg(
        F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.sum((F.col("quality") == 0).cast("long")).alias("bad"))
    # at most GRID + 1 buckets for each stratum and rule
    grouped = counts.groupBy("stratum", "rule").agg(
        F.collect_list(F.struct("bucket", "good", "bad")).alias("hist"), F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)
    above = lambda j, what: total(F.transform(F.filter("hist", lambda x: x["bucket"] > j), lambda x: x[what]))
    tests = (len(params.strata) + 1) * len(RULES)
    steps = F.transform(F.sequence(F.lit(0), F.lit(GRID - 1)), lambda j: F.struct(j.alias("j"), above(j, "good").alias("good"), above(j, "bad").alias("bad")))
    tested = grouped.where("n_good > 0 AND n_bad > 0").select(
        "stratum", "rule", "n_good", "n_bad", steps.alias("steps"),
        allowed_losses(F.col("n_good"), params.risk / len(RULES), params.failure / tests).alias("allowed"))
    gain = lambda x: x["bad"] / F.col("n_bad") - params.lift * x["good"] / F.col("n_good")
    useful = F.filter("steps", lambda x: (x["good"] <= F.col("allowed")) & (gain(x) > 0))
    best = F.array_max(F.transform(useful, lambda x: F.struct(gain(x).alias("gain"), x["j"].alias("j"), x["good"].alias("good"))))
    return tested.withColumn("best", best).where("best IS NOT NULL").select(
        "stratum", "rule", (F.col("best.j") / GRID).alias("cutoff"), "n_good", F.col("best.good").alias("losses"), "allowed")


def judged(measured: DataFrame, limits: DataFrame, params: Params = Params()) -> DataFrame:
    """Measured rows with ``base_failed`` and ``kept``; no row is lost and none is added."""
    wide = limits.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])
    base = (F.col("n_words") < params.min_words) | (100 * F.col("n_repeat_words") > params.max_repeat_percent * F.col("n_words"))
    ruled = F.lit(False)
    for r in RULES:
        ruled = ruled | F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False))
    # the broadcast side has one row per stratum: len(strata) + 1 at most
    return (measured.join(F.broadcast(wide), "stratum", "left")
            .withColumn("base_failed", base).withColumn("kept", ~base & ~ruled).drop(*[f"cut_{r}" for r in RULES]))


def apply_rules(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """Counts and verdict of every document. The counts are taken once and stored without texts.

    Empty tables give an empty result; without labels only the base rules decide.
    """
    measured = stored(measures(docs, params), "quality-measures")
    return judged(measured, cutoffs(measured, labels, params), params)


def keep_good(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents, all columns as they are, that pass. Verdicts are computed in the row, so texts are never shuffled."""
    limits = cutoffs(measures(docs, params), labels, params)
    wanted = measures(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), "text", *(["lang"] if "lang" in docs.columns else [])), params)
    # a running number stops the optimiser from taking the counts once more for the filter on the verdict
    held = wanted.withColumn("_row", F.monotonically_increasing_id())
    return judged(held, limits, params).where("kept").select("doc_id.*")
