"""Stored histories, published marts, rankings from stored offsets, and interval joins against nested loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from recurra.operators import intervals, ranking
from recurra.operators.extras import scd2_history
from recurra.operators.history import merge_versions
from recurra.plans import models, reporting
from recurra.plans.registry import Source
from recurra.plans.snapshots import StoredHistory

SMALL = "/root/testdata/sf0.001"
KIND = "id string, at date, v string"


def day(text):
    return dt.date.fromisoformat(text)


def rows(df):
    return sorted(map(tuple, df.select("id", "v", "valid_from", "valid_to", "is_current").collect()), key=str)


def test_batches_give_the_history_computed_at_once(spark, tmp_path):
    rng = random.Random(3)
    versions = [(f"k{rng.randint(0, 9)}", day("2020-01-01") + dt.timedelta(rng.randint(0, 400)), rng.choice("abc")) for _ in range(120)]
    versions += [("hot", day("2020-01-01") + dt.timedelta(n), str(n % 7)) for n in range(60)] + versions[:5]
    history = StoredHistory(spark, str(tmp_path / "h"), "id", "at")
    assert history.ranges() is None and history.current() is None
    cuts = [day("2020-01-01"), day("2020-05-01"), day("2020-09-01"), day("2022-01-01")]
    for low, high in zip(cuts, cuts[1:]):
        # each batch repeats a month of the one before
        batch = [v for v in versions if low - dt.timedelta(30) <= v[1] < high]
        history.apply(spark.createDataFrame(batch, KIND))
    want = rows(scd2_history(spark.createDataFrame(versions, KIND), "id", "at"))
    assert rows(history.ranges()) == want
    history.apply(spark.createDataFrame(versions, KIND))  # all of it again, and nothing at all
    history.apply(spark.createDataFrame([], KIND))
    assert rows(history.ranges()) == want and history.current().count() == 11


def test_snapshots_close_keys_that_vanish(spark, tmp_path):
    history = StoredHistory(spark, str(tmp_path / "h"), "id", "at")
    take = lambda when, *r: history.apply(spark.createDataFrame([(k, day(d), v) for k, d, v in r], KIND), day(when))
    take("2020-02-01", ("a", "2020-01-01", "x"), ("b", "2020-01-05", "y"), ("c", "2020-01-09", "z"))
    take("2020-03-01", ("a", "2020-01-01", "x"), ("c", "2020-02-09", "zz"))
    take("2020-04-01", ("a", "2020-01-01", "x"), ("b", "2020-03-20", "back"))
    assert rows(history.ranges()) == sorted([
        ("a", "x", day("2020-01-01"), None, True),
        ("b", "y", day("2020-01-05"), day("2020-03-01"), False), ("b", "back", day("2020-03-20"), None, True),
        ("c", "z", day("2020-01-09"), day("2020-02-09"), False), ("c", "zz", day("2020-02-09"), day("2020-04-01"), False),
    ], key=str)
    take("2020-05-01")  # an empty snapshot closes everything
    assert history.current().count() == 0 and history.ranges().count() == 5


def test_rows_without_key_or_time_are_no_versions(spark):
    now = spark.createDataFrame([("a", "x", day("2020-01-01"))], "id string, v string, valid_from date")
    batch = spark.createDataFrame([(None, day("2020-02-01"), "n"), ("b", None, "n"), ("a", day("2019-01-01"), "late")], KIND)
    assert rows(merge_versions(now, batch, "id", "at")) == [("a", "x", day("2020-01-01"), None, True)]


def test_a_batch_that_fails_leaves_the_history_before(spark, tmp_path):
    history = StoredHistory(spark, str(tmp_path / "h"), "id", "at")
    history.apply(spark.createDataFrame([("a", day("2020-01-01"), "x")], KIND))
    bad = spark.createDataFrame([("a", day("2020-02-01"), "y")], KIND).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        history.apply(bad)
    assert rows(history.ranges()) == [("a", "x", day("2020-01-01"), None, True)]
    assert history.apply(spark.createDataFrame([("a", day("2020-03-01"), "z")], KIND)) == 2
    assert [r[1:4] for r in rows(history.ranges())] == [("x", day("2020-01-01"), day("2020-03-01")), ("z", day("2020-03-01"), None)]


@pytest.mark.parametrize("levels", [0, 1, 3, 12])
def test_interval_join_equals_a_nested_loop(spark, levels):
    rng = random.Random(levels)
    spans = [(n, low, low + rng.choice([-1, 0, 1, 2, 7, 8, 40])) for n in range(80) for low in [rng.randint(-60, 60)]]
    spans += [(80, -100, 100), (81, None, 5), (82, 5, None), (83, -8, -1), (84, 0, 7)]
    points = [(rng.randint(-70, 70),) for _ in range(90)] + [(None,), (0,), (0,), (-8,), (7,)]
    got = intervals.interval_join(
        spark.createDataFrame(spans, "n int, low int, high int"), spark.createDataFrame(points, "at int"), "low", "high", "at", levels
    )
    want = [(n, low, high, p) for n, low, high in spans if None not in (low, high) for (p,) in points if p is not None and low <= p <= high]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_long_intervals_need_few_blocks(spark):
    df = spark.range(1).select(F.size(intervals.cover(F.lit(-5), F.lit(100_000), 20)).alias("n"), F.size(intervals.cover(F.lit(3), F.lit(3))).alias("one"))
    assert df.first()["n"] <= 40 and df.first()["one"] == 1


def test_ranks_come_from_stored_offsets(spark, tmp_path):
    data = [("a", k % 5, k) for k in range(300)] + [("b", 1, 1), ("c", None, 2), ("c", 4, 3)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    ranking.sorted_pieces(df, "g", "v", "id").write.parquet(str(tmp_path / "rows"))
    placed = spark.read.parquet(str(tmp_path / "rows"))
    ranking.piece_offsets(placed, "g").write.parquet(str(tmp_path / "offsets"))
    got = ranking.ranked(placed, spark.read.parquet(str(tmp_path / "offsets")), "g", "rank")
    want = []
    for g in "abc":
        ordered = sorted((r for r in data if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        want += [(*r, n + 1) for n, r in enumerate(ordered)]
    assert sorted(map(str, map(tuple, got.select("g", "v", "id", "rank").collect()))) == sorted(map(str, want))
    empty = ranking.sorted_pieces(df.limit(0), "g", "v", "id")
    assert ranking.ranked(empty, ranking.piece_offsets(empty, "g"), "g", "rank").count() == 0


def test_reports_read_one_month_of_marts_built_once(spark, tmp_path, monkeypatch):
    built = []
    real = models.build
    monkeypatch.setattr(models, "build", lambda *a, **k: built.append(list(a[5])) or real(*a, **k))
    monkeypatch.setattr("recurra.plans.published.shared_dir", lambda _: str(tmp_path))
    first = reporting.kept_movements(Source(spark, SMALL))
    again = reporting.kept_movements(Source(spark, SMALL))
    health = reporting.kept_health(Source(spark, SMALL))
    assert len(built) == 2 and built[0][-1] == "fct_mrr_movements" and "subscription_mrr" not in built[1]
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month_start" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert first.select("month_start").distinct().count() == 1 == health.select("month_start").distinct().count()
    whole = Source(spark, SMALL).marts.mart("fct_mrr_movements")
    assert first.first()["month_start"] == whole.agg(F.max("month_start")).first()[0]


def test_newest_months_come_from_a_store_of_the_last_months(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("recurra.plans.published.shared_dir", lambda _: str(tmp_path))
    marts = Source(spark, SMALL).marts
    for name, months in (("fct_mrr_movements", 1), ("fct_account_monthly_health", 2)):
        got, whole = marts.newest(name, months), marts.mart(name)
        last = whole.agg(F.max("month_start")).first()[0]
        want = whole.where(F.col("month_start") >= F.add_months(F.lit(last), 1 - months))
        assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
    store = [p for p in tmp_path.iterdir() if p.name.endswith("-2")][0]
    assert len([m for m in (store / "fct_mrr_movements" / "build=1").iterdir() if m.name.startswith("month_start=")]) == 3


def test_the_summary_is_built_without_the_marts_of_all_months(spark, tmp_path, monkeypatch):
    built = []
    real = models.build
    monkeypatch.setattr(models, "build", lambda *a, **k: built.extend(a[5]) or real(*a, **k))
    monkeypatch.setattr("recurra.plans.published.shared_dir", lambda _: str(tmp_path))
    s = Source(spark, SMALL)
    got = reporting.kept_summary(s)
    assert "customer_success_summary" in built and not {"fct_account_monthly_health", "subscription_mrr"} & set(built)
    last = s.marts.mart("fct_account_monthly_health").groupBy("account_id").agg(F.max(F.struct("month_start", "health_score", "prev_mrr", "risk_reasons")).alias("s")).select("account_id", "s.*")
    mine = got.select("account_id", F.col("snapshot_date").alias("month_start"), "health_score", "prev_mrr", "risk_reasons")
    assert mine.count() == last.count() > 0 and mine.exceptAll(last).isEmpty()
    month = got.agg(F.max("snapshot_date")).first()[0]
    whole = s.marts.mart("fct_mrr_movements").where(F.col("month_start") == month)
    assert s.marts.month("fct_mrr_movements", month).exceptAll(whole).isEmpty() and s.marts.month("fct_mrr_movements", month).count() == whole.count()
