"""Order statistics and keyed updates against brute force, with one hot group."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from recurra.config import Tables
from recurra.operators import cohorts, extras, incremental, mrr, ranking, spine, usage
from recurra.operators.silver import latest_per_key
from recurra.session import shared_dir


def hot_rows(n=4000):
    rng = random.Random(7)
    # a third of all rows in one group, and there most values tie
    return [("hot", 5 if rng.random() < 0.8 else rng.randint(0, 9), i) if i % 3 == 0 else (f"g{i % 40}", rng.randint(0, 99), i) for i in range(n)]


def brute_rank(rows):
    out = {}
    for g in {r[0] for r in rows}:
        for pos, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1):
            out[(g, r[2])] = pos
    return out


def test_full_rank_spreads_a_hot_group(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "g string, v int, k int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ranking.rank_within(df, "g", "v", "k", "pos")
        got = {(r["g"], r["k"]): r["pos"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute_rank(rows)


def test_top_k_rank_uses_group_limit(spark):
    rows = hot_rows(600)
    top = ranking.rank_within(spark.createDataFrame(rows, "g string, v int, k int"), "g", "v", "k", "pos", 3)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    want = {k: p for k, p in brute_rank(rows).items() if p <= 3}
    assert {(r["g"], r["k"]): r["pos"] for r in top.collect()} == want


def test_nearest_rank(spark):
    rows = hot_rows(999)
    got = ranking.nearest_rank(spark.createDataFrame(rows, "g string, v int, k int"), ["g"], "v", {"p50": 0.5, "p99": 0.99})
    for r in got.collect():
        vs = sorted(v for g, v, _ in rows if g == r["g"])
        assert r["p50"] == vs[int(len(vs) * 0.5)] and r["p99"] == vs[min(int(len(vs) * 0.99), len(vs) - 1)]


def test_latest_per_key_keeps_the_newest_of_many_copies(spark):
    rows = [(1, v, dt.datetime(2020, 1, 1) + dt.timedelta(minutes=v)) for v in range(500)] + [(2, 7, dt.datetime(2020, 1, 1))]
    df = spark.createDataFrame(rows, "id long, v int, at timestamp_ntz").repartition(5)
    assert sorted((r["id"], r["v"]) for r in latest_per_key(df, ["id"], "at").collect()) == [(1, 499), (2, 7)]


def test_latest_per_key_shuffles_no_column_twice(spark):
    rows = [(1, "a", None, 1), (1, "b", "x", 1), (1, None, "z", 1), (2, "c", None, None), (2, None, None, None), (3, None, "y", 2), (3, "q", "q", 1)]
    df = spark.createDataFrame(rows, "id long, v string, w string, at long").repartition(3)
    newest = latest_per_key(df, ["id"], "at", ["v", "w"])
    assert sorted(map(tuple, newest.collect())) == [(1, "b", "x", 1), (2, "c", None, None), (3, None, "y", 2)]
    assert "max_by" not in newest._jdf.queryExecution().optimizedPlan().toString()


def test_scd2_is_ordered_across_months(spark):
    days = [dt.date(2020, 1, 5), dt.date(2020, 1, 20), dt.date(2020, 4, 1), dt.date(2020, 4, 1)]
    df = spark.createDataFrame([(1, d, i) for i, d in enumerate(days)], "id long, at date, v int")
    got = sorted((r["valid_from"], r["valid_to"], r["v"], r["is_current"]) for r in extras.scd2_history(df, "id", "at").collect())
    assert got == [(days[0], days[1], 0, False), (days[1], days[2], 1, False), (days[2], None, 3, True)]


def test_upsert_counts_and_result(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    at = dt.datetime(2020, 1, 1)
    changes = spark.createDataFrame([(2, "x", at), (2, "y", at + dt.timedelta(hours=1)), (3, "c", at), (4, "d", at)], "id long, v string, at timestamp_ntz")
    assert tuple(incremental.upsert_counts(target, changes, ["id"]).collect()[0]) == (2, 1)
    got = incremental.upsert_by_key(target, changes, ["id"], "at")
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "y"), (3, "c"), (4, "d")]


class FakeSession:
    """The setting is fixed when a session starts, so the test hands over its own."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: folder)})


def test_shared_dir_follows_the_session():
    assert shared_dir(FakeSession("yarn", "hdfs://x/ck")) == "hdfs://x/ck"
    with pytest.raises(ValueError):
        shared_dir(FakeSession("yarn", None))


def test_no_broadcast_hint_on_growing_sides(spark):
    from recurra.plans.registry import QUERIES
    import __spark_entry__ as e
    from tests.conftest import SMALL

    e.queries()
    for name in ("fct_mrr_movements", "health_signals", "fct_sales_conversion", "join_theta_spine"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
        assert "strategy=broadcast" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_time_to_value_takes_the_next_core_action(spark):
    d = lambda n: dt.datetime(2020, 1, n)
    events = spark.createDataFrame([(1, "a", d(3)), (1, "a", d(9)), (1, "x", d(4)), (2, "a", d(1))], "account_id long, feature_id string, occurred_at timestamp_ntz")
    leads = spark.createDataFrame([(1, 1, d(3)), (2, 1, d(4)), (3, 1, d(4)), (4, 2, d(2))], "lead_id long, account_id long, trial_started_at timestamp_ntz")
    features = spark.createDataFrame([("a", True), ("x", False)], "feature_id string, is_core boolean")
    r = extras.time_to_value(events, leads, features).collect()[0]
    assert (r["leads"], r["avg_days_to_value"]) == (3, 3.33)


def test_running_months_equal_generated_months(spark):
    rng, end = random.Random(3), dt.date(2003, 6, 15)
    day = lambda: dt.date(2000, 1, 1) + dt.timedelta(days=rng.randint(0, 1500))
    rows = [(k, rng.randint(1, 5) if k % 3 else 1, rng.choice("ab"), rng.choice(["active", "trial"]), rng.choice([None, 3, 7]), day(), rng.choice([None, day()])) for k in range(400)]
    subs = spark.createDataFrame(rows, "subscription_id int, account_id int, plan_name string, status string, seats int, start_date date, end_date date")
    for since in (None, F.lit(dt.date(2002, 3, 1))):
        spans = spine.paid_spans(subs, end, since)
        got = spine.running_months(spans, ["account_id", "plan_name"], "account_id", {"seats": F.col("seats")})
        want = spine.with_months(spans, F.col("_from"), F.col("_to")).groupBy("account_id", "plan_name", "month_start").agg(F.sum("seats").alias("seats"))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(got.columns).collect()), key=str)


def test_usage_counts_are_exact_beyond_the_bits(spark):
    rng = random.Random(8)
    catalogue = spark.createDataFrame([(f"f{k:03}", k % 2 == 0, k % 5 == 0, float(1 + k % 3)) for k in range(90)], "feature_id string, is_core boolean, is_premium boolean, health_weight double")
    names = [f"f{k:03}" for k in range(90)] + ["unknown", "other", None]
    rows = [(k, k % 3 and 1, rng.choice([1, 2, 3, None]), rng.choice(["s", "t", "u", None]), rng.choice(names if k % 3 else names[-2:]), rng.choice([None, 5, 9]), dt.datetime(2020, 1 + k % 2, rng.randint(1, 28))) for k in range(600)]
    events = spark.createDataFrame(rows, "event_id long, account_id int, user_id int, session_id string, feature_id string, duration_seconds int, occurred_at timestamp_ntz")
    got = {(r.account_id, r.month_start.month): r for r in usage.usage_monthly(events, catalogue).collect()}
    known = {r.feature_id: r for r in catalogue.collect()}
    for key in got:
        own = [r for r in rows if (r[1], r[6].month) == key]
        r, feats = got[key], {x[4] for x in own} - {None}
        weights = {known[f].health_weight for f in feats if f in known} | ({0.0} if any(x[4] is None for x in own) else set())
        distinct = lambda i: len({x[i] for x in own} - {None})
        assert (r.total_events, r.active_users, r.total_sessions, r.distinct_features_used, r.active_days_in_month) == (len(own), distinct(2), distinct(3), len(feats), distinct(6))
        assert (r.core_features_used, r.premium_features_used) == (sum(f in known and known[f].is_core for f in feats), sum(f in known and known[f].is_premium for f in feats))
        assert r.feature_adoption_score == (sum(weights) if weights else None) and r.total_duration_seconds == sum(x[5] or 0 for x in own)
    plan = usage.usage_monthly(events, catalogue)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.index("Join")  # rows are expanded after the first aggregation only


@pytest.fixture
def all_keys(spark):
    """Joins ask for all of their keys when rows are dealt, as sessions do by default; small sides are not broadcast."""
    conf = {"spark.sql.requireAllClusterKeysForCoPartition": "true", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def dealt_by_month(df):
    """Shuffles on account and month."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(account_id" in line and "month_start" in line]


def account_rows(spark, *rows):
    schema = "account_id long, company_name string, industry string, region string, country string, company_size string, acquisition_channel string, created_at timestamp_ntz"
    return spark.createDataFrame([(k, f"c{k}", "i", "r", "x", "1-10", "organic", at) for k, at in rows], schema)


def test_cohort_months_are_not_shuffled(spark, subs, all_keys):
    accounts = account_rows(spark, (1, dt.datetime(2020, 1, 5)), (2, dt.datetime(2020, 2, 1)), (3, dt.datetime(2020, 3, 1)))
    s = subs((1, 1, "starter", 10, "2020-01-05", "2020-02-10"), (2, 1, "growth", 5, "2020-04-01", None), (3, 2, "starter", 7, "2020-02-01", None), (4, None, "starter", 9, "2020-01-01", None))
    empty = spark.createDataFrame([], "x int")
    t = Tables(accounts=accounts, plans=empty, features=empty, subscriptions=s, invoices=empty, usage_events=empty, tickets=empty, leads=empty)
    out = cohorts.cohort_base(t, dt.date(2020, 4, 30))
    assert not dealt_by_month(out)
    got = {(r.account_id, r.months_since_created): (float(r.mrr), r.plan_name, r.retention_status, r.cohort_size) for r in out.collect()}
    assert got == {
        (1, 0): (10.0, "starter", "new", 1), (1, 1): (10.0, "starter", "retained", 1), (1, 2): (0.0, None, "churned", 1), (1, 3): (5.0, "growth", "reactivated", 1),
        (2, 0): (7.0, "starter", "new", 1), (2, 1): (7.0, "starter", "retained", 1), (2, 2): (7.0, "starter", "retained", 1),
        (3, 0): (0.0, None, "new", 1), (3, 1): (0.0, None, "inactive", 1),
    }


def test_months_of_an_account_meet_without_a_shuffle_by_month(spark, all_keys):
    day = lambda m: dt.date(2020, m, 1)
    rows = spark.createDataFrame([(1, day(1), "a"), (1, day(1), "twice"), (1, day(2), "b"), (2, day(1), "c"), (None, day(1), "d"), (1, None, "e")], "account_id long, month_start date, v string")
    values = spark.createDataFrame([(1, day(1), 5, None), (1, day(3), 6, "x"), (None, day(1), 7, "y"), (1, None, 8, "z"), (2, day(1), 9, "w")], "account_id long, month_start date, n int, w string")
    out = spine.join_months(rows, values)
    assert out.columns == ["account_id", "month_start", "v", "n", "w"] and not dealt_by_month(out)
    want = rows.join(values, ["account_id", "month_start"], "left")
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_movement_facts_are_dealt_by_account_only(spark, subs, all_keys):
    moves = mrr.movement_rows(subs((1, 1, "starter", 10, "2020-01-05", "2020-02-10")), dt.date(2020, 4, 30))
    paid = spark.createDataFrame([(1, dt.date(2020, 2, 1), 2, 1, 10.0)], "account_id long, month_start date, failed_payments long, successful_payments long, total_invoiced_paid double")
    joined = mrr.joined_facts(moves, account_rows(spark, (1, dt.datetime(2020, 1, 5))), paid)
    assert not dealt_by_month(joined)
    got = sorted((r.month_start.month, r.mrr_movement_type, r.company_name, r.failed_payments) for r in mrr.fact_columns(joined).collect())
    assert got == [(1, "new", "c1", 0), (2, "retained", "c1", 2), (3, "churned", "c1", 0)]
