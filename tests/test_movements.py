import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from recurra.config import MetricConfig, Tables
from recurra.operators import mrr, spine
from recurra.plans import models, registry
from recurra.plans.store import MartStore

AS_OF = dt.date(2020, 8, 31)
STORY = [
    (1, 1, "starter", 100, "2020-02-01", "2020-02-28"),
    (2, 1, "growth", 150, "2020-03-01", "2020-04-30"),
    (3, 1, "growth", 120, "2020-05-01", "2020-05-31"),
    (4, 1, "starter", 80, "2020-08-01", None),
]


def by_month(df, *cols):
    return {r["month_start"].month: tuple(r[c] for c in cols) for r in df.collect()}


def test_one_account_shows_every_movement(subs):
    got = by_month(mrr.movement_rows(subs(*STORY), AS_OF), "mrr_movement_type", "net_mrr_contribution")
    assert {m: (k, float(v)) for m, (k, v) in got.items()} == {
        2: ("new", 100.0), 3: ("expansion", 50.0), 4: ("retained", 0.0), 5: ("contraction", -30.0),
        6: ("churned", -120.0), 8: ("reactivation", 80.0),
    }


def test_two_subscriptions_are_one_account_month(subs):
    rows = subs((1, 1, "starter", 100, "2020-07-01", None), (2, 1, "growth", 50, "2020-07-01", "2020-07-31"))
    got = by_month(mrr.mrr_movement_type(rows, AS_OF), "mrr", "mrr_delta", "mrr_movement_type", "plan_name")
    assert [float(x) for x in got[7][:2]] == [150.0, 150.0] and got[7][3] == "starter"
    assert float(got[8][1]) == -50.0 and got[8][2] == "contraction"


def test_month_edges_and_trials(subs):
    rows = subs(
        (1, 1, "starter", 10, "2020-01-31", "2020-02-29"), (2, 2, "starter", 10, "2020-01-31", None, "trial"),
        (3, 3, "starter", 10, "2020-05-10", "2020-04-01"),
    )
    got = spine.subscription_months(rows, AS_OF).select("subscription_id", "month_start").collect()
    assert sorted((r[0], r[1].month) for r in got) == [(1, 1), (1, 2)]


def test_no_churn_row_beyond_the_last_month(subs):
    rows = subs((1, 1, "starter", 10, "2020-07-01", "2020-08-15"))
    assert mrr.mrr_churn_rows(rows, AS_OF).count() == 0


def test_zero_base_gives_null_nrr_and_full_grr(spark):
    months = spark.createDataFrame([(dt.date(2020, 1, 1), "2020-01"), (dt.date(2020, 2, 1), "2020-02")], "month_start date, month_key string")
    zeros = {c: F.lit(0).cast("decimal(18,2)") for c in [*mrr.COMPONENTS, "total_mrr", "total_arr", "net_new_mrr"]}
    counts = {c: F.lit(0).cast("bigint") for c in ("active_accounts", "churned_accounts", "total_failed_payments")}
    rows = mrr.exec_rates(months.withColumns({**zeros, **counts, "arpa": F.lit(None).cast("double")})).collect()
    assert all(r["nrr"] is None and r["grr"] == 1.0 and r["logo_churn_rate"] is None for r in rows)


def test_rollforward_dead_band_and_gap(subs):
    rows = subs(
        (1, 1, "starter", 100, "2020-01-01", "2020-02-01"), (2, 1, "starter", 104, "2020-02-01", "2020-03-01"),
        (3, 1, "starter", 120, "2020-03-01", "2020-04-01"), (4, 1, "starter", 120, "2020-06-01", None),
    )
    got = by_month(mrr.mrr_rollforward(rows, MetricConfig(), AS_OF), "movement_type")
    assert got == {1: ("new",), 2: ("retained",), 3: ("expansion",), 4: ("churn",), 6: ("reactivation",), 7: ("retained",)}


def test_components_sum_to_the_change_of_total(spark):
    from recurra.plans.registry import Source
    from tests.conftest import SMALL

    s = Source(spark, SMALL)
    from recurra.sources.adapter import AS_OF as end

    rows = mrr.movement_rows(s.t.subscriptions, end)
    m = rows.groupBy("month_start").agg(F.sum("mrr").alias("t"), F.sum("net_mrr_contribution").alias("n")).orderBy("month_start").collect()
    assert len(m) > 60
    for before, now in zip(m, m[1:]):
        assert now["t"] - before["t"] == now["n"]


def looked_back(spark, out, early, late):
    """Movements built in full in June and refreshed by a look-back build later."""
    for subscriptions, as_of in ((early, dt.date(2020, 6, 30)), (late, AS_OF)):
        t = Tables(**{f.name: None for f in dataclasses.fields(Tables)} | {"subscriptions": subscriptions})
        models.build(spark, t, MetricConfig(), as_of, str(out), ["+mrr_movement_rows"])
    return MartStore(spark, str(out)).read("mrr_movement_rows")


def test_lookback_corrects_two_months_and_ignores_older(spark, subs, tmp_path):
    base = [(1, 1, "starter", 100, "2020-01-01", None), (2, 2, "growth", 60, "2020-02-01", "2020-03-31")]
    late = base + [(3, 1, "starter", 20, "2020-04-01", "2020-04-30"), (4, 2, "growth", 70, "2020-03-01", "2020-03-31"),
                   (5, 2, "growth", 70, "2020-07-01", None)]
    out = looked_back(spark, tmp_path, subs(*base), subs(*late))
    got = {(r["account_id"], r["month_start"].month): (r["mrr_movement_type"], float(r["mrr"])) for r in out.collect()}
    assert got[(1, 4)] == ("expansion", 120.0)  # within the look-back: corrected
    assert got[(1, 5)] == ("contraction", 100.0)
    assert got[(2, 3)] == ("retained", 60.0)  # older: kept as stored
    assert got[(2, 7)] == ("reactivation", 70.0)  # known from the state, not new


def test_incremental_equals_full(spark, subs, tmp_path):
    a = looked_back(spark, tmp_path, subs(*STORY), subs(*STORY))
    b = mrr.movement_rows(subs(*STORY), AS_OF)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(*a.columns).collect()), key=str)


def test_months_of_many_spans_lie_in_more_tasks(spark, subs, monkeypatch):
    rows = subs(*[(k, k, "starter", 10, "2020-02-01", None) for k in range(12)])
    assert mrr.account_month_mrr(rows, AS_OF).rdd.getNumPartitions() <= 4
    want = sorted(map(tuple, mrr.account_month_mrr(rows, AS_OF).collect()))
    monkeypatch.setattr(spine, "SPANS_A_TASK", 2)
    spread = mrr.account_month_mrr(rows, AS_OF)
    assert spread.rdd.getNumPartitions() == 6 and sorted(map(tuple, spread.collect())) == want


def test_newest_paid_months_equal_the_last_of_all(subs):
    rows = subs(*STORY, (5, 2, "growth", 50, "2020-01-01", "2020-01-31"), (6, 3, "growth", 9, "2019-01-01", None), (7, 3, "starter", 9, "2020-08-03", None),
                (8, 4, "starter", 0, "2020-01-01", None), (9, 5, "growth", 7, "2020-08-01", None, "trial"), (10, 6, "growth", 30, "2020-03-01", "2020-03-31"), (11, 6, "starter", -30, "2020-03-01", "2020-04-30"))
    cols = ["account_id", "month_start", "mrr", "prev_mrr", "plan_name", "seat_utilization_rate", "seats_purchased", "seats_used"]
    every = sorted(map(tuple, mrr.mrr_movement_type(rows, AS_OF).select(*cols).collect()))
    want = [r for r in every if sum(o[0] == r[0] and o[1] > r[1] for o in every) < 3]
    assert sorted(map(tuple, mrr.newest_paid_months(rows, AS_OF, 3).select(*cols).collect())) == want and len(want) == 7


def test_what_follows_from_a_movement_row_is_not_dealt_to_months(spark, tmp_path):
    """Components reach the stored marts, but not the rows that are shuffled by month."""
    t, cfg, as_of = registry.Source(spark, "/root/testdata/sf0.001").t, registry.CFG, registry.AS_OF
    models.build(spark, t, cfg, as_of, str(tmp_path), ["+fct_mrr_movements"])
    store = MartStore(spark, str(tmp_path))
    context = models.Context(t, cfg, as_of, store.draft(store.current()), None, 2)
    derived = {*mrr.COMPONENTS, "net_mrr_contribution", "arr"}
    for name in ("mrr_movement_rows", "fct_mrr_movements"):
        assert not derived & set(models.MODELS[name].build(context).columns) and derived < set(store.read(name).columns)
    whole = mrr.fct_mrr_movements(t, cfg, as_of)
    ordered = sorted(whole.columns)
    assert sorted(map(str, store.read("fct_mrr_movements").select(ordered).collect())) == sorted(map(str, whole.select(ordered).collect()))
