"""Versioned marts: selection, look-back builds that read no history, versions that appear whole."""

import dataclasses
import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recurra.operators.incremental import first_paid_months
from recurra.plans import models
from recurra.plans.registry import CFG, Source
from recurra.plans.store import MartStore, shifted

SMALL = "/root/testdata/sf0.001"
MAY, JULY = dt.date(2001, 5, 31), dt.date(2001, 7, 31)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_selection_follows_the_graph():
    assert models.selected(["exec_waterfall"]) == ["exec_waterfall"]
    assert models.selected(["+exec_waterfall"]) == ["subscription_mrr", "payers", "mrr_movement_rows", "exec_waterfall"]
    down = models.selected(["invoice_monthly+"])
    assert down[0] == "invoice_monthly" and {"fct_mrr_movements", "fct_account_monthly_health", "customer_success_summary", "exec_revenue_summary"} < set(down)
    assert "subscription_mrr" not in down and set(models.selected()) == set(models.MODELS)
    for name in models.selected():
        assert all(models.selected().index(u) < models.selected().index(name) for u in models.MODELS[name].upstream)
    with pytest.raises(KeyError):
        models.selected(["nothing"])


def test_months_shift_over_years():
    assert shifted(dt.date(2001, 1, 31), -2) == dt.date(2000, 11, 1) and shifted(dt.date(2000, 12, 5), 1) == dt.date(2001, 1, 1)


def day(text):
    return dt.date.fromisoformat(text)


def test_state_of_first_payments(spark):
    kind = "account_id int, month_start date, mrr double"
    full = [(1, day("2000-01-01"), 5.0), (1, day("2001-04-01"), 5.0), (2, day("2001-03-01"), 0.0), (2, day("2001-05-01"), 9.0), (3, day("2001-04-01"), 1.0)]
    known = first_paid_months(spark.createDataFrame(full, kind))
    assert rows(known) == [(1, day("2000-01-01")), (2, day("2001-05-01")), (3, day("2001-04-01"))]
    # account 3 never paid after all, 2 paid earlier, 4 is new; the months before April are not given
    recent = [(1, day("2001-04-01"), 5.0), (2, day("2001-04-01"), 2.0), (3, day("2001-04-01"), 0.0), (4, day("2001-06-01"), 1.0)]
    got = first_paid_months(spark.createDataFrame(recent, kind), known, day("2001-04-01"))
    assert rows(got) == [(1, day("2000-01-01")), (2, day("2001-04-01")), (4, day("2001-06-01"))]


@pytest.fixture
def source(spark):
    s = Source(spark, SMALL)
    events = [(k, k % 3, d) for k, d in enumerate(["1999-02-03", "2001-05-04", "2001-02-01", "2001-06-01", "2001-07-03", "2001-05-06", "2001-06-07", "2001-07-08"] * 3)]
    events += [(100 + k, 7, d) for k, d in enumerate(["1998-01-01"] * 9 + ["2001-07-02"] * 2)]  # years without usage
    usage = spark.createDataFrame([(k, a, f"view", 1, f"s{k}", 5, dt.datetime.fromisoformat(d)) for k, a, d in events], "event_id long, account_id long, feature_id string, user_id long, session_id string, duration_seconds int, occurred_at timestamp_ntz")
    return dataclasses.replace(s.t, usage_events=usage)


def until(t, end):
    kept = lambda df, c: df.where(F.col(c).cast("date") <= end)
    return dataclasses.replace(t, subscriptions=kept(t.subscriptions, "start_date"), invoices=kept(t.invoices, "invoice_date"), usage_events=kept(t.usage_events, "occurred_at"), tickets=kept(t.tickets, "created_at"))


HEALTH = ["+fct_account_monthly_health", "+fct_mrr_movements"]


def spoil(folder: Path, before: str) -> int:
    """Make every stored month before one unreadable."""
    files = [f for f in folder.rglob("*.parquet") if f.parent.name.startswith("month_start=") and f.parent.name.split("=")[1] < before]
    for f in files:
        f.write_bytes(b"spoilt")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    return len(files)


def test_look_back_equals_a_full_build_and_reads_no_history(spark, source, tmp_path):
    out, whole = str(tmp_path / "marts"), str(tmp_path / "whole")
    models.build(spark, until(source, MAY), CFG, MAY, out, HEALTH, full_refresh=True)
    models.build(spark, source, CFG, JULY, whole, HEALTH, full_refresh=True)
    names = ["fct_account_monthly_health", "fct_mrr_movements", "usage_monthly", "payers"]
    # what is older than the look-back and one month more is not read: March to July are
    assert spoil(tmp_path / "marts", "2001-02-01") > 50
    models.build(spark, source, CFG, JULY, out, HEALTH)
    store, full = MartStore(spark, out), MartStore(spark, whole)
    since = F.col("month_start") >= dt.date(2001, 3, 1)
    for name in names:
        cut = (lambda df: df.where(since)) if models.MODELS[name].monthly else (lambda df: df)
        assert rows(cut(store.read(name))) == rows(cut(full.read(name))), name
    assert "PartitionFilters: [" in store.read("usage_monthly").where(since)._jdf.queryExecution().toString()
    # the state names the last usage before the months that the next build can reach
    last = {r.account_id: (r.month_start, r.total_events) for r in store.read("usage_last").collect()}
    assert last[7] == (day("1998-01-01"), 9) and all(m < day("2001-05-01") for m, _ in last.values())


def test_a_failed_build_leaves_the_version_before(spark, source, tmp_path, monkeypatch):
    out = str(tmp_path / "marts")
    with pytest.raises(LookupError):
        models.build(spark, source, CFG, JULY, out, ["exec_waterfall"])
    assert MartStore(spark, out).current().number == 0 and MartStore(spark, out).read("exec_waterfall") is None
    first = models.build(spark, until(source, MAY), CFG, MAY, out, ["+exec_waterfall"])
    before = rows(MartStore(spark, out).read("exec_waterfall"))

    def broken(c):
        raise RuntimeError("no waterfall")

    with monkeypatch.context() as m:
        m.setitem(models.MODELS, "exec_waterfall", dataclasses.replace(models.MODELS["exec_waterfall"], build=broken))
        with pytest.raises(RuntimeError, match="no waterfall"):
            models.build(spark, source, CFG, JULY, out, ["+exec_waterfall"])
    store = MartStore(spark, out)
    assert store.current() == first and rows(store.read("exec_waterfall")) == before
    newest = store.read("mrr_movement_rows").agg(F.max("month_start")).first()[0]
    assert newest == dt.date(2001, 5, 1)  # upstream rows of the failed build stay unseen
    second = models.build(spark, source, CFG, JULY, out, ["+exec_waterfall"])
    assert second.number == 2 and second.build == 3
    assert rows(MartStore(spark, out).read("exec_waterfall", first)) == before
    with pytest.raises(FileExistsError):  # a build that began before another published
        store.draft(first).publish()


def test_months_that_become_empty_vanish(spark, source, tmp_path):
    out = str(tmp_path / "marts")
    models.build(spark, source, CFG, JULY, out, ["usage_monthly"])
    fewer = dataclasses.replace(source, usage_events=source.usage_events.where("occurred_at < '2001-06-01'"))
    models.build(spark, fewer, CFG, JULY, out, ["usage_monthly"])
    store = MartStore(spark, out)
    assert store.read("usage_monthly").agg(F.max("month_start")).first()[0] == dt.date(2001, 5, 1)
    assert store.current().marts["usage_monthly"].newest == "2001-05-01"
    models.build(spark, dataclasses.replace(source, usage_events=source.usage_events.where("false")), CFG, JULY, out, ["usage_monthly"], full_refresh=True)
    assert MartStore(spark, out).read("usage_monthly").count() == 0
