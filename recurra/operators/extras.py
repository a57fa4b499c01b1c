"""Measures the glossary defines beside the marts: users, time to value, histories, logs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.config import MetricConfig, Tables
from recurra.functions.expr import MONEY, count_if, day, mean_exact, month_start, rounded, safe_divide
from recurra.operators.mrr import account_month_mrr, invoice_monthly
from recurra.operators.ranking import nearest_rank


def arpu(health: DataFrame) -> DataFrame:
    g = health.groupBy("month_start").agg(
        F.sum("mrr").cast(MONEY).alias("mrr"), F.sum("active_users").alias("active_users")
    )
    return g.withColumn("arpu", rounded(safe_divide("mrr", "active_users"), 2))


def time_to_value(events: DataFrame, leads: DataFrame, features: DataFrame) -> DataFrame:
    """Average days from trial start to the first core action on or after it.

    Actions and trials shrink to one row per account and day and are merged in
    date order; the next action is a minimum over the days that follow, so no
    trial is paired with every action of its account.
    """
    core = features.where("is_core").select("feature_id")
    active = events.join(core, "feature_id", "left_semi").select(
        "account_id", F.col("occurred_at").cast("date").alias("d")
    ).distinct()
    started = F.col("trial_started_at").cast("date")
    trials = (
        leads.where(started.isNotNull() & F.col("account_id").isNotNull())
        .groupBy("account_id", started.alias("d"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    merged = active.withColumn("active_day", F.col("d")).unionByName(trials, allowMissingColumns=True)
    # newest first, so that a running minimum sees the days that follow and is never computed anew
    ahead = Window.partitionBy("account_id").orderBy(F.desc("d")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    waits = (
        merged.withColumn("next_day", F.min("active_day").over(ahead))
        .where(F.col("n").isNotNull() & F.col("next_day").isNotNull())
        .withColumn("days", F.datediff("next_day", "d"))
    )
    return waits.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("leads"),
        rounded(safe_divide(F.sum(F.col("days") * F.col("n")), F.sum("n")), 2).alias("avg_days_to_value"),
    )


def feature_stagnation(events: DataFrame, cfg: MetricConfig, as_of: dt.date) -> DataFrame:
    """Accounts whose newest feature was first used too long ago."""
    first = events.groupBy("account_id", "feature_id").agg(F.min(F.col("occurred_at").cast("date")).alias("first_use"))
    newest = first.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("features_adopted"), F.max("first_use").alias("last_adoption")
    )
    idle = F.datediff(day(as_of), "last_adoption")
    return newest.withColumns({"days_since_adoption": idle, "is_stagnant": idle > cfg.stagnation_days})


def downgrade_signal(movements: DataFrame) -> DataFrame:
    """Contraction in this month or the one before, as a frame over month numbers."""
    number = F.year("month_start") * 12 + F.month("month_start")
    rows = movements.withColumn("n", number)
    w = Window.partitionBy("account_id").orderBy("n").rangeBetween(-1, 0)
    hit = F.coalesce(F.max(F.col("contraction_mrr") > 0).over(w), F.lit(False))
    return rows.select("account_id", "month_start", "contraction_mrr", hit.alias("has_downgrade_signal"))


def account_profile(t: Tables, as_of: dt.date, account_id=None) -> DataFrame:
    """Monthly history of one account, or of all: MRR, plan, usage, tickets, invoices."""
    pick = (lambda df: df) if account_id is None else (lambda df: df.where(F.col("account_id") == account_id))
    at = lambda c: month_start(F.col(c).cast("date")).alias("month_start")
    keys = ["account_id", "month_start"]
    mrr = account_month_mrr(pick(t.subscriptions), as_of).select(*keys, "mrr", "plan_name")
    use = pick(t.usage_events).groupBy("account_id", at("occurred_at")).agg(F.count(F.lit(1)).alias("events"))
    tix = pick(t.tickets).groupBy("account_id", at("created_at")).agg(F.count(F.lit(1)).alias("tickets"))
    inv = invoice_monthly(pick(t.invoices)).select(*keys, "failed_payments", "total_invoiced_paid")
    joined = mrr.join(use, keys, "full").join(tix, keys, "full").join(inv, keys, "full")
    names = pick(t.accounts).select("account_id", "company_name")
    z = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return joined.join(names, "account_id").select(
        *keys, "company_name", "plan_name", z("mrr"), z("events"), z("tickets"), z("failed_payments"),
        z("total_invoiced_paid"),
    )


FILTERS = ["region", "plan_name", "industry", "acquisition_channel", "company_size"]


def filter_values(t: Tables) -> DataFrame:
    """Distinct values of every filter; repeated values collapse before the shuffle."""
    dims = [c for c in FILTERS if c != "plan_name"]
    pairs = F.array(*[F.struct(F.lit(c).alias("filter_name"), F.col(c).alias("value")) for c in dims])
    from_accounts = t.accounts.select(F.inline(pairs))
    from_plans = t.subscriptions.select(F.lit("plan_name").alias("filter_name"), F.col("plan_name").alias("value"))
    return from_accounts.unionByName(from_plans).where(F.col("value").isNotNull()).distinct()


def request_path(path: Column) -> Column:
    """Segments shaped like a UUID become ``:id``."""
    clean = F.regexp_replace(path, "/+$", "")
    dashes = lambda s: F.length(s) - F.length(F.regexp_replace(s, "-", ""))
    named = F.transform(F.split(clean, "/"), lambda s: F.when((F.length(s) == 36) & (dashes(s) == 4), ":id").otherwise(s))
    return F.array_join(named, "/")


def request_log_rollup(log: DataFrame, limit: int = 10) -> DataFrame:
    """Requests, errors and latency percentiles of the busiest paths."""
    rows = log.select(request_path(F.col("path")).alias("path"), "latency_ms", (F.col("status") >= 500).alias("is_error"))
    totals = rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("requests"), count_if(F.col("is_error")).alias("errors"),
        rounded(mean_exact(F.col("latency_ms")), 2).alias("avg_ms"),
    )
    ranks = nearest_rank(rows, ["path"], "latency_ms", {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99})
    rate = rounded(safe_divide("errors", "requests") * 100, 2)
    return (
        totals.join(ranks, "path")
        .withColumn("error_rate_pct", rate)
        .orderBy(F.desc("requests"), "path")
        .limit(limit)
    )


def scd2_history(versions: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Validity ranges per key from dated versions.

    The next version is looked up inside (key, month) and across months, so even a
    key with a third of all versions is ordered in month-sized pieces.
    """
    rest = [c for c in versions.columns if c not in (key, updated_at)]
    unique = versions.groupBy(key, updated_at).agg(F.max(F.struct(*rest)).alias("v")).select(key, updated_at, "v.*")
    rows = unique.withColumn("_piece", F.trunc(F.col(updated_at).cast("date"), "MM"))
    inside = Window.partitionBy(key, "_piece").orderBy(updated_at)
    local = rows.withColumn("_next", F.lead(updated_at).over(inside))
    starts = rows.groupBy(key, "_piece").agg(F.min(updated_at).alias("_first"))
    later = starts.select(
        key, "_piece", F.lead("_first").over(Window.partitionBy(key).orderBy("_piece")).alias("_later")
    )
    until = F.coalesce("_next", "_later")
    return local.join(later, [key, "_piece"]).select(
        key, *rest, F.col(updated_at).alias("valid_from"), until.alias("valid_to"), until.isNull().alias("is_current")
    )


def inactive_churn(accounts: DataFrame, events: DataFrame, cfg: MetricConfig, as_of: dt.date) -> DataFrame:
    """Accounts without any activity for the configured number of days."""
    last = events.groupBy("account_id").agg(F.max(F.col("occurred_at").cast("date")).alias("last_active_date"))
    idle = F.datediff(day(as_of), "last_active_date")
    return accounts.select("account_id").join(last, "account_id", "left").select(
        "account_id", "last_active_date", idle.alias("days_inactive"),
        F.coalesce(idle >= cfg.inactive_days, F.lit(True)).alias("is_inactive_churn"),
    )
