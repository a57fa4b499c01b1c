"""Join, aggregation, window, ordering and set shapes the metric models rely on.

Facts are reduced before they are joined wherever the shape allows it. No side
carries a broadcast hint: small dimensions are broadcast from their statistics,
everything else is co-partitioned and split by AQE if a key is hot.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from recurra.config import Tables
from recurra.functions.expr import (
    MONEY,
    count_if,
    day,
    mean_exact,
    month_key,
    month_start,
    next_month,
    rounded,
    safe_divide,
)
from recurra.operators.intervals import interval_join
from recurra.operators.mrr import account_month_mrr, invoice_monthly
from recurra.operators.ranking import positions, rank_within
from recurra.operators.reports import whole
from recurra.operators.spine import account_months, with_months

# --- joins -------------------------------------------------------------------


def join_inner(t: Tables) -> DataFrame:
    price = t.plans.select("plan_id", "monthly_price")
    return (
        t.subscriptions.join(t.accounts.select("account_id", "region"), "account_id")
        .join(price, "plan_id")
        .select("subscription_id", "account_id", "region", "plan_name", "monthly_price", "mrr")
    )


def join_left_multi(t: Tables, as_of: dt.date) -> DataFrame:
    """Account-months with four signals, each reduced to (account, month) first."""
    keys = ["account_id", "month_start"]
    at = lambda c: month_start(F.col(c).cast("date")).alias("month_start")
    mrr = account_month_mrr(t.subscriptions, as_of).select(*keys, "mrr")
    events = t.usage_events.groupBy("account_id", at("occurred_at")).agg(F.count(F.lit(1)).alias("events"))
    tickets = t.tickets.groupBy("account_id", at("created_at")).agg(F.count(F.lit(1)).alias("tickets"))
    failed = invoice_monthly(t.invoices).select(*keys, "failed_payments")
    grid = account_months(t.accounts, as_of).select(*keys)
    joined = grid.join(mrr, keys, "left").join(events, keys, "left").join(tickets, keys, "left").join(failed, keys, "left")
    z = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return joined.select(*keys, z("mrr"), z("events"), z("tickets"), z("failed_payments"))


def join_month_spine(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Interval join with the month spine as a generator: no join at all."""
    last = F.least(F.coalesce("end_date", day(as_of)), day(as_of))
    return with_months(subscriptions, F.col("start_date"), last).select("subscription_id", "month_start")


def join_theta_spine(subscriptions: DataFrame, months: DataFrame, as_of: dt.date) -> DataFrame:
    """The same interval join against a real month table.

    Days are positions and intervals are covered by aligned blocks of days, so this is an
    equi-join on blocks instead of a nested loop over all months.
    """
    last = F.least(F.coalesce("end_date", day(as_of)), day(as_of))
    spans = subscriptions.select(
        "subscription_id", F.unix_date(month_start("start_date")).alias("low"), F.unix_date(last).alias("high")
    )
    spine = months.select("month_start", F.unix_date("month_start").alias("at"))
    return interval_join(spans, spine, "low", "high", "at").select("subscription_id", "month_start")


def join_truncated_key(events: DataFrame, months: DataFrame) -> DataFrame:
    """Events meet their month row on the truncated timestamp, after counting."""
    counted = events.groupBy(
        "account_id", F.date_trunc("month", "occurred_at").cast("date").alias("month_start")
    ).agg(F.count(F.lit(1)).alias("events"))
    return counted.join(months, "month_start").select("account_id", "month_start", "month_key", "events")


def join_shifted_self(account_mrr: DataFrame) -> DataFrame:
    later = account_mrr.select(
        "account_id", F.add_months("month_start", -1).alias("month_start"), F.col("mrr").alias("next_mrr")
    )
    return account_mrr.select("account_id", "month_start", "mrr").join(later, ["account_id", "month_start"])


def join_anti_correlated(account_mrr: DataFrame) -> DataFrame:
    """Paying account-months without a paying month right after."""
    paying = account_mrr.where(F.col("mrr") > 0).select("account_id", "month_start", "mrr")
    follow = paying.select("account_id", F.add_months("month_start", -1).alias("month_start"))
    return paying.join(follow, ["account_id", "month_start"], "left_anti")


def join_semi(t: Tables) -> DataFrame:
    """Usage events of accounts that ever failed a payment."""
    failing = t.invoices.where(F.col("status") == "failed").select("account_id").distinct()
    return t.usage_events.join(failing, "account_id", "left_semi").select("event_id", "account_id", "event_type")


def join_null_coalesced(leads: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Leads and group totals meet on a plan that may be missing on both sides."""
    plan = subscriptions.where(F.col("status") == "active").groupBy("account_id").agg(F.max("plan_name").alias("plan_name"))
    rows = leads.select("lead_id", "account_id").join(plan, "account_id", "left")
    sizes = rows.groupBy("plan_name").agg(F.count(F.lit(1)).alias("group_size"))
    named = sizes.select(F.coalesce("plan_name", F.lit("unknown")).alias("plan_group"), "group_size")
    return (
        rows.withColumn("plan_group", F.coalesce("plan_name", F.lit("unknown")))
        .join(named, "plan_group", "left")
        .select("lead_id", "plan_name", "group_size")
    )


def join_left_on_filter(t: Tables) -> DataFrame:
    """Every account with its critical tickets: the condition narrows the right side only."""
    critical = t.tickets.where(F.col("priority") == "critical").groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    return t.accounts.select("account_id").join(critical, "account_id", "left").select(
        "account_id", F.coalesce("n", F.lit(0)).alias("critical_tickets")
    )


def join_scalar_subquery(account_mrr: DataFrame) -> DataFrame:
    newest = account_mrr.select(F.max("month_start")).scalar()
    return account_mrr.where(F.col("month_start") == newest).select("account_id", "month_start", "mrr", "plan_name")


def join_denormalize_back(subscriptions: DataFrame) -> DataFrame:
    """Subscriptions next to the totals of their plan and status."""
    keys = ["plan_name", "status"]
    totals = subscriptions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("group_rows"), F.sum("mrr").cast(MONEY).alias("group_mrr")
    )
    return subscriptions.join(totals, keys).select(
        "subscription_id", *keys, "mrr", "group_rows", "group_mrr",
        rounded(safe_divide("mrr", "group_mrr"), 8).alias("mrr_share"),
    )


# --- aggregations ------------------------------------------------------------


def agg_sum_count_avg(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.groupBy("plan_name").agg(
        F.sum("mrr").cast(MONEY).alias("total"), F.count(F.lit(1)).alias("n"),
        rounded(safe_divide(F.sum("mrr"), F.count("mrr")), 2).alias("mean"),
        F.min("mrr").alias("low"), F.max("mrr").alias("high"),
    )


def agg_conditional_count(tickets: DataFrame) -> DataFrame:
    p = F.col("priority")
    return tickets.groupBy("account_id").agg(
        *[F.count(F.when(p == x, 1)).alias(f"n_{x}") for x in ("low", "medium", "high", "critical")]
    )


def agg_conditional_sum(invoices: DataFrame) -> DataFrame:
    s = F.col("status")
    return invoices.groupBy("account_id").agg(
        *[F.sum(F.when(s == x, F.col("amount")).otherwise(F.lit(0))).cast(MONEY).alias(f"{x}_amount")
          for x in ("paid", "failed", "pending")]
    )


def agg_filter_clause(invoices: DataFrame) -> DataFrame:
    """The FILTER clause itself, through the SQL expression parser."""
    return invoices.groupBy("account_id").agg(
        F.expr("count(*) FILTER (WHERE status = 'paid')").alias("paid_invoices"),
        F.expr("sum(amount) FILTER (WHERE status = 'failed')").cast(MONEY).alias("failed_amount"),
        F.expr("max(paid_date) FILTER (WHERE status = 'paid')").alias("last_paid"),
    )


def agg_count_distinct(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct("session_id").alias("sessions"),
        F.countDistinct("account_id").alias("accounts"), F.countDistinct(F.col("occurred_at").cast("date")).alias("days"),
    )


def agg_count_distinct_if(invoices: DataFrame) -> DataFrame:
    s = F.col("status")
    return invoices.groupBy(month_key("invoice_date").alias("month_key")).agg(
        F.countDistinct(F.when(s == "failed", F.col("account_id"))).alias("failing_accounts"),
        F.countDistinct(F.when(s == "paid", F.col("account_id"))).alias("paying_accounts"),
    )


def agg_sum_distinct(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.groupBy("account_id").agg(F.sum_distinct("seats_purchased").alias("distinct_seat_sum"))


def agg_mode(accounts: DataFrame) -> DataFrame:
    """Most frequent value, the lowest one on ties."""
    return accounts.groupBy("region").agg(
        F.mode("industry", True).alias("top_industry"), F.mode("company_size", True).alias("top_size"),
        F.mode("acquisition_channel", True).alias("top_channel"),
    )


def agg_median(invoices: DataFrame) -> DataFrame:
    """Exact median of whole days; the buffer holds one counter per distinct day count."""
    waited = F.when(F.col("status") == "paid", F.datediff("paid_date", "invoice_date"))
    return invoices.groupBy(month_key("invoice_date").alias("month_key")).agg(F.percentile(waited, 0.5).alias("median_days"))


def agg_ratio(invoices: DataFrame) -> DataFrame:
    paid = F.sum(F.when(F.col("status") == "paid", F.col("amount")))
    return invoices.groupBy("account_id").agg(
        rounded(safe_divide(paid, F.sum("amount")), 6).alias("collection_rate"),
        rounded(safe_divide(count_if(F.col("status") == "failed"), F.count(F.lit(1))), 6).alias("failure_rate"),
    )


def agg_having_dups(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def agg_global(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.agg(
        F.count(F.lit(1)).alias("subscriptions"), F.sum("mrr").cast(MONEY).alias("mrr"),
        count_if(F.col("status") == "trial").alias("trials"), F.min("start_date").alias("first_start"),
        F.max("start_date").alias("last_start"),
    )


def agg_pct_of_total(subscriptions: DataFrame) -> DataFrame:
    g = subscriptions.groupBy("plan_name").agg(F.sum("mrr").cast(MONEY).alias("mrr"))
    return g.withColumn("pct_of_total", rounded(safe_divide(F.col("mrr"), F.sum("mrr").over(whole())) * 100, 2))


def agg_avg_of_groups(subscriptions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Mean of the channel means and element n div 2 of them in order."""
    channel = accounts.select("account_id", "acquisition_channel")
    means = subscriptions.join(channel, "account_id").groupBy("acquisition_channel").agg(
        rounded(safe_divide(F.sum("mrr"), F.count(F.lit(1))), 2).alias("mean_mrr")
    )
    placed = means.withColumns(
        {
            "place": F.row_number().over(Window.orderBy("mean_mrr", "acquisition_channel")) - 1,
            "n": F.count(F.lit(1)).over(whole()),
        }
    )
    return placed.agg(
        rounded(mean_exact(F.col("mean_mrr")), 2).alias("mean_of_means"),
        F.max(F.when(F.col("place") == F.floor(F.col("n") / 2), F.col("mean_mrr"))).alias("middle_mean"),
    )


def agg_explode_count(health: DataFrame) -> DataFrame:
    return health.select("mrr", F.explode("risk_flags").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("mrr").cast(MONEY).alias("mrr")
    )


def agg_pivot_case(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy("priority").pivot("status", ["open", "in_progress", "escalated", "resolved"]).agg(
        F.count(F.lit(1))
    ).na.fill(0)


def agg_multi_dim(t: Tables) -> DataFrame:
    dims = ["company_size", "acquisition_channel", "region", "industry"]
    accounts = t.accounts.select("account_id", *dims)
    return t.subscriptions.join(accounts, "account_id").groupBy(*dims, "plan_name").agg(
        F.count(F.lit(1)).alias("subscriptions"), F.sum("mrr").cast(MONEY).alias("mrr")
    )


def agg_argmax(t: Tables) -> DataFrame:
    """Channel with the largest MRR per region; the lowest name wins a tie."""
    accounts = t.accounts.select("account_id", "acquisition_channel", "region")
    g = t.subscriptions.join(accounts, "account_id").groupBy("region", "acquisition_channel").agg(
        F.sum("mrr").cast(MONEY).alias("mrr")
    )
    best = g.groupBy("region").agg(F.min(F.struct((-F.col("mrr")).alias("neg"), "acquisition_channel")).alias("b"))
    return best.select("region", F.col("b.acquisition_channel").alias("best_channel"), (-F.col("b.neg")).alias("mrr"))


# --- windows -------------------------------------------------------------------


def win_lag_partition(account_mrr: DataFrame) -> DataFrame:
    w = Window.partitionBy("account_id").orderBy("month_start")
    return account_mrr.select("account_id", "month_start", "mrr", F.lag("mrr").over(w).alias("prev_mrr"))


def win_lag_global(executive: DataFrame) -> DataFrame:
    w = Window.orderBy("month_start")
    return executive.select("month_start", "total_mrr", F.lag("total_mrr").over(w).alias("prev_total_mrr"))


def win_row_number(account_mrr: DataFrame) -> DataFrame:
    w = Window.partitionBy("account_id").orderBy("month_start")
    return account_mrr.select("account_id", "month_start", F.row_number().over(w).alias("month_rank"))


def win_latest_n(account_mrr: DataFrame, n: int = 3) -> DataFrame:
    w = Window.partitionBy("account_id").orderBy(F.desc("month_start"))
    return account_mrr.select("account_id", "month_start", "mrr", F.row_number().over(w).alias("month_rank")).where(
        F.col("month_rank") <= n
    )


def win_distinct_on_first(subscriptions: DataFrame) -> DataFrame:
    first = F.min(F.struct("start_date", "subscription_id", "plan_name")).alias("f")
    return subscriptions.groupBy("account_id").agg(first).select("account_id", "f.*")


def win_distinct_on_latest(subscriptions: DataFrame) -> DataFrame:
    last = F.max(F.struct("start_date", "subscription_id", "plan_name")).alias("f")
    return subscriptions.groupBy("account_id").agg(last).select("account_id", "f.*")


def win_top_per_month(movements: DataFrame, k: int = 10) -> DataFrame:
    grown = movements.where(F.col("expansion_mrr") > 0).select("month_key", "account_id", "expansion_mrr")
    return rank_within(grown, "month_key", "expansion_mrr", "account_id", "expansion_rank", k)


def win_lag_before_limit(executive: DataFrame, n: int = 6) -> DataFrame:
    w = Window.orderBy("month_key")
    return executive.select("month_key", "total_mrr", F.lag("total_mrr").over(w).alias("starting_mrr")).orderBy(
        F.desc("month_key")
    ).limit(n)


def win_running_total(invoices: DataFrame) -> DataFrame:
    """Cumulative collected amount over months, after the monthly sums."""
    g = invoices.where(F.col("status") == "paid").groupBy(month_start("invoice_date").alias("month_start")).agg(
        F.sum("amount").cast(MONEY).alias("collected")
    )
    w = Window.orderBy("month_start").rowsBetween(Window.unboundedPreceding, 0)
    return g.withColumn("cumulative", F.sum("collected").over(w).cast(MONEY))


def win_prior_activity(grid: DataFrame) -> DataFrame:
    w = Window.partitionBy("account_id").orderBy("month_start").rowsBetween(Window.unboundedPreceding, -1)
    return grid.select(
        "account_id", "month_start", "mrr", F.coalesce(F.max(F.col("mrr") > 0).over(w), F.lit(False)).alias("paid_before")
    )


# --- ordering and sets ------------------------------------------------------------


def sort_nulls_last(usage: DataFrame) -> DataFrame:
    """All rows with their position; changes that are unknown come last."""
    rows = usage.select("account_id", "month_start", "events_mom_pct_change")
    return positions(rows, [F.desc_nulls_last("events_mom_pct_change"), F.asc("account_id"), F.asc("month_start")], "position")


def topk_limit(subscriptions: DataFrame, k: int = 20) -> DataFrame:
    return subscriptions.select("subscription_id", "account_id", "mrr").orderBy(F.desc("mrr"), "subscription_id").limit(k)


def page_offset(subscriptions: DataFrame, page: int, size: int) -> DataFrame:
    rows = subscriptions.select("subscription_id", "mrr", "start_date")
    total = rows.select(F.count(F.lit(1))).scalar()
    cut = rows.orderBy(F.desc("start_date"), "subscription_id").offset((page - 1) * size).limit(size)
    return cut.withColumn("total_count", total)


def last_n_months_asc(executive: DataFrame, n: int = 12) -> DataFrame:
    return executive.select("month_key", "total_mrr").orderBy(F.desc("month_key")).limit(n).orderBy("month_key")


def sort_abs(movements: DataFrame) -> DataFrame:
    """All rows with their position by the size of the change."""
    rows = movements.select("account_id", "month_start", "net_mrr_contribution")
    return positions(rows, [F.abs("net_mrr_contribution").desc(), F.asc("account_id"), F.asc("month_start")], "position")


def sort_multi(health: DataFrame) -> DataFrame:
    """All rows with their position, weakest health first and dearest first among equals."""
    rows = health.select("account_id", "month_start", "health_score", "mrr")
    return positions(rows, [F.asc("health_score"), F.desc("mrr"), F.asc("account_id"), F.asc("month_start")], "position")


def union_all_typed_nulls(paying: DataFrame, churn: DataFrame) -> DataFrame:
    """Active and churn rows in one frame; columns one side lacks become typed NULLs."""
    a = paying.select("account_id", "month_start", "mrr", "mrr_movement_type", "plan_name", F.lit(False).alias("is_churned"))
    c = churn.select("account_id", "month_start", "mrr", "mrr_movement_type", F.lit(True).alias("is_churned"))
    return a.unionByName(c, allowMissingColumns=True)


def distinct_months(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.select(month_start("start_date").alias("month_start")).distinct()


def distinct_sorted_values(accounts: DataFrame) -> DataFrame:
    return accounts.select(month_key("created_at").alias("cohort_month")).distinct().orderBy("cohort_month")


def tenant_filter(t: Tables, tenant_id) -> DataFrame:
    """MRR per account of one tenant; the tenant is part of every key."""
    scoped = t.for_tenant(tenant_id)
    return scoped.subscriptions.join(scoped.accounts.select("tenant_id", "account_id"), ["tenant_id", "account_id"]).groupBy(
        "tenant_id", "account_id"
    ).agg(F.count(F.lit(1)).alias("subscriptions"), F.sum("mrr").cast(MONEY).alias("mrr"))
