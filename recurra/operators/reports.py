"""Parameterised reports over the marts. Each returns a frame; nothing is collected.

``month`` defaults to the newest month of the mart, read as a scalar subquery: on
a mart stored by month both the subquery and the filter prune to one partition.
Windows without a partition only see rows already grouped to a few segments.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.config import RISK_LABELS
from recurra.functions.expr import (
    MONEY,
    count_if,
    day,
    divide_or,
    literal_frame,
    mean_exact,
    month_key,
    month_start,
    percent,
    rounded,
    safe_divide,
    share_pct,
)
from recurra.operators.mrr import COMPONENTS

RISKY = ["high", "critical"]
BRIDGE = [c for c in COMPONENTS if c != "retained_mrr"]


def whole() -> Window:
    return Window.partitionBy()


MONTH_DATE = {"month_key": "month_start", "snapshot_month": "snapshot_date"}


def in_month(df: DataFrame, column: str, month=None) -> DataFrame:
    """Rows of one month, named as text or date. The filter uses the date, which marts are stored by."""
    date = MONTH_DATE.get(column, column)
    if month is not None:
        return df.where(F.col(date) == (F.lit(f"{month}-01").cast("date") if date != column else F.lit(month)))
    newest = df.select(F.max(date)).scalar()
    return df.where(F.col(date) == newest)


def newest_months(df: DataFrame, column: str, n: int) -> DataFrame:
    """The last n rows by month, ascending. Every column is computed before the cut."""
    return df.orderBy(F.desc(column)).limit(n).orderBy(column)


def since(as_of: dt.date, months: int) -> Column:
    return F.add_months(day(as_of), -months)


def allowed(dimension: str, *names: str) -> str:
    if dimension not in names:
        raise ValueError(f"dimension must be one of {', '.join(names)}")
    return dimension


def money_sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast(MONEY)


# --- convenience views ----------------------------------------------------------


def current_mrr_summary(executive: DataFrame) -> DataFrame:
    w = Window.orderBy("month_start")
    prev = F.lag("total_mrr").over(w)
    growth = F.when(prev > 0, safe_divide(F.col("total_mrr") - prev, prev)).otherwise(0.0)
    return executive.select(
        "month_start", "total_mrr", "total_arr", "active_accounts", prev.alias("prev_mrr"),
        F.lag("active_accounts").over(w).alias("prev_accounts"), rounded(growth, 6).alias("mrr_growth_rate"),
    )


def active_accounts_health(health: DataFrame, accounts: DataFrame) -> DataFrame:
    latest = in_month(health, "month_start").select(
        "account_id", "month_start", "company_name", "plan_name", "mrr", "health_score", "health_tier", "churn_risk_level"
    )
    return latest.join(
        accounts.select("account_id", "industry", "region", "acquisition_channel", "company_size"), "account_id"
    )


def mrr_waterfall(movements: DataFrame) -> DataFrame:
    return movements.groupBy("month_start").agg(
        *[F.sum(c).cast(MONEY).alias(c) for c in BRIDGE],
        F.sum("net_mrr_contribution").cast(MONEY).alias("net_new_mrr"),
        money_sum(F.when(~F.col("is_churned"), F.col("mrr"))).alias("total_mrr"),
    )


def latest_revenue_by(movements: DataFrame, dimension: str) -> DataFrame:
    rows = in_month(movements, "month_start").where(~F.col("is_churned"))
    return rows.groupBy(dimension).agg(
        F.sum("mrr").cast(MONEY).alias("total_mrr"),
        F.count(F.lit(1)).alias("account_count"),
        rounded(safe_divide(F.sum("mrr"), F.count(F.lit(1))), 2).alias("avg_mrr"),
    )


def top_expanding_accounts(movements: DataFrame, health: DataFrame, limit: int = 10) -> DataFrame:
    top = (
        in_month(movements, "month_start")
        .where(F.col("mrr_movement_type") == "expansion")
        .orderBy(F.desc("expansion_mrr"), "account_id")
        .limit(limit)
    )
    scores = health.select("account_id", "month_start", "health_score")
    return top.join(scores, ["account_id", "month_start"], "left").select(
        "account_id", "company_name", "plan_name", "region", "industry", "expansion_mrr",
        F.col("mrr").alias("ending_mrr"), "health_score",
    )


def churn_risk_accounts(health: DataFrame) -> DataFrame:
    flags = [f"risk_{k}" for k in RISK_LABELS]
    rows = in_month(health, "month_start").where(F.col("health_score") < 75)
    total = sum((F.col(f).cast("int") for f in flags[1:]), F.col(flags[0]).cast("int"))
    return rows.select(
        "account_id", "company_name", "plan_name", "mrr", "health_score",
        F.when(F.col("health_score") >= 50, "at_risk").otherwise("critical").alias("risk_level"), *flags,
        "region", "industry", "acquisition_channel", total.alias("risk_flag_count"),
    ).orderBy("health_score", F.desc("mrr"))


def funnel_summary(conversions: DataFrame) -> DataFrame:
    n, trials = F.count(F.lit(1)), count_if(F.col("trial_started_at").isNotNull())
    paid = F.col("is_paid_conversion")
    won = count_if(paid)
    rate = lambda a, b: rounded(safe_divide(a, b) * 100, 2)
    return conversions.agg(
        n.alias("total_leads"), trials.alias("trial_starts"), won.alias("paid_conversions"),
        rate(trials, n).alias("lead_to_trial_rate"), rate(won, trials).alias("trial_to_paid_rate"),
        rate(won, n).alias("overall_conversion_rate"),
        rounded(mean_exact(F.when(paid, F.col("days_lead_to_paid"))), 1).alias("avg_days_to_convert"),
    )


def current_mrr(subscriptions: DataFrame, accounts: DataFrame) -> DataFrame:
    active = subscriptions.where(F.col("status") == "active")
    attrs = accounts.select("account_id", "company_name", "industry", "region", "company_size", "acquisition_channel")
    return active.join(attrs, "account_id").select(
        "account_id", "subscription_id", "company_name", "industry", "region", "company_size", "acquisition_channel",
        "plan_name", "mrr", "seats_purchased", "seats_used", "status", "start_date",
    )


def latest_health(health: DataFrame) -> DataFrame:
    keep = ["company_name", "plan_name", "mrr", "health_score", "health_tier", "churn_risk_level", "churn_risk_score",
            "risk_flag_count", "risk_reasons", "month_key"]
    newest = health.groupBy("account_id").agg(F.max_by(F.struct(*keep), F.col("month_start")).alias("h"))
    return newest.select("account_id", "h.*")


# --- executive ------------------------------------------------------------------


def exec_kpi(executive: DataFrame, month: str | None = None) -> DataFrame:
    w = Window.orderBy("month_key")
    with_prior = executive.withColumns(
        {
            "p_mrr": F.lag("total_mrr").over(w),
            "p_nrr": F.lag("nrr").over(w),
            "p_churn": F.lag("logo_churn_rate").over(w),
        }
    )
    row = with_prior.where(F.col("month_key") == month) if month else with_prior.orderBy(F.desc("month_key")).limit(1)
    rates = ["nrr", "grr", "logo_churn_rate", "revenue_churn_rate", "mrr_mom_pct"]
    return row.select(
        "month_key", "total_mrr", "total_arr", "active_accounts", "arpa", "net_new_mrr", "churned_accounts",
        *[percent(F.col(c)).alias(c) for c in rates],
        F.col("p_mrr").alias("prev_month_mrr"), percent(F.col("p_nrr")).alias("prev_month_nrr"),
        percent(F.col("p_churn")).alias("prev_month_logo_churn"),
    )


def mrr_trend(executive: DataFrame, months: int = 24) -> DataFrame:
    rates = ["nrr", "grr", "logo_churn_rate", "mrr_mom_pct"]
    cols = ["month_key", "total_mrr", "total_arr", *BRIDGE, "net_new_mrr", "active_accounts"]
    return newest_months(executive.select(*cols, *[percent(F.col(c)).alias(c) for c in rates]), "month_key", months)


# Order, label and kind of the seven bridge steps.
STEPS = [("Starting MRR", "start"), ("New", "positive"), ("Expansion", "positive"), ("Reactivation", "positive"),
         ("Contraction", "negative"), ("Churn", "negative"), ("Ending MRR", "end")]


def waterfall(executive: DataFrame, month: str | None = None) -> DataFrame:
    row = executive.where(F.col("month_key") == month) if month else executive.orderBy(F.desc("month_key")).limit(1)
    start = (F.col("total_mrr") - F.col("net_new_mrr")).cast(MONEY)
    values = [start, *[F.col(f"{k}_mrr") for k in ("new", "expansion", "reactivation", "contraction", "churned")],
              F.col("total_mrr")]
    steps = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(label).alias("label"), F.lit(kind).alias("type"),
                     v.cast(MONEY).alias("value"))
            for i, ((label, kind), v) in enumerate(zip(STEPS, values))
        ]
    )
    signed = F.when(F.col("type") == "negative", -F.col("value")).when(F.col("type") == "end", F.lit(0)).otherwise(F.col("value"))
    run = F.sum(signed).over(Window.partitionBy("month_key").orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    return row.select("month_key", F.inline(steps)).withColumn("cumulative", run.cast(MONEY))


def revenue_by_dimension(movements: DataFrame, dimension: str, month: str | None = None) -> DataFrame:
    d = allowed(dimension, "plan_name", "region", "industry", "company_size")
    g = (
        in_month(movements, "month_key", month)
        .where(F.col("mrr") > 0)
        .groupBy(F.col(d).alias("value"))
        .agg(F.sum("mrr").cast(MONEY).alias("mrr"), F.count(F.lit(1)).alias("account_count"))
    )
    return g.select(
        F.lit(d).alias("dimension"), "value", "mrr", (F.col("mrr") * 12).cast(MONEY).alias("arr"), "account_count",
        rounded(safe_divide("mrr", "account_count"), 2).alias("arpa"),
        share_pct(F.col("mrr"), F.sum("mrr").over(whole())).alias("pct_of_total"),
    )


def top_accounts(success: DataFrame, movements: DataFrame, sort_by: str = "churn_risk", limit: int = 10) -> DataFrame:
    """Highest churn risk, or largest expansion of the month."""
    rows = in_month(success, "snapshot_month")
    if sort_by == "churn_risk":
        rows = rows.where(F.col("churn_risk_level").isin(RISKY)).withColumn("sort_value", F.col("risk_priority_score"))
    else:
        grown = movements.where(F.col("expansion_mrr") > 0).select(
            "account_id", F.col("month_start").alias("snapshot_date"), F.col("expansion_mrr").cast("double").alias("sort_value")
        )
        rows = rows.join(grown, ["account_id", "snapshot_date"])
    return rows.orderBy(F.desc_nulls_last("sort_value"), "account_id").limit(limit).select(
        "account_id", "company_name", "plan_name", "region", "industry", "company_size", "mrr", "arr", "health_score",
        "health_tier", "churn_risk_level", "risk_reasons", "health_trend", "sort_value",
    )


# --- revenue movements ------------------------------------------------------------


def mrr_bridge(executive: DataFrame, months: int = 12) -> DataFrame:
    start = F.lag("total_mrr").over(Window.orderBy("month_key"))
    rows = executive.select(
        "month_key", F.coalesce(start, F.lit(0)).cast(MONEY).alias("starting_mrr"), *BRIDGE, "net_new_mrr",
        F.col("total_mrr").alias("ending_mrr"),
    )
    return newest_months(rows, "month_key", months)


def account_movements(
    movements: DataFrame, month: str | None = None, kind: str | None = None, page: int = 1, page_size: int = 50
) -> DataFrame:
    rows = in_month(movements, "month_key", month)
    if kind:
        rows = rows.where(F.col("mrr_movement_type") == kind)
    cols = ["account_id", "company_name", "plan_name", "region", "industry", "company_size", "month_key", "mrr",
            "mrr_movement_type", *BRIDGE, "net_mrr_contribution", "acquisition_channel"]
    return paged(rows.select(*cols), [F.abs("net_mrr_contribution").desc(), F.col("account_id").asc()], page, page_size)


def paged(rows: DataFrame, order: list[Column], page: int, page_size: int) -> DataFrame:
    """One page plus the total number of rows it was cut from."""
    total = rows.select(F.count(F.lit(1))).scalar()
    cut = rows.orderBy(*order).offset((page - 1) * page_size).limit(page_size)
    return cut.withColumn("total_count", total)


def movement_by(movements: DataFrame, dimension: str, value: str, month: str | None = None) -> DataFrame:
    """Sum, accounts, average and share of one movement component per segment."""
    g = (
        in_month(movements, "month_key", month)
        .where(F.col(value) > 0)
        .groupBy(F.col(dimension).alias("segment"))
        .agg(F.sum(value).cast(MONEY).alias(value), F.count(F.lit(1)).alias("accounts"))
    )
    return g.select(
        "segment", value, "accounts", rounded(divide_or(F.col(value), F.col("accounts")), 2).alias("avg_per_account"),
        share_pct(F.col(value), F.sum(value).over(whole())).alias("pct_of_total"),
    )


def new_mrr_by_channel(movements: DataFrame, month: str | None = None) -> DataFrame:
    return movement_by(movements, "acquisition_channel", "new_mrr", month).withColumnRenamed("segment", "channel")


def expansion_by_segment(movements: DataFrame, dimension: str = "company_size", month: str | None = None) -> DataFrame:
    return movement_by(movements, allowed(dimension, "company_size", "plan_name", "region"), "expansion_mrr", month)


def churned_by_plan(movements: DataFrame, month: str | None = None) -> DataFrame:
    """A churn row has no current plan: the plan of the last paying month counts."""
    return movement_by(movements, "prev_plan_name", "churned_mrr", month).withColumnRenamed("segment", "plan_name")


def payment_trend(invoices: DataFrame, months: int = 12) -> DataFrame:
    s, amount = F.col("status"), F.col("amount")
    n, paid = F.count(F.lit(1)), count_if(s == "paid")
    waited = F.when(s == "paid", F.datediff("paid_date", "invoice_date"))
    g = invoices.groupBy(month_key("invoice_date").alias("month_key")).agg(
        n.alias("total_invoices"), paid.alias("paid_invoices"), count_if(s == "failed").alias("failed_invoices"),
        count_if(s == "pending").alias("pending_invoices"), share_pct(paid, n).alias("payment_success_rate"),
        money_sum(amount).alias("total_invoice_amount"), money_sum(F.when(s == "paid", amount)).alias("collected_amount"),
        money_sum(F.when(s == "failed", amount)).alias("failed_amount"),
        rounded(F.coalesce(mean_exact(waited), F.lit(0.0)), 1).alias("avg_days_to_pay"),
    )
    return newest_months(g, "month_key", months)


# --- cohorts -----------------------------------------------------------------------


def cohort_heatmap(cohorts: DataFrame, metric: str = "logo_retention_rate") -> DataFrame:
    allowed(metric, "logo_retention_rate", "revenue_retention_rate", "nrr", "grr")
    return cohorts.select(
        "cohort_month", "months_since_created", "cohort_size", "active_accounts", "logo_retention_rate",
        "revenue_retention_rate", "nrr", "grr", "cohort_mrr", F.col("cohort_starting_mrr").alias("starting_mrr"),
        "cohort_health", F.lit(metric).alias("metric"), F.col(metric).alias("value"),
    )


def logo_churn_trend(executive: DataFrame, months: int = 24) -> DataFrame:
    rows = newest_months(
        executive.select(
            "month_key", percent(F.col("logo_churn_rate")).alias("logo_churn_rate"), "churned_accounts",
            F.col("prev_active_accounts").alias("starting_accounts"), "active_accounts",
        ),
        "month_key", months,
    )
    return rows.withColumn("avg_logo_churn_rate", rounded(mean_exact_over("logo_churn_rate"), 2))


def mean_exact_over(c: str) -> Column:
    total = F.sum(F.col(c).cast("decimal(38,12)")).over(whole())
    return safe_divide(total, F.count(c).over(whole()))


def nrr_by_cohort(cohorts: DataFrame, period: int = 12, limit: int = 24) -> DataFrame:
    rows = newest_months(
        cohorts.where(F.col("months_since_created") == period).select(
            "cohort_month", "nrr", "grr", "logo_retention_rate", "revenue_retention_rate", "cohort_size",
            "active_accounts", "cohort_mrr", F.col("cohort_starting_mrr").alias("starting_mrr"), "cohort_health",
        ),
        "cohort_month", limit,
    )
    # a missing rate counts as zero in the averages
    avg = lambda c: rounded(
        safe_divide(F.sum(F.coalesce(c, F.lit(0.0)).cast("decimal(38,12)")).over(whole()), F.count(F.lit(1)).over(whole())), 2
    )
    return rows.withColumns({"avg_nrr": avg("nrr"), "avg_grr": avg("grr")})


def retention_by_segment(health: DataFrame, dimension: str, months: int, as_of: dt.date) -> DataFrame:
    d = allowed(dimension, "plan_name", "company_size", "region")
    high = F.when(F.col("churn_risk_level") == "high", 1).otherwise(0)
    return (
        health.where(F.col("month_start") >= since(as_of, months))
        .groupBy(F.col(d).alias("segment_value"))
        .agg(
            rounded(mean_exact(F.col("health_score")), 4).alias("avg_health_score"),
            F.countDistinct("account_id").alias("account_count"),
            rounded(safe_divide(F.sum("mrr"), F.count(F.lit(1))), 2).alias("avg_mrr"),
            F.sum("mrr").cast(MONEY).alias("total_mrr"),
            rounded(safe_divide(F.sum(high), F.count(F.lit(1))) * 100, 4).alias("pct_high_risk"),
        )
    )


# --- health ---------------------------------------------------------------------------


def health_distribution(success: DataFrame, month: str | None = None) -> DataFrame:
    g = (
        in_month(success, "snapshot_month", month)
        .groupBy("health_tier")
        .agg(
            F.count(F.lit(1)).alias("account_count"), F.sum("mrr").cast(MONEY).alias("total_mrr"),
            rounded(mean_exact(F.col("health_score")), 1).alias("avg_health_score"),
            rounded(safe_divide(F.sum("mrr"), F.count(F.lit(1))), 2).alias("avg_mrr"),
        )
    )
    return g.withColumns(
        {
            "pct_of_accounts": share_pct(F.col("account_count"), F.sum("account_count").over(whole())),
            "pct_of_mrr": share_pct(F.col("total_mrr"), F.sum("total_mrr").over(whole())),
        }
    )


ACCOUNT_CARD = ["account_id", "company_name", "plan_name", "region", "industry", "company_size", "mrr", "arr", "health_score",
                "churn_risk_level", "risk_priority_score", "risk_reasons", "health_trend", "health_tier"]


def _priority() -> list[Column]:
    return [F.desc_nulls_last("risk_priority_score"), F.col("account_id").asc()]


def risk_quadrant(success: DataFrame, month: str | None = None, limit: int = 200) -> DataFrame:
    return in_month(success, "snapshot_month", month).select(*ACCOUNT_CARD).orderBy(*_priority()).limit(limit)


def risky_accounts(
    success: DataFrame, month: str | None = None, level: str | None = None, plan: str | None = None,
    page: int = 1, page_size: int = 25,
) -> DataFrame:
    rows = in_month(success, "snapshot_month", month).where(F.col("churn_risk_level").isin(RISKY))
    if level:
        rows = rows.where(F.col("churn_risk_level") == level)
    if plan:
        rows = rows.where(F.col("plan_name") == plan)
    return paged(rows.select(*ACCOUNT_CARD), _priority(), page, page_size)


def support_burden(success: DataFrame, tickets: DataFrame, limit: int = 20) -> DataFrame:
    """Tickets opened in the snapshot month per account; accounts without tickets stay with zero."""
    rows = in_month(success, "snapshot_date").select(
        "account_id", "snapshot_date", "company_name", "plan_name", "mrr", "health_score", "churn_risk_level"
    )
    seconds = F.timestamp_diff("SECOND", F.col("created_at"), F.col("resolved_at"))
    monthly = tickets.groupBy("account_id", month_start(F.col("created_at").cast("date")).alias("snapshot_date")).agg(
        F.count("ticket_id").alias("n"), count_if(F.col("priority") == "high").alias("high"),
        count_if(F.col("status") == "open").alias("open"), mean_exact(seconds / 3600).alias("hours"),
        mean_exact(F.col("csat_score")).alias("csat"),
    )
    z = lambda c: F.coalesce(c, F.lit(0))
    out = rows.join(monthly, ["account_id", "snapshot_date"], "left").select(
        "account_id", "company_name", "plan_name", "mrr", "health_score", "churn_risk_level",
        z("n").alias("total_tickets"), z("high").alias("high_priority_tickets"), z("open").alias("open_tickets"),
        rounded(F.coalesce("hours", F.lit(0.0)), 1).alias("avg_resolution_hours"),
        rounded(F.coalesce("csat", F.lit(0.0)), 2).alias("avg_csat"),
    )
    return out.orderBy(F.desc("total_tickets"), "account_id").limit(limit)


def health_summary(success: DataFrame, month: str | None = None) -> DataFrame:
    return (
        in_month(success, "snapshot_month", month)
        .groupBy("health_tier")
        .agg(
            F.count(F.lit(1)).alias("account_count"),
            rounded(mean_exact(F.col("health_score")), 1).alias("avg_health_score"),
            F.sum("mrr").cast(MONEY).alias("total_mrr"),
            rounded(mean_exact(F.col("churn_risk_score")), 1).alias("avg_churn_risk_score"),
        )
    )


def risk_flag_breakdown(success: DataFrame, month: str | None = None) -> DataFrame:
    """Accounts and MRR at risk per flag; flags nobody has are kept with zeros."""
    rows = in_month(success, "snapshot_month", month).where(F.col("churn_risk_level").isin(RISKY))
    found = rows.select("mrr", F.explode("risk_flags").alias("flag")).groupBy("flag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("mrr").alias("m")
    )
    every = literal_frame(success.sparkSession, "flag, definition", list(RISK_LABELS.items()))
    return every.join(found, "flag", "left").select(
        "flag", "definition", F.coalesce("n", F.lit(0)).alias("account_count"),
        F.coalesce("m", F.lit(0)).cast(MONEY).alias("at_risk_mrr"),
    )


def account_health_trend(health: DataFrame, months: int = 12, account_id=None) -> DataFrame:
    """Last months of one account, or of every account, with the direction of the newest step."""
    rows = health if account_id is None else health.where(F.col("account_id") == account_id)
    back = Window.partitionBy("account_id").orderBy(F.desc("month_start"))
    newest = F.max(F.when(F.col("recency") == 1, F.col("health_score"))).over(Window.partitionBy("account_id"))
    second = F.max(F.when(F.col("recency") == 2, F.col("health_score"))).over(Window.partitionBy("account_id"))
    cut = rows.withColumn("recency", F.row_number().over(back)).where(F.col("recency") <= months)
    trend = F.when(second.isNull(), "stable").when(newest > second, "improving").otherwise("declining")
    return cut.select(
        "account_id", "month_key", "health_score", "health_tier", "churn_risk_level", "mrr", "risk_reasons",
        trend.alias("trend"),
    )


def usage_drop_alerts(health: DataFrame, threshold: float = 0.4, month: str | None = None, limit: int = 50) -> DataFrame:
    now = in_month(health, "month_key", month).select(
        "account_id", "month_start", "company_name", "plan_name", "mrr", "health_score", "churn_risk_level",
        F.col("active_users").alias("cur_mau"),
    )
    before = health.where(F.col("active_users") > 0).select(
        "account_id", F.add_months("month_start", 1).alias("month_start"), F.col("active_users").alias("prev_mau")
    )
    change = safe_divide(F.col("cur_mau") - F.col("prev_mau"), F.col("prev_mau"))
    return (
        now.join(before, ["account_id", "month_start"])
        .withColumn("change", change)
        .where(F.col("change") <= -threshold)
        .orderBy("change", "account_id")
        .limit(limit)
        .select(
            "account_id", "company_name", "plan_name", "mrr", "health_score", "churn_risk_level", "cur_mau", "prev_mau",
            rounded(F.col("change") * 100, 1).alias("usage_change_pct"),
        )
    )


# --- funnel -----------------------------------------------------------------------------


def recent_leads(conversions: DataFrame, months: int, as_of: dt.date) -> DataFrame:
    opened = month_start(F.col("lead_created_at").cast("date"))
    return conversions.where(opened >= since(as_of, months))


def _funnel_measures() -> dict[str, Column]:
    paid = F.col("is_paid_conversion")
    return {
        "total_leads": F.count(F.lit(1)),
        "trial_starts": count_if(F.col("funnel_stage").isin("trial", "paid")),
        "paid_conversions": count_if(paid),
        "avg_days": rounded(F.coalesce(mean_exact(F.when(paid, F.col("days_lead_to_paid"))), F.lit(0.0)), 1),
        "avg_mrr": rounded(F.coalesce(safe_divide(F.sum(F.when(paid, F.col("converted_mrr"))), count_if(paid)), F.lit(0.0)), 2),
        "total_mrr": money_sum(F.when(paid, F.col("converted_mrr"))),
    }


def funnel_overview(conversions: DataFrame, months: int, as_of: dt.date) -> DataFrame:
    g = recent_leads(conversions, months, as_of).agg(*[e.alias(k) for k, e in _funnel_measures().items()])
    n, tr, paid = F.col("total_leads"), F.col("trial_starts"), F.col("paid_conversions")
    return g.select(
        "total_leads", "trial_starts", "paid_conversions", share_pct(tr, n).alias("lead_to_trial_rate"),
        share_pct(paid, tr).alias("trial_to_paid_rate"), share_pct(paid, n).alias("overall_conversion_rate"),
        F.col("avg_days").alias("avg_days_to_paid"), F.col("avg_mrr").alias("avg_first_month_mrr"),
        F.col("total_mrr").alias("total_converted_mrr"),
    )


def conversion_by_channel(conversions: DataFrame, months: int, as_of: dt.date) -> DataFrame:
    g = (
        recent_leads(conversions, months, as_of)
        .groupBy(F.col("acquisition_channel").alias("channel"))
        .agg(*[e.alias(k) for k, e in _funnel_measures().items()])
    )
    n, tr, paid = F.col("total_leads"), F.col("trial_starts"), F.col("paid_conversions")
    rated = g.select(
        "channel", "total_leads", "trial_starts", "paid_conversions", share_pct(paid, tr).alias("trial_to_paid_rate"),
        share_pct(paid, n).alias("overall_conversion_rate"), F.col("avg_days").alias("avg_days_to_convert"),
        F.col("avg_mrr").alias("avg_first_month_mrr"), F.col("total_mrr").alias("total_converted_mrr"),
        share_pct(n, F.sum(n).over(whole())).alias("pct_of_total_leads"),
        share_pct(paid, F.sum(paid).over(whole())).alias("pct_of_total_conversions"),
    )
    best = lambda c: F.first("channel").over(Window.orderBy(F.desc(c), "channel"))
    return rated.withColumns(
        {
            "best_channel_by_conversion": best("overall_conversion_rate"),
            "best_channel_by_mrr": best("avg_first_month_mrr"),
        }
    )


def sales_cycle(conversions: DataFrame, months: int, as_of: dt.date) -> DataFrame:
    d = F.col("days_lead_to_paid")
    z = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    g = (
        recent_leads(conversions, months, as_of)
        .where("is_paid_conversion")
        .groupBy(F.col("acquisition_channel").alias("channel"))
        .agg(
            rounded(z(mean_exact(d)), 1).alias("avg_days"), rounded(z(F.percentile(d, 0.5)), 1).alias("median_days"),
            z(F.min(d)).alias("min_days"), z(F.max(d)).alias("max_days"), F.count(F.lit(1)).alias("conversions"),
            rounded(safe_divide(F.sum("converted_mrr"), F.count(F.lit(1))), 2).alias("avg_mrr"),
        )
    )
    # overall figures are means over the channel means; the median is element n div 2
    usable = F.when(F.col("avg_days") > 0, F.col("avg_days"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last(usable), "channel")) - 1
    n = F.count(usable).over(whole())
    overall = rounded(F.coalesce(safe_divide(F.sum(usable.cast("decimal(38,12)")).over(whole()), n), F.lit(0.0)), 1)
    mid = F.max(F.when(F.col("place") == F.floor(F.col("n") / 2), F.col("avg_days"))).over(whole())
    return (
        g.withColumns({"place": place, "n": n, "overall_avg_days": overall})
        .withColumn("overall_median_days", F.coalesce(mid, F.lit(0.0)))
        .drop("place", "n")
    )


def trial_usage(conversions: DataFrame, months: int, as_of: dt.date) -> DataFrame:
    g = recent_leads(conversions, months, as_of).agg(*[e.alias(k) for k, e in _funnel_measures().items()])
    return g.select(
        F.col("trial_starts").alias("trial_accounts"), "paid_conversions",
        share_pct(F.col("paid_conversions"), F.col("trial_starts")).alias("trial_to_paid_rate"),
        F.col("avg_mrr").alias("avg_converted_mrr"), F.col("avg_days").alias("avg_days_to_convert"),
    )


def expansion_by_size_channel_plan(movements: DataFrame, months: int, as_of: dt.date, limit: int = 50) -> DataFrame:
    keys = ["company_size", "acquisition_channel", "plan_name"]
    g = (
        movements.where((F.col("expansion_mrr") > 0) & (F.col("month_start") >= since(as_of, months)))
        .groupBy(*keys)
        .agg(F.sum("expansion_mrr").cast(MONEY).alias("total_expansion_mrr"),
             F.countDistinct("account_id").alias("expanding_accounts"))
        .orderBy(F.desc("total_expansion_mrr"), *keys)
        .limit(limit)
    )
    total = F.col("total_expansion_mrr")
    return g.withColumns(
        {
            "avg_expansion_per_account": rounded(divide_or(total, F.col("expanding_accounts")), 2),
            "pct_of_total_expansion": share_pct(total, F.sum(total).over(whole())),
        }
    )


# --- chart shapes ---------------------------------------------------------------------------


def channel_over_months(movements: DataFrame) -> DataFrame:
    return (
        movements.where(F.col("new_mrr") > 0)
        .groupBy(F.col("acquisition_channel").alias("channel"))
        .agg(F.sum("new_mrr").cast(MONEY).alias("total_mrr"), F.count(F.lit(1)).alias("accounts"))
        .orderBy(F.desc("total_mrr"))
    )


def chart_reaggregates(expansion: DataFrame, cycles: DataFrame) -> DataFrame:
    by_size = expansion.groupBy(F.col("company_size").alias("label")).agg(
        F.sum("total_expansion_mrr").cast("double").alias("value")
    )
    by_channel = cycles.groupBy(F.col("channel").alias("label")).agg(rounded(mean_exact(F.col("avg_days")), 4).alias("value"))
    return by_size.withColumn("chart", F.lit("expansion_by_size")).unionByName(
        by_channel.withColumn("chart", F.lit("sales_cycle_by_channel"))
    )


def cohort_period_average(cohorts: DataFrame, period: int = 11) -> DataFrame:
    rows = cohorts.where(F.col("months_since_created") == period)
    avg = lambda c: rounded(F.coalesce(mean_exact(F.coalesce(c, F.lit(0.0))), F.lit(0.0)), 4)
    return rows.agg(F.count(F.lit(1)).alias("cohorts"), avg("nrr").alias("avg_nrr"), avg("logo_retention_rate").alias("avg_retention"))


def funnel_width_pct(overview: DataFrame) -> DataFrame:
    stages = {"Leads": "total_leads", "Trials": "trial_starts", "Paid": "paid_conversions"}
    steps = F.array(*[F.struct(F.lit(k).alias("stage"), F.col(c).alias("value")) for k, c in stages.items()])
    return overview.select("total_leads", F.inline(steps)).select(
        "stage", "value", rounded(safe_divide("value", "total_leads") * 100, 2).alias("width_pct")
    )


def risky_accounts_by_mrr(success: DataFrame, month: str | None = None, limit: int = 20) -> DataFrame:
    rows = in_month(success, "snapshot_month", month).where(F.col("health_tier") != "healthy")
    return rows.select(*ACCOUNT_CARD).orderBy(F.desc("mrr"), "account_id").limit(limit)
