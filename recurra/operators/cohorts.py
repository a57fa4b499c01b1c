"""Cohort retention at account x period and cohort x period grain.

On the dense grid an account appears once per period, so every distinct count
of accounts is a plain conditional count: no Expand and no second shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from recurra.config import Tables
from recurra.functions.expr import (
    MONEY,
    banded,
    count_if,
    day,
    in_cents,
    month_key,
    month_start,
    months_apart,
    rounded,
    safe_divide,
    surrogate_key,
)
from recurra.operators.mrr import account_month_mrr, plan_tier_order
from recurra.operators.spine import account_months, months_of_account, paid_spans, running_spans, tasks_for

ACTIVE = ["new", "retained", "reactivated"]
BROADCAST_ROWS = 200_000  # about 40 MB of period totals; beyond it the join shuffles and AQE splits hot cohorts
COHORT_BANDS = [(0.90, "excellent"), (0.75, "good"), (0.60, "fair")]


def cohort_rows(t: Tables, as_of: dt.date) -> DataFrame:
    """Account x period with retention status and the starting MRR of the account."""
    # both sides lie by account in as many partitions before months are generated and meet there, whatever session settings say of joins
    # by account and month, so no months are shuffled; paid months are many times the bytes that the planner knows, too many to broadcast
    tasks = tasks_for(paid_spans(t.subscriptions, as_of))
    activity = account_month_mrr(t.subscriptions, as_of, tasks=tasks).select("account_id", "month_start", "mrr", "plan_name")
    accounts = t.accounts.repartition(tasks, "account_id").join(months_of_account(activity, "_paid").hint("merge"), "account_id", "left")
    grid = account_months(accounts, as_of, kept=("_paid",)).drop("account_month_key", "month_year", "month_num", "country")
    zero = F.lit(0).cast(MONEY)
    described = [c for c in grid.columns if c not in ("account_id", "month_start", "_paid")]
    base = (
        grid.withColumn("_month", F.try_element_at("_paid", "month_start"))
        .select("account_id", "month_start", *described, F.coalesce("_month.mrr", zero).alias("mrr"), "_month.plan_name")
        .withColumn("is_active_this_month", F.col("mrr") > 0)
    )
    in_order = Window.partitionBy("account_id").orderBy("month_start")
    whole = Window.partitionBy("account_id")
    first = F.col("is_first_month")
    lagged = base.withColumns(
        {
            "was_active_prev_month": F.lag("is_active_this_month").over(in_order),
            "starting_mrr": F.max(F.when(first, F.col("mrr"))).over(whole),
            "starting_plan": F.max(F.when(first, F.col("plan_name"))).over(whole),
        }
    )
    before = F.coalesce("was_active_prev_month", F.lit(False))
    now = F.col("is_active_this_month")
    status = (
        F.when(first, "new")
        .when(now & before, "retained")
        .when(now, "reactivated")
        .when(before, "churned")
        .otherwise("inactive")
    )
    return lagged.withColumns(
        {
            "retention_status": status,
            "revenue_retention_rate": rounded(safe_divide("mrr", "starting_mrr"), 6),
            "mrr_vs_starting": (F.col("mrr") - F.coalesce("starting_mrr", zero)).cast(MONEY),
            "plan_tier_order": F.when(F.col("plan_name").isNotNull(), plan_tier_order(F.col("plan_name"))),
        }
    )


def retention_at(t: Tables, as_of: dt.date, periods: tuple[int, ...]) -> DataFrame:
    """Retention status of each account some months after its first one, NULL where that month is still to come.

    Points are looked up in the spans over which an account's MRR holds; neither the
    account x month grid nor any month is generated.
    """
    born = month_start(F.col("created_at").cast("date"))
    cohort = t.accounts.where(born <= day(as_of)).select("account_id", born.alias("_born"))
    spans = running_spans(paid_spans(t.subscriptions, as_of), ["account_id", "plan_name"], "account_id", {"cents": in_cents("mrr")})
    points = sorted({k for p in periods for k in (p - 1, p)})
    at = lambda k: F.add_months("_born", k)
    holds = lambda k: (F.col("_since") <= at(k)) & (at(k) < F.col("_until"))
    paid = spans.join(cohort, "account_id").groupBy("account_id").agg(*[(F.sum(F.when(holds(k), F.col("cents"))) > 0).alias(f"_{k}") for k in points])
    known = cohort.join(paid, "account_id", "left")

    def status(k: int):
        now, before = (F.coalesce(f"_{n}", F.lit(False)) for n in (k, k - 1))
        word = F.when(now & before, "retained").when(now, "reactivated").when(before, "churned").otherwise("inactive")
        return F.when(at(k) <= day(as_of), word).alias(f"retention_status_{k}m")

    return known.select("account_id", month_key("_born").alias("cohort_month"), *[status(p) for p in periods])


def cohort_period_summary(rows: DataFrame) -> DataFrame:
    status = F.col("retention_status")
    active = status.isin(ACTIVE)
    zero = F.lit(0)
    g = rows.groupBy("cohort_month", "cohort_month_date", "months_since_created").agg(
        F.count(zero).alias("total_accounts_in_cohort"),
        count_if(active).alias("active_accounts"),
        count_if(status == "churned").alias("churned_accounts"),
        count_if(status == "reactivated").alias("reactivated_accounts"),
        F.sum("mrr").cast(MONEY).alias("cohort_mrr"),
        F.coalesce(F.sum(F.when(active, F.col("mrr"))), zero).cast(MONEY).alias("active_mrr"),
        F.sum("starting_mrr").cast(MONEY).alias("cohort_starting_mrr"),
        F.mode("industry", True).alias("dominant_industry"),
        F.mode("company_size", True).alias("dominant_company_size"),
        F.mode("acquisition_channel", True).alias("dominant_channel"),
        F.mode("plan_name", True).alias("dominant_plan"),
    )
    return g.withColumns(
        {
            "avg_account_mrr": rounded(safe_divide("cohort_mrr", "total_accounts_in_cohort"), 2),
            "logo_retention_rate": safe_divide("active_accounts", "total_accounts_in_cohort"),
            "revenue_retention_rate": safe_divide("cohort_mrr", "cohort_starting_mrr"),
        }
    )


def period_rows(accounts: DataFrame, as_of: dt.date) -> int:
    """Upper bound of cohort x period rows: it follows from the first creation date alone."""
    first = accounts.agg(F.min(F.col("created_at").cast("date")).alias("d")).first()["d"]
    if first is None:
        return 0
    months = (as_of.year - first.year) * 12 + as_of.month - first.month + 1
    return months * (months + 1) // 2


def cohort_base(t: Tables, as_of: dt.date) -> DataFrame:
    """Account x period detail with the cohort's period totals alongside."""
    rows = cohort_rows(t, as_of)
    period = cohort_period_summary(rows).select(
        "cohort_month",
        "months_since_created",
        F.col("total_accounts_in_cohort").alias("cohort_size"),
        "cohort_starting_mrr",
        F.col("active_mrr").alias("cohort_active_mrr"),
        F.col("active_accounts").alias("cohort_active_accounts"),
        rounded(F.col("logo_retention_rate"), 6).alias("cohort_logo_retention_rate"),
        rounded(F.col("revenue_retention_rate"), 6).alias("cohort_revenue_retention_rate"),
        F.col("cohort_mrr").alias("cohort_total_mrr"),
    )
    if period_rows(t.accounts, as_of) <= BROADCAST_ROWS:
        period = F.broadcast(period)
    joined = rows.join(period, ["cohort_month", "months_since_created"], "left")
    return joined.withColumn(
        "cohort_record_key", surrogate_key("account_id", "cohort_month", "months_since_created")
    )


def fct_customer_cohorts(rows: DataFrame) -> DataFrame:
    s = cohort_period_summary(rows)
    keep = F.col("revenue_retention_rate")
    m = F.col("months_since_created")
    return s.select(
        surrogate_key("cohort_month", "months_since_created").alias("cohort_period_key"),
        "cohort_month",
        "months_since_created",
        F.col("dominant_company_size").alias("company_size"),
        F.col("dominant_channel").alias("acquisition_channel"),
        F.col("dominant_plan").alias("plan_name"),
        F.col("total_accounts_in_cohort").alias("cohort_size"),
        "cohort_starting_mrr",
        "active_accounts",
        "churned_accounts",
        "active_mrr",
        "cohort_mrr",
        rounded(F.col("logo_retention_rate"), 4).alias("logo_retention_rate"),
        rounded(keep, 4).alias("revenue_retention_rate"),
        rounded(safe_divide("churned_accounts", "total_accounts_in_cohort"), 4).alias("logo_churn_rate"),
        rounded(1 - keep, 4).alias("revenue_churn_rate"),
        rounded(keep, 4).alias("nrr"),
        rounded(F.least(F.lit(1.0), keep), 4).alias("grr"),
        rounded(safe_divide("active_mrr", "active_accounts"), 2).alias("arpa"),
        banded(F.col("logo_retention_rate"), COHORT_BANDS, "poor").alias("cohort_health"),
        (m == 3).alias("is_3_month_mark"),
        (m == 6).alias("is_6_month_mark"),
        (m == 12).alias("is_12_month_mark"),
        (m == 24).alias("is_24_month_mark"),
    )


def cohort_segments(rows: DataFrame) -> DataFrame:
    active = F.col("retention_status").isin(ACTIVE)
    keys = ["cohort_month", "months_since_created"]
    dims = ["company_size", "acquisition_channel", "plan_name", "region", "industry"]
    zero = F.lit(0)
    seg = rows.groupBy(*keys, *dims).agg(
        F.count(zero).alias("segment_cohort_size"),
        count_if(active).alias("segment_active_accounts"),
        F.coalesce(F.sum(F.when(active, F.col("mrr"))), zero).cast(MONEY).alias("segment_active_mrr"),
        F.sum("mrr").cast(MONEY).alias("segment_total_mrr"),
        F.sum("starting_mrr").cast(MONEY).alias("segment_starting_mrr"),
    )
    # the cohort's starting MRR is summed over its segments: a window over a few vocabulary combinations
    cohort_total = F.sum("segment_starting_mrr").over(Window.partitionBy(*keys))
    return seg.withColumn("cohort_starting_mrr", cohort_total).select(
        *keys,
        *dims,
        "segment_cohort_size",
        "segment_active_accounts",
        "segment_active_mrr",
        "segment_total_mrr",
        rounded(safe_divide("segment_active_accounts", "segment_cohort_size"), 4).alias("segment_logo_retention_rate"),
        rounded(safe_divide("segment_active_mrr", "cohort_starting_mrr"), 4).alias("segment_revenue_retention_rate"),
    )


def cohorts_from_movements(movements: DataFrame, accounts: DataFrame, periods: int = 12) -> DataFrame:
    """Retention counted on movement rows only; period 0 gives size and starting MRR."""
    born = accounts.select("account_id", month_start(F.col("created_at").cast("date")).alias("cohort_date"))
    rows = movements.join(born, "account_id").withColumn(
        "months_since_created", months_apart(F.col("cohort_date"), F.col("month_start"))
    )
    stays = ~F.col("is_churned")
    g = (
        rows.where(F.col("months_since_created").between(0, periods))
        .groupBy("cohort_date", "months_since_created")
        .agg(
            count_if(stays).alias("active_accounts"),
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("mrr").cast(MONEY).alias("cohort_mrr"),
        )
    )
    at_start = F.col("months_since_created") == 0
    w = Window.partitionBy("cohort_date")
    g = g.withColumns(
        {
            "cohort_size": F.max(F.when(at_start, F.col("n_rows"))).over(w),
            "starting_mrr": F.max(F.when(at_start, F.col("cohort_mrr"))).over(w),
        }
    ).where(F.col("cohort_size").isNotNull())
    logo = F.coalesce(safe_divide("active_accounts", "cohort_size"), F.lit(0.0))
    revenue = F.coalesce(safe_divide("cohort_mrr", "starting_mrr"), F.lit(0.0))
    return g.select(
        F.date_format("cohort_date", "yyyy-MM").alias("cohort_month"),
        "months_since_created",
        "cohort_size",
        "active_accounts",
        rounded(logo, 4).alias("logo_retention_rate"),
        "cohort_mrr",
        "starting_mrr",
        rounded(revenue, 4).alias("revenue_retention_rate"),
        rounded(revenue, 4).alias("nrr"),
        rounded(F.least(revenue, F.lit(1.0)), 4).alias("grr"),
        banded(logo, [(0.85, "healthy"), (0.65, "at_risk")], "churning").alias("cohort_health"),
    )


def pivot_cohort_heatmap(cohorts: DataFrame, value: str = "logo_retention_rate", max_period: int = 12) -> DataFrame:
    at = lambda p: F.max(F.when(F.col("months_since_created") == p, F.col(value)))
    return cohorts.groupBy("cohort_month").agg(
        F.max("cohort_size").alias("cohort_size"), *[at(p).alias(f"m{p}") for p in range(max_period + 1)]
    )
