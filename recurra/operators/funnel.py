"""Lead-to-paid progression and conversion facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recurra.config import Tables
from recurra.functions.expr import (
    MONEY,
    banded,
    count_if,
    mean_exact,
    month_key,
    rounded,
    safe_divide,
    surrogate_key,
)

STAGE_ORDER = {"lost": 0, "lead": 1, "qualified": 2, "demo_requested": 3, "demo_completed": 4, "trial": 5, "paid": 6}
ENGAGEMENT = [(80, "high_engagement"), (50, "medium_engagement"), (20, "low_engagement")]


def days(a: Column, b: Column) -> Column:
    """Whole elapsed days; NULL when either end is missing."""
    return F.timestamp_diff("DAY", a, b).cast("int")


def first_paid_subscription(subscriptions: DataFrame) -> DataFrame:
    """Earliest paid subscription per account, picked while aggregating map-side."""
    pick = F.min(F.struct("start_date", "subscription_id", "plan_name", "mrr")).alias("first")
    return (
        subscriptions.where(F.col("status") != "trial")
        .groupBy("account_id")
        .agg(pick)
        .select(
            "account_id",
            F.col("first.subscription_id").alias("subscription_id"),
            F.col("first.plan_name").alias("converted_plan"),
            F.col("first.mrr").alias("converted_mrr"),
            F.col("first.start_date").cast("timestamp_ntz").alias("paid_started_at"),
        )
    )


def velocity(d: Column) -> Column:
    return F.when(d <= 14, "fast").when(d <= 30, "normal").when(d <= 60, "slow").when(d > 60, "very_slow").otherwise(
        "in_progress"
    )


def funnel_progression(t: Tables) -> DataFrame:
    l = t.leads.join(first_paid_subscription(t.subscriptions), "account_id", "left")
    has = lambda c: F.col(c).isNotNull()
    paid = has("converted_at") | has("paid_started_at")
    stage = (
        F.when(paid, "paid")
        .when(has("trial_started_at"), "trial")
        .when(has("demo_completed_at"), "demo_completed")
        .when(has("demo_requested_at"), "demo_requested")
        .when(has("qualified_at"), "qualified")
        .when(has("lost_at"), "lost")
        .otherwise("lead")
    )
    order = F.lit(None).cast("int")
    for name, n in STAGE_ORDER.items():
        order = F.when(F.col("funnel_stage") == name, n).otherwise(order)
    span = lambda a, b: days(F.col(a), F.col(b))
    return l.withColumn("funnel_stage", stage).select(
        "lead_id",
        "account_id",
        "acquisition_channel",
        "industry",
        "company_size",
        "lead_score",
        "trial_engagement_score",
        F.col("created_at").alias("lead_created_at"),
        "qualified_at",
        "demo_requested_at",
        "demo_completed_at",
        "trial_started_at",
        "trial_ended_at",
        F.coalesce("converted_at", "paid_started_at").alias("paid_converted_at"),
        "lost_at",
        "subscription_id",
        "converted_plan",
        "converted_mrr",
        "paid_started_at",
        "funnel_stage",
        order.alias("funnel_stage_order"),
        F.lit(True).alias("is_lead"),
        has("qualified_at").alias("is_qualified"),
        has("demo_requested_at").alias("is_demo_requested"),
        has("demo_completed_at").alias("is_demo_completed"),
        has("trial_started_at").alias("is_trial"),
        paid.alias("is_paid"),
        has("lost_at").alias("is_lost"),
        span("created_at", "qualified_at").alias("days_lead_to_qualified"),
        span("qualified_at", "demo_completed_at").alias("days_qualified_to_demo"),
        span("demo_completed_at", "trial_started_at").alias("days_demo_to_trial"),
        span("created_at", "trial_started_at").alias("days_lead_to_trial"),
        span("trial_started_at", "paid_started_at").alias("days_trial_to_paid"),
        span("created_at", "paid_started_at").alias("days_lead_to_paid"),
        span("trial_started_at", "trial_ended_at").alias("trial_duration_days"),
        velocity(span("created_at", "paid_started_at")).alias("conversion_velocity"),
        month_key("created_at").alias("lead_month"),
        month_key("trial_started_at").alias("trial_month"),
        month_key(F.coalesce("converted_at", "paid_started_at")).alias("conversion_month"),
    )


def conversion_rows(t: Tables) -> DataFrame:
    """Lead grain with account attributes and the account's active MRR."""
    f = funnel_progression(t).drop("industry", "company_size")
    accounts = t.accounts.select("account_id", "company_name", "company_size", "industry", "region")
    active = (
        t.subscriptions.where(F.col("status") == "active")
        .groupBy("account_id")
        .agg(
            F.min("start_date").alias("first_sub_date"),
            F.sum("mrr").cast(MONEY).alias("active_mrr"),
            F.max("plan_name").alias("active_plan"),
        )
    )
    zero = F.lit(0).cast(MONEY)
    mrr = F.coalesce("active_mrr", zero)
    paid = F.col("is_paid")
    engagement = F.col("trial_engagement_score")
    won = lambda v: F.when(paid, v).otherwise(zero).cast(MONEY)
    return (
        f.join(accounts, "account_id", "left")
        .join(active, "account_id", "left")
        .select(
            surrogate_key("lead_id").alias("conversion_key"),
            "lead_id",
            "account_id",
            "acquisition_channel",
            "funnel_stage",
            "funnel_stage_order",
            "lead_created_at",
            "trial_started_at",
            "paid_converted_at",
            F.col("lead_month").alias("lead_created_month"),
            F.col("trial_month").alias("trial_started_month"),
            F.col("conversion_month").alias("paid_converted_month"),
            "is_lead",
            "is_trial",
            paid.alias("is_paid_conversion"),
            "is_lost",
            "days_lead_to_trial",
            "days_trial_to_paid",
            "days_lead_to_paid",
            "conversion_velocity",
            "trial_engagement_score",
            "lead_score",
            F.coalesce("company_name", F.lit("Unknown")).alias("company_name"),
            *[F.coalesce(c, F.lit("unknown")).alias(c) for c in ("company_size", "industry", "region")],
            "first_sub_date",
            mrr.alias("first_month_mrr"),
            F.coalesce("active_plan", "converted_plan").alias("plan_name"),
            won(mrr).alias("converted_mrr"),
            won(mrr * 12).alias("converted_arr"),
            F.col("conversion_velocity").alias("sales_cycle_bucket"),
            F.when(engagement.isNull(), "no_trial")
            .otherwise(banded(engagement, ENGAGEMENT, "minimal_engagement"))
            .alias("trial_quality"),
        )
    )


def conversion_monthly(rows: DataFrame) -> DataFrame:
    paid, trial, n = F.col("is_paid_conversion"), F.col("is_trial"), F.count(F.lit(1))
    n_trial, n_paid = count_if(trial), count_if(paid)
    return rows.groupBy(
        F.col("lead_created_month").alias("month_key"), "acquisition_channel", "company_size", "plan_name"
    ).agg(
        n.alias("total_leads"),
        n_trial.alias("trial_starts"),
        n_paid.alias("paid_conversions"),
        count_if(F.col("is_lost")).alias("lost_leads"),
        rounded(safe_divide(n_trial, n), 4).alias("lead_to_trial_rate"),
        rounded(safe_divide(n_paid, n_trial), 4).alias("trial_to_paid_rate"),
        rounded(safe_divide(n_paid, n), 4).alias("overall_conversion_rate"),
        rounded(mean_exact(F.when(paid, F.col("days_lead_to_paid"))), 1).alias("avg_days_to_convert"),
        rounded(mean_exact(F.when(trial, F.col("trial_engagement_score"))), 1).alias("avg_trial_engagement"),
        F.sum("converted_mrr").cast(MONEY).alias("total_converted_mrr"),
        rounded(mean_exact(F.when(paid, F.col("first_month_mrr"))), 2).alias("avg_first_month_mrr"),
    )


CHANNEL_MONTH = {
    "total_leads": "channel_month_total_leads", "trial_starts": "channel_month_trial_starts",
    "paid_conversions": "channel_month_paid_conversions", "lead_to_trial_rate": "channel_lead_to_trial_rate",
    "trial_to_paid_rate": "channel_trial_to_paid_rate", "overall_conversion_rate": "channel_overall_conversion_rate",
    "avg_days_to_convert": "channel_avg_days_to_convert", "avg_trial_engagement": "channel_avg_trial_engagement",
    "total_converted_mrr": "channel_month_converted_mrr", "avg_first_month_mrr": "channel_avg_first_month_mrr",
}


def fct_sales_conversion(t: Tables) -> DataFrame:
    """Lead rows with the rates of their month x channel x size x plan group joined back."""
    rows = conversion_rows(t).withColumn("plan_group", F.coalesce("plan_name", F.lit("unknown")))
    s = conversion_monthly(rows)
    summary = s.select(
        F.col("month_key").alias("lead_created_month"),
        "acquisition_channel",
        "company_size",
        F.coalesce("plan_name", F.lit("unknown")).alias("plan_group"),
        *[F.col(k).alias(v) for k, v in CHANNEL_MONTH.items()],
    )
    keys = ["lead_created_month", "acquisition_channel", "company_size", "plan_group"]
    return rows.join(summary, keys, "left").drop("plan_group")


def conversion_simple(leads: DataFrame) -> DataFrame:
    """Conversion facts from lead dates alone."""
    d = lambda c: F.col(c).cast("date")
    gap = lambda a, b: F.datediff(d(b), d(a))
    return leads.select(
        "lead_id",
        d("created_at").alias("lead_date"),
        d("trial_started_at").alias("trial_start_date"),
        d("converted_at").alias("converted_date"),
        "acquisition_channel",
        "company_size",
        "industry",
        F.col("trial_started_at").isNotNull().alias("had_trial"),
        F.col("converted_at").isNotNull().alias("converted"),
        gap("created_at", "trial_started_at").alias("days_lead_to_trial"),
        gap("trial_started_at", "converted_at").alias("days_trial_to_paid"),
        gap("created_at", "converted_at").alias("days_lead_to_paid"),
    )
