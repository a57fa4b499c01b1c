"""Typed, cleaned views of each source entity. Narrow projections: no shuffle except where noted."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from recurra.config import MetricConfig, PLAN_TIERS, SIZE_MIDPOINTS, SIZE_TIERS
from recurra.functions.expr import (
    age_months,
    banded,
    day,
    mapped,
    month_key,
    month_start,
    surrogate_key,
    text,
)


def lowered(c):
    return F.lower(text(c))


def stg_accounts(accounts: DataFrame, subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Firmographic buckets, plus activity: any subscription not ended by ``as_of``."""
    size = text("company_size")
    open_ended = F.col("end_date").isNull() | (F.col("end_date") >= day(as_of))
    activity = subscriptions.groupBy("account_id").agg(F.bool_or(open_ended).alias("any_open"))
    kept = accounts.where(F.col("account_id").isNotNull() & F.col("company_name").isNotNull())
    active = F.coalesce("any_open", F.lit(False))
    return kept.join(activity, "account_id", "left").select(
        "account_id",
        text("company_name").alias("company_name"),
        lowered("industry").alias("industry"),
        F.upper(text("region")).alias("region"),
        size.alias("company_size"),
        lowered("acquisition_channel").alias("acquisition_channel"),
        lowered("country").alias("country"),
        mapped(size, SIZE_MIDPOINTS).alias("employee_midpoint"),
        mapped(size, SIZE_TIERS, "unknown").alias("size_tier"),
        "created_at",
        F.coalesce("updated_at", "created_at").alias("updated_at"),
        active.alias("is_active"),
        F.when(active, "active").otherwise("churned").alias("account_status"),
    )


def stg_calendar(first_day: DataFrame, as_of: dt.date, horizon_days: int = 365) -> DataFrame:
    """One row per day from the single date in ``first_day`` to the horizon."""
    start = F.col(first_day.columns[0])
    days = first_day.select(
        F.explode(F.sequence(start, F.date_add(day(as_of), horizon_days))).alias("d")
    )
    d = F.col("d")
    dow = F.dayofweek(d) - 1
    quarter_start = F.trunc(d, "QUARTER")
    weekend = dow.isin(0, 6)
    # a date after as_of counts negative months, symmetric around it
    ago = F.when(d <= day(as_of), age_months(d, day(as_of))).otherwise(-age_months(day(as_of), d))
    return days.select(
        d.alias("calendar_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.day(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        month_key(d).alias("month_key"),
        month_start(d).alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("quarter_key"),
        quarter_start.alias("quarter_start_date"),
        F.year(d).alias("fiscal_year"),
        F.date_format(d, "MMMM yyyy").alias("month_name_long"),
        F.date_format(d, "MMM yyyy").alias("month_name_short"),
        F.date_format(d, "EEEE").alias("day_name_long"),
        F.date_format(d, "EEE").alias("day_name_short"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        (d == month_start(d)).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
        (d == quarter_start).alias("is_quarter_start"),
        (d <= day(as_of)).alias("is_past_or_today"),
        (d == day(as_of)).alias("is_today"),
        F.datediff(day(as_of), d).alias("days_ago"),
        ago.alias("months_ago"),
        F.quarter(d).alias("fiscal_quarter_num"),
        F.month(d).alias("fiscal_month_num"),
    )


# Words in a job title and the persona they stand for, first match wins.
PERSONAS = [
    ("C-Suite", ["ceo", "founder", "president"]),
    ("VP / Director", ["cto", "cio", "vp"]),
    ("Manager", ["manager", "lead"]),
    ("Individual Contributor", ["engineer", "developer", "analyst"]),
]
TENURE_BANDS = [(730, "2+ years"), (365, "1-2 years"), (180, "6-12 months"), (90, "3-6 months")]


def persona(title):
    out = None
    for tier, words in PERSONAS:
        hit = F.lower(title).rlike("|".join(words))
        out = F.when(hit, tier) if out is None else out.when(hit, tier)
    return out.otherwise("Other")


def stg_customers(contacts: DataFrame, as_of: dt.date) -> DataFrame:
    """Primary contact of each account; rows without an e-mail are dropped."""
    name = text("primary_contact_name")
    tenure = F.datediff(day(as_of), F.col("created_at").cast("date"))
    return contacts.where(F.col("primary_contact_email") != "").select(
        surrogate_key("account_id").alias("customer_id"),
        "account_id",
        text("company_name").alias("company_name"),
        lowered("primary_contact_email").alias("email"),
        name.alias("full_name"),
        F.split_part(name, F.lit(" "), F.lit(1)).alias("first_name"),
        F.split_part(name, F.lit(" "), F.lit(2)).alias("last_name"),
        text("primary_contact_title").alias("job_title"),
        persona(F.col("primary_contact_title")).alias("persona_tier"),
        "created_at",
        tenure.alias("tenure_days"),
        banded(tenure, TENURE_BANDS, "0-3 months").alias("tenure_bucket"),
        (F.lower("account_status") == "churned").alias("is_churned"),
    )


def stg_features(features: DataFrame) -> DataFrame:
    tier = mapped(text("feature_tier"), PLAN_TIERS, 99)
    core, premium = F.col("is_core"), F.col("is_premium")
    typed = features.where(F.col("feature_id").isNotNull() & ~F.col("is_deprecated")).select(
        "feature_id",
        text("feature_name").alias("feature_name"),
        text("feature_slug").alias("feature_slug"),
        text("feature_category").alias("feature_category"),
        text("feature_tier").alias("feature_tier"),
        tier.alias("tier_order"),
        "is_core",
        "is_premium",
        "is_beta",
        "is_deprecated",
    )
    early = core & (F.col("tier_order") <= 2)
    return typed.withColumns(
        {
            "importance_tier": F.when(early, "high").when(core | premium, "medium").otherwise("low"),
            "health_weight": F.when(early, 3.0).when(core, 2.0).when(premium, 1.5).otherwise(1.0),
        }
    )


def stg_invoices(invoices: DataFrame, as_of: dt.date) -> DataFrame:
    s = lowered("status")
    return invoices.where(
        F.col("invoice_id").isNotNull() & F.col("account_id").isNotNull() & (F.col("amount") > 0)
    ).select(
        "invoice_id",
        "account_id",
        "subscription_id",
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        s.alias("status"),
        lowered("currency").alias("currency"),
        "invoice_date",
        "due_date",
        "paid_date",
        *[(s == x).alias(f"is_{x}") for x in ("paid", "failed", "pending", "refunded")],
        F.when(s == "paid", F.datediff("paid_date", "invoice_date")).alias("days_to_pay"),
        F.coalesce(~s.isin("paid", "void", "refunded") & (F.col("due_date") < day(as_of)), F.lit(False)).alias(
            "is_overdue"
        ),
        month_start("invoice_date").alias("billing_month"),
    )


def stg_leads(leads: DataFrame) -> DataFrame:
    started, paid = F.col("trial_started_at"), F.col("converted_at")
    return leads.where(F.col("lead_id").isNotNull()).select(
        "lead_id",
        "account_id",
        lowered("acquisition_channel").alias("channel"),
        lowered("industry").alias("industry"),
        text("company_size").alias("company_size"),
        "created_at",
        "trial_started_at",
        paid.alias("converted_to_paid_at"),
        started.isNotNull().alias("started_trial"),
        paid.isNotNull().alias("converted_paid"),
        F.datediff(paid.cast("date"), started.cast("date")).alias("trial_to_paid_days"),
        month_start(F.col("created_at").cast("date")).alias("lead_month"),
    )


def stg_plans(plans: DataFrame) -> DataFrame:
    name = lowered("plan_name")
    return plans.where(F.col("plan_id").isNotNull() & F.col("plan_name").isNotNull()).select(
        "plan_id",
        name.alias("plan_name"),
        "monthly_price",
        "annual_price",
        mapped(name, PLAN_TIERS, 99).alias("plan_tier_order"),
        (name == "enterprise").alias("is_enterprise"),
    )


def stg_subscriptions(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    s, cycle = lowered("status"), lowered("billing_cycle")
    until = F.coalesce("end_date", day(as_of))
    required = ["subscription_id", "account_id", "plan_id"]
    return subscriptions.dropna(subset=required).select(
        *required,
        "plan_name",
        s.alias("status"),
        cycle.alias("billing_cycle"),
        "mrr",
        "arr",
        "seats_purchased",
        "seats_used",
        "start_date",
        "end_date",
        ((s == "active") & (F.col("end_date").isNull() | (F.col("end_date") >= day(as_of)))).alias("is_active"),
        (s == "trial").alias("is_trial"),
        age_months(F.col("start_date"), until).alias("tenure_months"),
        (cycle == "annual").alias("is_annual"),
    )


SESSION_BANDS = [(30, "deep"), (10, "medium"), (1, "light")]


def stg_usage_events(events: DataFrame, cfg: MetricConfig) -> DataFrame:
    on = F.col("occurred_at").cast("date")
    minutes = F.col("duration_seconds") / 60
    return events.where(
        F.col("event_id").isNotNull() & F.col("account_id").isNotNull() & F.col("user_id").isNotNull() & on.isNotNull()
    ).select(
        "event_id",
        "account_id",
        "user_id",
        "session_id",
        lowered("event_type").alias("event_type"),
        "feature_id",
        lowered("feature_name").alias("feature_name"),
        lowered("feature_category").alias("feature_category"),
        on.alias("event_date"),
        "duration_seconds",
        month_start(on).alias("event_month"),
        F.date_trunc("week", on).cast("date").alias("event_week"),
        (F.dayofweek(on) - 1).alias("day_of_week"),
        banded(minutes, SESSION_BANDS, "bounce").alias("session_quality"),
        lowered("feature_category").isin(list(cfg.core_categories)).alias("is_core_feature"),
    )


def stg_support_tickets(tickets: DataFrame) -> DataFrame:
    s = lowered("status")
    return tickets.where(F.col("ticket_id").isNotNull() & F.col("account_id").isNotNull()).select(
        "ticket_id",
        "account_id",
        "user_id",
        lowered("category").alias("category"),
        lowered("priority").alias("priority"),
        s.alias("status"),
        F.col("csat_score").cast("decimal(3,1)").alias("csat_score"),
        "created_at",
        "resolved_at",
        "first_response_at",
        (s == "escalated").alias("is_escalated"),
    )
