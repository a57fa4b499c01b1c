"""Record validation: column rules give a reason list per record, valid and rejected are filters on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recurra.functions.expr import surrogate_key

# Accepted literals of incoming records.
LITERALS = {
    "company_size": ["startup", "smb", "mid_market", "enterprise"],
    "subscription_status": ["active", "trialing", "past_due", "canceled", "paused"],
    "billing_interval": ["monthly", "quarterly", "annual"],
    "invoice_status": ["paid", "open", "void", "uncollectible", "draft", "failed"],
    "priority": ["low", "medium", "high", "critical"],
    "ticket_status": ["open", "pending", "resolved", "closed"],
    "funnel_stage": ["lead", "mql", "sql", "trial", "opportunity", "closed_won", "closed_lost"],
}
MAX_MRR = 1_000_000


def number(c: str, kind: str = "double") -> Column:
    return F.col(c).try_cast(kind)


def missing(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)), F.lit("")) == ""


def unreadable(c: str, kind: str = "double") -> Column:
    return F.col(c).isNotNull() & number(c, kind).isNull()


def below(c: str, low: float) -> Column:
    return F.coalesce(number(c) < low, F.lit(False))


def above(c: str, high: float) -> Column:
    return F.coalesce(number(c) > high, F.lit(False))


def foreign(c: str, literals: str) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).isin(LITERALS[literals])


def longer(c: str, n: int) -> Column:
    return F.coalesce(F.length(c) > n, F.lit(False))


def _not_negative(*names: str) -> dict[str, Column]:
    return {f"{c} negative": below(c, 0) for c in names}


def rules(kind: str) -> dict[str, Column]:
    """Reason -> violated condition."""
    if kind == "account":
        return {
            "account_id missing": missing("account_id"), "company_name missing": missing("company_name"),
            "company_name too long": longer("company_name", 255), "company_size unknown": foreign("company_size", "company_size"),
        }
    if kind == "subscription":
        return {
            "subscription_id missing": missing("subscription_id"), "account_id missing": missing("account_id"),
            "plan_name missing": missing("plan_name"), "mrr missing": missing("mrr"), "mrr unreadable": unreadable("mrr"),
            "mrr negative": below("mrr", 0), "mrr above limit": above("mrr", MAX_MRR), "arr negative": below("arr", 0),
            "status unknown": foreign("status", "subscription_status"),
            "billing_interval unknown": foreign("billing_interval", "billing_interval"), "seats negative": below("seats", 0),
        }
    if kind == "invoice":
        return {
            "invoice_id missing": missing("invoice_id"), "account_id missing": missing("account_id"),
            "amount missing": missing("amount"), "amount negative": below("amount", 0), "currency too long": longer("currency", 3),
            "status unknown": foreign("status", "invoice_status"), "attempt_count negative": below("attempt_count", 0),
        }
    if kind == "usage_event":
        return {
            "account_id missing": missing("account_id"), "feature_name missing": missing("feature_name"),
            "event_count negative": below("event_count", 0), "session_duration_seconds negative": below("session_duration_seconds", 0),
            "occurred_at missing": missing("occurred_at"), "occurred_at unreadable": unreadable("occurred_at", "timestamp_ntz"),
        }
    if kind == "ticket":
        return {
            "ticket_id missing": missing("ticket_id"), "account_id missing": missing("account_id"), "subject too long": longer("subject", 500),
            "priority unknown": foreign("priority", "priority"), "status unknown": foreign("status", "ticket_status"),
            "csat_score out of range": below("csat_score", 1) | above("csat_score", 5),
            "resolution_time_hours negative": below("resolution_time_hours", 0),
        }
    if kind == "lead":
        return {
            "lead_id missing": missing("lead_id"), "funnel_stage unknown": foreign("funnel_stage", "funnel_stage"),
            "lead_score out of range": below("lead_score", 0) | above("lead_score", 100),
            **_not_negative("converted_mrr", "days_lead_to_trial", "days_trial_to_paid", "days_lead_to_paid"),
        }
    raise ValueError(f"unknown record type {kind}")


def normalised(kind: str) -> dict[str, Column]:
    """Cleaned values and defaults of accepted records."""
    filled = lambda c, v: F.coalesce(F.col(c), F.lit(v))
    money = lambda c: F.round(number(c, "decimal(18,6)"), 2).cast("decimal(12,2)")
    if kind == "account":
        return {"account_id": F.trim("account_id")}
    if kind == "subscription":
        yearly = (money("mrr") * 12).cast("decimal(14,2)")
        return {
            "mrr": money("mrr"), "arr": F.coalesce(F.round(number("arr", "decimal(18,6)"), 2).cast("decimal(14,2)"), yearly),
            "status": filled("status", "active"), "billing_interval": filled("billing_interval", "monthly"),
            "seats": number("seats", "int"),
        }
    if kind == "invoice":
        return {"amount": money("amount"), "currency": filled("currency", "USD"), "status": filled("status", "paid")}
    if kind == "usage_event":
        # a record without an id gets one from its content, so a replay stays idempotent
        made = surrogate_key("account_id", "user_id", "feature_name", "occurred_at")
        return {
            "event_id": F.coalesce("event_id", made), "feature_name": F.replace(F.trim(F.lower("feature_name")), F.lit(" "), F.lit("_")),
            "event_count": F.coalesce(number("event_count", "int"), F.lit(1)), "occurred_at": number("occurred_at", "timestamp_ntz"),
            "session_duration_minutes": number("session_duration_seconds") / 60,
        }
    if kind == "ticket":
        return {"priority": filled("priority", "medium"), "status": filled("status", "open"), "csat_score": number("csat_score", "decimal(3,1)")}
    return {"funnel_stage": filled("funnel_stage", "lead"), "account_id": F.col("converted_account_id"), "lead_score": number("lead_score", "int")}


FIELDS = {
    "account": ["account_id", "company_name", "company_size"],
    "subscription": ["subscription_id", "account_id", "plan_name", "mrr", "arr", "status", "billing_interval", "seats"],
    "invoice": ["invoice_id", "account_id", "amount", "currency", "status", "attempt_count"],
    "usage_event": ["event_id", "account_id", "user_id", "feature_name", "event_count", "session_duration_seconds", "occurred_at"],
    "ticket": ["ticket_id", "account_id", "subject", "priority", "status", "csat_score", "resolution_time_hours"],
    "lead": ["lead_id", "converted_account_id", "funnel_stage", "lead_score", "converted_mrr", "days_lead_to_trial",
             "days_trial_to_paid", "days_lead_to_paid"],
}


def ingest_validate(records: DataFrame, kind: str) -> DataFrame:
    """Normalised records with ``reject_reason``; an empty list means accepted."""
    absent = {c: F.lit(None).cast("string") for c in FIELDS[kind] if c not in records.columns}
    full = records.withColumns(absent) if absent else records
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(reason)) for reason, bad in rules(kind).items()]))
    return full.withColumn("reject_reason", reasons).withColumns(normalised(kind))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reject_reason") == 0).drop("reject_reason")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reject_reason") > 0)
