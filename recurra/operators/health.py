"""Account health: signals joined per account-month, component scores, risk."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from recurra.config import HealthWeights, MetricConfig, RISK_LABELS, Tables
from recurra.functions.expr import banded, mapped, month_key, month_start, months_apart, rounded, surrogate_key
from recurra.operators.mrr import ATTRIBUTES, invoice_monthly, mrr_movement_type, newest_paid_months
from recurra.operators.spine import join_months
from recurra.operators.staging import stg_features
from recurra.operators.support import ticket_burden, ticket_monthly
from recurra.operators.usage import usage_flags, usage_monthly


def health_signals(t: Tables, cfg: MetricConfig, as_of: dt.date) -> DataFrame:
    """Paying account-months with usage, support and payment signals.

    Every input is reduced to (account, month) before it is joined, so the joins
    carry one row per account-month on both sides.
    """
    return joined_signals(
        mrr_movement_type(t.subscriptions, as_of), t.accounts, usage_monthly(t.usage_events, stg_features(t.features)),
        ticket_monthly(t.tickets), invoice_monthly(t.invoices), cfg,
    )


def joined_signals(movements: DataFrame, accounts: DataFrame, usage: DataFrame, tickets: DataFrame, invoices: DataFrame, cfg: MetricConfig) -> DataFrame:
    """Signals from classified paying months and monthly measures."""
    moves = movements.select(
        "account_id", "month_start", "mrr", "prev_mrr", "plan_name", "seat_utilization_rate", "seats_purchased", "seats_used"
    )
    born = F.col("created_at").cast("date")
    accounts = accounts.select("account_id", *ATTRIBUTES, month_start(born).alias("cohort_start"))
    usage = usage_flags(usage, cfg).select(
        "account_id", "month_start", "total_events", "active_users", "total_sessions", "distinct_features_used",
        "feature_adoption_score", "active_days_in_month", "last_active_date", "days_since_last_activity",
        "usage_intensity", "has_usage_drop_flag", "has_no_login_flag", "events_mom_pct_change",
    )
    support = ticket_burden(tickets, cfg).select(
        "account_id", "month_start", "total_tickets", "open_tickets", "unresolved_high_priority", "avg_csat_score",
        "support_burden_score", "support_health_score", "has_high_priority_flag", "has_low_csat_flag", "escalation_rate",
    )
    paid = invoices.select("account_id", "month_start", "failed_payments")
    joined = moves.join(accounts, "account_id").where(F.col("month_start") >= F.col("cohort_start"))
    for values in (usage, support, paid):
        joined = join_months(joined, values)

    def filled(name, default):
        return F.coalesce(name, F.lit(default)).alias(name)

    return joined.select(
        surrogate_key("account_id", month_key("month_start")).alias("account_month_key"),
        "account_id",
        *ATTRIBUTES,
        "month_start",
        month_key("month_start").alias("month_key"),
        months_apart(F.col("cohort_start"), F.col("month_start")).alias("months_since_created"),
        month_key("cohort_start").alias("cohort_month"),
        "mrr",
        "prev_mrr",
        "plan_name",
        filled("seat_utilization_rate", 0.0),
        filled("seats_purchased", 0),
        filled("seats_used", 0),
        filled("total_events", 0),
        filled("active_users", 0),
        filled("total_sessions", 0),
        filled("distinct_features_used", 0),
        filled("feature_adoption_score", 0.0),
        filled("active_days_in_month", 0),
        "last_active_date",
        filled("days_since_last_activity", 31),
        filled("usage_intensity", "inactive"),
        filled("has_usage_drop_flag", False),
        filled("has_no_login_flag", True),
        "events_mom_pct_change",
        filled("total_tickets", 0),
        filled("open_tickets", 0),
        filled("unresolved_high_priority", 0),
        "avg_csat_score",
        filled("support_burden_score", 0),
        filled("support_health_score", 100),
        filled("has_high_priority_flag", False),
        filled("has_low_csat_flag", False),
        filled("escalation_rate", 0.0),
        filled("failed_payments", 0),
        (F.coalesce("failed_payments", F.lit(0)) > 0).alias("has_payment_failure"),
    )


def health_components(signals: DataFrame) -> DataFrame:
    """Seven scores between 0 and 100."""
    seats = [(0.80, 100), (0.60, 80), (0.40, 60), (0.25, 40)]
    tenure = [(24, 100), (12, 80), (6, 60), (3, 40)]
    usage = {"power_user": 100, "regular": 80, "occasional": 50, "minimal": 20}
    csat = F.col("avg_csat_score")
    return signals.withColumns(
        {
            "usage_score": mapped(F.col("usage_intensity"), usage, 0),
            "seat_util_score": banded(F.col("seat_utilization_rate"), seats, 10),
            "feature_score": F.least(F.lit(100.0), F.col("feature_adoption_score") * 10),
            "support_score": F.col("support_health_score"),
            "csat_score": F.when(csat.isNull(), 70.0).otherwise((csat - 1) / 4 * 100),
            "payment_score": mapped(F.col("failed_payments"), {0: 100, 1: 50}, 0),
            "tenure_score": banded(F.col("months_since_created"), tenure, 20),
        }
    )


def weighted(parts: dict[str, float], weights: HealthWeights) -> Column:
    """Weighted sum of component columns in the order usage ... tenure."""
    total = None
    for column, field in parts.items():
        term = F.col(column).cast("double") * getattr(weights, field)
        total = term if total is None else total + term
    return total


SCORE_COLUMNS = {
    "usage_score": "usage", "seat_util_score": "seats", "feature_score": "features", "support_score": "support",
    "csat_score": "csat", "payment_score": "payment", "tenure_score": "tenure",
}
RISK_COLUMNS = {
    "usage_drop": "has_usage_drop_flag", "no_login": "has_no_login_flag", "high_tickets": "has_high_priority_flag",
    "payment_failure": "has_payment_failure", "low_csat": "has_low_csat_flag",
}


def score_health(components: DataFrame, cfg: MetricConfig) -> DataFrame:
    """Weighted score, risk flags, tier, risk level and reasons."""
    flags = {f"risk_{k}": F.col(c) for k, c in RISK_COLUMNS.items()}
    flags["risk_low_seat_util"] = F.col("seat_utilization_rate") < cfg.low_seat_util
    s = components.withColumns({"health_score": rounded(weighted(SCORE_COLUMNS, cfg.weights), 1), **flags})
    active = F.array_compact(F.array(*[F.when(F.col(f"risk_{k}"), F.lit(k)) for k in RISK_LABELS]))
    shown = F.concat_ws("|", *[F.when(F.col(f"risk_{k}"), F.lit(v)) for k, v in RISK_LABELS.items()])
    s = s.withColumns({"risk_flags": active, "risk_reasons": shown}).withColumn("risk_flag_count", F.size("risk_flags"))
    score, n = F.col("health_score"), F.col("risk_flag_count")
    level = (
        F.when((score < 40) | (n >= 4), "critical")
        .when((score < 60) | (n >= 3), "high")
        .when((score < 75) | (n >= 2), "medium")
        .when((score < 85) | (n >= 1), "low")
        .otherwise("minimal")
    )
    return s.withColumns(
        {
            "health_tier": banded(score, [(80, "healthy"), (60, "at_risk"), (40, "high_risk")], "critical"),
            "churn_risk_level": level,
            "churn_risk_score": rounded(100 - score, 1),
        }
    )


def fct_account_monthly_health(t: Tables, cfg: MetricConfig, as_of: dt.date) -> DataFrame:
    return score_health(health_components(health_signals(t, cfg, as_of)), cfg)


def newest_account_health(t: Tables, cfg: MetricConfig, as_of: dt.date, months: int, usage: DataFrame, tickets: DataFrame, invoices: DataFrame) -> DataFrame:
    """Health of the newest ``months`` paying months of each account, from monthly measures: signals meet these months only."""
    signals = joined_signals(newest_paid_months(t.subscriptions, as_of, months), t.accounts, usage, tickets, invoices, cfg)
    return score_health(health_components(signals), cfg)


def health_score_linear(signals: DataFrame, cfg: MetricConfig) -> DataFrame:
    """Straight-line component scores on measured inputs."""
    csat = F.col("avg_csat_score")
    parts = signals.select(
        "account_id",
        "month_start",
        F.least(F.lit(100.0), F.col("total_sessions") / 100 * 100).alias("usage_score"),
        (F.col("seat_utilization_rate") * 100).alias("seat_util_score"),
        (F.col("distinct_features_used") / 12 * 100).alias("feature_score"),
        F.greatest(F.lit(0), 100 - F.col("open_tickets") * 20).alias("support_score"),
        F.when(csat.isNull(), 70.0).otherwise((csat - 1) / 4 * 100).alias("csat_score"),
        F.greatest(F.lit(0), 100 - F.col("failed_payments") * 40).alias("payment_score"),
        F.least(F.lit(100.0), F.col("months_since_created") / 24 * 100).alias("tenure_score"),
    )
    return parts.select(
        "account_id",
        "month_start",
        *[rounded(F.col(c), 4).alias(c) for c in SCORE_COLUMNS],
        rounded(weighted(SCORE_COLUMNS, cfg.weights), 2).alias("health_score"),
    ).withColumn("risk_level", banded(F.col("health_score"), [(75, "healthy"), (50, "at_risk")], "critical"))
