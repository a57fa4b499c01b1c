"""Monthly product-usage measures per account."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recurra.config import MetricConfig
from recurra.functions.expr import banded, month_key, month_start, safe_divide, surrogate_key

INTENSITY = [(500, "power_user"), (100, "regular"), (20, "occasional"), (1, "minimal")]


#: features with a bit of their own; others are counted by name
FEATURE_BITS = 60


def feature_bits(features: DataFrame) -> DataFrame:
    """The catalogue with a number for each feature, from 0."""
    numbered = F.row_number().over(Window.orderBy("feature_id")) - 1
    return features.select("feature_id", "is_core", "is_premium", "health_weight", numbered.alias("bit"))


def usage_monthly(events: DataFrame, features: DataFrame) -> DataFrame:
    """All distinct counts of a month in one scan of the events, which are unique by ``event_id``.

    Days and catalogue features are bits of a number, so their distinct counts are bit counts of an OR.
    The first aggregation is by account, month, user and session: it runs with fixed-width
    buffers and map-side combine, and the events of a hot account spread over all tasks. Users
    and sessions are counted on its rows, not on the events. Weights are a key of the first aggregation, for
    there are few, and so are features that the catalogue lacks or that come after the first sixty.
    """
    catalogue = feature_bits(features)
    e = events.select(
        "account_id",
        "event_id",
        "user_id",
        "session_id",
        "feature_id",
        "duration_seconds",
        F.col("occurred_at").cast("date").alias("active_day"),
    ).withColumn("month_start", month_start("active_day"))
    e = e.join(catalogue, "feature_id", "left")
    known = F.coalesce(F.col("bit") < FEATURE_BITS, F.lit(False))
    bit = F.expr("shiftleft(1L, bit)")
    other = F.when(~known, F.col("feature_id"))
    weight = F.when(F.col("feature_id").isNotNull(), F.col("health_weight")).otherwise(F.lit(0.0))
    sessions = e.withColumns({"other": other, "weight": weight}).groupBy("account_id", "month_start", "user_id", "session_id", "other", "weight").agg(
        F.count("event_id").alias("events"),
        F.sum("duration_seconds").alias("duration"),
        F.count("duration_seconds").alias("timed"),
        F.bit_or(F.expr("shiftleft(1, dayofmonth(active_day))")).alias("days"),
        F.bit_or(F.when(known, bit)).alias("features"),
        F.bit_or(F.when(known & F.col("is_core"), bit)).alias("core"),
        F.bit_or(F.when(known & F.col("is_premium"), bit)).alias("premium"),
        F.max(F.col("other").isNotNull() & F.col("is_core")).alias("other_core"),
        F.max(F.col("other").isNotNull() & F.col("is_premium")).alias("other_premium"),
        F.max("active_day").alias("last_active_date"),
    )
    bits = lambda c: F.coalesce(F.bit_count(F.bit_or(c)), F.lit(0))
    named = lambda c: F.countDistinct(F.when(F.col(c), F.col("other")))
    g = sessions.groupBy("account_id", "month_start").agg(
        F.sum("events").alias("total_events"),
        F.countDistinct("user_id").alias("active_users"),
        F.countDistinct("session_id").alias("total_sessions"),
        (bits("features") + F.countDistinct("other")).alias("distinct_features_used"),
        F.sum("duration").alias("total_duration_seconds"),
        F.sum("timed").alias("timed_events"),
        bits("days").cast("bigint").alias("active_days_in_month"),
        (bits("core") + named("other_core")).alias("core_features_used"),
        (bits("premium") + named("other_premium")).alias("premium_features_used"),
        F.sum_distinct("weight").alias("feature_adoption_score"),
        F.max("last_active_date").alias("last_active_date"),
    )
    return g.select(
        "account_id",
        "month_start",
        month_key("month_start").alias("month_key"),
        "total_events",
        "active_users",
        "total_sessions",
        "distinct_features_used",
        "total_duration_seconds",
        safe_divide("total_duration_seconds", "timed_events").alias("avg_session_duration_seconds"),
        safe_divide("total_events", "active_days_in_month").alias("avg_events_per_active_day"),
        "active_days_in_month",
        "core_features_used",
        "premium_features_used",
        "feature_adoption_score",
        "last_active_date",
        F.datediff(F.last_day("month_start"), "last_active_date").alias("days_since_last_activity"),
    )


def usage_flags(monthly: DataFrame, cfg: MetricConfig) -> DataFrame:
    w = Window.partitionBy("account_id").orderBy("month_start")
    m = monthly.withColumns(
        {
            "prev_month_events": F.lag("total_events").over(w),
            "prev_month_active_users": F.lag("active_users").over(w),
            "prev_month_features_used": F.lag("distinct_features_used").over(w),
        }
    )
    delta = F.col("total_events") - F.coalesce("prev_month_events", F.lit(0))
    change = safe_divide(F.col("total_events") - F.col("prev_month_events"), F.col("prev_month_events"))
    return m.withColumns(
        {
            "account_month_key": surrogate_key("account_id", "month_key"),
            "events_mom_delta": delta,
            "events_mom_pct_change": change,
            "has_usage_drop_flag": F.coalesce(change < -cfg.usage_drop, F.lit(False)),
            "has_no_login_flag": F.coalesce(F.col("days_since_last_activity") >= cfg.idle_days, F.lit(False)),
            "usage_intensity": banded(F.col("total_events"), INTENSITY, "inactive"),
        }
    )
