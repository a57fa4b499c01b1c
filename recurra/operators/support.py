"""Monthly support-ticket measures per account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.config import MetricConfig
from recurra.functions.expr import count_if, mean_exact, month_key, month_start, safe_divide, surrogate_key

OPEN = ["open", "in_progress"]


def hours_between(a: Column, b: Column) -> Column:
    seconds = F.timestamp_diff("SECOND", a, b)
    return seconds.cast("double") / 3600


def ticket_monthly(tickets: DataFrame) -> DataFrame:
    p, s, score = F.col("priority"), F.col("status"), F.col("csat_score")
    total = F.count("ticket_id")
    return (
        tickets.withColumn("month_start", month_start(F.col("created_at").cast("date")))
        .groupBy("account_id", "month_start")
        .agg(
            total.alias("total_tickets"),
            *[count_if(p == x).alias(f"{x}_tickets") for x in ("critical", "high", "medium", "low")],
            count_if(s.isin(OPEN)).alias("open_tickets"),
            count_if(s == "resolved").alias("resolved_tickets"),
            count_if(s == "escalated").alias("escalated_tickets"),
            count_if(p.isin("high", "critical") & s.isin(*OPEN, "escalated")).alias("unresolved_high_priority"),
            mean_exact(score).alias("avg_csat_score"),
            F.count(score).alias("csat_responses"),
            count_if(score < 3).alias("low_csat_count"),
            mean_exact(hours_between(F.col("created_at"), F.col("resolved_at"))).alias("avg_resolution_hours"),
            mean_exact(hours_between(F.col("created_at"), F.col("first_response_at"))).alias("avg_first_response_hours"),
            safe_divide(count_if(F.col("is_escalated")), total).alias("escalation_rate"),
            safe_divide(count_if(s == "resolved"), total).alias("resolution_rate"),
        )
        .withColumn("month_key", month_key("month_start"))
    )


def ticket_burden(monthly: DataFrame, cfg: MetricConfig) -> DataFrame:
    low = F.col("avg_csat_score") < cfg.low_csat
    load = (
        F.col("total_tickets") * 5
        + F.col("critical_tickets") * 20
        + F.col("high_tickets") * 10
        + F.col("unresolved_high_priority") * 15
        + F.when(low, 20).otherwise(0)
    )
    burden = F.least(F.lit(100), load).cast("int")
    w = Window.partitionBy("account_id").orderBy("month_start")
    return monthly.withColumns(
        {
            "account_month_key": surrogate_key("account_id", "month_key"),
            "prev_month_tickets": F.lag("total_tickets").over(w),
            "has_high_priority_flag": F.col("unresolved_high_priority") >= cfg.open_tickets,
            "has_low_csat_flag": F.coalesce(low & (F.col("csat_responses") > 0), F.lit(False)),
            "support_burden_score": burden,
            "support_health_score": F.lit(100) - burden,
        }
    )
