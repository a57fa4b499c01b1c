"""All-text raw rows to typed rows: latest version per key, guarded casts, key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F



def latest_per_key(df: DataFrame, keys: list[str], order: str, tiebreak: list[str] | None = None) -> DataFrame:
    """Newest row per key by partial aggregation.

    Copies of one key collapse inside every map task, so a key that holds a third
    of all rows reaches the reducer as one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    by = list(dict.fromkeys([order, *(tiebreak or [])]))
    if set(rest) <= set(by):
        # the order names every column, so its maximum is the row: no column is shuffled twice
        newest = F.max(F.struct(*by)).alias("r")
        return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"r.{c}") for c in rest])
    newest = F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in by])).alias("r")
    return df.groupBy(*keys).agg(newest).select(*keys, "r.*")


def cast_text(c: str, to: str, default=None) -> Column:
    """NULL for blanks and for text that does not parse; an optional default."""
    value = F.nullif(F.col(c), F.lit("")).try_cast(to)
    return (F.coalesce(value, F.lit(default).cast(to)) if default is not None else value).alias(c)


# Column types and defaults of the typed layer.
TYPED = {
    "plans": {"plan_id": "string", "plan_name": "string", "monthly_price": "decimal(10,2)", "annual_price": "decimal(10,2)",
              "max_seats": "int", "max_workflows": "int", "tier": "string", "is_active": "boolean"},
    "features": {"feature_id": "string", "feature_name": "string", "feature_category": "string", "feature_tier": "string",
                 "is_core": "boolean", "is_premium": "boolean", "is_beta": "boolean", "is_deprecated": "boolean"},
    "calendar": {"date_id": "int", "full_date": "date", "year": "int", "quarter": "int", "month": "int", "month_name": "string",
                 "week": "int", "day_of_week": "int", "day_name": "string", "is_weekend": "boolean", "is_month_start": "boolean",
                 "is_month_end": "boolean"},
    "accounts": {"account_id": "bigint", "company_name": "string", "industry": "string", "company_size": "string",
                 "region": "string", "country": "string", "acquisition_channel": "string", "account_owner": "string",
                 "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz", "website": "string",
                 "annual_revenue_usd": "decimal(18,2)", "employee_count": "int"},
    "subscriptions": {"subscription_id": "bigint", "account_id": "bigint", "plan_id": "string", "plan_name": "string",
                      "status": "string", "billing_cycle": "string", "mrr": "decimal(12,2)", "arr": "decimal(18,2)",
                      "seats_purchased": "int", "seats_used": "int", "start_date": "date", "end_date": "date",
                      "trial_start": "date", "trial_end": "date", "cancelled_at": "timestamp_ntz",
                      "cancellation_reason": "string", "discount_pct": "decimal(6,3)"},
    "invoices": {"invoice_id": "string", "account_id": "bigint", "subscription_id": "bigint", "amount": "decimal(12,2)",
                 "currency": "string", "status": "string", "invoice_date": "date", "due_date": "date", "paid_date": "date",
                 "failed_date": "date", "payment_method": "string", "failure_reason": "string", "retry_count": "int"},
    "usage_events": {"event_id": "bigint", "account_id": "bigint", "user_id": "bigint", "feature_id": "string",
                     "feature_name": "string", "event_type": "string", "platform": "string", "session_id": "string",
                     "duration_seconds": "int", "actions_count": "int", "occurred_at": "timestamp_ntz"},
    "tickets": {"ticket_id": "bigint", "account_id": "bigint", "user_id": "bigint", "subject": "string", "category": "string",
                "priority": "string", "status": "string", "csat_score": "decimal(3,1)", "is_escalated": "boolean",
                "created_at": "timestamp_ntz", "resolved_at": "timestamp_ntz", "first_response_at": "timestamp_ntz",
                "agent_id": "string"},
    "leads": {"lead_id": "bigint", "account_id": "bigint", "company_name": "string", "industry": "string",
              "company_size": "string", "region": "string", "acquisition_channel": "string", "lead_source": "string",
              "lead_score": "int", "trial_engagement_score": "double", "created_at": "timestamp_ntz",
              "qualified_at": "timestamp_ntz", "demo_requested_at": "timestamp_ntz", "demo_completed_at": "timestamp_ntz",
              "trial_started_at": "timestamp_ntz", "trial_ended_at": "timestamp_ntz", "converted_at": "timestamp_ntz",
              "lost_at": "timestamp_ntz", "plan_id": "string", "first_mrr": "decimal(12,2)", "lost_reason": "string"},
}
DEFAULTS = {
    "plans": {"is_active": True}, "features": {"is_core": False},
    "calendar": {"is_weekend": False, "is_month_start": False, "is_month_end": False},
    "invoices": {"currency": "USD", "retry_count": 0},
}
KEYS = {
    "plans": "plan_id", "features": "feature_id", "calendar": "date_id", "accounts": "account_id",
    "subscriptions": "subscription_id", "invoices": "invoice_id", "usage_events": "event_id", "tickets": "ticket_id",
    "leads": "lead_id",
}


def newest_rows(raw: DataFrame, entity: str) -> DataFrame:
    """Newest all-text row of each key with the contract's columns that the source has."""
    key = KEYS[entity]
    have = [c for c in TYPED[entity] if c in raw.columns]
    # rows of one load are told apart by file and row, then by value
    lineage = [c for c in ("_source_file", "_row_id") if c in raw.columns]
    rows = raw.where(F.nullif(F.col(key), F.lit("")).isNotNull()).select(*have, "_loaded_at", *lineage)
    return latest_per_key(rows, [key], "_loaded_at", lineage + [c for c in have if c != key]).select(*have, "_loaded_at")


def typed_columns(entity: str, have: list[str]) -> list[Column]:
    types, defaults = TYPED[entity], DEFAULTS.get(entity, {})
    missing = [F.lit(defaults.get(c)).cast(types[c]).alias(c) for c in types if c not in have]
    return [cast_text(c, types[c], defaults.get(c)) for c in have] + missing


def silver(raw: DataFrame, entity: str) -> DataFrame:
    """Typed table of one entity from its all-text rows; values that do not parse are NULL."""
    newest = newest_rows(raw, entity)
    return newest.select(*typed_columns(entity, newest.columns[:-1]), "_loaded_at")


def checked(raw: DataFrame, entity: str) -> DataFrame:
    """Typed rows with the names of the columns whose text does not parse (``_failed``) and, where there are any, the text as it came (``_text``)."""
    newest = newest_rows(raw, entity)
    have = newest.columns[:-1]
    fails = [F.when(F.nullif(F.col(c), F.lit("")).isNotNull() & F.col(c).try_cast(TYPED[entity][c]).isNull(), F.lit(c)) for c in have]
    failed = F.array_compact(F.array(*fails))
    text = F.when(F.size("_failed") > 0, F.to_json(F.struct(*have)))
    return newest.withColumn("_failed", failed).withColumn("_text", text).select(*typed_columns(entity, have), "_loaded_at", "_failed", "_text")


def write_typed(raw: DataFrame, entity: str, path: str) -> tuple[DataFrame, DataFrame]:
    """Typed table and quarantine of one entity, written by one job that parses each row once.

    A row with text that does not parse goes to the quarantine as a whole, (entity, key, columns,
    text, _loaded_at), instead of reaching the typed table with holes; once its source has
    mended it, the next load's newest row passes.
    """
    rows = checked(raw, entity).withColumn("_passed", F.size("_failed") == 0)
    rows.write.mode("overwrite").partitionBy("_passed").parquet(path)
    stored = raw.sparkSession.read.schema(rows.schema).parquet(path)
    good = stored.where("_passed").drop("_failed", "_text", "_passed")
    bad = stored.where("NOT _passed").select(
        F.lit(entity).alias("entity"), F.get_json_object("_text", f"$.{KEYS[entity]}").alias("key"), F.concat_ws("|", "_failed").alias("columns"), F.col("_text").alias("text"), "_loaded_at")
    return good, bad


def fk_guard(rows: DataFrame, parents: DataFrame, key: str = "account_id") -> DataFrame:
    """Keep rows whose parent exists."""
    return rows.join(parents.select(key), key, "left_semi")


def orphans(rows: DataFrame, parents: DataFrame, key: str = "account_id") -> DataFrame:
    return rows.where(F.col(key).isNotNull()).join(parents.select(key), key, "left_anti")


def ticket_durations(tickets: DataFrame) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", F.col("created_at"), F.col("resolved_at"))
    return tickets.withColumn("resolution_hours", seconds.cast("double") / 3600)


def lead_durations(leads: DataFrame) -> DataFrame:
    whole_days = lambda a, b: F.datediff(F.col(b).cast("date"), F.col(a).cast("date"))
    return leads.withColumns(
        {
            "days_to_convert": whole_days("created_at", "converted_at"),
            "trial_duration_days": whole_days("trial_started_at", "trial_ended_at"),
        }
    )
