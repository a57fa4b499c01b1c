"""CSV, JSON, Parquet and JDBC scans and sinks for the raw layer."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recurra.sources.quoted import longest_file, quoted_rows, range_bytes

# Raw files, their target tables and load order.
RAW_FILES = {
    "plans": "raw_plans", "features": "raw_features", "calendar": "raw_calendar", "accounts": "raw_accounts",
    "subscriptions": "raw_subscriptions", "invoices": "raw_invoices", "usage_events": "raw_usage_events",
    "support_tickets": "raw_tickets", "leads": "raw_leads",
}


#: a quote inside a quoted value is doubled
QUOTING = {"quote": '"', "escape": '"'}


def _header_scan(spark: SparkSession, path: str, multi_line: bool) -> DataFrame | None:
    """Text columns by header and ``_file``; None if there is no such file.

    Files with line breaks in values are read by a task each as long as all are no longer than one byte range, and range by range beyond.
    """
    try:
        rows = spark.read.options(header=True, multiLine=multi_line, **QUOTING).csv(path)
        if multi_line and longest_file(spark, path) > range_bytes(spark):
            return quoted_rows(spark, path, rows.columns, QUOTING)
        return rows.select("*", F.col("_metadata.file_name").alias("_file"))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            warnings.warn(f"no such file, skipped: {path}", stacklevel=3)
            return None
        raise


def csv_text_scan(spark: SparkSession, path: str, columns: list[str], loaded_at: dt.datetime | None = None, multi_line: bool = True) -> DataFrame:
    """Listed columns as text with lineage. Absent columns and blanks are NULL; a missing file is empty.

    Quoted values may hold line breaks; files known to have none need no shuffle with ``multi_line=False``.
    """
    stamp = F.lit(loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    raw = _header_scan(spark, path, multi_line)
    if raw is None:
        lineage = [T.StructField("_row_id", T.LongType()), T.StructField("_loaded_at", T.TimestampNTZType()),
                   T.StructField("_source_file", T.StringType())]
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns] + lineage))
    found = set(raw.columns)
    text = [
        (F.nullif(F.col(f"`{c}`"), F.lit("")) if c in found else F.lit(None).cast("string")).alias(c) for c in columns
    ]
    return raw.select(
        *text, F.monotonically_increasing_id().alias("_row_id"), stamp.alias("_loaded_at"),
        F.col("_file").alias("_source_file"),
    )


# Column names with a type other than text.
FLAGS = ["is_weekend", "is_escalated", "is_converted", "is_lost", "seat_based", "is_annual", "payment_succeeded", "is_dunning"]
AMOUNTS = ["monthly_price", "annual_price", "price_per_seat", "mrr", "amount", "mrr_at_conversion", "health_score_at_event",
           "health_score_at_open", "health_score_baseline", "seat_utilization_pct", "trial_engagement_score", "failure_rate_pct"]
COUNTS = ["min_seats", "max_seats", "seats", "seats_purchased", "active_users_this_month", "session_duration_minutes",
          "dunning_count", "resolution_days", "days_to_convert", "months_to_churn", "csat_score", "tier"]


def type_for(column: str) -> str:
    """Column type by naming rule."""
    if column.endswith(("_date", "_at", "_month")) or column in ("date", "month"):
        return "date"
    if column.endswith("_id"):
        return "string"
    for names, kind in ((FLAGS, "boolean"), (AMOUNTS, "decimal(12,4)"), (COUNTS, "int")):
        if column in names:
            return kind
    return "string"


def csv_typed_scan(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All columns of a CSV typed by their names; blanks and the text None are NULL."""
    raw = _header_scan(spark, path, multi_line)
    if raw is None:
        raise FileNotFoundError(path)
    present = lambda c: F.when(~F.col(f"`{c}`").isin("", "None"), F.col(f"`{c}`"))
    return raw.select(*[present(c).try_cast(type_for(c)).alias(c) for c in raw.columns if c != "_file"])


def load_raw_layer(spark: SparkSession, folder: str, columns: dict[str, list[str]]) -> dict[str, DataFrame]:
    """All raw tables of a folder, also registered as temporary views."""
    layer = {}
    for name, table in RAW_FILES.items():
        if name in columns:
            layer[table] = csv_text_scan(spark, f"{folder}/{name}.csv", columns[name])
            layer[table].createOrReplaceTempView(table)
    return layer


def csv_sink(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, **QUOTING).csv(path)


def json_sink(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_full_refresh(df: DataFrame, path: str, partition: str | None = None, finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Replace a table and return its rows. REBALANCE lets AQE split a heavy partition value and merge light ones.

    ``finish`` adds columns to the rows once they are dealt, so these are neither shuffled nor sorted.
    """
    if partition:
        df = df.hint("rebalance", partition)
    if finish:
        df = finish(df.sortWithinPartitions(partition) if partition else df)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return df


def write_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions that occur in ``df``."""
    df.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        partition
    ).parquet(path)


def write_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def schema_name(target: str, custom: str | None, default: str) -> str:
    """Production uses the plain schema; other targets prefix it with their default schema."""
    if not custom:
        return default
    return custom if target == "prod" else f"{default}_{custom}"


def jdbc_options(url: str | None = None, *, host=None, port=5432, database=None, table: str, user=None, password=None,
                 partition: tuple[str, int, int, int] | None = None, fetch_size: int = 10000) -> dict[str, str]:
    """Options of a JDBC scan from a URL or from its parts; ``partition`` is (column, low, high, parts)."""
    options = {"url": url or f"jdbc:postgresql://{host}:{port}/{database}", "dbtable": table, "fetchsize": str(fetch_size)}
    if user:
        options.update(user=user, password=password or "")
    if partition:
        column, low, high, parts = partition
        options.update(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return options


def jdbc_scan(spark: SparkSession, **kwargs) -> DataFrame:
    """Parallel database read; without ``partition`` the driver reads through one connection."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def jdbc_sink(df: DataFrame, mode: str = "append", **kwargs) -> None:
    df.write.format("jdbc").mode(mode).options(**jdbc_options(**kwargs), batchsize="1000").save()


# Pass-through columns of the bronze views.
BRONZE = {
    "accounts": ["account_id", "company_name", "industry", "region", "country", "company_size", "acquisition_channel",
                 "created_at", "updated_at", "_loaded_at"],
    "subscriptions": ["subscription_id", "account_id", "plan_id", "plan_name", "status", "mrr", "billing_cycle",
                      "seats_purchased", "seats_used", "start_date", "end_date", "_loaded_at"],
    "invoices": ["invoice_id", "account_id", "subscription_id", "amount", "currency", "status", "due_date", "paid_date",
                 "failed_date", "invoice_date", "_loaded_at"],
    "usage_events": ["event_id", "account_id", "user_id", "feature_name", "event_type", "session_id", "duration_seconds",
                     "occurred_at", "_loaded_at"],
    "tickets": ["ticket_id", "account_id", "user_id", "category", "priority", "status", "csat_score", "created_at",
                "resolved_at", "first_response_at", "_loaded_at"],
    "leads": ["lead_id", "account_id", "industry", "company_size", "acquisition_channel", "trial_started_at",
              "trial_ended_at", "converted_at", "created_at", "_loaded_at"],
}


def bronze_views(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    views = {}
    for name, columns in BRONZE.items():
        views[name] = raw[name].select(*columns)
        views[name].createOrReplaceTempView(f"bronze_{name}")
    return views
