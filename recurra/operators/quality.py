"""Data-quality checks. Every check is a frame of result rows, one pass over its table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from recurra.functions.expr import count_if, safe_divide



def verdict(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("FAIL")


def result_row(df: DataFrame, name: str, table: str, value: Column, op: str, expected: float) -> DataFrame:
    """One row: an aggregate compared with an expected value."""
    v = F.col("result")
    compare = {"eq": v == expected, "gt": v > expected, "lt": v < expected, "gte": v >= expected, "lte": v <= expected}[op]
    return df.agg(value.cast("double").alias("result")).select(
        F.lit(name).alias("check_name"), F.lit(table).alias("table_name"), "result",
        F.lit(f"{op} {expected:g}").alias("expected"), verdict(compare).alias("status"),
    )


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """NULL counts of all columns from a single aggregation."""
    counts = df.agg(*[count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failing")) for c in columns])
    return counts.select(F.lit(table).alias("table_name"), F.inline(rows)).withColumn("status", verdict(F.col("failing") == 0))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def unaccepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values)).groupBy(
        F.col(column).cast("string").alias("value")
    ).agg(F.count(F.lit(1)).alias("failing"))


def orphan_keys(df: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent. Children shrink to distinct keys before the join."""
    refs = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    known = parents.select(F.col(parent_key or key).alias(key))
    return refs.join(known, key, "left_anti")


def broken(df: DataFrame, expression: Column) -> DataFrame:
    """Rows for which the expression is false or NULL."""
    return df.where(~F.coalesce(expression, F.lit(False)))


def between_mostly(df: DataFrame, table: str, column: str, low: float, high: float, mostly: float = 1.0) -> DataFrame:
    seen = F.count(column)
    inside = count_if(F.col(column).between(low, high))
    ratio = F.coalesce(safe_divide(inside, seen), F.lit(1.0))
    return df.agg(seen.alias("checked"), inside.alias("in_range"), ratio.alias("ratio")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "checked", "in_range",
        verdict(F.col("ratio") >= mostly).alias("status"),
    )


def positive_values(df: DataFrame, column: str) -> DataFrame:
    """Values that are zero or negative, with how often they occur."""
    return df.where(F.col(column) <= 0).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("failing"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def freshness(df: DataFrame, table: str, now: dt.datetime, warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    age = F.timestamp_diff("HOUR", F.max("_loaded_at"), F.lit(now).cast("timestamp_ntz"))
    status = F.when(F.col("age_hours") >= error_hours, "ERROR").when(F.col("age_hours") >= warn_hours, "WARN").otherwise("PASS")
    return df.agg(age.alias("age_hours")).select(F.lit(table).alias("table_name"), "age_hours", status.alias("status"))


def source_vs_table(source: DataFrame, loaded: DataFrame, table: str) -> DataFrame:
    a = source.agg(F.count(F.lit(1)).alias("source_rows"))
    b = loaded.agg(F.count(F.lit(1)).alias("loaded_rows"))
    # two one-row frames meet on a constant key
    one = lambda df: df.withColumn("k", F.lit(1))
    return one(a).join(one(b), "k").select(
        F.lit(table).alias("table_name"), "source_rows", "loaded_rows",
        verdict(F.col("source_rows") == F.col("loaded_rows")).alias("status"),
    )


# Accepted literals of the enumerated columns.
ENUMS = {
    ("subscriptions", "status"): ["active", "trial", "cancelled", "past_due", "paused"],
    ("subscriptions", "billing_cycle"): ["monthly", "annual"],
    ("invoices", "status"): ["paid", "failed", "pending", "refunded"],
    ("tickets", "priority"): ["low", "medium", "high", "critical"],
    ("tickets", "status"): ["open", "in_progress", "resolved", "closed", "escalated"],
}


def enum_constraints(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows outside the accepted literals, per enumerated column, plus the CSAT range."""
    parts = []
    for table in dict.fromkeys(t for t, _ in ENUMS):
        cols = {c: v for (t, c), v in ENUMS.items() if t == table}
        bad = {c: F.col(c).isNotNull() & ~F.col(c).isin(v) for c, v in cols.items()}
        if table == "tickets":
            bad["csat_score"] = F.col("csat_score").isNotNull() & ~F.col("csat_score").between(1, 5)
        counts = frames[table].agg(*[count_if(e).alias(c) for c, e in bad.items()])
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failing")) for c in bad])
        parts.append(counts.select(F.lit(table).alias("table_name"), F.inline(rows)))
    return union_all(parts).withColumn("status", verdict(F.col("failing") == 0))


def named_checks(t, movements: DataFrame, executive: DataFrame, as_of: dt.date) -> DataFrame:
    """Ten named invariants over staging and marts."""
    n = F.count(F.lit(1))
    bad = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    future = F.date_add(F.lit(as_of), 365)
    subs, inv, tix, leads = t.subscriptions, t.invoices, t.tickets, t.leads
    dup = duplicates(movements.select("month_start", "account_id"), ["month_start", "account_id"])
    zero = lambda df, name, table, v: result_row(df, name, table, F.coalesce(v, F.lit(0)), "eq", 0)
    return union_all(
        [
            zero(subs, "no null account_id", "subscriptions", bad(F.col("account_id").isNull())),
            zero(subs, "no negative mrr", "subscriptions", bad(F.col("mrr") < 0)),
            zero(orphan_keys(subs, t.accounts, "account_id"), "all accounts exist", "subscriptions", F.sum("rows")),
            zero(orphan_keys(subs, t.plans, "plan_id"), "all plans exist", "subscriptions", F.sum("rows")),
            zero(dup, "no duplicate account and month", "fct_mrr_movements", n),
            zero(executive, "total_mrr above zero", "mart_exec_revenue_summary", bad(F.col("total_mrr") <= 0)),
            zero(executive, "nrr in valid range", "mart_exec_revenue_summary", bad(~F.col("nrr").between(0.5, 2.0))),
            zero(tix, "csat in valid range", "tickets", bad(~F.col("csat_score").between(1, 5))),
            zero(inv, "no far-future invoice dates", "invoices", bad(F.col("invoice_date") > future)),
            zero(leads, "converted leads have an account", "leads", bad(F.col("converted_at").isNotNull() & F.col("account_id").isNull())),
        ]
    )


@dataclass(frozen=True)
class TableChecks:
    """A table with its key, the accepted number of keyed rows, and conditions that no row may meet."""

    rows: DataFrame
    key: str
    low: int
    high: int
    layer: str = "raw"
    broken: dict[str, Column] = field(default_factory=dict)


def table_results(tables: dict[str, TableChecks]) -> DataFrame:
    """A row for every check of every table: (layer, table_name, check_name, measured, low, high, status).

    All checks of a table are measured in one scan of it, as one aggregation.
    """
    parts = []
    for name, t in tables.items():
        checks = {"row_count": (F.count(t.key), t.low, t.high)} | {c: (count_if(e), 0, 0) for c, e in t.broken.items()}
        counts = t.rows.agg(*[m.cast("bigint").alias(f"c{i}") for i, (m, _, _) in enumerate(checks.values())])
        rows = [F.struct(F.lit(c).alias("check_name"), F.col(f"c{i}").alias("measured"), F.lit(low).cast("bigint").alias("low"), F.lit(high).cast("bigint").alias("high")) for i, (c, (_, low, high)) in enumerate(checks.items())]
        parts.append(counts.select(F.lit(t.layer).alias("layer"), F.lit(name).alias("table_name"), F.inline(F.array(*rows))))
    return union_all(parts).withColumn("status", verdict(F.col("measured").between(F.col("low"), F.col("high"))))


def observed(name: str, t: TableChecks) -> tuple[DataFrame, Callable[[], list[dict]]]:
    """The table's rows, measured while they are written or read for another purpose, and a function that then gives the results.

    No scan is added: the measures are collected by the job that consumes the rows. The function
    raises if no job has done so.
    """
    seen = Observation(f"checks of {name}")
    conditions = {c: count_if(e).cast("bigint").alias(f"c{i}") for i, (c, e) in enumerate(t.broken.items())}
    rows = t.rows.observe(seen, F.count(t.key).alias("n"), *conditions.values())

    def results() -> list[dict]:
        found = seen.get
        checks = [("row_count", found["n"], t.low, t.high)] + [(c, found[f"c{i}"], 0, 0) for i, c in enumerate(t.broken)]
        return [{"layer": t.layer, "table_name": name, "check_name": c, "measured": n, "low": low, "high": high, "status": "PASS" if low <= n <= high else "FAIL"} for c, n, low, high in checks]

    return rows, results


def report(results: DataFrame) -> DataFrame:
    """All result rows, then a row of totals for each table and one for all: ``failed`` of ``checks``."""
    totals = results.groupBy("table_name").agg(F.count(F.lit(1)).alias("checks"), count_if(F.col("status") == "FAIL").alias("failed"))
    overall = totals.agg(F.sum("checks").alias("checks"), F.sum("failed").alias("failed"))
    line = lambda df, level, table, check: df.select(
        F.lit(level).alias("level"), table.alias("table_name"), check.alias("check_name"), F.col("checks"), F.col("failed"), verdict(F.col("failed") == 0).alias("status"))
    one = results.withColumns({"checks": F.lit(1).cast("bigint"), "failed": F.when(F.col("status") == "FAIL", 1).otherwise(0).cast("bigint")})
    return union_all([line(one, "check", F.col("table_name"), F.col("check_name")), line(totals, "table", F.col("table_name"), F.lit("all")), line(overall, "overall", F.lit("all"), F.lit("all"))])


def fail_fast(results: DataFrame) -> None:
    """Raise on the first failing row; the limit lets Spark stop early."""
    first = results.where(F.col("status") != "PASS").limit(1).take(1)
    if first:
        raise AssertionError(f"data quality check failed: {first[0].asDict()}")


def fail_fast_tables(tables: dict[str, TableChecks]) -> None:
    """Check one table after another and raise at the first that fails, before the others are read."""
    for name, t in tables.items():
        fail_fast(table_results({name: t}))


# Rules every mart must satisfy: required columns, key, accepted values, ranges.
MART_RULES = {
    "fct_mrr_movements": {
        "required": ["account_month_key", "account_id", "month_start", "mrr", "mrr_movement_type"],
        "values": {"mrr_movement_type": ["new", "expansion", "contraction", "churned", "reactivation", "retained"]},
        "range": {"mrr": (0, 1e12), "new_mrr": (0, 1e12), "expansion_mrr": (0, 1e12), "contraction_mrr": (0, 1e12)},
    },
    "fct_account_monthly_health": {
        "required": ["account_month_key", "account_id", "month_start", "health_score", "health_tier", "churn_risk_level"],
        "values": {
            "health_tier": ["healthy", "at_risk", "high_risk", "critical"],
            "churn_risk_level": ["critical", "high", "medium", "low", "minimal"],
        },
        "range": {"health_score": (0, 100), "churn_risk_score": (0, 100), "risk_flag_count": (0, 6)},
    },
    "fct_customer_cohorts": {
        "required": ["cohort_period_key", "cohort_month", "months_since_created", "cohort_size"],
        "values": {"cohort_health": ["excellent", "good", "fair", "poor"]},
        "range": {"logo_retention_rate": (0, 1), "grr": (0, 1), "months_since_created": (0, 1200)},
    },
    "fct_sales_conversion": {
        "required": ["conversion_key", "lead_id", "funnel_stage"],
        "values": {"funnel_stage": ["lead", "qualified", "demo_requested", "demo_completed", "trial", "paid", "lost"]},
        "range": {"funnel_stage_order": (0, 6)},
    },
    "mart_exec_revenue_summary": {
        "required": ["exec_summary_key", "month_start", "total_mrr", "active_accounts"],
        "values": {},
        "range": {"logo_churn_rate": (0, 1), "grr": (0, 1)},
    },
    "mart_customer_success_summary": {
        "required": ["customer_success_key", "account_id", "health_score", "risk_priority_score"],
        "values": {"health_trend": ["improving", "declining", "stable"]},
        "range": {"health_score": (0, 100)},
    },
}


def mart_rules(name: str, df: DataFrame) -> DataFrame:
    """All row rules of one mart in one aggregation: NULLs, foreign values, ranges, repeated keys."""
    rule = MART_RULES[name]
    key = rule["required"][0]
    checks: dict[str, Column] = {}
    for c in rule["required"]:
        checks[f"not_null:{c}"] = count_if(F.col(c).isNull())
    for c, values in rule["values"].items():
        checks[f"accepted:{c}"] = count_if(F.col(c).isNotNull() & ~F.col(c).isin(values))
    for c, (low, high) in rule["range"].items():
        checks[f"range:{c}"] = count_if(~F.col(c).between(low, high))
    checks[f"unique:{key}"] = F.count(key) - F.countDistinct(key)
    counts = df.agg(*[e.alias(f"c{i}") for i, e in enumerate(checks.values())])
    rows = F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(f"c{i}").alias("failing")) for i, c in enumerate(checks)])
    return counts.select(F.lit(name).alias("table_name"), F.inline(rows)).withColumn("status", verdict(F.col("failing") == 0))
