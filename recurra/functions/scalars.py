"""Scalar functions and the callable surface: SQL functions, table function, ordered aggregate."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from recurra.functions.expr import MONEY, banded, divide_or, month_start, rounded, safe_divide


def safe_float(c: Column, default: float = 0.0) -> Column:
    return F.coalesce(c.cast("string").try_cast("double"), F.lit(default))


def safe_int(c: Column, default: int = 0) -> Column:
    return F.coalesce(c.cast("string").try_cast("int"), F.lit(default))


def epoch_seconds(c: Column) -> Column:
    """Unix seconds to a UTC timestamp; anything unreadable gives NULL."""
    seconds = c.cast("string").try_cast("bigint")
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def short_money(c: Column) -> Column:
    """$1.2m, $3.4k or $567."""
    v = c.cast("double")
    one = lambda x: F.format_number(rounded(x, 1), 1)
    return (
        F.when(v >= 1000000, F.concat(F.lit("$"), F.regexp_replace(one(v / 1000000), ",", ""), F.lit("m")))
        .when(v >= 1000, F.concat(F.lit("$"), F.regexp_replace(one(v / 1000), ",", ""), F.lit("k")))
        .otherwise(F.concat(F.lit("$"), F.format_number(rounded(v, 0), 0)))
    )


def signed_money(c: Column) -> Column:
    return F.concat(F.when(c >= 0, F.lit("+")).otherwise(F.lit("-")), short_money(F.abs(c)))


def percent_text(ratio: Column) -> Column:
    return F.concat(F.format_number(rounded(ratio * 100, 1), 1), F.lit("%"))


# Colours of the retention bands.
RETENTION_COLOURS = [(0.9, "#10b981"), (0.75, "#f59e0b"), (0.5, "#f97316")]
NRR_COLOURS = [(1.1, "#10b981"), (1.0, "#3b82f6"), (0.9, "#f59e0b")]
WORST_COLOUR = "#ef4444"


def retention_colour(c: Column) -> Column:
    return banded(c, RETENTION_COLOURS, WORST_COLOUR)


def nrr_colour(c: Column) -> Column:
    return banded(c, NRR_COLOURS, WORST_COLOUR)


def health_score_label(c: Column) -> Column:
    return banded(c, [(75, "Healthy"), (50, "At Risk")], "Critical")


def mrr_for_month(movements: DataFrame, month: dt.date) -> DataFrame:
    rows = movements.where((F.col("month_start") == month_start(F.lit(month))) & ~F.col("is_churned"))
    return rows.agg(F.coalesce(F.sum("mrr"), F.lit(0)).cast(MONEY).alias("mrr"))


def nrr_for_month(movements: DataFrame, month: dt.date) -> DataFrame:
    rows = movements.where(F.col("month_start") == month_start(F.lit(month)))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    base = total("prev_mrr")
    kept = base + total("expansion_mrr") + total("reactivation_mrr") - total("contraction_mrr") - total("churned_mrr")
    return rows.agg(rounded(divide_or(kept, base, 1.0), 6).alias("nrr"))


def refresh_exec_summary(executive: DataFrame) -> DataFrame:
    """Month-over-month columns computed again from the stored totals."""
    w = Window.orderBy("month_start")

    def change(c):
        prev = F.lag(c).over(w)
        return rounded(F.when(prev > 0, safe_divide(F.col(c) - prev, prev)).otherwise(0.0), 6)

    return executive.select(
        "month_start", "total_mrr", "total_arr", "active_accounts", change("total_mrr").alias("mrr_mom_change"),
        change("total_arr").alias("arr_mom_change"), change("active_accounts").alias("accounts_mom_change"),
    )


def register_sql_functions(spark: SparkSession) -> None:
    """The helpers as SQL functions, inlined by the analyzer when they are called."""
    definitions = [
        "safe_ratio(n DOUBLE, d DOUBLE) RETURNS DOUBLE RETURN try_divide(n, d)",
        """score_label(score DOUBLE) RETURNS STRING
           RETURN CASE WHEN score >= 75 THEN 'Healthy' WHEN score >= 50 THEN 'At Risk' ELSE 'Critical' END""",
        "months_apart(a DATE, b DATE) RETURNS INT RETURN (year(b) - year(a)) * 12 + month(b) - month(a)",
    ]
    for d in definitions:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {d}")


def udtf_month_spine(accounts: DataFrame, as_of: dt.date) -> DataFrame:
    """Months from an account's first day on, through a SQL table function that stays inside the engine."""
    spark = accounts.sparkSession
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION month_spine(born DATE, upto DATE) RETURNS TABLE (month_start DATE) RETURN
      SELECT explode(CASE WHEN born <= upto THEN sequence(trunc(born, 'MM'), trunc(upto, 'MM'), INTERVAL 1 MONTH) END)""")
    born = accounts.select("account_id", F.col("created_at").cast("date").alias("born"))
    return spark.sql(
        "SELECT a.account_id, m.month_start FROM {a} a, LATERAL month_spine(a.born, DATE'" + as_of.isoformat() + "') m", a=born
    )


@pandas_udf(T.StringType())
def _lowest_mode(value: pd.Series, copies: pd.Series) -> str:
    best = pd.DataFrame({"v": value, "n": copies}).sort_values(["n", "v"], ascending=[False, True])
    return best["v"].iloc[0]


def mode_by_udaf(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Built-in ordered mode next to a grouped-aggregate UDF.

    The UDF sees (value, copies) pairs, one per distinct value, never the raw rows.
    """
    builtin = rows.groupBy(group).agg(F.mode(value, True).alias("mode_builtin"))
    pairs = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    custom = pairs.groupBy(group).agg(_lowest_mode(F.col(value), F.col("n")).alias("mode_udaf"))
    return builtin.join(custom, group, "left")
