"""Column helpers used by every operator. All compile to JVM expressions."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
NULL_KEY = "_dbt_utils_surrogate_key_null_"  # fixed value: null marker inside hashed keys


def day(value: dt.date) -> Column:
    return F.lit(value).cast("date")


def month_start(c) -> Column:
    return F.trunc(c, "MM")


def month_key(c) -> Column:
    return F.date_format(c, "yyyy-MM")


def next_month(c) -> Column:
    return F.add_months(c, 1)


def months_apart(earlier: Column, later: Column) -> Column:
    """Whole calendar months between two dates, ignoring the day of month."""
    years = F.year(later) - F.year(earlier)
    return (years * 12 + F.month(later) - F.month(earlier)).cast("int")


def age_months(earlier: Column, later: Column) -> Column:
    """Completed months: one less when the day of month was not reached."""
    short = F.when(F.day(later) < F.day(earlier), 1).otherwise(0)
    return (months_apart(earlier, later) - short).cast("int")


def safe_divide(n, d) -> Column:
    """n / d as a double; a null or zero denominator gives NULL."""
    return F.try_divide(F.col(n).cast("double") if isinstance(n, str) else n.cast("double"),
                        F.col(d).cast("double") if isinstance(d, str) else d.cast("double"))


def divide_or(n, d, default: float = 0.0) -> Column:
    return F.coalesce(safe_divide(n, d), F.lit(float(default)))


def rounded(c: Column, digits: int) -> Column:
    """Half-up rounding through decimal, so that 1.005 becomes 1.01.

    Four guard digits absorb the binary error of the double.
    """
    return F.round(c.cast(f"decimal(38,{digits + 4})"), digits).cast("double")


def percent(c: Column) -> Column:
    return rounded(F.coalesce(c.cast("double"), F.lit(0.0)) * 100, 2)


def share_pct(n: Column, total: Column) -> Column:
    return rounded(divide_or(n, total) * 100, 2)


def surrogate_key(*cols) -> Column:
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def mapped(c: Column, table: dict, default=None) -> Column:
    """Lookup through a fixed vocabulary as one CASE expression."""
    branches = list(table.items())
    out = F.when(c == branches[0][0], F.lit(branches[0][1]))
    for k, v in branches[1:]:
        out = out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(default))


def banded(c: Column, bands: list[tuple], default) -> Column:
    """First lower bound reached, from the highest band down."""
    out = F.when(c >= bands[0][0], F.lit(bands[0][1]))
    for bound, label in bands[1:]:
        out = out.when(c >= bound, F.lit(label))
    return out.otherwise(F.lit(default))


def clamp(c: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value))


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def mean_exact(c: Column) -> Column:
    """Average whose sum is a decimal, independent of row order."""
    return safe_divide(F.sum(c.cast("decimal(38,12)")), F.count(c))


def in_cents(c) -> Column:
    """Money as a 64-bit integer: sums stay exact without wide decimals."""
    return ((F.col(c) if isinstance(c, str) else c) * 100).cast("bigint")


def from_cents(c: Column) -> Column:
    return (c.cast("decimal(20,0)") / 100).cast(MONEY)


def scaled(c: Column) -> Column:
    """A ratio in billionths, for exact sums of small fractions."""
    return F.floor(c * 1e9 + 0.5)


def unscaled(c: Column) -> Column:
    return c.cast("double") / 1e9


def text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c)


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def literal_frame(spark, columns: str, rows: list[tuple]):
    """Fixed rows as a relation of known size, so the planner can broadcast it on evidence."""
    values = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")
