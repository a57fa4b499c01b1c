"""Month grids: one row per month, account-month or subscription-month.

Each grid is a narrow ``sequence`` + ``explode``: no join and no shuffle. Sums over
overlapping spans sweep over their ends.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.functions.expr import day, month_key, month_start, months_apart, surrogate_key


def with_months(df: DataFrame, start: Column, end: Column, name: str = "month_start") -> DataFrame:
    """One row per month from ``start`` to ``end``; none when the range is reversed.

    The generator runs over plain integers and the dates are added afterwards,
    which keeps calendar arithmetic out of the array.
    """
    n = months_apart(start, end)
    offsets = F.explode(F.when(n >= 0, F.sequence(F.lit(0), n)))
    return (
        df.withColumn("_first", month_start(start))
        .withColumn("_offset", offsets)
        .withColumn(name, F.add_months("_first", F.col("_offset")))
        .drop("_first", "_offset")
    )


def month_spine(dates: DataFrame, column: str, as_of: dt.date) -> DataFrame:
    """One row per month from the earliest date in ``column`` to ``as_of``."""
    span = dates.agg(F.min(F.col(column).cast("date")).alias("first_day"))
    return with_months(span, F.col("first_day"), day(as_of)).select(
        "month_start", month_key("month_start").alias("month_key")
    )


def day_spine(dates: DataFrame, column: str, as_of: dt.date) -> DataFrame:
    """One row per day from the first of the earliest month in ``column`` to ``as_of``."""
    span = dates.agg(month_start(F.min(F.col(column).cast("date"))).alias("first_day"))
    days = span.where(F.col("first_day") <= day(as_of)).select(F.explode(F.sequence("first_day", day(as_of))).alias("full_date"))
    return days.select("full_date", F.year("full_date").alias("year"), F.quarter("full_date").alias("quarter"), F.month("full_date").alias("month"))


def months_of_account(values: DataFrame, name: str) -> DataFrame:
    """Rows that are unique by account and month as one row per account: a map ``name`` from the month to a struct of the other columns."""
    rest = [c for c in values.columns if c not in ("account_id", "month_start")]
    entry = F.struct("month_start", F.struct(*rest))
    known = values.where(F.col("month_start").isNotNull())
    return known.groupBy("account_id").agg(F.map_from_entries(F.collect_list(entry)).alias(name))


def join_months(rows: DataFrame, values: DataFrame) -> DataFrame:
    """``rows`` with the columns that ``values`` has for their account and month, NULL if there is no such row.

    The join needs the account alone, so rows that lie by account are not shuffled once more by account and month.
    """
    rest = [c for c in values.columns if c not in ("account_id", "month_start")]
    joined = rows.join(months_of_account(values, "_months"), "account_id", "left").withColumn("_found", F.try_element_at("_months", "month_start"))
    return joined.select(*rows.columns, *[F.col(f"_found.{c}") for c in rest])


def account_months(accounts: DataFrame, as_of: dt.date, since: Column | None = None, kept: tuple[str, ...] = ()) -> DataFrame:
    """One row for each account and month since its creation, or since a month if one is given; ``kept`` names further columns of the accounts."""
    born = F.col("created_at").cast("date")
    grid = with_months(accounts, born if since is None else F.greatest(born, since), day(as_of))
    cohort = month_start(born)
    return grid.select(
        surrogate_key("account_id", month_key("month_start")).alias("account_month_key"),
        "account_id",
        "company_name",
        "industry",
        "company_size",
        "region",
        "country",
        "acquisition_channel",
        born.alias("account_created_date"),
        "month_start",
        month_key("month_start").alias("month_key"),
        F.year("month_start").alias("month_year"),
        F.month("month_start").alias("month_num"),
        month_key(cohort).alias("cohort_month"),
        cohort.alias("cohort_month_date"),
        months_apart(cohort, F.col("month_start")).alias("months_since_created"),
        (F.col("month_start") == cohort).alias("is_first_month"),
        *kept,
    )


def paid_spans(subscriptions: DataFrame, as_of: dt.date, since: Column | None = None) -> DataFrame:
    """Paid subscriptions with their first active day (``_from``) and last one (``_to``), cut to ``since`` and ``as_of``."""
    paid = subscriptions.where(F.col("status") != "trial")
    first = F.col("start_date")
    if since is not None:
        paid = paid.where(F.col("end_date").isNull() | (F.col("end_date") >= since))
        first = F.greatest(first, since)
    return paid.withColumns({"_from": first, "_to": F.least(F.coalesce("end_date", day(as_of)), day(as_of))})


def subscription_months(subscriptions: DataFrame, as_of: dt.date, since: Column | None = None) -> DataFrame:
    """Paid subscriptions spread over their active months, both ends included.

    ``since`` limits the work to months from that date on.
    """
    return (
        with_months(paid_spans(subscriptions, as_of, since), F.col("_from"), F.col("_to"))
        .select(
            surrogate_key("subscription_id", month_key("month_start")).alias("sub_month_key"),
            "subscription_id",
            "account_id",
            "plan_id",
            "plan_name",
            "mrr",
            "status",
            "billing_cycle",
            "seats_purchased",
            "seats_used",
            "month_start",
            month_key("month_start").alias("month_key"),
            F.col("start_date").alias("started_date"),
            F.col("end_date").alias("ended_date"),
        )
    )


#: spans whose months one task holds; months are many times the bytes of the spans that they come from
SPANS_A_TASK = 100_000


def tasks_for(spans: DataFrame) -> int:
    """Partitions for the months of ``spans``: as many as shuffles have, or more by their number, so a task's share has a bound."""
    return max(int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-spans.count() // SPANS_A_TASK))


def running_spans(spans: DataFrame, keys: list[str], owner: str, sums: dict[str, Column], tasks: int | None = None) -> DataFrame:
    """Sums of ``spans`` (``_from``, ``_to``) by ``keys`` as long as they hold: from month ``_since`` to before ``_until``.

    A sweep: every span adds its values in its first month and takes them back in the month
    behind its last. These ends are summed by key and month, and running sums over
    the sorted ends hold until the next one. Values must be whole numbers; a sum without
    any value is NULL. The result lies in ``tasks`` partitions by ``owner``, see :func:`tasks_for`.
    """
    counted = {f"_n_{c}": v.isNotNull().cast("bigint") for c, v in sums.items()}
    values = {c: F.coalesce(v.cast("bigint"), F.lit(0)) for c, v in sums.items()} | counted | {"_spans": F.lit(1).cast("bigint")}
    named = spans.where(months_apart(F.col("_from"), F.col("_to")) >= 0).select(*keys, "_from", "_to", *[v.alias(c) for c, v in values.items()])
    ends = F.array(
        F.struct(month_start("_from").alias("_since"), F.lit(1).alias("_sign")),
        F.struct(F.add_months(month_start("_to"), 1).alias("_since"), F.lit(-1).alias("_sign")),
    )
    deltas = named.select(*keys, *values, F.inline(ends)).groupBy(*keys, "_since").agg(*[F.sum(F.col(c) * F.col("_sign")).alias(c) for c in values])
    order = Window.partitionBy(*keys).orderBy("_since")
    running = deltas.repartition(tasks or tasks_for(spans), owner).withColumns({c: F.sum(c).over(order) for c in values} | {"_until": F.lead("_since").over(order)})
    return running.where("_spans > 0").select(*keys, "_since", "_until", *[F.when(F.col(f"_n_{c}") > 0, F.col(c)).alias(c) for c in sums])


def running_months(spans: DataFrame, keys: list[str], owner: str, sums: dict[str, Column], tasks: int | None = None) -> DataFrame:
    """:func:`running_spans` month by month: months are generated once for all spans of a key and not for each span."""
    live = running_spans(spans, keys, owner, sums, tasks)
    return with_months(live, F.col("_since"), F.add_months("_until", -1)).select(*keys, "month_start", *sums)


def newest_months(spans: DataFrame, owner: str, value: str, months: int, tasks: int | None = None) -> DataFrame:
    """(owner, ``_oldest``): the oldest of the newest ``months`` months in which the sum of ``value`` over ``spans`` is positive.

    An owner with fewer such months has its first one. Only the last months of each span are generated.
    """
    held = running_spans(spans, [owner], owner, {"_value": F.col(value)}, tasks).where("_value > 0")
    last = F.add_months("_until", -1)
    points = with_months(held, F.greatest("_since", F.add_months("_until", -months)), last, "_month")
    newest = Window.partitionBy(owner).orderBy(F.desc("_month"))
    kept = points.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") <= months)
    return kept.groupBy(owner).agg(F.min("_month").alias("_oldest"))
