"""Keyed updates and the look-back refresh of a monthly mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from recurra.operators.silver import latest_per_key


def newest_change(changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One change per key: the newest, then the last row of the last file, then the largest by value."""
    lineage = [c for c in ("_source_file", "_row_id") if c in changes.columns]
    rest = [c for c in changes.columns if c not in keys and c != order and c not in lineage]
    return latest_per_key(changes, keys, order, lineage + rest)


def upsert_by_key(target: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Target after the newest change of every key has replaced or joined its row; see :func:`newest_change` for ties."""
    newest = newest_change(changes, keys, order).select(*target.columns)
    return target.join(newest.select(*keys), keys, "left_anti").unionByName(newest)


def upsert_counts(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys a batch of changes inserts and updates."""
    incoming = changes.select(*keys).distinct().withColumn("incoming", F.lit(True))
    known = target.select(*keys).withColumn("known", F.lit(True))
    joined = incoming.join(known, keys, "left")
    return joined.agg(
        F.count_if(F.col("known").isNull()).alias("inserted"), F.count_if(F.col("known")).alias("updated")
    )


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows with a new key only; the newest row if the batch repeats a key."""
    once = newest_change(rows, keys, order).select(*target.columns)
    return once.join(target.select(*keys), keys, "left_anti")


def upsert_partial_columns(target: DataFrame, changes: DataFrame, keys: list[str], mutable: list[str], order: str) -> DataFrame:
    """Only mutable columns take the value of the newest change; a NULL there leaves the stored one.

    The batch is first reduced to one change per key, so no target row is doubled.
    """
    new = newest_change(changes, keys, order).select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("n"))
    old = target.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("o"))
    joined = old.join(new, keys, "full")

    def value(c):
        if c in mutable:
            return F.coalesce(f"n.{c}", f"o.{c}").alias(c)
        return F.when(F.col("o").isNotNull(), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c)

    return joined.select(*[F.col(c) if c in keys else value(c) for c in target.columns])


def first_paid_months(months: DataFrame, known: DataFrame | None = None, since: dt.date | None = None) -> DataFrame:
    """State (account_id, first_paid) of a mart of account-months: when each account first paid.

    With ``known``, ``months`` holds the rows from ``since`` on only: what the state says about
    earlier months stays, the rest follows from the rows, so corrected months count and no history is read.
    """
    first = months.where(F.col("mrr") > 0).groupBy("account_id").agg(F.min("month_start").alias("first_paid"))
    if known is None:
        return first
    kept = known.where(F.col("first_paid") < F.lit(since))
    return kept.unionByName(first.join(kept, "account_id", "left_anti"))
