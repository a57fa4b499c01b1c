"""Merging batches of versions into validity ranges that are kept."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from recurra.operators.extras import scd2_history


def merge_versions(current: DataFrame, batch: DataFrame, key: str, updated_at: str, seen_at: dt.date | dt.datetime | None = None) -> DataFrame:
    """Ranges that a batch leaves: the open ranges ``current``, closed or not, and those of the new versions.

    ``current`` has one row for each key with ``valid_from``. A version counts if it is newer than
    the open range of its key, so a batch that is delivered again changes nothing. A key may have several new versions; of
    copies with one time the greatest counts. With ``seen_at`` the batch is a snapshot of all keys: keys that
    are not in it close at that time, and a key that comes back opens a range from its own time on.
    Rows without key or time are no versions. Closed ranges are neither read nor changed.
    """
    rest = [c for c in batch.columns if c not in (key, updated_at)]
    known = batch.where(F.col(key).isNotNull() & F.col(updated_at).isNotNull())
    open_from = current.select(key, F.col("valid_from").alias("_from"))
    newer = known.join(open_from, key, "left").where(F.col("_from").isNull() | (F.col(updated_at) > F.col("_from"))).select(*batch.columns)
    ends = newer.groupBy(key).agg(F.min(updated_at).alias("_until"))
    if seen_at is not None:
        seen = known.select(key).distinct().withColumn("_seen", F.lit(True))
        ends = seen.join(ends, key, "left")
    ended = current.join(ends, key, "left")
    until = F.col("_until")
    if seen_at is not None:
        until = F.when(F.col("_seen"), until).otherwise(F.lit(seen_at).cast(batch.schema[updated_at].dataType))
    before = ended.select(key, *rest, "valid_from", until.alias("valid_to"), until.isNull().alias("is_current"))
    return before.unionByName(scd2_history(newer, key, updated_at))
