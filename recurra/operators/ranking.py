"""Ordered positions inside groups that may be far larger than one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.session import reliable_checkpoint, scratch_path


def rank_within(df: DataFrame, group: str, value: str, tiebreak: str, out: str, k: int | None = None) -> DataFrame:
    """Position by ``value`` descending, then ``tiebreak``, inside each ``group``.

    With ``k`` this is a top-k report: row_number <= k is pushed below the shuffle
    (WindowGroupLimit), so each task sends at most k rows per group. Without it
    every row is ranked by a distributed sort, see :func:`_rank_all`.
    """
    if k is not None:
        w = Window.partitionBy(group).orderBy(F.desc(value), F.col(tiebreak))
        return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)
    return _rank_all(df, group, value, tiebreak, out)


def _rank_all(df: DataFrame, group: str, value: str, tiebreak: str, out: str) -> DataFrame:
    """Range-sort all rows, then add per-partition offsets.

    A group spreads over as many sorted partitions as its size asks for, also
    when most of its values tie, because the tiebreak is part of the range key.
    The rows are stored before they are sorted, so sampling the ranges does not compute them
    again, and sorted rows are stored too: partition numbers stay fixed if an executor is lost.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ranks")
    df.write.parquet(f"{path}/rows")
    sorted_pieces(spark.read.parquet(f"{path}/rows"), group, value, tiebreak).write.parquet(f"{path}/sorted")
    placed = spark.read.parquet(f"{path}/sorted")
    return ranked(placed, piece_offsets(placed, group), group, out)


def sorted_pieces(df: DataFrame, group: str, value: str, tiebreak: str) -> DataFrame:
    """Rows in order with the sorted partition that holds them and their place in it; to be stored before they are used."""
    ordered = df.orderBy(F.col(group), F.desc(value), F.col(tiebreak))
    return ordered.withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id())


def piece_offsets(placed: DataFrame, group: str) -> DataFrame:
    """For each group and sorted partition, the first place there and the rows of the group before it."""
    pieces = placed.groupBy(group, "_part").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.select(group, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))


def ranked(placed: DataFrame, offsets: DataFrame, group: str, out: str) -> DataFrame:
    """Stored pieces with the position of every row in its group, from the offsets stored beside them."""
    position = (F.col("_seq") - F.col("_first") + F.col("_before") + 1).cast("int")
    return placed.join(offsets, [group, "_part"]).withColumn(out, position).drop("_part", "_seq", "_first", "_before")


def positions(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Position of every row in one order over the whole table, by a distributed sort.

    ``order`` must be total. Only one count for each sorted partition meets in one task.
    """
    placed = reliable_checkpoint(
        df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id())
    )
    pieces = placed.groupBy("_part").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = (F.col("_seq") - F.col("_first") + F.col("_before") + 1).alias(out)
    return placed.join(offsets, "_part").select(*df.columns, place)


def nearest_rank(df: DataFrame, group: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Exact order statistics: the element at zero-based index floor(n * p).

    Rows are first reduced to (group, value) counts, so repeated values of a hot
    group collapse. What is left is sorted over the cluster; a group with many values
    spreads over many sorted partitions, whose sums give the running count its start.
    """
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = reliable_checkpoint(counts.orderBy(*group, value).withColumn("_part", F.spark_partition_id()))
    pieces = placed.groupBy(*group, "_part").agg(F.sum("_n").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.withColumns({
        "_start": F.coalesce(F.sum("_sum").over(before), F.lit(0)), "_total": F.sum("_sum").over(Window.partitionBy(*group)),
    }).drop("_sum")
    inside = Window.partitionBy(*group, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = placed.withColumn("_upto", F.sum("_n").over(inside)).join(starts, [*group, "_part"]).withColumn("_upto", F.col("_upto") + F.col("_start"))
    picks = []
    for name, p in points.items():
        index = F.least(F.floor(F.col("_total") * p), F.col("_total") - 1)
        picks.append(F.min(F.when(F.col("_upto") > index, F.col(value))).alias(name))
    return run.groupBy(*group).agg(*picks)
