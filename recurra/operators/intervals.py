"""Joins of points with the intervals that hold them, by a hierarchy of aligned blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: blocks of the highest level have 2^LEVELS positions
LEVELS = 12


def _up(c: Column, level: int) -> Column:
    """Number of the block at ``level`` that holds position ``c``; rounds down, below zero too."""
    return F.shiftright(c, level)


def cover(low: Column, high: Column, levels: int = LEVELS) -> Column:
    """The blocks that make up the positions low..high, none twice: at most two of a level, and what is needed of the highest.

    At each level a block is needed where the borders, rounded inwards, are odd: its
    neighbour is then not part of a block of the next level.
    """
    low, end = low.cast("long"), high.cast("long") + 1
    pieces = []
    for k in range(levels):
        first, stop = _up(low + ((1 << k) - 1), k), _up(end, k)
        some = first < stop
        block = lambda n: F.struct(F.lit(k).alias("level"), n.alias("block"))
        pieces.append(F.when(some & (first.bitwiseAND(F.lit(1)) == 1), block(first)))
        pieces.append(F.when(some & (stop.bitwiseAND(F.lit(1)) == 1), block(stop - 1)))
    first, stop = _up(low + ((1 << levels) - 1), levels), _up(end, levels)
    top = F.transform(F.sequence(first, stop - 1), lambda n: F.struct(F.lit(levels).alias("level"), n.alias("block")))
    small = F.filter(F.array(*pieces), lambda p: p.isNotNull())
    return F.when(first < stop, F.concat(small, top)).otherwise(small)


def interval_join(intervals: DataFrame, points: DataFrame, low: str, high: str, point: str, levels: int = LEVELS) -> DataFrame:
    """All pairs with low <= point <= high, whole numbers all three, as an equi-join on blocks.

    A point lies in one block of each level, and in one block at most of an interval's
    cover, so no pair comes twice. A point is copied ``levels`` + 1 times; an interval makes about two
    pieces for each doubling of its length up to 2^levels and one piece for each 2^levels
    positions beyond. Rows with a null border, with low above high or a null point match nothing.
    """
    pieces = intervals.where(F.col(low) <= F.col(high)).withColumn("_p", F.explode(cover(F.col(low), F.col(high), levels)))
    at = F.col(point).cast("long")
    chain = F.array(*[F.struct(F.lit(k).alias("level"), _up(at, k).alias("block")) for k in range(levels + 1)])
    places = points.where(F.col(point).isNotNull()).withColumn("_q", F.explode(chain))
    same = (F.col("_p.level") == F.col("_q.level")) & (F.col("_p.block") == F.col("_q.block"))
    return pieces.join(places, same).drop("_p", "_q")
