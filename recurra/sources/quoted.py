"""CSV files whose quoted values hold line breaks, read by many tasks.

A line border is a record border only outside quotes, and whether a byte range begins inside a quoted
value depends on all ranges before it. Every line is therefore taken as a function of two states: how it
ends if it begins outside quotes, and how if it begins inside. Functions of lines make the function of a
range, one row for each range tells the state in which the next one begins, and then every line
knows its record. Only records of several lines are put together by a shuffle of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

#: a quoted value that is closed, or a value without a quote at its start
CLOSED = '"[^"]*"|[^,"][^,]*'
RANGE = ["file", "block"]
#: one short row for each byte range; more of them are joined by a shuffle
BROADCAST_RANGES = 100_000


def _open_after(line: Column, inside: bool) -> Column:
    """Whether a quoted value is open behind ``line``; quotes amid a value without quotes are text."""
    single = F.replace(line, F.lit('""'), F.lit(""))
    rest = F.regexp_replace(F.concat(F.lit('"'), single) if inside else single, CLOSED, "")
    return F.when(F.instr(line, '"') == 0, F.lit(inside)).otherwise(F.instr(rest, '"') > 0)


def entered(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    """Columns in0 / in1: the state before each row, and end0 / end1 behind it, if the group begins outside / inside.

    ``to0`` and ``to1`` are the states behind a row that begins outside or inside. A row either sets the
    state, keeps it or turns it round, so the last setting row and the count of turns since tell the state.
    """
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sets = F.col("to0") == F.col("to1")
    turned = rows.withColumn("_turns", F.sum((F.col("to0") & ~F.col("to1")).cast("int")).over(w))
    found = turned.withColumn("_set", F.last(F.when(sets, F.struct(F.col("to0").cast("int").alias("to"), "_turns")), ignorenulls=True).over(w))
    step = Window.partitionBy(*group).orderBy(order)
    for entry in (0, 1):
        base = F.coalesce(F.col("_set.to") - F.col("_set._turns"), F.lit(entry))
        found = found.withColumn(f"end{entry}", F.pmod(base + F.col("_turns"), F.lit(2)) == 1)
        found = found.withColumn(f"in{entry}", F.lag(f"end{entry}", 1, bool(entry)).over(step))
    return found.drop("_turns", "_set")


def range_bytes(spark: SparkSession) -> int:
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def longest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the longest file; lists files and reads none."""
    return spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0


def range_bound(spark: SparkSession, path: str) -> int:
    """Upper bound of the byte ranges of the files, from their number and length alone."""
    n, total = spark.read.format("binaryFile").load(path).agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    # ranges are shorter than the setting if there are tasks to spare
    return n + total // min(range_bytes(spark), max(1, total // spark.sparkContext.defaultParallelism)) if total else n


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, name, block, line, header, record): the whole records of CSV files, in no order.

    ``block`` and ``line`` are the byte range where the record begins and a number that grows inside it. A range in which no value
    stays open over a line border needs no order: its lines are its records, straight from the scan. The lines of other ranges are
    ordered range by range. A value that is never closed takes the rest of its file as one record, as it does in any reader.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value",
    )
    both = {"to0": _open_after(F.col("value"), False), "to1": _open_after(F.col("value"), True)}
    # a line without quotes keeps the state, so only the others are put in order to learn what a range does
    marked = entered(lines.where(F.instr("value", '"') > 0).withColumns(both).drop("value", "name"), RANGE, "line")
    ends = marked.groupBy(*RANGE).agg(*[F.max_by(f"end{e}", "line").alias(f"to{e}") for e in (0, 1)], F.max("end0").alias("opens"))
    ranges = lines.groupBy(*RANGE).agg(F.min("line").alias("first")).join(ends, RANGE, "left").select(
        *RANGE, "first", *[F.coalesce(f"to{e}", F.lit(bool(e))).alias(f"to{e}") for e in (0, 1)], F.coalesce("opens", F.lit(False)).alias("opens")
    )
    known = entered(ranges, ["file"], "block").select(
        *RANGE, F.col("in0").alias("inside"), (F.col("in0") | F.col("opens")).alias("busy"),
        F.when(F.col("block") == 0, F.col("first")).alias("header_line"),
    )
    if range_bound(spark, path) <= BROADCAST_RANGES:
        known = F.broadcast(known)
    lines = lines.join(known, RANGE).withColumn("header", F.coalesce(F.col("line") == F.col("header_line"), F.lit(False)))
    calm = lines.where(~F.col("busy")).select("file", "name", "block", "line", "header", F.col("value").alias("record"))

    inside = F.col("inside")
    upto = Window.partitionBy(*RANGE).orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = entered(lines.where("busy").withColumns(both), RANGE, "line").select(
        "file", "name", "block", "line", "header", "value",
        F.when(inside, F.col("in1")).otherwise(F.col("in0")).alias("goes_on"),
        F.when(inside, F.col("end1")).otherwise(F.col("end0")).alias("open"),
    ).withColumn("begin", F.max(F.when(~F.col("goes_on"), F.struct("line", "header"))).over(upto))
    # the record that is open where a range begins began in the last range before it with a beginning
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.max("begin").alias("last")
    started = F.when(F.col("last").isNotNull(), F.struct("block", "last"))
    carried = states.groupBy(*RANGE).agg(last).select(*RANGE, F.last(started, ignorenulls=True).over(before).alias("carried"))
    own = F.col("begin").isNotNull()
    placed = states.join(carried, RANGE).withColumn(
        "begin", F.when(own, F.struct("block", F.col("begin").alias("last"))).otherwise(F.col("carried"))
    )
    alone = ~F.col("goes_on") & ~F.col("open")
    begin = [F.col("begin.block").alias("block"), F.col("begin.last.line").alias("line"), F.col("begin.last.header").alias("header")]
    whole = placed.where(alone).select("file", "name", *begin, F.col("value").alias("record"))
    parts = placed.where(~alone).groupBy("file", "name", "begin").agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("parts"))
    joined = parts.select("file", "name", *begin, F.array_join(F.col("parts.value"), "\n").alias("record"))
    return calm.unionByName(whole).unionByName(joined).withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def quoted_rows(spark: SparkSession, path: str, columns: list[str], quoting: dict[str, str]) -> DataFrame:
    """Columns of CSV files as text and ``_file``, the name of the file. The first record of a file is its header."""
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(columns))])
    body = quoted_records(spark, path).where(~F.col("header") & (F.length("record") > 0))
    values = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), {**quoting, "multiLine": "true"})
    return body.select(values.alias("v"), F.col("name").alias("_file")).select(
        *[F.col(f"v.c{k}").alias(c) for k, c in enumerate(columns)], "_file"
    )
