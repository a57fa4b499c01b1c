"""Streaming upserts, duplicate removal and daily usage counts.

Upserts are log-structured: a micro-batch writes its rows under its own batch
number, so a replayed batch replaces itself, and readers take the newest row per
key. The cost of a batch follows the batch, not the size of the table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recurra.operators.silver import latest_per_key
from recurra.session import scratch_path
from recurra.sources import webhooks
from recurra.sources.folders import Folder


def append_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch_id={batch_id}")


def current_rows(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """Newest version per key over all batches."""
    log = spark.read.option("basePath", path).parquet(path)
    return latest_per_key(log, keys, order[0], order[1:]).drop("batch_id")


def compact(spark: SparkSession, path: str, target: str, keys: list[str], order: list[str]) -> None:
    """Fold the log into one version in a new folder; readers switch when it is complete."""
    append_batch(current_rows(spark, path, keys, order), 0, target)


def run_available(stream: DataFrame, write_batch, checkpoint: str, mode: str = "append") -> None:
    """Process everything that is there now, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write_batch)
        .start()
    )
    query.awaitTermination()


#: longest method that the JVM compiles; Spark splits the code of a plan beyond it
JIT_BYTES = 8000
#: entities of the billing events and their keys
WEBHOOK_KEYS = {"subscription": "subscription_id", "invoice": "invoice_id", "account": "account_id"}


class CommittedLogs:
    """Logs of several tables that show a batch in all of them or in none.

    A batch writes its rows to every log under its number and then publishes its commit. Batches
    come one after another, so all up to the newest commit are complete; a batch that failed half way is
    not seen, and is written anew when it is replayed.
    """

    def __init__(self, spark: SparkSession, path: str, schemas: dict[str, T.StructType]):
        self.spark, self.path, self.schemas = spark, path, schemas
        self.commits = Folder(spark, f"{path}/_commits")

    def write(self, tables: dict[str, DataFrame], batch_id: int) -> None:
        for name, rows in tables.items():
            append_batch(rows, batch_id, f"{self.path}/{name}")
        self.commits.publish(f"{batch_id:012d}", "", replace=True)

    def read(self, name: str) -> DataFrame:
        """Rows of all complete batches with their ``batch_id``; without any batch an empty table."""
        committed = [int(n) for n in self.commits.names() if n.isdigit()]
        if not committed:
            return self.spark.createDataFrame([], self.schemas[name]).withColumn("batch_id", F.lit(0))
        schema = T.StructType([*self.schemas[name].fields, T.StructField("batch_id", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}").where(F.col("batch_id") <= committed[-1])


def webhook_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """Rows of each entity from parsed events, with the event that brought them."""
    return {name: rows.where(F.col(name).isNotNull()).select("event_id", "event_at", f"{name}.*") for name in WEBHOOK_KEYS}


def stream_webhooks(spark: SparkSession, folder: str, received_at: dt.datetime, out: str | None = None) -> dict[str, DataFrame]:
    """Billing events from JSON-lines files, upserted as subscriptions, invoices and accounts.

    A batch is parsed once: its rows are written with the three entities side by side, the three
    logs are filled from there without a shuffle, and once they are committed the parsed rows go. Copies of an
    event, in one batch or several, settle to one row when a log is read; of the events of a key the newest
    counts, whatever the order of arrival. Without input all three are empty.
    """
    out = out or scratch_path(spark, "webhook")
    bodies = spark.readStream.schema("value string").text(folder).withColumnRenamed("value", "body")
    parsed = webhooks.stripe_rows(webhooks.parse_stripe(spark.createDataFrame([], "body string")), received_at)
    parsed_rows = Folder(spark, f"{out}/parsed")
    logs = CommittedLogs(spark, f"{out}/log", {name: rows.schema for name, rows in webhook_tables(parsed).items()})

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # the stream's own session: code of all entities in one method would be too long for the JVM to compile
        batch.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_BYTES)
        append_batch(webhooks.stripe_rows(webhooks.parse_stripe(batch), received_at).where("processed"), batch_id, f"{out}/parsed")
        rows = spark.read.schema(parsed.schema).parquet(f"{out}/parsed/batch_id={batch_id}")
        logs.write(webhook_tables(rows), batch_id)
        parsed_rows.remove(f"batch_id={batch_id}")

    run_available(bodies, write_batch, f"{out}/checkpoint")
    return {name: latest_per_key(logs.read(name), [key], "event_at", ["event_id"]).drop("batch_id") for name, key in WEBHOOK_KEYS.items()}


def stream_webhook_upsert(spark: SparkSession, folder: str, received_at: dt.datetime, out: str | None = None) -> DataFrame:
    """The subscriptions of :func:`stream_webhooks`."""
    return stream_webhooks(spark, folder, received_at, out)["subscription"]


def opened_log(rows: DataFrame, path: str) -> None:
    """Give a log its schema before any batch, so that a stream without input reads as an empty table."""
    rows.sparkSession.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{path}/batch_id=-1")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def stream_dedupe_events(events: DataFrame, out: str | None = None, key: str = "event_id") -> DataFrame:
    """One row per key over all batches, however late or out of order rows arrive.

    A batch drops the copies it sees itself and appends the rest, so the stream keeps no
    state; copies from different batches are settled when the log is read, where the
    row of the first batch stays.
    """
    spark = events.sparkSession
    out = out or scratch_path(spark, "dedupe")
    opened_log(events, f"{out}/log")
    run_available(events, lambda b, i: append_batch(b.dropDuplicates([key]), i, f"{out}/log"), f"{out}/checkpoint")
    log = read_log(spark, f"{out}/log").withColumn("earliest", -F.col("batch_id"))
    return latest_per_key(log, [key], "earliest").select(*events.columns)


def usage_counts(events: DataFrame) -> DataFrame:
    """Daily measures of each user of an account, small enough to be added up later."""
    return events.groupBy("account_id", F.col("occurred_at").cast("date").alias("day"), "user_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum("duration_seconds").alias("duration_seconds"), F.max("duration_seconds").alias("longest_seconds")
    )


def stream_usage_counts(events: DataFrame, out: str | None = None) -> DataFrame:
    """Daily measures per account over all batches; users are counted exactly.

    Every batch adds its partial counts to the log. No row is too late, because nothing
    is closed; readers add up the parts.
    """
    spark = events.sparkSession
    out = out or scratch_path(spark, "usage")
    opened_log(usage_counts(events), f"{out}/log")
    run_available(events, lambda b, i: append_batch(usage_counts(b), i, f"{out}/log"), f"{out}/checkpoint")
    users = read_log(spark, f"{out}/log").groupBy("account_id", "day", "user_id").agg(
        F.sum("events").alias("events"), F.sum("duration_seconds").alias("duration_seconds"), F.max("longest_seconds").alias("longest_seconds")
    )
    return users.groupBy("account_id", "day").agg(
        F.sum("events").alias("events"), F.sum("duration_seconds").alias("duration_seconds"), F.max("longest_seconds").alias("longest_seconds"),
        F.count("user_id").alias("users"),
    )
