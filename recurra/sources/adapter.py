"""Maps the star-schema test tables onto the subscription-business entities.

Only columns the mapping needs are selected, so the scans stay narrow.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from recurra.config import PLAN_PRICES, PLAN_TIERS, Tables
from recurra.functions.expr import banded, day, literal_frame, mapped

AS_OF = dt.date(2001, 7, 31)
EVENT_SHIFT_DAYS = 8219
CHANNELS = ["organic", "paid_search", "referral", "partner", "content"]
FEATURE_CATEGORY = {"view": "core", "click": "workflow", "signup": "automation", "purchase": "commerce"}
FEATURE_TIER = {"view": "starter", "click": "starter", "signup": "business", "purchase": "growth"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _channel(key):
    return mapped(key % 5, dict(enumerate(CHANNELS)))


def dated_orders(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.withColumn("d", F.col("o_orderdate").cast("date")).where(F.col("d") <= day(AS_OF))


def _first_orders(spark, sf_dir) -> DataFrame:
    return dated_orders(spark, sf_dir).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("d").alias("first_day"))


def accounts(spark, sf_dir) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    places = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    size = banded(
        F.col("c_acctbal"),
        [(8000, "1000+"), (5500, "201-1000"), (3000, "51-200"), (1000, "11-50")],
        "1-10",
    )
    return (
        c.join(_first_orders(spark, sf_dir), "c_custkey")
        .join(places, c.c_nationkey == places.n_nationkey)
        .select(
            F.col("c_custkey").alias("account_id"),
            F.trim("c_name").alias("company_name"),
            F.lower("c_mktsegment").alias("industry"),
            F.upper("r_name").alias("region"),
            F.lower("n_name").alias("country"),
            size.alias("company_size"),
            _channel(F.col("c_custkey")).alias("acquisition_channel"),
            F.col("first_day").cast("timestamp_ntz").alias("created_at"),
            F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        )
    )


def plans(spark) -> DataFrame:
    rows = [(p, p, price, price * 10, t) for (p, price), t in zip(PLAN_PRICES.items(), PLAN_TIERS.values())]
    return literal_frame(spark, "plan_id, plan_name, m, a, tier", rows).select(
        "plan_id",
        "plan_name",
        F.col("m").cast("decimal(10,2)").alias("monthly_price"),
        F.col("a").cast("decimal(10,2)").alias("annual_price"),
        "tier",
    )


def feature_attributes(ids: DataFrame) -> DataFrame:
    """Catalogue attributes for a frame of ``feature_id`` values."""
    f = F.col("feature_id")
    return ids.select(
        "feature_id",
        f.alias("feature_name"),
        f.alias("feature_slug"),
        mapped(f, FEATURE_CATEGORY, "system").alias("feature_category"),
        mapped(f, FEATURE_TIER, "starter").alias("feature_tier"),
        f.isin("view", "click", "signup").alias("is_core"),
        (f == "purchase").alias("is_premium"),
        (f == "error").alias("is_beta"),
        F.lit(False).alias("is_deprecated"),
    )


def features(spark) -> DataFrame:
    ids = literal_frame(spark, "feature_id", [(x,) for x in ("view", "click", "signup", "purchase", "error")])
    return feature_attributes(ids)


def subscriptions(spark, sf_dir) -> DataFrame:
    k, d = F.col("o_orderkey"), F.col("d")
    seats = 1 + k % 50
    plan = banded(
        F.col("o_totalprice"), [(325000, "enterprise"), (175000, "business"), (75000, "growth")], "starter"
    )
    status = mapped(F.col("o_orderstatus"), {"F": "cancelled", "O": "active", "P": "trial"})
    ended = F.when(F.col("o_orderstatus") == "F", F.date_add(d, 90)).when(
        (F.col("o_orderstatus") == "O") & (k % 10 != 0), F.date_add(d, 365)
    )
    money = F.col("o_totalprice").cast("decimal(12,2)")
    return dated_orders(spark, sf_dir).select(
        k.alias("subscription_id"),
        F.col("o_custkey").alias("account_id"),
        plan.alias("plan_id"),
        plan.alias("plan_name"),
        status.alias("status"),
        F.when(k % 3 == 0, "annual").otherwise("monthly").alias("billing_cycle"),
        money.alias("mrr"),
        (money * 12).cast("decimal(18,2)").alias("arr"),
        seats.cast("int").alias("seats_purchased"),
        (k % 37 % seats).cast("int").alias("seats_used"),
        d.alias("start_date"),
        ended.alias("end_date"),
        F.when(status == "cancelled", ended.cast("timestamp_ntz")).alias("cancelled_at"),
    )


def invoices(spark, sf_dir) -> DataFrame:
    # hashed on the order alone, lines meet in their aggregation and with their order in one shuffle
    lines = (
        read_table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate")
        .repartition("l_orderkey")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("decimal(12,2)").alias("amount"),
            # a number keeps the aggregation of the largest table a hash aggregation
            F.min(F.ascii("l_returnflag")).alias("code"),
            F.min("l_shipdate").cast("date").alias("invoice_date"),
        )
    )
    owners = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    status = mapped(F.char("code"), {"A": "paid", "N": "pending", "R": "failed"})
    return lines.join(owners, lines.l_orderkey == owners.o_orderkey).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("invoice_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("l_orderkey").alias("subscription_id"),
        "amount",
        F.lit("usd").alias("currency"),
        status.alias("status"),
        "invoice_date",
        F.date_add("invoice_date", 30).alias("due_date"),
        F.when(status == "paid", F.date_add("invoice_date", (F.col("l_linenumber") % 5).cast("int"))).alias("paid_date"),
        F.when(status == "failed", F.col("invoice_date")).alias("failed_date"),
    )


def _shifted_day():
    back = F.when(F.col("user_id") % 2 == 1, F.col("event_id") % 6).otherwise(
        F.floor(F.sqrt((F.col("event_id") % 36).cast("double")))
    )
    return F.add_months(F.date_sub(F.col("ts").cast("date"), EVENT_SHIFT_DAYS), (-back).cast("int"))


def usage_events(spark, sf_dir) -> DataFrame:
    return as_usage_events(read_table(spark, sf_dir, "events"))


def as_usage_events(events: DataFrame) -> DataFrame:
    """Row-wise mapping, so it serves a batch scan and a stream alike."""
    return events.withColumn("d", _shifted_day()).select(
        "event_id",
        (F.col("user_id") % 50).alias("account_id"),
        "user_id",
        F.col("event_type").alias("feature_id"),
        F.col("event_type").alias("feature_name"),
        mapped(F.col("event_type"), FEATURE_CATEGORY, "system").alias("feature_category"),
        "event_type",
        F.lit("web").alias("platform"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("d").cast("string")).alias("session_id"),
        F.floor(F.col("value") * 10).cast("int").alias("duration_seconds"),
        F.lit(1).alias("actions_count"),
        F.col("d").cast("timestamp_ntz").alias("occurred_at"),
    )


def tickets(spark, sf_dir) -> DataFrame:
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "error").withColumn("d", _shifted_day())
    k = F.col("event_id")
    opened = F.col("d").cast("timestamp_ntz")
    status = mapped(k % 5, {0: "open", 1: "in_progress", 2: "escalated"}, "resolved")
    score = F.when(k % 5 < 3, None).when(k % 7 == 0, F.lit(2)).otherwise(1 + k % 5)
    return e.select(
        k.alias("ticket_id"),
        (F.col("user_id") % 50).alias("account_id"),
        "user_id",
        F.lit("error").alias("category"),
        mapped(k % 4, {0: "low", 1: "medium", 2: "high"}, "critical").alias("priority"),
        status.alias("status"),
        score.cast("decimal(3,1)").alias("csat_score"),
        (status == "escalated").alias("is_escalated"),
        opened.alias("created_at"),
        F.when(k % 5 >= 3, opened + F.expr("interval 6 hours")).alias("resolved_at"),
        (opened + F.expr("interval 1 hour")).alias("first_response_at"),
    )


def leads(spark, sf_dir) -> DataFrame:
    c = F.col("c_custkey")
    created = F.date_sub("first_day", (c % 75).cast("int"))
    qualified = c % 3 != 0
    trial = qualified & (c % 7 != 0)
    converted = trial & (c % 2 == 0)

    def at(cond, offset):
        return F.when(cond, F.date_add("created", offset)).cast("timestamp_ntz")

    base = (
        read_table(spark, sf_dir, "customer")
        .select("c_custkey", "c_mktsegment", "c_acctbal")
        .join(_first_orders(spark, sf_dir), "c_custkey")
        .withColumn("created", created)
    )
    size = banded(
        F.col("c_acctbal"),
        [(8000, "1000+"), (5500, "201-1000"), (3000, "51-200"), (1000, "11-50")],
        "1-10",
    )
    return base.select(
        c.alias("lead_id"),
        F.when(converted, c).alias("account_id"),
        _channel(c).alias("acquisition_channel"),
        F.lower("c_mktsegment").alias("industry"),
        size.alias("company_size"),
        (c % 100).cast("int").alias("lead_score"),
        (c % 101).cast("double").alias("trial_engagement_score"),
        F.col("created").cast("timestamp_ntz").alias("created_at"),
        at(qualified, (c % 5).cast("int")).alias("qualified_at"),
        at(qualified & (c % 4 != 0), 6).alias("demo_requested_at"),
        at(qualified & (c % 4).isin(1, 2), 7).alias("demo_completed_at"),
        at(trial, 8).alias("trial_started_at"),
        at(trial, 22).alias("trial_ended_at"),
        at(converted, (9 + c % 60).cast("int")).alias("converted_at"),
        at(~converted & (c % 5 == 0), 30).alias("lost_at"),
    )


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        accounts=accounts(spark, sf_dir),
        plans=plans(spark),
        features=features(spark),
        subscriptions=subscriptions(spark, sf_dir),
        invoices=invoices(spark, sf_dir),
        usage_events=usage_events(spark, sf_dir),
        tickets=tickets(spark, sf_dir),
        leads=leads(spark, sf_dir),
    )


TITLES = ["CEO", "Co-Founder", "CTO", "VP Sales", "Account Manager", "Team Lead", "Software Engineer", "Accountant"]


def contacts(spark, sf_dir) -> DataFrame:
    """Primary contact of each account; every eleventh e-mail is blank."""
    c = F.col("account_id")
    return accounts(spark, sf_dir).select(
        "account_id",
        "company_name",
        "created_at",
        F.when(c % 11 == 0, "").otherwise(F.concat(F.lit(" User"), c.cast("string"), F.lit("@Example.com"))).alias(
            "primary_contact_email"
        ),
        F.concat(F.lit("First"), (c % 13).cast("string"), F.lit(" Last"), (c % 17).cast("string")).alias(
            "primary_contact_name"
        ),
        mapped(c % 8, dict(enumerate(TITLES))).alias("primary_contact_title"),
        F.when(c % 6 == 0, "Churned").otherwise("Active").alias("account_status"),
    )


def event_features(spark, sf_dir) -> DataFrame:
    """Feature catalogue found in the events themselves."""
    ids = read_table(spark, sf_dir, "events").select(F.col("event_type").alias("feature_id")).distinct()
    return feature_attributes(ids)


def sold_plans(spark, sf_dir) -> DataFrame:
    """Catalogue plans that at least one subscription uses."""
    sold = subscriptions(spark, sf_dir).select("plan_id").distinct()
    return plans(spark).join(sold, "plan_id", "left_semi")


LOADED_AT = dt.datetime(2001, 7, 31, 6, 0, 0)


def raw_text(df: DataFrame, key: str, stale: dict[str, object]) -> DataFrame:
    """All-text copy of an entity: blanks for NULL, plus an older version of every row.

    ``stale`` gives the values the older version carries.
    """
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]
    now = df.select(*as_text)
    old = now.withColumns({c: F.lit(v) for c, v in stale.items()})
    stamp = F.lit(LOADED_AT).cast("timestamp_ntz")
    hour = F.expr("interval 1 hour")
    return now.withColumn("_loaded_at", stamp).unionByName(old.withColumn("_loaded_at", stamp - hour)).withColumn(
        "_source_file", F.lit(f"{key}.csv")
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day from the first order to the as-of date."""
    span = dated_orders(spark, sf_dir).agg(F.min("d").alias("first_day"))
    d = F.col("full_date")
    days = span.select(F.explode(F.sequence("first_day", day(AS_OF))).alias("full_date"))
    return days.select(
        F.date_format(d, "yyyyMMdd").alias("date_id"), d, F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.weekofyear(d).alias("week"), F.weekday(d).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"), (F.dayofmonth(d) == 1).alias("is_month_start"), (d == F.last_day(d)).alias("is_month_end"),
    )


#: per entity: a column that some newest rows carry text in that does not parse, and what older versions of every row say
BROKEN = {
    "plans": ("monthly_price", {"plan_name": "old"}), "features": ("is_core", {"feature_name": "old"}), "calendar": ("week", {"day_name": "old"}),
    "accounts": ("created_at", {"company_name": "old"}), "subscriptions": ("seats_purchased", {"status": "old"}), "invoices": ("amount", {"status": "old"}),
    "usage_events": ("occurred_at", {"event_type": "old"}), "tickets": ("csat_score", {"status": "old"}), "leads": ("converted_at", {"acquisition_channel": "old"}),
}


def raw_layer(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All-text rows of the nine entities: an older version of every row, and one row in 97 whose newest version does not parse."""
    t = tables(spark, sf_dir)
    sources = {
        "plans": t.plans, "features": event_features(spark, sf_dir), "calendar": calendar(spark, sf_dir), "accounts": t.accounts,
        "subscriptions": t.subscriptions, "invoices": t.invoices, "usage_events": t.usage_events, "tickets": t.tickets, "leads": t.leads,
    }
    keys = {"plans": "plan_id", "features": "feature_id", "calendar": "date_id", "accounts": "account_id", "subscriptions": "subscription_id",
            "invoices": "subscription_id", "usage_events": "event_id", "tickets": "ticket_id", "leads": "lead_id"}
    out = {}
    for name, rows in sources.items():
        column, stale = BROKEN[name]
        number = F.col(keys[name]).try_cast("bigint")
        chosen = F.coalesce(number % 97 == 0, F.col(keys[name]).isin("growth", "click"))
        raw = raw_text(rows, name, stale)
        newest = F.col("_loaded_at") == F.lit(LOADED_AT).cast("timestamp_ntz")
        out[name] = raw.withColumn(column, F.when(newest & chosen, "n/a").otherwise(F.col(column)))
    return out
