"""Registered queries: files, validation, webhooks, keyed updates, streams, stored marts."""

import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from recurra.functions.expr import rounded
from recurra.operators import incremental as inc, mrr, quality as dq, spine
from recurra.plans import models
from recurra.plans.store import MartStore
from recurra.plans.registry import AS_OF, CFG, Source, query
from recurra.session import scratch_path
from recurra.sources import adapter, files, ingest, webhooks
from recurra.streaming import changes

NOW = adapter.LOADED_AT
INVOICE_COLUMNS = ["invoice_id", "account_id", "subscription_id", "amount", "status", "invoice_date", "paid_date", "payment_method"]


def written_csv(s: Source, df, name: str) -> str:
    path = f"{scratch_path(s.spark, 'csv')}/{name}.csv"
    files.csv_sink(df, path)
    return path


@query("csv_text_scan")
def _text(s):
    scanned = files.csv_text_scan(s.spark, written_csv(s, s.t.invoices, "invoices"), INVOICE_COLUMNS, NOW)
    return scanned.withColumn("has_lineage", F.col("_row_id").isNotNull() & F.col("_source_file").endswith(".csv")).drop(
        "_row_id", "_source_file"
    )


@query("csv_typed_scan")
def _typed(s):
    noisy = s.t.invoices.select(
        "invoice_id", "account_id", "amount", "invoice_date", F.coalesce(F.col("paid_date").cast("string"), F.lit("None")).alias("paid_date"),
        F.when(F.col("status") == "paid", "True").otherwise("false").alias("payment_succeeded"), "status",
    )
    return files.csv_typed_scan(s.spark, written_csv(s, noisy, "invoices"))


@query("load_raw_layer")
def _layer(s):
    folder = scratch_path(s.spark, "raw")
    t = s.t
    frames = {
        "plans": adapter.sold_plans(s.spark, s.sf_dir), "features": adapter.event_features(s.spark, s.sf_dir),
        "calendar": spine.day_spine(t.accounts, "created_at", AS_OF), "accounts": t.accounts, "subscriptions": t.subscriptions,
        "invoices": t.invoices, "usage_events": t.usage_events, "support_tickets": t.tickets, "leads": t.leads,
    }
    for name, df in frames.items():
        files.csv_sink(df, f"{folder}/{name}.csv")
    layer = files.load_raw_layer(s.spark, folder, {name: df.columns for name, df in frames.items()})
    return dq.union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count"), F.count(F.col(df.columns[0])).alias("keyed_rows")).withColumn(
                "table_name", F.lit(table)
            )
            for table, df in layer.items()
        ]
    )


def _texts(s):
    t = s.t
    none = lambda df, *cs: df.withColumns({c: F.lit(None).cast("string") for c in cs})
    return {
        "accounts": adapter.raw_text(t.accounts, "accounts", {}), "subscriptions": adapter.raw_text(t.subscriptions, "subscriptions", {}),
        "invoices": adapter.raw_text(t.invoices, "invoices", {}), "usage_events": adapter.raw_text(t.usage_events, "usage_events", {}),
        "tickets": adapter.raw_text(t.tickets, "tickets", {}), "leads": adapter.raw_text(t.leads, "leads", {}),
    }


@query("bronze_views")
def _bronze(s):
    views = files.bronze_views(_texts(s))
    return dq.union_all(
        [
            df.groupBy("_loaded_at").agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct(df.columns[0]).alias("keys")).withColumn("view", F.lit(n))
            for n, df in views.items()
        ]
    )


@query("ingest_validate")
def _validate(s):
    """Six record types derived from the tables, with faults that follow from their values."""
    o, c, e = s.raw("orders"), s.raw("customer"), s.raw("events")
    k = F.col("o_orderkey")
    text = lambda x: x.cast("string")
    subs = o.select(
        text(k).alias("subscription_id"), F.when(k % 97 == 0, " ").otherwise(text(F.col("o_custkey"))).alias("account_id"), F.lit("Growth").alias("plan_name"),
        F.when(k % 89 == 0, "n/a").otherwise(text((F.col("o_totalprice") * 3).cast("decimal(14,2)"))).alias("mrr"),
        F.when(F.col("o_orderstatus") == "F", "canceled").when(F.col("o_orderstatus") == "O", "active").when(k % 2 == 0, "pending").alias("status"),
        text(k % 50 - 1).alias("seats"),
    )
    inv = s.t.invoices.select(
        "invoice_id", text(F.col("account_id")).alias("account_id"), text(F.col("amount") - 2000).alias("amount"),
        F.when(F.col("status") == "pending", "open").otherwise(F.col("status")).alias("status"),
        F.when(F.col("account_id") % 10 == 0, "EURO").alias("currency"),
    )
    acc = c.select(
        text(F.col("c_custkey")).alias("account_id"), F.when(F.col("c_custkey") % 31 == 0, "").otherwise(F.col("c_name")).alias("company_name"),
        F.when(F.col("c_acctbal") < 0, "tiny").otherwise("smb").alias("company_size"),
    )
    use = e.select(
        text(F.col("event_id")).alias("event_id"), text(F.col("user_id")).alias("account_id"), F.concat(F.lit(" My "), "event_type").alias("feature_name"),
        text(F.col("event_id") % 40 - 1).alias("event_count"), F.when(F.col("event_id") % 71 == 0, "yesterday").otherwise(text(F.col("ts"))).alias("occurred_at"),
    )
    tix = s.t.tickets.select(
        text(F.col("ticket_id")).alias("ticket_id"), text(F.col("account_id")).alias("account_id"), "priority", "status",
        text(F.col("ticket_id") % 7).alias("csat_score"),
    )
    leads = s.t.leads.select(
        text(F.col("lead_id")).alias("lead_id"), F.when(F.col("converted_at").isNotNull(), "closed_won").when(F.col("lost_at").isNotNull(), "lost").alias("funnel_stage"),
        text(F.col("trial_engagement_score").cast("int") + 3).alias("lead_score"), text(F.col("lead_id") % 9 - 1).alias("days_lead_to_paid"),
        text(F.col("account_id")).alias("converted_account_id"),
    )

    def checked(df, kind, key, shown):
        return ingest.ingest_validate(df, kind).select(
            F.lit(kind).alias("record_type"), F.col(key).alias("record_id"), "reject_reason", shown.cast("string").alias("shown")
        )

    return dq.union_all(
        [
            checked(subs, "subscription", "subscription_id", F.col("status")), checked(inv, "invoice", "invoice_id", F.col("currency")),
            checked(acc, "account", "account_id", F.col("account_id")), checked(use, "usage_event", "event_id", F.col("feature_name")),
            checked(tix, "ticket", "ticket_id", F.col("priority")), checked(leads, "lead", "lead_id", F.col("account_id")),
        ]
    )


def stripe_bodies(s: Source):
    """One event per subscription and per invoice, and one per account, as JSON text."""
    t = s.t
    epoch = lambda c: F.unix_timestamp(c.cast("timestamp"))
    k = F.col("subscription_id")
    nil = lambda kind: F.lit(None).cast(kind)
    price = (F.col("mrr") * 100).cast("bigint")
    subs = t.subscriptions.select(
        F.to_json(
            F.struct(
                F.concat(F.lit("evt_s"), k).alias("id"),
                F.when(k % 4 == 0, "customer.subscription.created").when(k % 4 == 1, "customer.subscription.updated")
                .when(k % 4 == 2, "customer.subscription.deleted").otherwise("customer.tax_id.created").alias("type"),
                epoch(F.col("start_date")).alias("created"),
                F.struct(
                    F.struct(
                        F.concat(F.lit("sub_"), k).alias("id"), F.col("account_id").cast("string").alias("customer"),
                        F.when(k % 5 != 0, F.struct(F.col("plan_id").alias("id"), price.alias("amount"), F.col("plan_name").alias("nickname"),
                               F.when(k % 3 == 0, "year").otherwise("month").alias("interval"))).alias("plan"),
                        F.struct(F.array(F.struct(F.struct(F.concat(F.lit("price_"), "plan_id").alias("id"), price.alias("unit_amount")).alias("price"))).alias("data")).alias("items"),
                        F.when(k % 6 != 0, F.col("seats_purchased")).alias("quantity"), epoch(F.col("start_date")).alias("start_date"),
                        epoch(F.col("end_date")).alias("current_period_end"),
                        F.when(F.col("status") == "trial", epoch(F.col("start_date"))).alias("trial_start"),
                        F.when(F.col("status") == "trial", epoch(F.date_add("start_date", 14))).alias("trial_end"),
                    ).alias("object")
                ).alias("data"),
            )
        ).alias("body")
    )
    cents = (F.col("amount") * 100).cast("bigint")
    inv = t.invoices.select(
        F.to_json(
            F.struct(
                F.concat(F.lit("evt_i"), "invoice_id").alias("id"),
                F.when(F.col("status") == "paid", "invoice.payment_succeeded").when(F.col("status") == "failed", "invoice.payment_failed").otherwise("invoice.created").alias("type"),
                epoch(F.col("invoice_date")).alias("created"),
                F.struct(
                    F.struct(
                        F.col("invoice_id").alias("id"), F.col("account_id").cast("string").alias("customer"), F.concat(F.lit("sub_"), "subscription_id").alias("subscription"),
                        cents.alias("amount_due"), F.lit("usd").alias("currency"), epoch(F.col("invoice_date")).alias("created"), epoch(F.col("due_date")).alias("due_date"),
                        F.when(F.col("account_id") % 4 == 0, F.lit(3)).alias("attempt_count"), F.when(F.col("account_id") % 5 == 0, F.struct(F.array(F.lit("sepa"), F.lit("card")).alias("payment_method_types"))).alias("payment_settings"),
                        F.struct(epoch(F.col("paid_date")).alias("paid_at")).alias("status_transitions"),
                    ).alias("object")
                ).alias("data"),
            )
        ).alias("body")
    )
    acc = t.accounts.select(
        F.to_json(
            F.struct(
                F.concat(F.lit("evt_a"), "account_id").alias("id"), F.lit("customer.created").alias("type"), epoch(F.col("created_at")).alias("created"),
                F.struct(
                    F.struct(
                        F.col("account_id").cast("string").alias("id"), F.when(F.col("account_id") % 3 != 0, F.col("company_name")).alias("name"),
                        F.struct(F.col("country").alias("country")).alias("address"), epoch(F.col("created_at")).alias("created"),
                        F.when(F.col("account_id") % 2 == 0, F.struct(F.concat(F.lit("https://"), "account_id", F.lit(".example")).alias("website"))).alias("metadata"),
                    ).alias("object")
                ).alias("data"),
            )
        ).alias("body")
    )
    return subs, inv, acc


@query("stripe_events_normalize")
def _stripe(s):
    subs, inv, acc = stripe_bodies(s)
    rows = webhooks.stripe_rows(webhooks.parse_stripe(subs.unionByName(inv).unionByName(acc)), NOW)
    slash = lambda *cs: F.concat_ws("/", *[F.col(c).cast("string") for c in cs])
    pick = lambda sub, invoice, account, other: (
        F.when(F.col("subscription").isNotNull(), sub).when(F.col("invoice").isNotNull(), invoice)
        .when(F.col("account").isNotNull(), account).otherwise(other)
    )
    c, none, lit = F.col, F.lit(None), F.lit
    day = lambda name: c(name).cast("date")
    return rows.select(
        pick(lit("subscription"), lit("invoice"), lit("account"), lit("unprocessed")).alias("kind"),
        pick(c("subscription.subscription_id"), c("invoice.invoice_id"), c("account.account_id"), c("event_id")).alias("key"),
        pick(c("subscription.account_id"), c("invoice.account_id"), c("account.account_id"), none).alias("account_id"),
        pick(c("subscription.mrr"), c("invoice.amount"), none, none).cast("double").alias("amount"),
        pick(c("subscription.status"), c("invoice.status"), c("account.acquisition_channel"), none).alias("status"),
        pick(
            slash("subscription.plan_id", "subscription.plan_name", "subscription.billing_interval", "subscription.seats"),
            slash("invoice.subscription_id", "invoice.currency", "invoice.payment_method", "invoice.attempt_count"),
            slash("account.company_name", "account.country"), c("event_type"),
        ).alias("label"),
        pick(day("subscription.started_at"), day("invoice.invoice_date"), day("account.created_at"), none).alias("starts"),
        pick(day("subscription.canceled_at"), day("invoice.paid_at"), none, none).alias("ends"),
    )


@query("chargebee_events_normalize")
def _chargebee(s):
    t = s.t
    k = F.col("subscription_id")
    epoch = lambda c: F.unix_timestamp(c.cast("timestamp"))
    subs = t.subscriptions.select(
        F.to_json(
            F.struct(
                F.concat(F.lit("ev_"), k).alias("id"),
                F.when(k % 4 == 0, "subscription_created").when(k % 4 == 1, "subscription_changed").when(k % 4 == 2, "subscription_cancelled").otherwise("card_added").alias("event_type"),
                F.struct(
                    F.struct(
                        F.concat(F.lit("cb_"), k).alias("id"), F.col("account_id").cast("string").alias("customer_id"), "plan_id",
                        (F.col("mrr") * 100).cast("bigint").alias("mrr"), F.when(k % 6 != 0, F.col("seats_purchased")).alias("plan_quantity"),
                        epoch(F.col("start_date")).alias("started_at"), F.when(k % 3 == 0, "year").otherwise("month").alias("billing_period_unit"),
                        F.when(F.col("status") == "trial", epoch(F.col("start_date"))).alias("trial_start"), F.when(F.col("status") == "trial", epoch(F.date_add("start_date", 14))).alias("trial_end"),
                    ).alias("subscription"),
                    F.when(k % 5 != 0, F.struct(F.upper("plan_name").alias("name"))).alias("plan"),
                ).alias("content"),
            )
        ).alias("body")
    )
    n = F.length("invoice_id")
    # small invoices arrive in full units, large ones in cents; some as transaction, some as invoice
    value = F.when(F.col("amount") > 5000, (F.col("amount") * 100).cast("bigint").cast("string")).otherwise((F.col("amount") / 100).cast("decimal(12,2)").cast("string"))
    body = F.struct(
        F.col("invoice_id").alias("id"), F.col("account_id").cast("string").alias("customer_id"), value.alias("amount"), F.lit("usd").alias("currency_code"),
        epoch(F.col("invoice_date")).alias("date"),
    )
    odd = F.col("account_id") % 2 == 1
    inv = t.invoices.select(
        F.to_json(
            F.struct(
                F.concat(F.lit("ev_i"), "invoice_id").alias("id"),
                F.when(F.col("status") == "paid", "payment_succeeded").when(F.col("status") == "failed", "payment_failed").otherwise("invoice_generated").alias("event_type"),
                F.struct(F.when(odd, body).alias("transaction"), F.when(~odd, body).alias("invoice")).alias("content"),
            )
        ).alias("body")
    )
    parsed = webhooks.parse_chargebee(subs.unionByName(inv))
    a, b = webhooks.chargebee_subscriptions(parsed, NOW), webhooks.chargebee_invoices(parsed, NOW)
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None)
    return dq.union_all(
        [
            a.select(F.lit("subscription").alias("kind"), F.col("subscription_id").alias("key"), "account_id", F.col("mrr").cast("double").alias("amount"), "status",
                     F.concat_ws("/", "plan_id", "plan_name", "billing_interval", text("seats"), F.col("trial_started_at").cast("date").cast("string"), F.col("trial_ended_at").cast("date").cast("string")).alias("label"), F.col("started_at").cast("date").alias("starts")),
            b.select(F.lit("invoice").alias("kind"), F.col("invoice_id").alias("key"), "account_id", F.col("amount").cast("double").alias("amount"), "status",
                     F.concat_ws("/", "currency", "payment_method", text("attempt_count")).alias("label"), F.col("invoice_date").alias("starts")),
            parsed.where(~F.col("processed")).select(
                F.lit("unprocessed").alias("kind"), F.col("event_id").alias("key"), none.cast("string").alias("account_id"), none.cast("double").alias("amount"),
                none.cast("string").alias("status"), F.col("event_type").alias("label"), none.cast("date").alias("starts"),
            ),
        ]
    )


# sinks: written once, read back
@query("write_full_refresh")
def _full(s):
    path = scratch_path(s.spark, "full")
    rows = mrr.movement_rows(s.t.subscriptions, AS_OF).select("account_id", "month_start", "mrr", "mrr_movement_type")
    files.write_full_refresh(rows, path, "month_start")
    return s.spark.read.parquet(path)


@query("write_append")
def _append(s):
    path = scratch_path(s.spark, "append")
    cols = ["subscription_id", "status", "mrr"]
    files.write_append(s.t.subscriptions.where(F.col("status") != "trial").select(*cols), path)
    files.write_append(s.t.subscriptions.where(F.col("status") == "trial").select(*cols), path)
    return s.spark.read.parquet(path)


@query("csv_sink")
def _csv(s):
    rows = s.t.subscriptions.select("subscription_id", "plan_name", "mrr", "start_date", "end_date")
    return s.spark.read.option("header", True).schema("subscription_id bigint, plan_name string, mrr decimal(12,2), start_date date, end_date date").csv(
        written_csv(s, rows, "subscriptions")
    )


@query("json_sink")
def _json(s):
    path = scratch_path(s.spark, "json")
    files.json_sink(s.t.leads.select("lead_id", "account_id", "acquisition_channel", F.col("created_at").cast("date").alias("day")), path)
    return s.spark.read.schema("lead_id bigint, account_id bigint, acquisition_channel string, day date").json(path)


@query("dq_csv_vs_table")
def _csv_rows(s):
    path = written_csv(s, s.t.subscriptions, "subscriptions")
    return dq.source_vs_table(files.csv_text_scan(s.spark, path, ["subscription_id"], NOW), s.t.subscriptions, "subscriptions")


# keyed updates
def _target_and_changes(s):
    cols = ["subscription_id", "account_id", "status", "mrr", "start_date"]
    stamp = F.col("start_date").cast("timestamp_ntz").alias("_loaded_at")
    rows = s.t.subscriptions.select(*cols)
    early = rows.where(F.col("start_date") < dt.date(2000, 1, 1))
    # every later subscription is new, every cancelled one changes twice
    changed = rows.where(F.col("status") == "cancelled").select(
        "subscription_id", "account_id", F.lit("closed").alias("status"), F.lit(0).cast("decimal(12,2)").alias("mrr"), "start_date", stamp
    )
    older = changed.withColumn("status", F.lit("closing")).withColumn("_loaded_at", F.col("_loaded_at") - F.expr("interval 1 hour"))
    new = rows.where((F.col("start_date") >= dt.date(2000, 1, 1)) & (F.col("status") != "cancelled")).select(*cols, stamp)
    return early, new.unionByName(older).unionByName(changed)


@query("upsert_by_key")
def _upsert(s):
    target, changed = _target_and_changes(s)
    counts = inc.upsert_counts(target, changed, ["subscription_id"])
    out = inc.upsert_by_key(target, changed, ["subscription_id"], "_loaded_at")
    return out.withColumns({"inserted": counts.select("inserted").scalar(), "updated": counts.select("updated").scalar()})


@query("insert_ignore")
def _ignore(s):
    target, changed = _target_and_changes(s)
    return inc.insert_ignore(target, changed, ["subscription_id"], "_loaded_at")


@query("upsert_partial_columns")
def _partial(s):
    target, changed = _target_and_changes(s)
    repeated = changed.withColumn("account_id", F.lit(-1).cast("bigint"))
    return inc.upsert_partial_columns(target, repeated, ["subscription_id"], ["status", "mrr"], "_loaded_at")


EARLY = dt.date(2001, 5, 31)


def lookback_store(s: Source, models_: list[str]) -> MartStore:
    """Marts built in full two months ago from what was there then, and refreshed to the present by a look-back build."""
    t, before = s.t, lambda rows, column: rows.where(F.col(column).cast("date") <= EARLY)
    early = dataclasses.replace(
        t, accounts=before(t.accounts, "created_at"), subscriptions=before(t.subscriptions, "start_date"), invoices=before(t.invoices, "invoice_date"),
        usage_events=before(t.usage_events, "occurred_at"), tickets=before(t.tickets, "created_at"))
    out = scratch_path(s.spark, "marts")
    models.build(s.spark, early, CFG, EARLY, out, models_, full_refresh=True)
    models.build(s.spark, t, CFG, AS_OF, out, models_)
    return MartStore(s.spark, out)


@query("incremental_lookback")
def _lookback(s):
    out = lookback_store(s, ["+mrr_movement_rows"]).read("mrr_movement_rows")
    return out.select("account_id", "month_start", "mrr", "prev_mrr", "mrr_movement_type", *mrr.COMPONENTS)


query("lookback_account_months")(lambda s: lookback_store(s, ["account_months"]).read("account_months"))


@query("lookback_usage_monthly")
def _lookback_usage(s):
    out = lookback_store(s, ["usage_monthly"]).read("usage_monthly")
    return out.withColumns({c: rounded(F.col(c), 4) for c in ("avg_session_duration_seconds", "avg_events_per_active_day")})


@query("lookback_ticket_monthly")
def _lookback_tickets(s):
    rates = dict(avg_csat_score=4, avg_resolution_hours=4, avg_first_response_hours=4, escalation_rate=6, resolution_rate=6)
    out = lookback_store(s, ["ticket_monthly"]).read("ticket_monthly")
    return out.withColumns({c: rounded(F.col(c), k) for c, k in rates.items()})


@query("lookback_health")
def _lookback_health(s):
    digits = dict(csat_score=4, seat_utilization_rate=6, events_mom_pct_change=6, avg_csat_score=4, escalation_rate=6)
    out = lookback_store(s, ["+fct_account_monthly_health"]).read("fct_account_monthly_health")
    return out.withColumns({c: rounded(F.col(c), k) for c, k in digits.items()})


@query("stored_exec_summary")
def _stored_exec(s):
    """The executive mart from stored movements, these from a look-back build."""
    return lookback_store(s, ["+exec_revenue_summary"]).read("exec_revenue_summary")


# streams
def webhook_stream(s: Source) -> dict:
    """All billing events as packed files of a bounded number of events, each event twice, as providers retry."""
    subs, inv, acc = stripe_bodies(s)
    folder = scratch_path(s.spark, "bodies")
    older = F.regexp_replace("body", '"status":"[a-z_]*"', '"status":"stale"')
    # besides the event itself comes an older one of the same object
    stale = F.regexp_replace(older, '"created":[0-9]+', '"created":86400')
    # an event is made once and its copies are dealt from there
    sent = lambda df, *bodies: df.select(F.explode(F.array(*bodies)).alias("body"))
    everything = sent(subs, "body", "body", stale).unionByName(sent(inv.unionByName(acc), "body", "body"))
    everything.write.options(compression="gzip", maxRecordsPerFile=200_000, **{"zlib.compress.level": "BEST_SPEED"}).text(folder)
    return changes.stream_webhooks(s.spark, folder, NOW)


def days(df, *names):
    return df.withColumns({n: F.col(n).cast("date") for n in names}).drop("event_at")


@query("stream_webhook_upsert")
def _stream_webhook(s):
    return days(webhook_stream(s)["subscription"], "started_at", "canceled_at", "trial_started_at", "trial_ended_at")


query("stream_webhook_invoices")(lambda s: days(webhook_stream(s)["invoice"], "paid_at", "failed_at", "created_at"))
query("stream_webhook_accounts")(lambda s: days(webhook_stream(s)["account"], "created_at"))


def table_stream(spark, path: str, schema):
    """A Parquet table as a stream, one file in each batch; files of a folder and single files alike."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def event_stream(s: Source, copies: int = 1):
    """Events dealt to four files without regard to their time, so that they arrive in four mixed batches."""
    rows = s.raw("events").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    folder = f"{scratch_path(s.spark, 'events')}/events.parquet"
    rows.repartition(4, "event_id", "copy").drop("copy").write.parquet(folder)
    return table_stream(s.spark, folder, s.raw("events").schema)


@query("stream_dedupe_events")
def _stream_dedupe(s):
    twice = event_stream(s, copies=2).withColumn("ts", F.col("ts").cast("timestamp"))
    return changes.stream_dedupe_events(twice.select("event_id", "user_id", "event_type", "ts")).select(
        "event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day")
    )


query("stream_usage_counts")(
    lambda s: changes.stream_usage_counts(adapter.as_usage_events(event_stream(s)))
)


@query("full_refresh")
def _refresh(s):
    out = scratch_path(s.spark, "marts")
    models.build(s.spark, s.t, CFG, EARLY, out, ["+exec_waterfall"], full_refresh=True)
    models.build(s.spark, s.t, CFG, AS_OF, out, ["+exec_waterfall"])
    return MartStore(s.spark, out).read("exec_waterfall")
