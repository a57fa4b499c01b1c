"""Billing-provider event envelopes to subscription, invoice and account rows.

Each envelope is parsed once with a fixed schema. Numbers arrive loosely typed,
so they are read as text and parsed safely. The same functions serve a batch of
stored events and a stream.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from recurra.functions.scalars import epoch_seconds, safe_float, safe_int

MONEY = "decimal(12,2)"

STRIPE_SCHEMA = """
  id string, type string, created string,
  data struct<object: struct<
    id: string, customer: string, subscription: string, status: string, name: string, description: string,
    plan: struct<id: string, amount: string, nickname: string, interval: string>,
    items: struct<data: array<struct<price: struct<id: string, unit_amount: string>>>>,
    quantity: string, start_date: string, current_period_end: string, trial_start: string, trial_end: string,
    amount_due: string, currency: string, due_date: string, attempt_count: string, created: string,
    status_transitions: struct<paid_at: string>,
    payment_settings: struct<payment_method_types: array<string>>,
    metadata: struct<website: string>,
    address: struct<country: string>>>
"""

# Handled event types and the status / interval words of the target tables.
STRIPE_SUBSCRIPTION = ["customer.subscription.created", "customer.subscription.updated", "customer.subscription.deleted"]
STRIPE_INVOICE = ["invoice.payment_succeeded", "invoice.payment_failed"]
STRIPE_CUSTOMER = ["customer.created", "customer.updated"]
STRIPE_HANDLED = STRIPE_SUBSCRIPTION + STRIPE_INVOICE + STRIPE_CUSTOMER
INTERVALS = {"month": "monthly", "year": "annual", "quarter": "quarterly"}


def filled(c: Column) -> Column:
    """Blank text counts as missing."""
    return F.nullif(c, F.lit(""))


def billing_interval(c: Column) -> Column:
    out = F.coalesce(filled(c), F.lit("monthly"))
    for word, name in INTERVALS.items():
        out = F.when(c == word, name).otherwise(out)
    return out


def cents(c: Column) -> Column:
    """Cents to money; zero and unreadable values are missing."""
    return F.nullif(safe_float(c), F.lit(0.0))


def money(c: Column) -> Column:
    return F.round(c.cast("decimal(20,6)"), 2).cast(MONEY)


def parse_stripe(events: DataFrame, body: str = "body") -> DataFrame:
    parsed = events.select(F.from_json(body, STRIPE_SCHEMA).alias("e"))
    return parsed.select(
        F.coalesce("e.id", F.lit("unknown")).alias("event_id"),
        F.coalesce("e.type", F.lit("unknown")).alias("event_type"),
        epoch_seconds(F.col("e.created")).alias("event_at"),
        F.col("e.data.object").alias("o"),
    ).withColumn("processed", F.col("event_type").isin(STRIPE_HANDLED))


def _subscription(now: Column) -> list[Column]:
    first = F.get(F.col("o.items.data"), 0)
    amount = F.coalesce(cents(F.col("o.plan.amount")), cents(first.price.unit_amount), F.lit(0.0)) / 100
    status = F.when(F.col("event_type") == "customer.subscription.deleted", "canceled").otherwise(
        F.coalesce("o.status", F.lit("active"))
    )
    return [
        F.coalesce("o.id", F.concat(F.lit("stripe_"), "event_id")).alias("subscription_id"),
        F.coalesce("o.customer", F.lit("unknown")).alias("account_id"),
        F.coalesce(filled(F.col("o.plan.id")), first.price.id, F.lit("unknown")).alias("plan_id"),
        F.coalesce(filled(F.col("o.plan.nickname")), F.lit("Stripe Plan")).alias("plan_name"),
        status.alias("status"),
        money(amount).alias("mrr"),
        (money(amount) * 12).cast("decimal(14,2)").alias("arr"),
        safe_int(F.col("o.quantity"), 1).alias("seats"),
        F.coalesce(epoch_seconds(F.col("o.start_date")), now).alias("started_at"),
        epoch_seconds(F.col("o.current_period_end")).alias("canceled_at"),
        epoch_seconds(F.col("o.trial_start")).alias("trial_started_at"),
        epoch_seconds(F.col("o.trial_end")).alias("trial_ended_at"),
        billing_interval(F.col("o.plan.interval")).alias("billing_interval"),
    ]


def _invoice(now: Column) -> list[Column]:
    paid = F.col("event_type") == "invoice.payment_succeeded"
    method = F.get(F.col("o.payment_settings.payment_method_types"), 0)
    return [
        F.coalesce("o.id", F.concat(F.lit("inv_"), "event_id")).alias("invoice_id"),
        F.coalesce("o.customer", F.lit("unknown")).alias("account_id"),
        F.coalesce("o.subscription", F.lit("")).alias("subscription_id"),
        money(safe_float(F.col("o.amount_due")) / 100).alias("amount"),
        F.upper(F.coalesce("o.currency", F.lit("usd"))).alias("currency"),
        F.when(paid, "paid").otherwise("failed").alias("status"),
        F.coalesce(method, F.lit("card")).alias("payment_method"),
        safe_int(F.col("o.attempt_count"), 1).alias("attempt_count"),
        F.coalesce(epoch_seconds(F.col("o.created")), now).cast("date").alias("invoice_date"),
        epoch_seconds(F.col("o.due_date")).cast("date").alias("due_date"),
        F.when(paid, epoch_seconds(F.col("o.status_transitions.paid_at"))).alias("paid_at"),
        F.when(~paid, now).alias("failed_at"),
        F.coalesce(epoch_seconds(F.col("o.created")), now).alias("created_at"),
    ]


def _account(now: Column) -> list[Column]:
    return [
        F.coalesce("o.id", F.concat(F.lit("cust_"), "event_id")).alias("account_id"),
        F.coalesce(filled(F.col("o.name")), filled(F.col("o.description")), F.lit("Unknown Company")).alias("company_name"),
        F.lit("stripe").alias("acquisition_channel"),
        filled(F.col("o.name")).alias("account_owner"),
        filled(F.col("o.metadata.website")).alias("website"),
        F.col("o.address.country").alias("country"),
        F.coalesce(epoch_seconds(F.col("o.created")), now).alias("created_at"),
    ]


def stripe_rows(parsed: DataFrame, received_at: dt.datetime) -> DataFrame:
    """All handled kinds from one pass: each row carries the struct of its own kind, the others are NULL.

    Writing the three targets from a stored copy of this frame reads and parses every envelope once.
    """
    now = F.lit(received_at).cast("timestamp_ntz")
    is_one = lambda kinds: F.col("event_type").isin(kinds)
    return parsed.select(
        "event_id", "event_at", "event_type", "processed",
        F.when(is_one(STRIPE_SUBSCRIPTION), F.struct(*_subscription(now))).alias("subscription"),
        F.when(is_one(STRIPE_INVOICE), F.struct(*_invoice(now))).alias("invoice"),
        F.when(is_one(STRIPE_CUSTOMER), F.struct(*_account(now))).alias("account"),
    )


def _of_kind(parsed: DataFrame, kinds: list[str], columns: list[Column]) -> DataFrame:
    return parsed.where(F.col("event_type").isin(kinds)).select("event_id", "event_at", *columns)


def stripe_subscriptions(parsed: DataFrame, received_at: dt.datetime) -> DataFrame:
    return _of_kind(parsed, STRIPE_SUBSCRIPTION, _subscription(F.lit(received_at).cast("timestamp_ntz")))


def stripe_invoices(parsed: DataFrame, received_at: dt.datetime) -> DataFrame:
    return _of_kind(parsed, STRIPE_INVOICE, _invoice(F.lit(received_at).cast("timestamp_ntz")))


def stripe_accounts(parsed: DataFrame, received_at: dt.datetime) -> DataFrame:
    return _of_kind(parsed, STRIPE_CUSTOMER, _account(F.lit(received_at).cast("timestamp_ntz")))


CHARGEBEE_SCHEMA = """
  id string, event_type string, occurred_at string,
  content struct<
    subscription: struct<id: string, customer_id: string, plan_id: string, status: string, mrr: string, plan_quantity: string,
      started_at: string, current_term_end: string, trial_start: string, trial_end: string, billing_period_unit: string>,
    plan: struct<name: string>,
    transaction: struct<id: string, customer_id: string, customer: string, subscription_id: string, subscription: string,
      amount_paid: string, amount: string, total: string, currency_code: string, currency: string, payment_method: string, date: string>,
    invoice: struct<id: string, customer_id: string, customer: string, subscription_id: string, subscription: string,
      amount_paid: string, amount: string, total: string, currency_code: string, currency: string, payment_method: string, date: string>>
"""
CHARGEBEE_SUBSCRIPTION = ["subscription_created", "subscription_changed", "subscription_cancelled"]
CHARGEBEE_PAYMENT = ["payment_succeeded", "payment_failed"]


def parse_chargebee(events: DataFrame, body: str = "body") -> DataFrame:
    parsed = events.select(F.from_json(body, CHARGEBEE_SCHEMA).alias("e"))
    return parsed.select(
        F.coalesce("e.id", F.lit("unknown")).alias("event_id"),
        F.coalesce("e.event_type", F.lit("unknown")).alias("event_type"),
        F.col("e.content.subscription").alias("s"),
        F.col("e.content.plan.name").alias("plan_name"),
        F.coalesce("e.content.transaction", "e.content.invoice").alias("x"),
    ).withColumn("processed", F.col("event_type").isin(CHARGEBEE_SUBSCRIPTION + CHARGEBEE_PAYMENT))


def chargebee_subscriptions(parsed: DataFrame, received_at: dt.datetime) -> DataFrame:
    now = F.lit(received_at).cast("timestamp_ntz")
    mrr = money(safe_float(F.col("s.mrr")) / 100)
    status = F.when(F.col("event_type") == "subscription_cancelled", "canceled").otherwise(
        F.coalesce("s.status", F.lit("active"))
    )
    return parsed.where(F.col("event_type").isin(CHARGEBEE_SUBSCRIPTION)).select(
        "event_id",
        F.coalesce("s.id", F.concat(F.lit("cb_"), "event_id")).alias("subscription_id"),
        F.coalesce("s.customer_id", F.lit("unknown")).alias("account_id"),
        F.coalesce("s.plan_id", F.lit("unknown")).alias("plan_id"),
        F.coalesce(filled(F.col("plan_name")), filled(F.col("s.plan_id")), F.lit("Chargebee Plan")).alias("plan_name"),
        status.alias("status"),
        mrr.alias("mrr"),
        (mrr * 12).cast("decimal(14,2)").alias("arr"),
        safe_int(F.col("s.plan_quantity"), 1).alias("seats"),
        F.coalesce(epoch_seconds(F.col("s.started_at")), now).alias("started_at"),
        epoch_seconds(F.col("s.current_term_end")).alias("canceled_at"),
        epoch_seconds(F.col("s.trial_start")).alias("trial_started_at"),
        epoch_seconds(F.col("s.trial_end")).alias("trial_ended_at"),
        billing_interval(F.col("s.billing_period_unit")).alias("billing_interval"),
    )


def chargebee_invoices(parsed: DataFrame, received_at: dt.datetime) -> DataFrame:
    """Amounts above 1000 are taken for cents."""
    now = F.lit(received_at).cast("timestamp_ntz")
    x = lambda c: F.col(f"x.{c}")
    raw = F.coalesce(cents(x("amount_paid")), cents(x("amount")), cents(x("total")), F.lit(0.0))
    paid = F.col("event_type") == "payment_succeeded"
    return parsed.where(F.col("event_type").isin(CHARGEBEE_PAYMENT)).select(
        "event_id",
        F.coalesce(x("id"), F.concat(F.lit("cb_txn_"), "event_id")).alias("invoice_id"),
        F.coalesce(filled(x("customer_id")), x("customer"), F.lit("unknown")).alias("account_id"),
        F.coalesce(filled(x("subscription_id")), x("subscription"), F.lit("")).alias("subscription_id"),
        money(F.when(raw > 1000, raw / 100).otherwise(raw)).alias("amount"),
        F.upper(F.coalesce(filled(x("currency_code")), x("currency"), F.lit("USD"))).alias("currency"),
        F.when(paid, "paid").otherwise("failed").alias("status"),
        F.coalesce(x("payment_method"), F.lit("card")).alias("payment_method"),
        F.lit(1).alias("attempt_count"),
        F.coalesce(epoch_seconds(x("date")), now).cast("date").alias("invoice_date"),
        F.when(paid, now).alias("paid_at"),
        F.when(~paid, now).alias("failed_at"),
        now.alias("created_at"),
    )
