"""Registered queries: staging, cohorts, usage, support, health, funnel, success."""

import dataclasses

from pyspark.sql import functions as F

from recurra.config import Tables
from recurra.functions.expr import rounded
from recurra.operators import cohorts, funnel, health, silver, staging, success, support, usage
from recurra.operators.mrr import invoice_monthly
from recurra.operators.quality import union_all
from recurra.plans import models
from recurra.plans.registry import AS_OF, CFG, Source, query
from recurra.plans.revenue import movements
from recurra.plans.store import MartStore
from recurra.session import scratch_path
from recurra.sources import adapter


def scores(s: Source):
    return health.fct_account_monthly_health(s.t, CFG, AS_OF)


def summary(s: Source):
    return success.customer_success_summary(s.t, CFG, AS_OF)


def retention(s: Source):
    return cohorts.cohort_rows(s.t, AS_OF)


def cohort_fact(s: Source):
    return cohorts.fct_customer_cohorts(retention(s))


def conversions(s: Source):
    return funnel.fct_sales_conversion(s.t)


def usage_rows(s: Source):
    return usage.usage_monthly(s.t.usage_events, staging.stg_features(s.t.features))


def ticket_rows(s: Source):
    return support.ticket_monthly(s.t.tickets)


def fixed(df, **digits):
    return df.withColumns({c: rounded(F.col(c), k) for c, k in digits.items()})


# staging
query("stg_accounts")(lambda s: staging.stg_accounts(s.t.accounts, s.t.subscriptions, AS_OF))
query("stg_calendar")(
    lambda s: staging.stg_calendar(
        adapter.dated_orders(s.spark, s.sf_dir).agg(F.trunc(F.min("d"), "YEAR").alias("start")), AS_OF
    )
)
query("stg_customers")(lambda s: staging.stg_customers(adapter.contacts(s.spark, s.sf_dir), AS_OF))
query("stg_features")(lambda s: staging.stg_features(adapter.event_features(s.spark, s.sf_dir)))
query("stg_invoices")(lambda s: staging.stg_invoices(s.t.invoices, AS_OF))
query("stg_leads")(lambda s: staging.stg_leads(s.t.leads))
query("stg_plans")(lambda s: staging.stg_plans(adapter.sold_plans(s.spark, s.sf_dir)))
query("stg_subscriptions")(lambda s: staging.stg_subscriptions(s.t.subscriptions, AS_OF))
query("stg_usage_events")(lambda s: staging.stg_usage_events(s.t.usage_events, CFG))
query("stg_support_tickets")(lambda s: staging.stg_support_tickets(s.t.tickets))


@query("silver_latest_per_key")
def _silver(s: Source):
    raw = adapter.raw_text(s.t.invoices, "invoices", {"amount": "0.01", "status": "draft", "currency": ""})
    return silver.silver(raw, "invoices")


def typed_layer(s: Source, *names: str):
    """(typed rows, quarantine) of the entities, each stored by one job."""
    raw = adapter.raw_layer(s.spark, s.sf_dir)
    return {n: silver.write_typed(raw[n], n, scratch_path(s.spark, f"typed-{n}")) for n in names}


for _entity in silver.TYPED:
    query(f"silver_{_entity}")(lambda s, n=_entity: typed_layer(s, n)[n][0])


@query("silver_quarantine")
def _quarantine(s: Source):
    bad = [b.select("entity", "key", "columns", F.get_json_object("text", f"$.{adapter.BROKEN[n][0]}").alias("shown")) for n, (_, b) in typed_layer(s, *silver.TYPED).items()]
    return union_all(bad)


def typed_tables(s: Source) -> Tables:
    """The marts' inputs from the typed layer: what is in quarantine or has no account does not reach them."""
    t = {n: rows for n, (rows, _) in typed_layer(s, "accounts", "subscriptions", "invoices").items()}
    owned = lambda n: silver.fk_guard(t[n], t["accounts"])
    # the staging rules of invoices: a known account and a positive amount
    invoices = owned("invoices").where((F.col("amount") > 0) & F.col("invoice_date").isNotNull())
    return dataclasses.replace(s.t, accounts=t["accounts"], subscriptions=owned("subscriptions"), invoices=invoices)


@query("pipeline_exec_summary")
def _connected(s: Source):
    """Raw text to typed tables to staging rules to the executive mart, each stored mart read by the next."""
    out = scratch_path(s.spark, "marts")
    models.build(s.spark, typed_tables(s), CFG, AS_OF, out, ["+exec_revenue_summary"])
    return MartStore(s.spark, out).read("exec_revenue_summary")


@query("silver_fk_guard")
def _guard(s: Source):
    # accounts 0..24 only appear as owners of some events; the rest must go
    known = s.t.accounts.where(F.col("account_id") % 2 == 0)
    raw = adapter.raw_text(s.t.usage_events, "usage_events", {"event_type": "stale"})
    return silver.fk_guard(silver.silver(raw, "usage_events"), known)


@query("derived_durations")
def _durations(s: Source):
    t = silver.ticket_durations(s.t.tickets).select(
        F.lit("ticket").alias("entity"), F.col("ticket_id").alias("id"), rounded(F.col("resolution_hours"), 2).alias("amount")
    )
    l = silver.lead_durations(s.t.leads)
    spans = F.inline(
        F.array(
            F.struct(F.lit("lead_conversion").alias("entity"), F.col("days_to_convert").cast("double").alias("amount")),
            F.struct(F.lit("lead_trial").alias("entity"), F.col("trial_duration_days").cast("double").alias("amount")),
        )
    )
    return t.unionByName(l.select(F.col("lead_id").alias("id"), spans).select("entity", "id", "amount"))


# cohorts
query("cohort_base")(lambda s: cohorts.cohort_base(s.t, AS_OF))
query("cohort_period_summary")(
    lambda s: fixed(cohorts.cohort_period_summary(retention(s)), logo_retention_rate=6, revenue_retention_rate=6)
)
query("fct_customer_cohorts")(cohort_fact)
query("cohort_segments")(lambda s: cohorts.cohort_segments(retention(s)))
query("cohorts_from_movements")(lambda s: cohorts.cohorts_from_movements(movements(s), s.t.accounts))
query("pivot_cohort_heatmap")(lambda s: cohorts.pivot_cohort_heatmap(cohort_fact(s)))

# usage, support, payments, health
query("usage_monthly")(
    lambda s: fixed(usage_rows(s), avg_session_duration_seconds=4, avg_events_per_active_day=4)
)
query("usage_flags")(
    lambda s: fixed(
        usage.usage_flags(usage_rows(s), CFG), avg_session_duration_seconds=4, avg_events_per_active_day=4,
        events_mom_pct_change=6,
    )
)
RATES = dict(avg_csat_score=4, avg_resolution_hours=4, avg_first_response_hours=4, escalation_rate=6, resolution_rate=6)
query("ticket_monthly")(lambda s: fixed(ticket_rows(s), **RATES))
query("ticket_burden")(lambda s: fixed(support.ticket_burden(ticket_rows(s), CFG), **RATES))
query("invoice_monthly")(lambda s: invoice_monthly(s.t.invoices))
SIGNALS = dict(seat_utilization_rate=6, events_mom_pct_change=6, avg_csat_score=4, escalation_rate=6)
query("health_signals")(lambda s: fixed(health.health_signals(s.t, CFG, AS_OF), **SIGNALS))
query("health_components")(
    lambda s: health.health_components(health.health_signals(s.t, CFG, AS_OF)).select(
        "account_id", "month_start", "usage_score", "seat_util_score", "feature_score", "support_score",
        rounded(F.col("csat_score"), 4).alias("csat_score"), "payment_score", "tenure_score",
    )
)
query("fct_account_monthly_health")(lambda s: fixed(scores(s), csat_score=4, **SIGNALS))
query("health_score_linear")(lambda s: health.health_score_linear(health.health_signals(s.t, CFG, AS_OF), CFG))

# funnel
query("funnel_progression")(lambda s: funnel.funnel_progression(s.t))
query("fct_sales_conversion")(conversions)
query("conversion_monthly")(lambda s: funnel.conversion_monthly(funnel.conversion_rows(s.t)))
query("conversion_simple")(lambda s: funnel.conversion_simple(s.t.leads))

# success
query("health_trend")(lambda s: success.health_trend(scores(s)))
query("account_lifetime")(lambda s: success.account_lifetime(s.t.subscriptions))
query("cohort_context")(lambda s: success.cohort_context(s.t, AS_OF))
query("mart_customer_success_summary")(summary)
query("latest_snapshot_simple")(lambda s: success.latest_snapshot_simple(scores(s)))
query("cs_monthly_rollup")(lambda s: success.cs_monthly_rollup(scores(s)))
