"""Registered queries: relational shapes, scalar functions, quality checks, glossary measures."""

import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from recurra.functions import scalars as sc
from recurra.functions.expr import age_months, clamp, divide_or, month_key, percent, rounded, safe_divide, surrogate_key
from recurra.operators import extras, mrr, quality as dq, relational as rel, silver, spine, staging, usage
from recurra.plans.customers import cohort_fact, conversions, scores, summary, usage_rows
from recurra.plans.registry import AS_OF, CFG, QUERIES, Source, query
from recurra.plans.revenue import executive, movements
from recurra.plans.snapshots import StoredHistory
from recurra.session import scratch_path
from recurra.sources import adapter


def account_mrr(s: Source):
    return mrr.account_month_mrr(s.t.subscriptions, AS_OF)


def months(s: Source):
    return spine.month_spine(s.t.accounts, "created_at", AS_OF)


# joins
query("join_inner")(lambda s: rel.join_inner(s.t))
query("join_left_multi")(lambda s: rel.join_left_multi(s.t, AS_OF))
query("join_month_spine")(lambda s: rel.join_month_spine(s.t.subscriptions, AS_OF))
query("join_theta_spine")(lambda s: rel.join_theta_spine(s.t.subscriptions, months(s), AS_OF))
query("join_truncated_key")(lambda s: rel.join_truncated_key(s.t.usage_events, months(s)))
query("join_shifted_self")(lambda s: rel.join_shifted_self(account_mrr(s)))
query("join_anti_correlated")(lambda s: rel.join_anti_correlated(account_mrr(s)))
query("join_anti_fk")(
    lambda s: silver.orphans(s.t.invoices, s.t.subscriptions, "subscription_id").select("invoice_id", "subscription_id", "amount")
)
query("join_semi")(lambda s: rel.join_semi(s.t))
query("join_null_coalesced")(lambda s: rel.join_null_coalesced(s.t.leads, s.t.subscriptions))
query("join_left_on_filter")(lambda s: rel.join_left_on_filter(s.t))
query("join_scalar_subquery")(lambda s: rel.join_scalar_subquery(account_mrr(s)))


@query("join_left_first_match")
def _first_match(s):
    from recurra.operators.funnel import first_paid_subscription

    return s.t.leads.select("lead_id", "account_id").join(first_paid_subscription(s.t.subscriptions), "account_id", "left")


query("join_update_from")(lambda s: sc.refresh_exec_summary(executive(s)).drop("total_arr", "arr_mom_change"))
query("join_denormalize_back")(lambda s: rel.join_denormalize_back(s.t.subscriptions))

# aggregations
query("agg_sum_count_avg")(lambda s: rel.agg_sum_count_avg(s.t.subscriptions))
query("agg_conditional_count")(lambda s: rel.agg_conditional_count(s.t.tickets))
query("agg_conditional_sum")(lambda s: rel.agg_conditional_sum(s.t.invoices))
query("agg_filter_clause")(lambda s: rel.agg_filter_clause(s.t.invoices))
query("agg_count_distinct")(lambda s: rel.agg_count_distinct(s.t.usage_events))
query("agg_count_distinct_if")(lambda s: rel.agg_count_distinct_if(s.t.invoices))
query("agg_sum_distinct")(lambda s: rel.agg_sum_distinct(s.t.subscriptions))
query("agg_mode")(lambda s: rel.agg_mode(s.t.accounts))
query("agg_median")(lambda s: rel.agg_median(s.t.invoices))
query("agg_ratio")(lambda s: rel.agg_ratio(s.t.invoices))
query("agg_having_dups")(lambda s: rel.agg_having_dups(s.raw("lineitem"), ["l_orderkey", "l_linenumber"]))
query("agg_global")(lambda s: rel.agg_global(s.t.subscriptions))
query("agg_pct_of_total")(lambda s: rel.agg_pct_of_total(s.t.subscriptions))
query("agg_avg_of_groups")(lambda s: rel.agg_avg_of_groups(s.t.subscriptions, s.t.accounts))
query("agg_explode_count")(lambda s: rel.agg_explode_count(scores(s)))
query("agg_pivot_case")(lambda s: rel.agg_pivot_case(s.t.tickets))
query("agg_multi_dim")(lambda s: rel.agg_multi_dim(s.t))
query("agg_argmax")(lambda s: rel.agg_argmax(s.t))

# windows, ordering, sets
query("win_lag_partition")(lambda s: rel.win_lag_partition(account_mrr(s)))
query("win_lag_global")(lambda s: rel.win_lag_global(executive(s)))
query("win_row_number")(lambda s: rel.win_row_number(account_mrr(s)))
query("win_latest_n")(lambda s: rel.win_latest_n(account_mrr(s), 3))
query("win_distinct_on_first")(lambda s: rel.win_distinct_on_first(s.t.subscriptions))
query("win_distinct_on_latest")(lambda s: rel.win_distinct_on_latest(s.t.subscriptions))
query("win_top_per_month")(lambda s: rel.win_top_per_month(movements(s), 10))
query("win_lag_before_limit")(lambda s: rel.win_lag_before_limit(executive(s)))
query("win_running_total")(lambda s: rel.win_running_total(s.t.invoices))


@query("win_prior_activity")
def _prior(s):
    grid = spine.account_months(s.t.accounts, AS_OF).select("account_id", "month_start")
    filled = grid.join(account_mrr(s).select("account_id", "month_start", "mrr"), ["account_id", "month_start"], "left")
    return rel.win_prior_activity(filled.withColumn("mrr", F.coalesce("mrr", F.lit(0))))


query("sort_nulls_last")(
    lambda s: rel.sort_nulls_last(
        usage.usage_flags(usage_rows(s), CFG).withColumn("events_mom_pct_change", rounded(F.col("events_mom_pct_change"), 6))
    )
)
query("topk_limit")(lambda s: rel.topk_limit(s.t.subscriptions))
query("page_offset")(lambda s: rel.page_offset(s.t.subscriptions, 3, 50))
query("last_n_months_asc")(lambda s: rel.last_n_months_asc(executive(s)))
query("sort_abs")(lambda s: rel.sort_abs(movements(s)))
query("sort_multi")(lambda s: rel.sort_multi(scores(s)))
query("union_all_typed_nulls")(
    lambda s: rel.union_all_typed_nulls(
        mrr.mrr_movement_type(s.t.subscriptions, AS_OF), mrr.mrr_churn_rows(s.t.subscriptions, AS_OF)
    )
)
query("distinct_months")(lambda s: rel.distinct_months(s.t.subscriptions))
query("distinct_sorted_values")(lambda s: rel.distinct_sorted_values(s.t.accounts))


@query("tenant_filter")
def _tenant(s):
    owner = s.t.accounts.withColumn("tenant_id", F.col("industry"))
    subs = s.t.subscriptions.join(owner.select("account_id", "tenant_id"), "account_id")
    return rel.tenant_filter(dataclasses.replace(s.t, accounts=owner, subscriptions=subs), "automobile")


# scalar functions
@query("scalar_string")
def _strings(s):
    n = F.col("c_name")
    return s.raw("customer").select(
        "c_custkey", F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("trimmed"), F.lower(n).alias("lowered"),
        F.upper("c_mktsegment").alias("uppered"), F.split_part(n, F.lit("#"), F.lit(2)).alias("part"),
        F.concat(n, F.lit(" / "), "c_mktsegment").alias("joined"), F.btrim(F.concat(F.lit("|"), n, F.lit("||")), F.lit("|")).alias("unpiped"),
        n.like("%#00%").alias("is_like"), F.replace(n, F.lit("#"), F.lit("_")).alias("replaced"), F.substring(n, 1, 4).alias("head"),
        n.endswith("7").alias("ends"),
    )


def _order_day(s):
    return s.raw("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))


query("scalar_date_parts")(
    lambda s: _order_day(s).select(
        "o_orderkey", F.year("d").alias("y"), F.month("d").alias("m"), F.day("d").alias("dom"), (F.dayofweek("d") - 1).alias("dow"),
        F.dayofyear("d").alias("doy"), F.weekofyear("d").alias("week"), F.quarter("d").alias("q"),
    )
)
query("scalar_date_trunc")(
    lambda s: _order_day(s).select(
        "o_orderkey", F.trunc("d", "MM").alias("month_start"), F.trunc("d", "QUARTER").alias("quarter_start"),
        F.date_trunc("week", "d").cast("date").alias("week_start"), F.date_trunc("day", "d").cast("date").alias("day_start"),
    )
)
query("scalar_date_format")(
    lambda s: _order_day(s).select(
        "o_orderkey", month_key("d").alias("month_key"), F.date_format("d", "MMM yyyy").alias("short_label"),
        F.date_format("d", "MMMM yyyy").alias("long_label"), F.date_format("d", "EEEE").alias("day_long"),
        F.date_format("d", "EEE").alias("day_short"),
        F.concat(F.year("d").cast("string"), F.lit("-Q"), F.quarter("d").cast("string")).alias("quarter_key"),
    )
)
query("scalar_date_arith")(
    lambda s: s.t.subscriptions.select(
        "subscription_id", F.last_day("start_date").alias("month_end"), F.add_months("start_date", 3).alias("plus_3"),
        F.datediff("end_date", "start_date").alias("days"), age_months(F.col("start_date"), F.col("end_date")).alias("months"),
        F.timestamp_diff("HOUR", F.col("start_date").cast("timestamp_ntz"), F.col("end_date").cast("timestamp_ntz")).alias("hours"),
    )
)
query("scalar_math")(
    lambda s: s.raw("customer").select(
        "c_custkey", F.abs("c_acctbal").alias("absolute"), rounded(F.col("c_acctbal") / 7, 2).alias("rounded"),
        F.least(F.lit(5000.0), F.col("c_acctbal")).alias("capped"), F.greatest(F.lit(0.0), F.col("c_acctbal")).alias("floored"),
        clamp(F.col("c_acctbal") / 100, 0.0, 50.0).alias("clamped"), (F.col("c_acctbal") > 0).cast("int").alias("flag"),
        rounded((F.col("c_custkey") % 5) / 4 * 100, 2).alias("normalised"),
    )
)
query("scalar_null")(
    lambda s: s.t.invoices.select(
        "invoice_id", F.coalesce("paid_date", "due_date").alias("settled"), F.nullif(F.col("status"), F.lit("failed")).alias("not_failed"),
        rounded(safe_divide(F.col("amount"), F.datediff("paid_date", "invoice_date")), 4).alias("per_day"),
        rounded(divide_or(F.col("amount"), F.datediff("paid_date", "invoice_date")), 4).alias("per_day_or_zero"),
        F.coalesce("failed_date", F.lit(dt.date(1970, 1, 1))).alias("failed_or_epoch"),
    )
)
query("scalar_case")(
    lambda s: s.t.subscriptions.select(
        "subscription_id", staging.mapped(F.col("plan_name"), {"starter": 1, "growth": 2, "business": 3, "enterprise": 4}, 99).alias("tier"),
        staging.banded(F.col("seats_purchased"), [(40, "xl"), (20, "l"), (5, "m")], "s").alias("seat_band"),
        F.when(F.col("end_date").isNull(), "open").when(F.col("end_date") < F.lit(AS_OF), "ended").otherwise("running").alias("phase"),
    )
)


@query("scalar_cast")
def _casts(s):
    raw = adapter.raw_text(s.t.tickets, "tickets", {"csat_score": "n/a", "created_at": "soon", "ticket_id": ""})
    return raw.select(
        silver.cast_text("ticket_id", "bigint"), silver.cast_text("csat_score", "decimal(3,1)"),
        silver.cast_text("is_escalated", "boolean"), F.nullif(F.col("created_at"), F.lit("")).try_cast("timestamp_ntz").cast("date").alias("created_day"),
    )


query("scalar_surrogate_key")(
    lambda s: s.t.invoices.select("invoice_id", surrogate_key("invoice_id", "account_id", "paid_date").alias("key_3"))
)


@query("scalar_array_reasons")
def _reasons(s):
    t = s.t.tickets
    reasons = F.array_compact(
        F.array(
            F.when(F.col("priority").isin("high", "critical"), "urgent"), F.when(F.col("is_escalated"), "escalated"),
            F.when(F.col("csat_score") < 3, "unhappy"), F.when(F.col("resolved_at").isNull(), "unresolved"),
        )
    )
    r = t.select("ticket_id", reasons.alias("reasons"))
    return r.select(
        "ticket_id", F.size("reasons").alias("n"), F.array_contains("reasons", "urgent").alias("is_urgent"),
        F.concat_ws("|", "reasons").alias("shown"),
    )


query("scalar_json")(
    lambda s: s.raw("events").select(
        "event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.from_json("props", "k int, tags array<string>").alias("p"),
    ).select("event_id", "k", F.col("p.k").alias("k_typed"), F.coalesce(F.get(F.col("p.tags"), 0), F.lit("none")).alias("first_tag"))
)
query("scalar_epoch")(
    lambda s: s.raw("events").select(
        "event_id", F.unix_seconds(F.date_trunc("second", "ts").cast("timestamp")).cast("string").alias("e"),
    ).select("event_id", sc.epoch_seconds(F.col("e")).alias("at"), sc.epoch_seconds(F.concat(F.lit("x"), "e")).alias("bad"))
)
query("scalar_safe_parse")(
    lambda s: s.raw("events").select(
        "event_id", sc.safe_float(F.get_json_object("props", "$.k")).alias("as_float"), sc.safe_int(F.get_json_object("props", "$.k")).alias("as_int"),
        sc.safe_float(F.col("event_type")).alias("float_default"), sc.safe_int(F.col("event_type"), 7).alias("int_default"),
    )
)


@query("scalar_format")
def _formats(s):
    v, ratio = F.col("o_totalprice"), F.col("o_totalprice") / 400000
    return s.raw("orders").select(
        "o_orderkey", sc.short_money(v).alias("small"), sc.short_money(v * 12).alias("large"),
        sc.signed_money(v - 200000).alias("delta"), sc.percent_text(ratio).alias("pct"),
        F.concat(F.lit("M"), (F.col("o_orderkey") % 13).cast("string")).alias("period"),
        sc.retention_colour(ratio).alias("retention"), sc.nrr_colour(ratio).alias("nrr"),
    )


query("scalar_pct")(
    lambda s: s.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", percent(F.col("l_discount")).alias("discount_pct"))
)

# callables
query("fn_mrr_for_month")(lambda s: sc.mrr_for_month(movements(s), dt.date(2001, 6, 15)))
query("fn_compute_nrr")(lambda s: sc.nrr_for_month(movements(s), dt.date(2001, 6, 15)))


@query("fn_health_score_label")
def _label(s):
    sc.register_sql_functions(s.spark)
    return s.spark.sql(
        "SELECT score_label(health_score) AS label, count(*) AS n, round(avg(safe_ratio(risk_flag_count, 6)), 6) AS share FROM {h} GROUP BY 1",
        h=scores(s),
    )


query("fn_refresh_exec_summary")(lambda s: sc.refresh_exec_summary(executive(s)))
query("udtf_month_spine")(lambda s: sc.udtf_month_spine(s.t.accounts, AS_OF))
query("udaf_mode")(lambda s: sc.mode_by_udaf(s.t.accounts, "country", "industry"))

# quality
query("dq_not_null")(
    lambda s: dq.not_null(s.t.invoices, "invoices", ["invoice_id", "account_id", "amount", "status", "paid_date", "failed_date"])
)
query("dq_unique")(lambda s: dq.duplicates(s.raw("lineitem"), ["l_orderkey", "l_linenumber"]))
query("dq_accepted_values")(lambda s: dq.unaccepted(s.t.subscriptions, "status", ["active", "cancelled"]))
query("dq_relationships")(lambda s: dq.orphan_keys(s.t.invoices, s.t.subscriptions, "subscription_id"))
query("dq_expression")(
    lambda s: dq.broken(s.t.subscriptions, F.col("seats_used") * 2 <= F.col("seats_purchased")).select(
        "subscription_id", "seats_used", "seats_purchased"
    )
)
query("dq_between_mostly")(
    lambda s: dq.between_mostly(s.t.invoices, "invoices", "amount", 1000, 90000, 0.95).unionByName(
        dq.between_mostly(s.t.tickets, "tickets", "csat_score", 1, 5)
    )
)
query("dq_positive_values")(lambda s: dq.positive_values(s.t.subscriptions, "seats_used"))
# Layers, tables, keys and accepted numbers of keyed rows.
ROW_RANGES = [
    ("raw", "raw_plans", "plan_id", 4, 20), ("raw", "raw_features", "feature_id", 10, 100), ("raw", "raw_calendar", "full_date", 700, 1000),
    ("raw", "raw_accounts", "account_id", 200, 500), ("raw", "raw_subscriptions", "subscription_id", 200, 600), ("raw", "raw_invoices", "invoice_id", 1000, 10000),
    ("raw", "raw_usage_events", "event_id", 5000, 100000), ("raw", "raw_tickets", "ticket_id", 500, 5000), ("raw", "raw_leads", "lead_id", 500, 3000),
    ("staging", "stg_plans", "plan_id", 4, 20), ("staging", "stg_features", "feature_id", 10, 100), ("staging", "stg_calendar", "calendar_date", 700, 1000),
    ("staging", "stg_accounts", "account_id", 200, 500), ("staging", "stg_subscriptions", "subscription_id", 200, 600), ("staging", "stg_invoices", "invoice_id", 1000, 10000),
    ("staging", "stg_usage_events", "event_id", 5000, 100000), ("staging", "stg_support_tickets", "ticket_id", 500, 5000), ("staging", "stg_leads", "lead_id", 500, 3000),
    ("marts", "fct_mrr_movements", "month_start", 500, 10000), ("marts", "exec_revenue_summary", "month_start", 12, 36), ("marts", "fct_sales_conversion", "lead_id", 500, 3000),
]


def checked_tables(s) -> dict[str, dq.TableChecks]:
    """All layers with their row-count rules and the conditions that no row may meet."""
    raw = adapter.raw_layer(s.spark, s.sf_dir)
    stg = {n: lambda n=n: QUERIES[n](s.spark, s.sf_dir) for _, n, *_ in ROW_RANGES if n.startswith("stg_")}
    marts = {"fct_mrr_movements": lambda: movements(s), "exec_revenue_summary": lambda: executive(s), "fct_sales_conversion": lambda: conversions(s)}
    frames = {f"raw_{n}": lambda n=n: raw[n] for n in raw} | stg | marts
    c = F.col
    broken = {
        "raw_subscriptions": {"seats unreadable": c("seats_purchased").try_cast("int").isNull()},
        "stg_subscriptions": {"mrr negative": c("mrr") < 0, "account missing": c("account_id").isNull()},
        "stg_invoices": {"amount not positive": c("amount") <= 0},
        "stg_support_tickets": {"csat out of range": ~c("csat_score").between(1, 5)},
        "fct_mrr_movements": {"mrr negative": c("mrr") < 0, "payment failed": c("has_payment_failure")},
        "exec_revenue_summary": {"nrr out of range": ~c("nrr").between(0.5, 2.0)},
    }
    return {n: dq.TableChecks(frames[n](), key, low, high, layer, broken.get(n, {})) for layer, n, key, low, high in ROW_RANGES}


@query("dq_row_count_range")
def _row_counts(s):
    rows = dq.table_results(checked_tables(s)).where("check_name = 'row_count'")
    return rows.select("layer", "table_name", F.col("measured").alias("row_count"), F.col("low").alias("min_expected"), F.col("high").alias("max_expected"), "status")


query("dq_table_checks")(lambda s: dq.table_results(checked_tables(s)))


def checks(s):
    return dq.named_checks(s.t, movements(s), executive(s), AS_OF)


query("dq_sql_checks")(checks)


@query("dq_report")
def _report(s):
    shared = ["table_name", "check_name", "status"]
    return dq.report(checks(s).select(*shared).unionByName(dq.table_results(checked_tables(s)).select(*shared)))


query("dq_freshness")(
    lambda s: dq.freshness(
        adapter.raw_text(s.t.invoices, "invoices", {"status": "draft"}), "invoices", adapter.LOADED_AT + dt.timedelta(hours=30)
    )
)
query("dq_enum_constraints")(
    lambda s: dq.enum_constraints({"subscriptions": s.t.subscriptions, "invoices": s.t.invoices, "tickets": s.t.tickets})
)


@query("dq_mart_rules")
def _mart_rules(s):
    marts = {
        "fct_mrr_movements": movements(s), "fct_account_monthly_health": scores(s), "fct_customer_cohorts": cohort_fact(s),
        "fct_sales_conversion": conversions(s), "mart_exec_revenue_summary": executive(s), "mart_customer_success_summary": summary(s),
    }
    return dq.union_all([dq.mart_rules(n, df) for n, df in marts.items()])


# glossary measures
query("arpu")(lambda s: extras.arpu(scores(s)))
query("time_to_value")(lambda s: extras.time_to_value(s.t.usage_events, s.t.leads, s.t.features))
query("flag_feature_stagnation")(lambda s: extras.feature_stagnation(s.t.usage_events, CFG, AS_OF))
query("flag_downgrade_signal")(lambda s: extras.downgrade_signal(movements(s)))
query("account_profile")(lambda s: extras.account_profile(s.t, AS_OF))
query("filter_values")(lambda s: extras.filter_values(s.t))


@query("request_log_rollup")
def _log(s):
    h = F.md5(F.col("user_id").cast("string"))
    uid = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    log = s.raw("events").select(
        F.concat(F.lit("/api/"), "event_type", F.lit("/"), F.when(F.col("event_id") % 3 == 0, "list").otherwise(uid), F.lit("/")).alias("path"),
        F.when(F.col("event_id") % 20 == 0, 500).otherwise(200).alias("status"), F.round(F.col("value").cast("decimal(18,6)"), 2).alias("latency_ms"),
    )
    return extras.request_log_rollup(log)


@query("scd2_snapshot")
def _scd2(s):
    """Three extracts that overlap by a year, merged one after the other into a stored history."""
    versions = s.t.subscriptions.select("account_id", F.col("start_date").alias("updated_at"), "plan_name", "mrr")
    history = StoredHistory(s.spark, scratch_path(s.spark, "history"), "account_id", "updated_at")
    since = None
    for until in (dt.date(1994, 6, 30), dt.date(1996, 6, 30), None):
        at = F.col("updated_at")
        extract = versions.where(at > F.add_months(F.lit(since), -12)) if since else versions
        history.apply(extract.where(at <= F.lit(until)) if until else extract)
        since = until
    return history.ranges()


query("flag_inactive_churn")(lambda s: extras.inactive_churn(s.t.accounts, s.t.usage_events, CFG, AS_OF))
