"""Recurring-revenue movements and the executive summary built on them.

Subscriptions are summed to (account, month) with map-side partial aggregation
before any window runs, so a window partition never holds more rows than an
account has months, however many subscriptions the account owns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.config import MetricConfig, PLAN_TIERS, Tables
from recurra.functions.expr import (
    MONEY,
    count_if,
    day,
    divide_or,
    from_cents,
    in_cents,
    mapped,
    month_key,
    month_start,
    next_month,
    rounded,
    safe_divide,
    scaled,
    surrogate_key,
    unscaled,
)
from recurra.operators.ranking import rank_within
from recurra.operators.spine import join_months, newest_months, paid_spans, running_months, running_spans, tasks_for, with_months

COMPONENTS = ["new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr", "reactivation_mrr", "retained_mrr"]
ATTRIBUTES = ["company_name", "industry", "company_size", "region", "acquisition_channel"]


def plan_tier_order(plan: Column) -> Column:
    return mapped(plan, PLAN_TIERS, 99)


def _measures() -> dict[str, Column]:
    """Whole numbers that add up over subscriptions."""
    utilisation = scaled(safe_divide("seats_used", "seats_purchased"))
    return {
        "mrr_cents": in_cents("mrr"), "util_sum": utilisation, "util_n": F.when(utilisation.isNotNull(), 1),
        "seats_purchased": F.col("seats_purchased"), "seats_used": F.col("seats_used"),
    }


def account_month_mrr(subscriptions: DataFrame, as_of: dt.date, since: Column | None = None, tasks: int | None = None) -> DataFrame:
    """Active MRR, plan and seats per account and month.

    The ends of all subscriptions are swept by account and plan: the first aggregation has
    fixed-width buffers and runs as a hash aggregation with map-side combine, and months are
    generated from its sums. Sums run on 64-bit integers. What is left (account x month x plan)
    is hashed on the account alone, which also serves the windows per account.
    """
    per_plan = running_months(paid_spans(subscriptions, as_of, since), ["account_id", "plan_name"], "account_id", _measures(), tasks)
    return _of_accounts(per_plan)


def _of_accounts(per_plan: DataFrame) -> DataFrame:
    """Sums of account and month from those of account, plan and month."""
    return (
        per_plan.groupBy("account_id", "month_start")
        .agg(
            from_cents(F.sum("mrr_cents")).alias("mrr"),
            F.max("plan_name").alias("plan_name"),
            safe_divide(unscaled(F.sum("util_sum")), F.sum("util_n")).alias("seat_utilization_rate"),
            F.sum("seats_purchased").alias("seats_purchased"),
            F.sum("seats_used").alias("seats_used"),
        )
    )


def newest_paid_months(subscriptions: DataFrame, as_of: dt.date, months: int) -> DataFrame:
    """The newest ``months`` paying months of every account, see :func:`mrr_movement_type`; the kind of movement is that among these.

    The spans over which sums hold are cut per account before months are generated, one calendar month earlier for ``prev_mrr``.
    """
    paid = paid_spans(subscriptions, as_of)
    tasks = tasks_for(paid)
    cut = newest_months(paid.withColumn("_cents", in_cents("mrr")), "account_id", "_cents", months, tasks)
    spans = running_spans(paid, ["account_id", "plan_name"], "account_id", _measures(), tasks).join(cut, "account_id")
    first = F.greatest("_since", F.add_months("_oldest", -1))
    per_plan = with_months(spans, first, F.add_months("_until", -1)).drop("_since", "_until", "_oldest")
    classified = classify(_of_accounts(per_plan).where(F.col("mrr") > 0))
    newest = Window.partitionBy("account_id").orderBy(F.desc("month_start"))
    return classified.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") <= months).drop("_nth")


def first_paid(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """(account_id, first_paid): the first paying month of each account, from the spans over which its MRR holds."""
    spans = running_spans(paid_spans(subscriptions, as_of), ["account_id"], "account_id", {"cents": in_cents("mrr")})
    return spans.where("cents > 0").groupBy("account_id").agg(F.min("_since").alias("first_paid"))


def _timeline() -> Window:
    return Window.partitionBy("account_id").orderBy("month_start")


def mrr_movement_type(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Movement of each paying account-month against the calendar month before it."""
    return classify(account_month_mrr(subscriptions, as_of).where(F.col("mrr") > 0))


def classify(paying: DataFrame, known_payer: Column | None = None) -> DataFrame:
    """Label paying account-months.

    Works on paying months only: a gap between neighbouring rows stands for the
    zero months of a dense grid, so the grid itself is never materialised.
    ``known_payer`` marks accounts that paid before the first row given here.
    """
    w = _timeline()
    adjacent = F.lag("month_start").over(w) == F.add_months("month_start", -1)
    lagged = (
        paying.withColumn("account_month_rank", F.row_number().over(w))
        .withColumn("prev_mrr", F.when(adjacent, F.lag("mrr").over(w)).otherwise(F.lit(0).cast(MONEY)))
        .withColumn("prev_plan_name", F.when(adjacent, F.lag("plan_name").over(w)))
        .withColumn("following_month", F.lead("month_start").over(w))
    )
    first = F.col("account_month_rank") == 1
    if known_payer is not None:
        first = first & ~known_payer
    kind = (
        F.when(first, "new")
        .when(F.col("prev_mrr") == 0, "reactivation")
        .when(F.col("mrr") > F.col("prev_mrr"), "expansion")
        .when(F.col("mrr") < F.col("prev_mrr"), "contraction")
        .otherwise("retained")
    )
    return lagged.select(
        "account_id",
        "month_start",
        "mrr",
        "prev_mrr",
        (F.col("mrr") - F.col("prev_mrr")).cast(MONEY).alias("mrr_delta"),
        kind.alias("mrr_movement_type"),
        "plan_name",
        "prev_plan_name",
        "account_month_rank",
        "seat_utilization_rate",
        "seats_purchased",
        "seats_used",
        "following_month",
    )


def _component(kind: str, value: Column) -> Column:
    zero = F.lit(0).cast(MONEY)
    return F.when(F.col("mrr_movement_type") == kind, value).otherwise(zero).cast(MONEY)


def with_components(movements: DataFrame) -> DataFrame:
    """Split each movement row into the six bridge components."""
    delta = F.col("mrr_delta")
    out = movements.withColumns(
        {
            "new_mrr": _component("new", F.col("mrr")),
            "expansion_mrr": _component("expansion", delta),
            "contraction_mrr": _component("contraction", -delta),
            "churned_mrr": _component("churned", F.col("prev_mrr")),
            "reactivation_mrr": _component("reactivation", F.col("mrr")),
            "retained_mrr": _component("retained", F.col("mrr")),
        }
    )
    gains = F.col("new_mrr") + F.col("expansion_mrr") + F.col("reactivation_mrr")
    losses = F.col("contraction_mrr") + F.col("churned_mrr")
    return out.withColumn("net_mrr_contribution", (gains - losses).cast(MONEY)).withColumn(
        "arr", (F.col("mrr") * 12).cast(MONEY)
    )


def mrr_components(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    return with_components(mrr_movement_type(subscriptions, as_of)).drop("following_month", "seats_purchased", "seats_used")


def _left_after(row_month: Column, following: Column, as_of: dt.date) -> Column:
    gone = following.isNull() | (following > next_month(row_month))
    return gone & (next_month(row_month) <= month_start(day(as_of)))


def _churn_struct() -> Column:
    money0 = F.lit(0).cast(MONEY)
    return F.struct(
        next_month("month_start").alias("month_start"),
        money0.alias("mrr"),
        F.col("mrr").alias("prev_mrr"),
        (-F.col("mrr")).cast(MONEY).alias("mrr_delta"),
        F.lit("churned").alias("mrr_movement_type"),
        F.lit(None).cast("string").alias("plan_name"),
        F.col("plan_name").alias("prev_plan_name"),
        F.lit(None).cast("double").alias("seat_utilization_rate"),
    )


def mrr_churn_rows(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """One row in the month after an account's paying months stop."""
    left = _left_after(F.col("month_start"), F.col("following_month"), as_of)
    return (
        mrr_movement_type(subscriptions, as_of).where(left).select("account_id", _churn_struct().alias("c"))
        .select("account_id", "c.*")
    )


def movement_rows(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    return with_churn_rows(mrr_movement_type(subscriptions, as_of), as_of)


def with_churn_rows(classified: DataFrame, as_of: dt.date) -> DataFrame:
    """Paying and churn rows with their components."""
    return with_components(paying_and_churn_rows(classified, as_of))


def paying_and_churn_rows(classified: DataFrame, as_of: dt.date) -> DataFrame:
    """Paying and churn rows emitted together from one pass over the window output."""
    kept = F.struct(
        "month_start", "mrr", "prev_mrr", "mrr_delta", "mrr_movement_type", "plan_name", "prev_plan_name",
        "seat_utilization_rate",
    )
    left = _left_after(F.col("month_start"), F.col("following_month"), as_of)
    rows = F.when(left, F.array(kept, _churn_struct())).otherwise(F.array(kept))
    return classified.select("account_id", F.inline(rows))


def invoice_monthly(invoices: DataFrame) -> DataFrame:
    paid, failed = F.col("status") == "paid", F.col("status") == "failed"
    return invoices.groupBy("account_id", month_start("invoice_date").alias("month_start")).agg(
        count_if(failed).alias("failed_payments"),
        count_if(paid).alias("successful_payments"),
        F.coalesce(F.sum(F.when(paid, F.col("amount"))), F.lit(0)).cast(MONEY).alias("total_invoiced_paid"),
    )


def fct_mrr_movements(t: Tables, cfg: MetricConfig, as_of: dt.date) -> DataFrame:
    """Account-month movements with account attributes and payment counts."""
    return movement_facts(movement_rows(t.subscriptions, as_of), t.accounts, invoice_monthly(t.invoices))


def movement_facts(rows: DataFrame, accounts: DataFrame, paid: DataFrame) -> DataFrame:
    return fact_columns(joined_facts(rows, accounts, paid))


def joined_facts(rows: DataFrame, accounts: DataFrame, paid: DataFrame) -> DataFrame:
    """Movement rows, without what follows from a row alone, with their account and payments; see :func:`fact_columns`."""
    # payments come first: rows are dealt by account without the attributes, which then meet them there
    rows = join_months(rows.drop(*COMPONENTS, "net_mrr_contribution", "arr"), paid)
    return rows.join(accounts.select("account_id", *ATTRIBUTES), "account_id", "left")


def fact_columns(joined: DataFrame) -> DataFrame:
    """All columns of the movement facts, from those that were joined."""
    zero = F.lit(0)
    return with_components(joined).select(
        surrogate_key("account_id", month_key("month_start")).alias("account_month_key"),
        "account_id",
        *ATTRIBUTES,
        "plan_name",
        "prev_plan_name",
        F.when(F.col("plan_name").isNotNull(), plan_tier_order(F.col("plan_name"))).alias("plan_tier_order"),
        "month_start",
        month_key("month_start").alias("month_key"),
        "mrr",
        "prev_mrr",
        "mrr_delta",
        "mrr_movement_type",
        "seat_utilization_rate",
        *COMPONENTS,
        (F.col("mrr_movement_type") == "churned").alias("is_churned"),
        F.coalesce("failed_payments", zero).alias("failed_payments"),
        F.coalesce("successful_payments", zero).alias("successful_payments"),
        F.coalesce("total_invoiced_paid", zero).cast(MONEY).alias("total_invoiced_paid"),
        (F.coalesce("failed_payments", zero) > 0).alias("has_payment_failure"),
        "net_mrr_contribution",
        "arr",
    )


def exec_monthly(movements: DataFrame) -> DataFrame:
    """Monthly totals. (account, month) is unique here, so plain counts are distinct counts."""
    sums = {c: F.sum(c).cast(MONEY) for c in COMPONENTS}
    out = movements.groupBy("month_start", "month_key").agg(
        F.sum("mrr").cast(MONEY).alias("total_mrr"),
        (F.sum("mrr") * 12).cast(MONEY).alias("total_arr"),
        count_if(F.col("mrr") > 0).alias("active_accounts"),
        *[e.alias(c) for c, e in sums.items()],
        F.sum("net_mrr_contribution").cast(MONEY).alias("net_new_mrr"),
        count_if(F.col("is_churned")).alias("churned_accounts"),
        F.sum("failed_payments").alias("total_failed_payments"),
    )
    return out.withColumn("arpa", safe_divide("total_mrr", "active_accounts"))


def exec_rates(monthly: DataFrame) -> DataFrame:
    """Month-over-month and retention rates; the input has one row per month."""
    w = Window.orderBy("month_start")
    m = monthly.withColumns(
        {
            "prior_mrr": F.lag("total_mrr").over(w),
            "prior_accounts": F.lag("active_accounts").over(w),
        }
    )
    base = F.coalesce("prior_mrr", "total_mrr")
    lost = F.col("contraction_mrr") + F.col("churned_mrr")
    regained = F.col("expansion_mrr") + F.col("reactivation_mrr")
    delta = F.col("total_mrr") - F.coalesce("prior_mrr", F.lit(0))
    return m.select(
        surrogate_key("month_key").alias("exec_summary_key"),
        "month_start",
        "month_key",
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month_num"),
        F.date_format("month_start", "MMM yyyy").alias("month_label"),
        "total_mrr",
        "total_arr",
        "active_accounts",
        rounded(F.col("arpa"), 2).alias("arpa"),
        *COMPONENTS,
        "net_new_mrr",
        "churned_accounts",
        rounded(safe_divide(F.col("churned_accounts"), F.coalesce("prior_accounts", "active_accounts")), 4).alias(
            "logo_churn_rate"
        ),
        rounded(safe_divide(lost, base), 4).alias("revenue_churn_rate"),
        rounded(safe_divide(base + regained - lost, base), 4).alias("nrr"),
        rounded(F.least(F.lit(1.0), safe_divide(base - lost, base)), 4).alias("grr"),
        delta.cast(MONEY).alias("mrr_mom_delta"),
        rounded(safe_divide(delta, F.coalesce("prior_mrr", F.lit(1))), 4).alias("mrr_mom_pct"),
        "total_failed_payments",
        F.coalesce("prior_mrr", F.lit(0)).cast(MONEY).alias("prev_total_mrr"),
        F.coalesce("prior_accounts", F.lit(0)).alias("prev_active_accounts"),
    )


def exec_revenue_summary(t: Tables, cfg: MetricConfig, as_of: dt.date) -> DataFrame:
    return exec_rates(exec_monthly(fct_mrr_movements(t, cfg, as_of)))


def revenue_by_plan_region_industry(movements: DataFrame) -> DataFrame:
    """One pass over the movements for all three breakdowns."""
    dims = {"plan": "plan_name", "region": "region", "industry": "industry"}
    pairs = F.array(*[F.struct(F.lit(k).alias("segment_type"), F.col(c).alias("segment_value")) for k, c in dims.items()])
    return (
        movements.select("month_key", "mrr", F.inline(pairs))
        .where(F.col("segment_value").isNotNull())
        .groupBy("month_key", "segment_type", "segment_value")
        .agg(F.sum("mrr").cast(MONEY).alias("mrr"), count_if(F.col("mrr") > 0).alias("accounts"))
    )


SEGMENTS = {
    "plan": "plan_name", "region": "region", "industry": "industry", "company_size": "company_size",
    "channel": "acquisition_channel",
}


def revenue_by_segment(movements: DataFrame) -> DataFrame:
    """Long table month x segment type x value with the share of the month's MRR."""
    paying = movements.where(F.col("mrr") > 0)
    sets = [["month_start", c] for c in SEGMENTS.values()] + [["month_start"]]
    cols = list(SEGMENTS.values())
    grouped = paying.groupingSets(sets, "month_start", *cols).agg(
        F.sum("mrr").cast(MONEY).alias("total_mrr"),
        F.count(F.lit(1)).alias("account_count"),
        F.grouping_id().alias("gid"),
    )
    kind, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (name, c) in enumerate(SEGMENTS.items()):
        marker = (1 << len(cols)) - 1 - (1 << (len(cols) - 1 - i))
        kind = F.when(F.col("gid") == marker, name).otherwise(kind)
        value = F.when(F.col("gid") == marker, F.col(c)).otherwise(value)
    labelled = grouped.withColumn("segment_type", kind).withColumn("segment_value", value)
    everything = F.max(F.when(F.col("segment_type").isNull(), F.col("total_mrr"))).over(Window.partitionBy("month_start"))
    return (
        labelled.withColumn("month_total", everything)
        .where(F.col("segment_type").isNotNull())
        .select(
            "month_start", "segment_type", "segment_value", "total_mrr", "account_count",
            rounded(safe_divide("total_mrr", "account_count"), 2).alias("avg_mrr"),
            rounded(safe_divide("total_mrr", "month_total"), 4).alias("pct_of_total"),
        )
    )


def expanding_rows(movements: DataFrame) -> DataFrame:
    return movements.where(F.col("mrr_movement_type") == "expansion").select(
        "month_key", "account_id", *[a for a in ATTRIBUTES if a != "acquisition_channel"], "plan_name", "mrr",
        "expansion_mrr", "mrr_delta",
    )


def top_expanding_per_month(movements: DataFrame, k: int | None = None) -> DataFrame:
    return rank_within(expanding_rows(movements), "month_key", "expansion_mrr", "account_id", "expansion_rank", k)


def churn_loss_rows(movements: DataFrame) -> DataFrame:
    return movements.where(F.col("mrr_movement_type").isin("churned", "contraction")).select(
        "month_key", "account_id", *[a for a in ATTRIBUTES if a != "acquisition_channel"], "plan_name", "mrr",
        "churned_mrr", "contraction_mrr", "mrr_movement_type",
        (F.col("churned_mrr") + F.col("contraction_mrr")).alias("mrr_loss"),
    )


def top_churn_loss_per_month(movements: DataFrame, k: int | None = None) -> DataFrame:
    return rank_within(churn_loss_rows(movements), "month_key", "mrr_loss", "account_id", "churn_risk_rank", k)


# --- variants -----------------------------------------------------------------


def mrr_movements_simple(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Load-time variant: no churn or reactivation, previous row instead of previous month."""
    last = F.least(F.coalesce("end_date", day(as_of)), day(as_of))
    paid = subscriptions.where(~F.col("status").isin("trial", "pending"))
    per_month = (
        with_months(paid, F.col("start_date"), last)
        .groupBy("account_id", "month_start")
        .agg(F.sum(F.coalesce("mrr", F.lit(0))).cast(MONEY).alias("ending_mrr"), F.max("plan_name").alias("plan_name"))
    )
    prev = F.lag("ending_mrr").over(_timeline())
    rows = per_month.withColumn("p", prev)
    up = F.col("p").isNotNull() & (F.col("ending_mrr") > F.col("p"))
    down = F.col("p").isNotNull() & (F.col("ending_mrr") < F.col("p")) & (F.col("ending_mrr") > 0)
    first = F.col("p").isNull()
    zero = F.lit(0).cast(MONEY)
    diff = (F.col("ending_mrr") - F.coalesce("p", zero)).cast(MONEY)
    return rows.select(
        "account_id",
        "month_start",
        "plan_name",
        F.coalesce("p", zero).alias("starting_mrr"),
        "ending_mrr",
        F.when(first, F.col("ending_mrr")).otherwise(zero).alias("new_mrr"),
        F.when(up, diff).otherwise(zero).alias("expansion_mrr"),
        F.when(down, -diff).otherwise(zero).cast(MONEY).alias("contraction_mrr"),
        zero.alias("churned_mrr"),
        zero.alias("reactivation_mrr"),
        diff.alias("net_new_mrr"),
        F.when(first, "new").when(up, "expansion").when(down, "contraction").otherwise("retained").alias("movement_type"),
    )


def mrr_rollforward(subscriptions: DataFrame, cfg: MetricConfig, as_of: dt.date) -> DataFrame:
    """Point-in-time variant: active on the first of the month, with a dead band around zero."""
    # first month start on or after start_date; last one strictly before end_date
    first = F.when(F.col("start_date") == month_start("start_date"), F.col("start_date")).otherwise(
        next_month(month_start("start_date"))
    )
    last = F.least(
        F.coalesce(F.date_sub("end_date", 1), day(as_of)), F.date_sub(month_start(day(as_of)), 1)
    )
    per_month = (
        with_months(subscriptions.where(F.col("start_date").isNotNull()), first, last)
        .groupBy("account_id", "month_start")
        .agg(F.sum("mrr").cast(MONEY).alias("ending_mrr"), F.max("plan_name").alias("plan_name"))
        .where(F.col("ending_mrr") > 0)
    )
    w = _timeline()
    adjacent = F.lag("month_start").over(w) == F.add_months("month_start", -1)
    zero = F.lit(0).cast(MONEY)
    rows = per_month.withColumns(
        {
            "starting_mrr": F.when(adjacent, F.lag("ending_mrr").over(w)).otherwise(zero),
            "seen_before": F.row_number().over(w) > 1,
            "following": F.lead("month_start").over(w),
        }
    )
    diff = F.col("ending_mrr") - F.col("starting_mrr")
    kind = (
        F.when((F.col("starting_mrr") == 0) & F.col("seen_before"), "reactivation")
        .when(F.col("starting_mrr") == 0, "new")
        .when(diff > cfg.dead_band, "expansion")
        .when(diff < -cfg.dead_band, "contraction")
        .otherwise("retained")
    )
    kept = F.struct("month_start", "plan_name", "starting_mrr", "ending_mrr", kind.alias("movement_type"))
    gone = F.struct(
        next_month("month_start").alias("month_start"), "plan_name", F.col("ending_mrr").alias("starting_mrr"),
        zero.alias("ending_mrr"), F.lit("churn").alias("movement_type"),
    )
    before_now = next_month("month_start") < month_start(day(as_of))
    leaves = (F.col("following").isNull() | (F.col("following") > next_month("month_start"))) & before_now
    out = rows.select("account_id", F.inline(F.when(leaves, F.array(kept, gone)).otherwise(F.array(kept))))
    delta = F.col("ending_mrr") - F.col("starting_mrr")

    def part(name, value):
        return F.when(F.col("movement_type") == name, value).otherwise(zero).cast(MONEY)

    out = out.withColumns(
        {
            "new_mrr": part("new", F.col("ending_mrr")),
            "expansion_mrr": part("expansion", delta),
            "contraction_mrr": part("contraction", -delta),
            "churned_mrr": part("churn", F.col("starting_mrr")),
            "reactivation_mrr": part("reactivation", F.col("ending_mrr")),
        }
    )
    net = F.col("new_mrr") + F.col("expansion_mrr") + F.col("reactivation_mrr") - F.col("contraction_mrr") - F.col(
        "churned_mrr"
    )
    return out.withColumn("net_new_mrr", net.cast(MONEY))


def exec_from_movements(rollforward: DataFrame) -> DataFrame:
    """Executive totals whose retention base is the month's summed starting MRR."""
    is_ = lambda *k: F.col("movement_type").isin(*k)
    g = rollforward.groupBy("month_start").agg(
        F.sum("ending_mrr").cast(MONEY).alias("total_mrr"),
        *[F.sum(c).cast(MONEY).alias(c) for c in COMPONENTS if c != "retained_mrr"],
        F.sum("net_new_mrr").cast(MONEY).alias("net_new_mrr"),
        F.sum("starting_mrr").cast(MONEY).alias("starting_mrr"),
        count_if(~is_("churn")).alias("active_accounts"),
        count_if(is_("new")).alias("new_accounts"),
        count_if(is_("churn")).alias("churned_accounts"),
        count_if(is_("retained", "expansion", "contraction")).alias("starting_accounts"),
    )
    s, lost = F.col("starting_mrr"), F.col("contraction_mrr") + F.col("churned_mrr")
    kept = s - lost
    return g.select(
        "month_start", "total_mrr", (F.col("total_mrr") * 12).cast(MONEY).alias("total_arr"),
        *[c for c in COMPONENTS if c != "retained_mrr"], "net_new_mrr",
        rounded(divide_or(kept + F.col("expansion_mrr") + F.col("reactivation_mrr"), s, 1.0), 4).alias("nrr"),
        rounded(divide_or(kept, s, 1.0), 4).alias("grr"),
        rounded(divide_or(F.col("churned_accounts"), F.col("starting_accounts")), 4).alias("logo_churn_rate"),
        rounded(divide_or(lost, s), 4).alias("revenue_churn_rate"),
        "active_accounts", "new_accounts", "churned_accounts",
        rounded(divide_or(F.col("total_mrr"), F.col("active_accounts")), 2).alias("arpa"),
    )


def exec_retained_base(movements: DataFrame) -> DataFrame:
    """Executive totals whose base is the current MRR of accounts carried over."""
    carried = F.col("mrr_movement_type").isin("retained", "expansion", "contraction")
    zero = F.lit(0)
    g = movements.groupBy("month_key").agg(
        F.sum("mrr").cast(MONEY).alias("total_mrr"),
        *[F.sum(c).cast(MONEY).alias(c) for c in COMPONENTS if c != "retained_mrr"],
        F.sum("net_mrr_contribution").cast(MONEY).alias("net_new_mrr"),
        count_if(~F.col("is_churned")).alias("active_accounts"),
        count_if(F.col("is_churned")).alias("churned_accounts"),
        count_if(carried).alias("starting_accounts"),
        F.coalesce(F.sum(F.when(carried, F.col("mrr"))), zero).cast(MONEY).alias("starting_mrr"),
    )
    s, lost = F.col("starting_mrr"), F.col("contraction_mrr") + F.col("churned_mrr")
    prev = F.lag("total_mrr").over(Window.orderBy("month_key"))
    return g.select(
        "month_key", "total_mrr", (F.col("total_mrr") * 12).cast(MONEY).alias("total_arr"), "active_accounts",
        rounded(divide_or(F.col("total_mrr"), F.col("active_accounts")), 2).alias("arpa"),
        *[c for c in COMPONENTS if c != "retained_mrr"], "net_new_mrr",
        rounded(divide_or(s - lost + F.col("expansion_mrr") + F.col("reactivation_mrr"), s, 1.0), 4).alias("nrr"),
        rounded(divide_or(s - lost, s, 1.0), 4).alias("grr"),
        rounded(divide_or(F.col("churned_accounts"), F.col("starting_accounts")), 4).alias("logo_churn_rate"),
        rounded(divide_or(lost, s), 4).alias("revenue_churn_rate"),
        rounded(divide_or(F.col("total_mrr") - prev, prev), 4).alias("mrr_mom_pct"),
        "churned_accounts", "starting_accounts", "starting_mrr",
    )


def normalized_mrr(monthly: Column, annual: Column, cycle: Column, seats: Column, per_seat: Column) -> Column:
    base = F.when(cycle == "annual", annual / 12).otherwise(monthly)
    return F.round(base + F.coalesce(seats * per_seat, F.lit(0)), 2).cast(MONEY)


def normalize_mrr(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """List-price MRR of each subscription; seat-priced plans add seats x price."""
    seat_price = F.col("price_per_seat") if "price_per_seat" in plans.columns else F.lit(0).cast("decimal(10,2)")
    priced = plans.withColumn("seat_price", seat_price).select("plan_id", "monthly_price", "annual_price", "seat_price")
    value = normalized_mrr(
        F.col("monthly_price"), F.col("annual_price"), F.col("billing_cycle"), F.col("seats_purchased"), F.col("seat_price")
    )
    return (
        subscriptions.join(priced, "plan_id", "left")
        .select("subscription_id", "billing_cycle", "seats_purchased", value.alias("list_mrr"))
        .withColumn("list_arr", (F.col("list_mrr") * 12).cast(MONEY))
    )


def billing_schedule(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Expected invoices: a monthly or yearly step from the start month to the end."""
    annual = F.col("billing_cycle") == "annual"
    first, last = month_start("start_date"), F.least(F.coalesce("end_date", day(as_of)), day(as_of))
    steps = F.when(
        first <= last,
        F.when(annual, F.sequence(first, last, F.expr("interval 12 months"))).otherwise(
            F.sequence(first, last, F.expr("interval 1 month"))
        ),
    )
    span = F.when(annual, 12).otherwise(1)
    rows = subscriptions.select(
        "subscription_id", "account_id", "plan_name", "billing_cycle", "mrr", F.explode(steps).alias("invoice_date")
    )
    return rows.select(
        "subscription_id",
        "account_id",
        "plan_name",
        "billing_cycle",
        "invoice_date",
        F.date_add("invoice_date", F.when(annual, 30).otherwise(15)).alias("due_date"),
        F.col("invoice_date").alias("period_start"),
        F.date_sub(F.add_months("invoice_date", span), 1).alias("period_end"),
        (F.col("mrr") * span).cast(MONEY).alias("amount"),
        F.col("mrr").cast(MONEY).alias("mrr_equivalent"),
    )
