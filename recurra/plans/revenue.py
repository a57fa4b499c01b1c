"""Registered queries: month grids, movements, executive summary."""

from pyspark.sql import functions as F

from recurra.functions.expr import rounded
from recurra.operators import mrr, spine
from recurra.plans.registry import AS_OF, CFG, Source, query


def movements(s: Source):
    return mrr.fct_mrr_movements(s.t, CFG, AS_OF)


def executive(s: Source):
    return mrr.exec_revenue_summary(s.t, CFG, AS_OF)


def tidy(df):
    return df.withColumn("seat_utilization_rate", rounded(F.col("seat_utilization_rate"), 6))


query("month_spine")(lambda s: spine.month_spine(s.t.accounts, "created_at", AS_OF))
query("account_months")(lambda s: spine.account_months(s.t.accounts, AS_OF))
query("subscription_months")(lambda s: spine.subscription_months(s.t.subscriptions, AS_OF))
query("mrr_movement_type")(lambda s: tidy(mrr.mrr_movement_type(s.t.subscriptions, AS_OF)).drop("following_month", "seats_purchased", "seats_used"))
query("mrr_components")(
    lambda s: mrr.mrr_components(s.t.subscriptions, AS_OF).select(
        "account_id", "month_start", "mrr_movement_type", "mrr", *mrr.COMPONENTS, "net_mrr_contribution", "arr"
    )
)
query("mrr_churn_rows")(
    lambda s: mrr.mrr_churn_rows(s.t.subscriptions, AS_OF).drop("plan_name", "seat_utilization_rate")
)
query("fct_mrr_movements")(lambda s: tidy(movements(s)))
query("exec_monthly")(
    lambda s: mrr.exec_monthly(movements(s)).withColumn("arpa", rounded(F.col("arpa"), 2))
)
query("exec_revenue_summary")(executive)
query("revenue_by_plan_region_industry")(lambda s: mrr.revenue_by_plan_region_industry(movements(s)))
query("agg_segment_rollup")(lambda s: mrr.revenue_by_segment(movements(s)))
query("top_expanding_per_month")(lambda s: mrr.top_expanding_per_month(movements(s)))
query("top_churn_loss_per_month")(lambda s: mrr.top_churn_loss_per_month(movements(s)))
query("mrr_movements_simple")(lambda s: mrr.mrr_movements_simple(s.t.subscriptions, AS_OF))
query("mrr_rollforward")(lambda s: mrr.mrr_rollforward(s.t.subscriptions, CFG, AS_OF))
query("exec_from_movements")(
    lambda s: mrr.exec_from_movements(mrr.mrr_rollforward(s.t.subscriptions, CFG, AS_OF))
)
query("exec_retained_base")(lambda s: mrr.exec_retained_base(movements(s)))
query("normalize_mrr")(lambda s: mrr.normalize_mrr(s.t.subscriptions, s.t.plans))
query("billing_schedule")(lambda s: mrr.billing_schedule(s.t.subscriptions, AS_OF))
