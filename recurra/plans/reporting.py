"""Registered queries: views, parameterised reports and chart shapes."""

from pyspark.sql import functions as F

from recurra.operators import reports as r
from recurra.plans.customers import cohort_fact, conversions, scores
from recurra.plans.registry import AS_OF, query
from recurra.plans.revenue import executive, movements

LEAD_MONTHS = 72


def kept_movements(s):
    return s.marts.newest("fct_mrr_movements")


def kept_health(s):
    return s.marts.newest("fct_account_monthly_health")


def kept_summary(s):
    return s.marts.mart("customer_success_summary")


query("v_current_mrr_summary")(lambda s: r.current_mrr_summary(executive(s)))
query("v_active_accounts_health")(lambda s: r.active_accounts_health(kept_health(s), s.t.accounts))
query("v_mrr_waterfall")(lambda s: r.mrr_waterfall(movements(s)))
query("v_revenue_by_plan")(lambda s: r.latest_revenue_by(kept_movements(s), "plan_name"))
query("v_revenue_by_region")(lambda s: r.latest_revenue_by(kept_movements(s), "region"))
query("v_top_expanding_accounts")(lambda s: r.top_expanding_accounts(kept_movements(s), kept_health(s)))
query("v_churn_risk_accounts")(lambda s: r.churn_risk_accounts(kept_health(s)))
query("v_funnel_summary")(lambda s: r.funnel_summary(conversions(s)))
query("v_current_mrr")(lambda s: r.current_mrr(s.t.subscriptions, s.t.accounts))
query("v_latest_health")(lambda s: r.latest_health(scores(s)))

query("report_exec_kpi")(lambda s: r.exec_kpi(executive(s)))
query("report_mrr_trend")(lambda s: r.mrr_trend(executive(s), 24))
query("report_waterfall")(lambda s: r.waterfall(executive(s)))


@query("report_revenue_by_dimension")
def _dims(s):
    m = kept_movements(s)
    out = None
    for d in ("plan_name", "region", "industry", "company_size"):
        part = r.revenue_by_dimension(m, d)
        out = part if out is None else out.unionByName(part)
    return out


@query("report_top_accounts")
def _top(s):
    cs = kept_summary(s)
    newest = cs.select(F.max("snapshot_date")).first()[0]  # its movements alone are read
    m = s.marts.month("fct_mrr_movements", newest or AS_OF)
    parts = [r.top_accounts(cs, m, kind, 10).withColumn("sort_by", F.lit(kind)) for kind in ("churn_risk", "expansion")]
    return parts[0].unionByName(parts[1])


query("report_mrr_bridge")(lambda s: r.mrr_bridge(executive(s), 12))
query("report_account_movements")(lambda s: r.account_movements(kept_movements(s), page=2, page_size=25))
query("report_new_mrr_by_channel")(lambda s: r.new_mrr_by_channel(movements(s), "1995-03"))
query("report_expansion_by_segment")(lambda s: r.expansion_by_segment(kept_movements(s), "company_size"))
query("report_churned_by_plan")(lambda s: r.churned_by_plan(kept_movements(s)))
query("report_payment_trend")(lambda s: r.payment_trend(s.t.invoices, 12))
query("report_cohort_heatmap")(lambda s: r.cohort_heatmap(cohort_fact(s), "nrr"))
query("report_logo_churn_trend")(lambda s: r.logo_churn_trend(executive(s), 24))
query("report_nrr_by_cohort")(lambda s: r.nrr_by_cohort(cohort_fact(s), 12))
query("report_retention_by_segment")(lambda s: r.retention_by_segment(scores(s), "plan_name", 12, AS_OF))
query("report_health_distribution")(lambda s: r.health_distribution(kept_summary(s)))
query("report_risky_accounts")(lambda s: r.risky_accounts(kept_summary(s), level="high", plan="business"))
query("report_risk_quadrant")(lambda s: r.risk_quadrant(kept_summary(s)))
query("report_support_burden")(lambda s: r.support_burden(kept_summary(s), s.t.tickets))
query("report_funnel_overview")(lambda s: r.funnel_overview(conversions(s), LEAD_MONTHS, AS_OF))
query("report_conversion_by_channel")(lambda s: r.conversion_by_channel(conversions(s), LEAD_MONTHS, AS_OF))
query("report_sales_cycle")(lambda s: r.sales_cycle(conversions(s), LEAD_MONTHS, AS_OF))
query("report_trial_usage")(lambda s: r.trial_usage(conversions(s), LEAD_MONTHS, AS_OF))
query("report_expansion_by_size_channel_plan")(lambda s: r.expansion_by_size_channel_plan(movements(s), 12, AS_OF))
query("report_health_summary")(lambda s: r.health_summary(kept_summary(s)))
query("report_risk_flag_breakdown")(lambda s: r.risk_flag_breakdown(kept_summary(s)))
query("report_account_health_trend")(lambda s: r.account_health_trend(scores(s), 12))
query("report_usage_drop_alerts")(lambda s: r.usage_drop_alerts(s.marts.newest("fct_account_monthly_health", 2), 0.3))

query("agg_channel_over_months")(lambda s: r.channel_over_months(movements(s)))
query("report_chart_reaggregates")(
    lambda s: r.chart_reaggregates(
        r.expansion_by_size_channel_plan(movements(s), 12, AS_OF), r.sales_cycle(conversions(s), LEAD_MONTHS, AS_OF)
    )
)
query("cohort_period_average")(lambda s: r.cohort_period_average(cohort_fact(s)))
query("funnel_width_pct")(lambda s: r.funnel_width_pct(r.funnel_overview(conversions(s), LEAD_MONTHS, AS_OF)))
query("risky_accounts_by_mrr")(lambda s: r.risky_accounts_by_mrr(kept_summary(s)))
