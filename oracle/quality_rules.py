"""Row rules of the marts as one statement."""

REQ = {
    "fct_mrr_movements": ("moves", ["account_month_key", "account_id", "month_start", "mrr", "mrr_movement_type"],
                          [("mrr_movement_type", "mtype NOT IN ('new', 'expansion', 'contraction', 'churned', 'reactivation', 'retained')")],
                          [(c, f"{c} NOT BETWEEN 0 AND 1e12") for c in ("mrr", "new_mrr", "expansion_mrr", "contraction_mrr")], "(account_id, month_start)"),
    "fct_account_monthly_health": ("hlth", ["account_month_key", "account_id", "month_start", "health_score", "health_tier", "churn_risk_level"],
                                   [("health_tier", "tier NOT IN ('healthy', 'at_risk', 'high_risk', 'critical')"), ("churn_risk_level", "lvl NOT IN ('critical', 'high', 'medium', 'low', 'minimal')")],
                                   [("health_score", "hs NOT BETWEEN 0 AND 100"), ("churn_risk_score", "crs NOT BETWEEN 0 AND 100"), ("risk_flag_count", "nf NOT BETWEEN 0 AND 6")], "(account_id, month_start)"),
    "fct_customer_cohorts": ("cohorts", ["cohort_period_key", "cohort_month", "months_since_created", "cohort_size"],
                             [("cohort_health", "cohort_health NOT IN ('excellent', 'good', 'fair', 'poor')")],
                             [("logo_retention_rate", "logo_retention_rate NOT BETWEEN 0 AND 1"), ("grr", "grr NOT BETWEEN 0 AND 1"), ("months_since_created", "months_since_created NOT BETWEEN 0 AND 1200")], "cohort_period_key"),
    "fct_sales_conversion": ("conv", ["conversion_key", "lead_id", "funnel_stage"],
                             [("funnel_stage", "stage NOT IN ('lead', 'qualified', 'demo_requested', 'demo_completed', 'trial', 'paid', 'lost')")], [("funnel_stage_order", "stage IS NULL")], "lead_id"),
    "mart_exec_revenue_summary": ("exec", ["exec_summary_key", "month_start", "total_mrr", "active_accounts"], [],
                                  [("logo_churn_rate", "logo_churn_rate NOT BETWEEN 0 AND 1"), ("grr", "grr NOT BETWEEN 0 AND 1")], "month_start"),
    "mart_customer_success_summary": ("css", ["customer_success_key", "account_id", "health_score", "risk_priority_score"],
                                      [("health_trend", "health_trend NOT IN ('improving', 'declining', 'stable')")], [("health_score", "health_score NOT BETWEEN 0 AND 100")], "account_id"),
}
LOCAL = {"account_month_key": "account_id", "mrr_movement_type": "mtype", "health_score": "hs", "health_tier": "tier", "churn_risk_level": "lvl",
         "conversion_key": "lead_id", "funnel_stage": "stage"}
parts = []
for mart, (rel, required, accepted, ranges, key) in REQ.items():
    name = lambda c: c if rel in ("css", "cohorts", "exec") else LOCAL.get(c, c)
    rules = [(f"not_null:{c}", f"{name(c)} IS NULL") for c in required]
    rules += [(f"accepted:{c}", w) for c, w in accepted] + [(f"range:{c}", w) for c, w in ranges]
    counted = [(n, f"count(*) FILTER ({w})") for n, w in rules] + [(f"unique:{required[0]}", f"count(*) - count(DISTINCT {key})")]
    parts += [f"SELECT '{mart}' AS table_name, '{n}' AS check_name, {e} AS failing, CASE WHEN {e} = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {rel}" for n, e in counted]
MART_CHECKS = " UNION ALL ".join(parts)
