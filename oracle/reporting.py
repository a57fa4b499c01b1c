"""Statements for views, reports and chart shapes."""

from oracle.base import ASOF, block, check, div, div0, key, r
from oracle.revenue import FIVE

pct = lambda e: r(f"coalesce({e}, 0) * 100", 2)
share = lambda a, b: r(f"{div0(a, b)} * 100", 2)
LAST = "month_start = (SELECT max(month_start) FROM {t})"
MOV = "(SELECT * FROM moves WHERE month_start = (SELECT max(month_start) FROM moves))"
HL = "(SELECT * FROM hlth WHERE month_start = (SELECT max(month_start) FROM hlth))"
SNAP = "(SELECT * FROM css WHERE snapshot_month = (SELECT max(snapshot_month) FROM css))"

check("v_current_mrr_summary", f"""SELECT month_start, total_mrr, total_arr, active_accounts, lag(total_mrr) OVER w AS prev_mrr,
  lag(active_accounts) OVER w AS prev_accounts, {r("CASE WHEN lag(total_mrr) OVER w > 0 THEN (total_mrr - lag(total_mrr) OVER w) / lag(total_mrr) OVER w ELSE 0 END", 6)} AS mrr_growth_rate
  FROM exec WINDOW w AS (ORDER BY month_start)""")
check("v_active_accounts_health", f"""SELECT h.account_id, h.month_start, h.company_name, h.plan_name, h.mrr::double AS mrr, hs AS health_score,
  tier AS health_tier, lvl AS churn_risk_level, a.industry, a.region, a.acquisition_channel, a.company_size FROM {HL} h JOIN accounts_raw a USING (account_id)""")
check("v_mrr_waterfall", """SELECT month_start, sum(new_mrr)::double AS new_mrr, sum(expansion_mrr)::double AS expansion_mrr,
  sum(contraction_mrr)::double AS contraction_mrr, sum(churned_mrr)::double AS churned_mrr, sum(reactivation_mrr)::double AS reactivation_mrr,
  sum(delta)::double AS net_new_mrr, sum(mrr)::double AS total_mrr FROM moves GROUP BY month_start""")
for name, col in (("plan", "plan_name"), ("region", "region")):
    check(f"v_revenue_by_{name}", f"""SELECT {col}, sum(mrr)::double AS total_mrr, count(DISTINCT account_id) AS account_count,
  {r(div('sum(mrr)', 'count(*)'), 2)} AS avg_mrr FROM {MOV} WHERE mtype <> 'churned' GROUP BY {col}""")
check("v_top_expanding_accounts", f"""SELECT m.account_id, m.company_name, m.plan_name, m.region, m.industry, m.expansion_mrr::double AS expansion_mrr,
  m.mrr::double AS ending_mrr, h.hs AS health_score FROM {MOV} m LEFT JOIN hlth h ON h.account_id = m.account_id AND h.month_start = m.month_start
  WHERE mtype = 'expansion' ORDER BY m.expansion_mrr DESC, m.account_id LIMIT 10""")
check("v_churn_risk_accounts", f"""SELECT account_id, company_name, plan_name, mrr::double AS mrr, hs AS health_score,
  CASE WHEN hs >= 50 THEN 'at_risk' ELSE 'critical' END AS risk_level, f_drop AS risk_usage_drop, f_idle AS risk_no_login, f_high AS risk_high_tickets,
  f_pay AS risk_payment_failure, f_csat AS risk_low_csat, f_seat AS risk_low_seat_util, region, industry, acquisition_channel,
  cast(nf AS integer) AS risk_flag_count FROM {HL} WHERE hs < 75""")
check("v_funnel_summary", f"""SELECT count(*) AS total_leads, count(trial_started_day) AS trial_starts, count(*) FILTER (won) AS paid_conversions,
  {r(div('count(trial_started_day)', 'count(*)') + '*100', 2)} AS lead_to_trial_rate, {r(div('count(*) FILTER (won)', 'count(trial_started_day)') + '*100', 2)} AS trial_to_paid_rate,
  {r(div('count(*) FILTER (won)', 'count(*)') + '*100', 2)} AS overall_conversion_rate, {r(div('sum(d_paid) FILTER (won)', 'count(d_paid) FILTER (won)'), 1)} AS avg_days_to_convert FROM conv""")
check("v_current_mrr", """SELECT account_id, subscription_id, company_name, industry, region, company_size, acquisition_channel, plan_name, mrr::double AS mrr,
  seats_purchased, seats_used, s.status, start_date FROM subs s JOIN accounts_raw USING (account_id) WHERE s.status = 'active'""")
check("v_latest_health", """SELECT account_id, company_name, plan_name, mrr::double AS mrr, hs AS health_score, tier AS health_tier, lvl AS churn_risk_level,
  crs AS churn_risk_score, cast(nf AS integer) AS risk_flag_count, reasons AS risk_reasons, month_key FROM ranked WHERE rk = 1""")

check("report_exec_kpi", f"""SELECT month_key, total_mrr, total_arr, active_accounts, arpa, net_new_mrr, churned_accounts, {pct('nrr')} AS nrr, {pct('grr')} AS grr,
  {pct('logo_churn_rate')} AS logo_churn_rate, {pct('revenue_churn_rate')} AS revenue_churn_rate, {pct('mrr_mom_pct')} AS mrr_mom_pct, a AS prev_month_mrr,
  {pct('b')} AS prev_month_nrr, {pct('c')} AS prev_month_logo_churn
  FROM (SELECT *, lag(total_mrr) OVER w AS a, lag(nrr) OVER w AS b, lag(logo_churn_rate) OVER w AS c FROM exec WINDOW w AS (ORDER BY month_key))
  ORDER BY month_key DESC LIMIT 1""")
NO_RET = "new_mrr, expansion_mrr, contraction_mrr, churned_mrr, reactivation_mrr"
check("report_mrr_trend", f"""SELECT month_key, total_mrr, total_arr, {NO_RET}, net_new_mrr, active_accounts, {pct('nrr')} AS nrr, {pct('grr')} AS grr,
  {pct('logo_churn_rate')} AS logo_churn_rate, {pct('mrr_mom_pct')} AS mrr_mom_pct FROM exec ORDER BY month_key DESC LIMIT 24""")
check("report_waterfall", """SELECT month_key, cast(step AS integer) AS step, label, type, value, cumulative FROM (SELECT * FROM exec ORDER BY month_key DESC LIMIT 1) e,
  LATERAL (SELECT round(total_mrr - net_new_mrr, 2) AS st) x, LATERAL (VALUES (0, 'Starting MRR', 'start', st, st), (1, 'New', 'positive', new_mrr, round(st + new_mrr, 2)),
   (2, 'Expansion', 'positive', expansion_mrr, round(st + new_mrr + expansion_mrr, 2)),
   (3, 'Reactivation', 'positive', reactivation_mrr, round(st + new_mrr + expansion_mrr + reactivation_mrr, 2)),
   (4, 'Contraction', 'negative', contraction_mrr, round(st + new_mrr + expansion_mrr + reactivation_mrr - contraction_mrr, 2)),
   (5, 'Churn', 'negative', churned_mrr, total_mrr), (6, 'Ending MRR', 'end', total_mrr, total_mrr)) v(step, label, type, value, cumulative)""")
check("report_revenue_by_dimension", " UNION ALL ".join(f"""SELECT '{d}' AS dimension, {d} AS value, sum(mrr)::double AS mrr, (sum(mrr) * 12)::double AS arr,
  count(DISTINCT account_id) AS account_count, {r(div('sum(mrr)', 'count(*)'), 2)} AS arpa, {share('sum(mrr)', 'sum(sum(mrr)) OVER ()')} AS pct_of_total
  FROM {MOV} WHERE mrr > 0 GROUP BY {d}""" for d in ("plan_name", "region", "industry", "company_size")))
CARD = "account_id, company_name, plan_name, region, industry, company_size, mrr, arr, health_score, health_tier, churn_risk_level, risk_reasons, health_trend"
check("report_top_accounts", f"""SELECT * FROM (SELECT {CARD}, risk_priority_score AS sort_value, 'churn_risk' AS sort_by FROM {SNAP} WHERE churn_risk_level IN ('high', 'critical')
  ORDER BY risk_priority_score DESC, account_id LIMIT 10) UNION ALL SELECT * FROM (SELECT {", ".join("c." + x.strip() for x in CARD.split(","))}, m.expansion_mrr::double AS sort_value, 'expansion' AS sort_by
  FROM {SNAP} c JOIN moves m ON m.account_id = c.account_id AND m.month_key = c.snapshot_month WHERE m.expansion_mrr > 0 ORDER BY m.expansion_mrr DESC, c.account_id LIMIT 10)""")
check("report_mrr_bridge", f"""SELECT month_key, coalesce(lag(total_mrr) OVER (ORDER BY month_key), 0) AS starting_mrr, {NO_RET}, net_new_mrr, total_mrr AS ending_mrr
  FROM exec ORDER BY month_key DESC LIMIT 12""")
check("report_account_movements", f"""SELECT account_id, company_name, plan_now AS plan_name, region, industry, company_size, month_key, mrr::double AS mrr, mtype AS mrr_movement_type, {FIVE},
  delta::double AS net_mrr_contribution, acquisition_channel, (SELECT count(*) FROM {MOV}) AS total_count FROM {MOV}
  ORDER BY abs(delta) DESC, account_id LIMIT 25 OFFSET 25""")


def component(dim, alias, value, source):
    return f"""SELECT {dim} AS {alias}, sum({value})::double AS {value}, count(DISTINCT account_id) AS accounts, {r(div0(f'sum({value})', 'count(*)'), 2)} AS avg_per_account,
  {share(f'sum({value})', f'sum(sum({value})) OVER ()')} AS pct_of_total FROM {source} WHERE {value} > 0 GROUP BY {dim}"""


check("report_new_mrr_by_channel", component("acquisition_channel", "channel", "new_mrr", "(SELECT * FROM moves WHERE month_key = '1995-03')"))
check("report_expansion_by_segment", component("company_size", "segment", "expansion_mrr", MOV))
check("report_churned_by_plan", component("prev_plan", "plan_name", "churned_mrr", MOV))
check("report_payment_trend", f"""SELECT strftime(invoice_date, '%Y-%m') AS month_key, count(*) AS total_invoices, count(*) FILTER (status = 'paid') AS paid_invoices,
  count(*) FILTER (status = 'failed') AS failed_invoices, count(*) FILTER (status = 'pending') AS pending_invoices,
  {share("count(*) FILTER (status = 'paid')", 'count(*)')} AS payment_success_rate, sum(amount)::double AS total_invoice_amount,
  coalesce(sum(amount) FILTER (status = 'paid'), 0)::double AS collected_amount, coalesce(sum(amount) FILTER (status = 'failed'), 0)::double AS failed_amount,
  {r("coalesce(" + div("sum(paid_date - invoice_date) FILTER (status = 'paid')", "count(*) FILTER (status = 'paid')") + ", 0)", 1)} AS avg_days_to_pay
  FROM inv GROUP BY 1 ORDER BY 1 DESC LIMIT 12""")
HEAT = "cohort_month, months_since_created, cohort_size, active_accounts, logo_retention_rate, revenue_retention_rate, nrr, grr, cohort_mrr, cohort_starting_mrr AS starting_mrr, cohort_health"
check("report_cohort_heatmap", f"SELECT {HEAT}, 'nrr' AS metric, nrr AS value FROM cohorts")
check("report_logo_churn_trend", f"""SELECT *, {r(div('sum(cast(logo_churn_rate AS decimal(38,12))) OVER ()', 'count(*) OVER ()'), 2)} AS avg_logo_churn_rate FROM (
  SELECT month_key, {pct('logo_churn_rate')} AS logo_churn_rate, churned_accounts, prev_active_accounts AS starting_accounts, active_accounts FROM exec ORDER BY month_key DESC LIMIT 24)""")
check("report_nrr_by_cohort", f"""SELECT *, {r(div('sum(cast(coalesce(nrr, 0) AS decimal(38,12))) OVER ()', 'count(*) OVER ()'), 2)} AS avg_nrr,
  {r(div('sum(cast(coalesce(grr, 0) AS decimal(38,12))) OVER ()', 'count(*) OVER ()'), 2)} AS avg_grr FROM (SELECT cohort_month, nrr, grr, logo_retention_rate, revenue_retention_rate,
  cohort_size, active_accounts, cohort_mrr, cohort_starting_mrr AS starting_mrr, cohort_health FROM cohorts WHERE months_since_created = 12 ORDER BY cohort_month DESC LIMIT 24)""")
check("report_retention_by_segment", f"""SELECT plan_name AS segment_value, {r(div('sum(cast(hs AS decimal(38,12)))', 'count(*)'), 4)} AS avg_health_score,
  count(DISTINCT account_id) AS account_count, {r(div('sum(mrr)', 'count(*)'), 2)} AS avg_mrr, sum(mrr)::double AS total_mrr,
  {r(div("count(*) FILTER (lvl = 'high')", 'count(*)') + '*100', 4)} AS pct_high_risk FROM hlth WHERE month_start >= DATE '2000-07-31' GROUP BY plan_name""")
check("report_health_distribution", f"""SELECT health_tier, count(*) AS account_count, sum(mrr::decimal(18,2))::double AS total_mrr,
  {r(div('sum(cast(health_score AS decimal(38,12)))', 'count(*)'), 1)} AS avg_health_score, {r(div('sum(mrr::decimal(18,2))', 'count(*)'), 2)} AS avg_mrr,
  {share('count(*)', 'sum(count(*)) OVER ()')} AS pct_of_accounts, {share('sum(mrr::decimal(18,2))', 'sum(sum(mrr::decimal(18,2))) OVER ()')} AS pct_of_mrr FROM {SNAP} GROUP BY health_tier""")
CARD2 = CARD + ", risk_priority_score"
check("report_risky_accounts", f"""SELECT {CARD2}, count(*) OVER () AS total_count FROM {SNAP} WHERE churn_risk_level = 'high' AND plan_name = 'business'
  ORDER BY risk_priority_score DESC, account_id LIMIT 25""")
check("report_risk_quadrant", f"SELECT {CARD2} FROM {SNAP} ORDER BY risk_priority_score DESC, account_id LIMIT 200")
check("report_support_burden", f"""SELECT s.account_id, s.company_name, s.plan_name, s.mrr, s.health_score, s.churn_risk_level, count(ticket_id) AS total_tickets,
  count(*) FILTER (priority = 'high') AS high_priority_tickets, count(*) FILTER (t.status = 'open') AS open_tickets,
  CASE WHEN bool_or(solved) THEN 6.0 ELSE 0.0 END::double AS avg_resolution_hours, {r('coalesce(avg(t.csat_score), 0)', 2)} AS avg_csat
  FROM {SNAP} s LEFT JOIN tix t ON t.account_id = s.account_id AND date_trunc('month', created_day) = s.snapshot_date
  GROUP BY ALL ORDER BY total_tickets DESC, s.account_id LIMIT 20""")
check("report_health_summary", f"""SELECT health_tier, count(*) AS account_count, {r(div('sum(cast(health_score AS decimal(38,12)))', 'count(*)'), 1)} AS avg_health_score,
  sum(mrr::decimal(18,2))::double AS total_mrr, {r(div('sum(cast(churn_risk_score AS decimal(38,12)))', 'count(*)'), 1)} AS avg_churn_risk_score FROM {SNAP} GROUP BY health_tier""")
FLAGS = [("usage_drop", "Usage drop >40%"), ("no_login", "No login 14d"), ("high_tickets", "2+ high tickets"), ("payment_failure", "Payment failed"),
         ("low_csat", "CSAT < 3"), ("low_seat_util", "Seat util < 25%")]
check("report_risk_flag_breakdown", " UNION ALL ".join(f"""SELECT '{f}' AS flag, '{d}' AS definition, count(*) AS account_count, coalesce(sum(mrr::decimal(18,2)), 0)::double AS at_risk_mrr
  FROM {SNAP} WHERE churn_risk_level IN ('high', 'critical') AND risk_{f}""" for f, d in FLAGS))
check("report_account_health_trend", """SELECT account_id, month_key, hs AS health_score, tier AS health_tier, lvl AS churn_risk_level, mrr::double AS mrr, reasons AS risk_reasons,
  CASE WHEN h1 IS NULL THEN 'stable' WHEN h0 > h1 THEN 'improving' ELSE 'declining' END AS trend FROM ranked JOIN trend USING (account_id) WHERE rk <= 12""")
check("report_usage_drop_alerts", f"""SELECT c.account_id, c.company_name, c.plan_name, c.mrr::double AS mrr, c.hs AS health_score, c.lvl AS churn_risk_level, c.active_users AS cur_mau,
  p.active_users AS prev_mau, {r(div('c.active_users - p.active_users', 'p.active_users') + '*100', 1)} AS usage_change_pct FROM {HL} c
  JOIN hlth p ON p.account_id = c.account_id AND p.month_start = c.month_start - INTERVAL 1 MONTH WHERE p.active_users > 0
  AND {div('c.active_users - p.active_users', 'p.active_users')} <= -0.3 ORDER BY {div('c.active_users - p.active_users', 'p.active_users')}, c.account_id LIMIT 50""")

block("recent", "SELECT * FROM conv WHERE date_trunc('month', created_day) >= DATE '1995-07-31'")
TRI = "count(*) FILTER (stage IN ('trial', 'paid'))"
WON = "count(*) FILTER (won)"
DAYS = r("coalesce(" + div("sum(d_paid) FILTER (won)", "count(d_paid) FILTER (won)") + ", 0)", 1)
AVGM = r("coalesce(" + div("sum(cmrr) FILTER (won)", WON) + ", 0)", 2)
TOTM = "coalesce(sum(cmrr) FILTER (won), 0)::double"
check("report_funnel_overview", f"""SELECT count(*) AS total_leads, {TRI} AS trial_starts, {WON} AS paid_conversions, {share(TRI, 'count(*)')} AS lead_to_trial_rate,
  {share(WON, TRI)} AS trial_to_paid_rate, {share(WON, 'count(*)')} AS overall_conversion_rate, {DAYS} AS avg_days_to_paid, {AVGM} AS avg_first_month_mrr, {TOTM} AS total_converted_mrr FROM recent""")
check("report_conversion_by_channel", f"""SELECT *, first_value(channel) OVER (ORDER BY overall_conversion_rate DESC, channel) AS best_channel_by_conversion,
  first_value(channel) OVER (ORDER BY avg_first_month_mrr DESC, channel) AS best_channel_by_mrr FROM (SELECT acquisition_channel AS channel, count(*) AS total_leads, {TRI} AS trial_starts,
  {WON} AS paid_conversions, {share(WON, TRI)} AS trial_to_paid_rate, {share(WON, 'count(*)')} AS overall_conversion_rate, {DAYS} AS avg_days_to_convert, {AVGM} AS avg_first_month_mrr,
  {TOTM} AS total_converted_mrr, {share('count(*)', 'sum(count(*)) OVER ()')} AS pct_of_total_leads, {share(WON, f'sum({WON}) OVER ()')} AS pct_of_total_conversions FROM recent GROUP BY 1)""")
block("cycle", f"""SELECT acquisition_channel AS channel, {r("coalesce(" + div('sum(d_paid)', 'count(d_paid)') + ", 0)", 1)} AS avg_days,
  {r('coalesce(quantile_cont(d_paid, 0.5), 0)', 1)} AS median_days, coalesce(min(d_paid), 0)::double AS min_days, coalesce(max(d_paid), 0)::double AS max_days, count(*) AS conversions,
  {r(div('sum(cmrr)', 'count(*)'), 2)} AS avg_mrr FROM recent WHERE won GROUP BY 1""")
block("cycle_all", f"""SELECT *, {r("coalesce(" + div('sum(cast(avg_days AS decimal(38,12))) FILTER (avg_days > 0) OVER ()', 'count(*) FILTER (avg_days > 0) OVER ()') + ", 0)", 1)} AS overall_avg_days,
  coalesce((SELECT list_sort(list(avg_days))[cast(floor(count(*) / 2.0) AS integer) + 1] FROM cycle WHERE avg_days > 0), 0) AS overall_median_days FROM cycle""")
check("report_sales_cycle", "SELECT * FROM cycle_all")
check("report_trial_usage", f"""SELECT {TRI} AS trial_accounts, {WON} AS paid_conversions, {share(WON, TRI)} AS trial_to_paid_rate, {AVGM} AS avg_converted_mrr, {DAYS} AS avg_days_to_convert FROM recent""")
block("seg50", """SELECT company_size, acquisition_channel, plan_now AS plan_name, sum(expansion_mrr) AS te, count(DISTINCT account_id) AS expanding_accounts FROM moves
  WHERE expansion_mrr > 0 AND month_start >= DATE '2000-07-31' GROUP BY ALL ORDER BY te DESC, company_size, acquisition_channel, plan_name LIMIT 50""")
check("report_expansion_by_size_channel_plan", f"""SELECT company_size, acquisition_channel, plan_name, te::double AS total_expansion_mrr, expanding_accounts,
  {r(div0('te', 'expanding_accounts'), 2)} AS avg_expansion_per_account, {share('te', 'sum(te) OVER ()')} AS pct_of_total_expansion FROM seg50""")
check("agg_channel_over_months", """SELECT acquisition_channel AS channel, sum(new_mrr)::double AS total_mrr, count(*) AS accounts FROM moves WHERE new_mrr > 0 GROUP BY 1""")
check("report_chart_reaggregates", f"""SELECT company_size AS label, sum(te)::double AS value, 'expansion_by_size' AS chart FROM seg50 GROUP BY 1
  UNION ALL SELECT channel, {r('avg(avg_days)', 4)}, 'sales_cycle_by_channel' FROM cycle GROUP BY 1""")
check("cohort_period_average", f"""SELECT count(*) AS cohorts, {r(div0('sum(cast(coalesce(nrr, 0) AS decimal(38,12)))', 'count(*)'), 4)} AS avg_nrr,
  {r(div0('sum(cast(logo_retention_rate AS decimal(38,12)))', 'count(*)'), 4)} AS avg_retention FROM cohorts WHERE months_since_created = 11""")
check("funnel_width_pct", f"""SELECT stage, value, {r(div('value', 'n') + '*100', 2)} AS width_pct FROM (SELECT count(*) AS n, {TRI} AS t, {WON} AS p FROM recent),
  LATERAL (VALUES ('Leads', n), ('Trials', t), ('Paid', p)) v(stage, value)""")
check("risky_accounts_by_mrr", f"SELECT {CARD2} FROM {SNAP} WHERE health_tier <> 'healthy' ORDER BY mrr DESC, account_id LIMIT 20")
