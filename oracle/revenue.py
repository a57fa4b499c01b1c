"""Month grids, movements and executive summary, on a dense account x month grid."""

from oracle.base import ASOF, ASOF_MONTH, block, check, div, div0, gap, key, r

block("grid", f"""SELECT a.*, cast(m AS date) AS month_start, cast(date_trunc('month', created_day) AS date) AS cohort_date
  FROM accounts_raw a, unnest(generate_series(date_trunc('month', created_day)::timestamp, TIMESTAMP '2001-07-01', INTERVAL 1 MONTH)) AS g(m)""")
block("submonth", f"""SELECT s.*, cast(m AS date) AS month_start FROM subs s,
  unnest(generate_series(date_trunc('month', start_date)::timestamp,
    date_trunc('month', least(coalesce(end_date, {ASOF}), {ASOF}))::timestamp, INTERVAL 1 MONTH)) AS g(m)
  WHERE status <> 'trial'""")
block("acct_month", """SELECT account_id, month_start, cast(sum(mrr) AS decimal(18,2)) AS mrr, max(plan_name) AS plan_name,
  sum(cast(floor(seats_used::double / seats_purchased * 1e9 + 0.5) AS bigint))::double / 1e9 / count(*)::double AS util,
  cast(sum(seats_purchased) AS bigint) AS seats_purchased, cast(sum(seats_used) AS bigint) AS seats_used
  FROM submonth GROUP BY ALL""")
block("dense", """SELECT g.*, coalesce(m.mrr, 0) AS mrr, m.plan_name, m.util, m.seats_purchased, m.seats_used,
  lag(coalesce(m.mrr, 0), 1, 0) OVER w AS prev_mrr, lag(m.plan_name) OVER w AS prev_plan,
  coalesce(max(coalesce(m.mrr, 0)) OVER (PARTITION BY account_id ORDER BY month_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 AS seen
  FROM grid g LEFT JOIN acct_month m USING (account_id, month_start)
  WINDOW w AS (PARTITION BY account_id ORDER BY month_start)""")
block("typed", """SELECT *, CASE WHEN mrr > 0 AND prev_mrr = 0 THEN CASE WHEN seen THEN 'reactivation' ELSE 'new' END
  WHEN mrr > prev_mrr THEN 'expansion' WHEN mrr = prev_mrr AND mrr > 0 THEN 'retained'
  WHEN mrr > 0 THEN 'contraction' WHEN prev_mrr > 0 THEN 'churned' ELSE 'inactive' END AS mtype FROM dense""")
block("inv_month", """SELECT account_id, cast(date_trunc('month', invoice_date) AS date) AS month_start,
  count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'paid') AS paid,
  coalesce(sum(amount) FILTER (status = 'paid'), 0) AS paid_amount FROM inv GROUP BY ALL""")
block("moves", """SELECT t.*, CASE WHEN mrr > 0 THEN plan_name END AS plan_now,
  CASE mtype WHEN 'new' THEN mrr ELSE 0 END AS new_mrr,
  CASE mtype WHEN 'expansion' THEN mrr - prev_mrr ELSE 0 END AS expansion_mrr,
  CASE mtype WHEN 'contraction' THEN prev_mrr - mrr ELSE 0 END AS contraction_mrr,
  CASE mtype WHEN 'churned' THEN prev_mrr ELSE 0 END AS churned_mrr,
  CASE mtype WHEN 'reactivation' THEN mrr ELSE 0 END AS reactivation_mrr,
  CASE mtype WHEN 'retained' THEN mrr ELSE 0 END AS retained_mrr,
  mrr - prev_mrr AS delta, coalesce(i.failed, 0) AS failed, coalesce(i.paid, 0) AS paid,
  coalesce(i.paid_amount, 0) AS paid_amount, strftime(month_start, '%Y-%m') AS month_key
  FROM typed t LEFT JOIN inv_month i USING (account_id, month_start) WHERE mtype <> 'inactive'""")
PARTS = ["new", "expansion", "contraction", "churned", "reactivation", "retained"]
PART_COLS = ", ".join(f"{p}_mrr::double AS {p}_mrr" for p in PARTS)
FIVE = ", ".join(f"{p}_mrr::double AS {p}_mrr" for p in PARTS[:-1])
block("monthly", f"""SELECT month_start, month_key, sum(mrr) AS total_mrr, count(*) FILTER (mrr > 0) AS active_accounts,
  {", ".join(f"sum({p}_mrr) AS {p}_mrr" for p in PARTS)}, sum(delta) AS net_new_mrr,
  count(DISTINCT account_id) FILTER (mtype = 'churned') AS churned_accounts,
  cast(sum(failed) AS bigint) AS total_failed_payments FROM moves GROUP BY ALL""")
block("exec_base", """SELECT *, lag(total_mrr) OVER (ORDER BY month_start) AS p_mrr,
  lag(active_accounts) OVER (ORDER BY month_start) AS p_acc FROM monthly""")
BASE = "coalesce(p_mrr, total_mrr)"
block("exec", f"""SELECT {key('month_key')} AS exec_summary_key, month_start, month_key, cast(year(month_start) AS integer) AS year,
  cast(month(month_start) AS integer) AS month_num, strftime(month_start, '%b %Y') AS month_label,
  total_mrr::double AS total_mrr, (total_mrr * 12)::double AS total_arr, active_accounts,
  {r(div('total_mrr', 'active_accounts'), 2)} AS arpa, {PART_COLS}, net_new_mrr::double AS net_new_mrr, churned_accounts,
  {r(div('churned_accounts', 'coalesce(p_acc, active_accounts)'), 4)} AS logo_churn_rate,
  {r(div('churned_mrr + contraction_mrr', BASE), 4)} AS revenue_churn_rate,
  {r(div(f'{BASE} + expansion_mrr + reactivation_mrr - contraction_mrr - churned_mrr', BASE), 4)} AS nrr,
  {r(f"least(1.0::double, {div(f'{BASE} - contraction_mrr - churned_mrr', BASE)})", 4)} AS grr,
  (total_mrr - coalesce(p_mrr, 0))::double AS mrr_mom_delta,
  {r(div('total_mrr - coalesce(p_mrr, 0)', 'coalesce(p_mrr, 1)'), 4)} AS mrr_mom_pct,
  total_failed_payments, coalesce(p_mrr, 0)::double AS prev_total_mrr, coalesce(p_acc, 0) AS prev_active_accounts FROM exec_base""")

check("month_spine", """SELECT DISTINCT month_start, strftime(month_start, '%Y-%m') AS month_key FROM grid""")
check("account_months", f"""SELECT {key('account_id', "strftime(month_start, '%Y-%m')")} AS account_month_key, account_id, company_name,
  industry, company_size, region, country, acquisition_channel, created_day AS account_created_date, month_start,
  strftime(month_start, '%Y-%m') AS month_key, cast(year(month_start) AS integer) AS month_year,
  cast(month(month_start) AS integer) AS month_num, strftime(created_day, '%Y-%m') AS cohort_month, cohort_date AS cohort_month_date,
  {gap('created_day', 'month_start')} AS months_since_created,
  strftime(created_day, '%Y-%m') = strftime(month_start, '%Y-%m') AS is_first_month FROM grid""")
check("subscription_months", f"""SELECT {key('subscription_id', "strftime(month_start, '%Y-%m')")} AS sub_month_key, subscription_id,
  account_id, plan_name AS plan_id, plan_name, mrr::double AS mrr, status, billing_cycle, seats_purchased, seats_used, month_start,
  strftime(month_start, '%Y-%m') AS month_key, start_date AS started_date, end_date AS ended_date FROM submonth""")
check("mrr_movement_type", f"""SELECT account_id, month_start, mrr::double AS mrr, prev_mrr::double AS prev_mrr,
  delta::double AS mrr_delta, mtype AS mrr_movement_type, plan_name, CASE WHEN prev_mrr > 0 THEN prev_plan END AS prev_plan_name,
  cast(row_number() OVER (PARTITION BY account_id ORDER BY month_start) AS integer) AS account_month_rank,
  {r('util', 6)} AS seat_utilization_rate FROM moves WHERE mrr > 0""")
check("mrr_components", f"""SELECT account_id, month_start, mtype AS mrr_movement_type, mrr::double AS mrr, {PART_COLS},
  delta::double AS net_mrr_contribution, (mrr * 12)::double AS arr FROM moves WHERE mtype <> 'churned'""")
check("mrr_churn_rows", """SELECT account_id, month_start, mrr::double AS mrr, prev_mrr::double AS prev_mrr,
  delta::double AS mrr_delta, mtype AS mrr_movement_type, prev_plan AS prev_plan_name FROM moves WHERE mtype = 'churned'""")
check("fct_mrr_movements", f"""SELECT {key('account_id', 'month_key')} AS account_month_key, account_id, company_name, industry,
  company_size, region, acquisition_channel, plan_now AS plan_name, CASE WHEN prev_mrr > 0 THEN prev_plan END AS prev_plan_name,
  cast(CASE plan_now WHEN 'starter' THEN 1 WHEN 'growth' THEN 2 WHEN 'business' THEN 3 WHEN 'enterprise' THEN 4 END AS integer) AS plan_tier_order,
  month_start, month_key, mrr::double AS mrr, prev_mrr::double AS prev_mrr, delta::double AS mrr_delta, mtype AS mrr_movement_type,
  {r('CASE WHEN mrr > 0 THEN util END', 6)} AS seat_utilization_rate, {PART_COLS}, mtype = 'churned' AS is_churned,
  failed AS failed_payments, paid AS successful_payments, paid_amount::double AS total_invoiced_paid, failed > 0 AS has_payment_failure,
  delta::double AS net_mrr_contribution, (mrr * 12)::double AS arr FROM moves""")
check("exec_monthly", f"""SELECT month_start, month_key, total_mrr::double AS total_mrr, (total_mrr * 12)::double AS total_arr,
  active_accounts, {PART_COLS}, net_new_mrr::double AS net_new_mrr, churned_accounts, total_failed_payments,
  {r(div('total_mrr', 'active_accounts'), 2)} AS arpa FROM monthly""")
check("exec_revenue_summary", "SELECT * FROM exec")
check("revenue_by_plan_region_industry", "".join(f"""{"UNION ALL " if i else ""}SELECT month_key, '{n}' AS segment_type,
  {c} AS segment_value, sum(mrr)::double AS mrr, count(*) FILTER (mrr > 0) AS accounts FROM moves WHERE {c} IS NOT NULL GROUP BY month_key, {c} """
  for i, (n, c) in enumerate([("plan", "plan_now"), ("region", "region"), ("industry", "industry")])))
SEG = [("plan", "plan_name"), ("region", "region"), ("industry", "industry"), ("company_size", "company_size"), ("channel", "acquisition_channel")]
check("agg_segment_rollup", " UNION ALL ".join(f"""SELECT month_start, '{n}' AS segment_type, {c} AS segment_value, sum(mrr)::double AS total_mrr,
  count(*) AS account_count, {r(div('sum(mrr)', 'count(*)'), 2)} AS avg_mrr,
  {r(div('sum(mrr)', 'any_value(tot)'), 4)} AS pct_of_total
  FROM (SELECT *, sum(mrr) OVER (PARTITION BY month_start) AS tot FROM moves WHERE mrr > 0) GROUP BY month_start, {c}""" for n, c in SEG))
check("top_expanding_per_month", """SELECT month_key, account_id, company_name, industry, company_size, region, plan_now AS plan_name,
  mrr::double AS mrr, expansion_mrr::double AS expansion_mrr, delta::double AS mrr_delta,
  cast(row_number() OVER (PARTITION BY month_key ORDER BY expansion_mrr DESC, account_id) AS integer) AS expansion_rank
  FROM moves WHERE mtype = 'expansion'""")
check("top_churn_loss_per_month", """SELECT month_key, account_id, company_name, industry, company_size, region, plan_now AS plan_name,
  mrr::double AS mrr, churned_mrr::double AS churned_mrr, contraction_mrr::double AS contraction_mrr, mtype AS mrr_movement_type,
  (prev_mrr - mrr)::double AS mrr_loss,
  cast(row_number() OVER (PARTITION BY month_key ORDER BY prev_mrr - mrr DESC, account_id) AS integer) AS churn_risk_rank
  FROM moves WHERE mtype IN ('churned', 'contraction')""")

# variants
block("simple_rows", """SELECT account_id, month_start, mrr AS ending_mrr, plan_name,
  lag(mrr) OVER (PARTITION BY account_id ORDER BY month_start) AS p FROM acct_month""")
check("mrr_movements_simple", """SELECT account_id, month_start, plan_name, coalesce(p, 0)::double AS starting_mrr, ending_mrr::double AS ending_mrr,
  (CASE WHEN p IS NULL THEN ending_mrr ELSE 0 END)::double AS new_mrr,
  (CASE WHEN ending_mrr > p THEN ending_mrr - p ELSE 0 END)::double AS expansion_mrr,
  (CASE WHEN ending_mrr < p AND ending_mrr > 0 THEN p - ending_mrr ELSE 0 END)::double AS contraction_mrr,
  0::double AS churned_mrr, 0::double AS reactivation_mrr, (ending_mrr - coalesce(p, 0))::double AS net_new_mrr,
  CASE WHEN p IS NULL THEN 'new' WHEN ending_mrr > p THEN 'expansion' WHEN ending_mrr < p AND ending_mrr > 0 THEN 'contraction' ELSE 'retained' END AS movement_type
  FROM simple_rows""")
block("roll_grid", """SELECT a.account_id, cast(m AS date) AS month_start, coalesce(sum(s.mrr), 0) AS e, max(s.plan_name) AS plan_name
  FROM (SELECT account_id, min(start_date) AS f FROM subs GROUP BY account_id) a,
  unnest(generate_series(date_trunc('month', f)::timestamp, TIMESTAMP '2001-06-01', INTERVAL 1 MONTH)) AS g(m)
  LEFT JOIN subs s ON s.account_id = a.account_id AND s.start_date <= m AND (s.end_date IS NULL OR s.end_date > m)
  GROUP BY a.account_id, m""")
block("roll_prev", """SELECT *, lag(e, 1, 0) OVER w AS p, lag(plan_name) OVER w AS p_plan,
  coalesce(max(e) OVER (PARTITION BY account_id ORDER BY month_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 AS seen
  FROM roll_grid WINDOW w AS (PARTITION BY account_id ORDER BY month_start)""")
block("roll", """SELECT *, CASE WHEN e > 0 AND p = 0 THEN CASE WHEN seen THEN 'reactivation' ELSE 'new' END WHEN e = 0 THEN 'churn'
  WHEN e - p > 5 THEN 'expansion' WHEN e - p < -5 THEN 'contraction' ELSE 'retained' END AS kind FROM roll_prev WHERE e > 0 OR p > 0""")
block("roll_parts", """SELECT account_id, month_start, kind, CASE WHEN e > 0 THEN plan_name ELSE p_plan END AS plan_name, p, e,
  CASE WHEN kind = 'new' THEN e ELSE 0 END AS new_mrr, CASE WHEN kind = 'expansion' THEN e - p ELSE 0 END AS expansion_mrr,
  CASE WHEN kind = 'contraction' THEN p - e ELSE 0 END AS contraction_mrr, CASE WHEN kind = 'churn' THEN p ELSE 0 END AS churned_mrr,
  CASE WHEN kind = 'reactivation' THEN e ELSE 0 END AS reactivation_mrr FROM roll""")
NET = "new_mrr + expansion_mrr + reactivation_mrr - contraction_mrr - churned_mrr"
check("mrr_rollforward", f"""SELECT account_id, month_start, plan_name, p::double AS starting_mrr, e::double AS ending_mrr, kind AS movement_type,
  {FIVE}, ({NET})::double AS net_new_mrr FROM roll_parts""")
block("roll_month", f"""SELECT month_start, sum(e) AS t, {", ".join(f"sum({p}_mrr) AS {p}_mrr" for p in PARTS[:-1])}, sum({NET}) AS net_new_mrr,
  sum(p) AS s, count(*) FILTER (kind <> 'churn') AS active_accounts, count(*) FILTER (kind = 'new') AS new_accounts,
  count(*) FILTER (kind = 'churn') AS churned_accounts,
  count(*) FILTER (kind IN ('retained', 'expansion', 'contraction')) AS starting_accounts FROM roll_parts GROUP BY ALL""")
check("exec_from_movements", f"""SELECT month_start, t::double AS total_mrr, (t * 12)::double AS total_arr, {FIVE}, net_new_mrr::double AS net_new_mrr,
  {r(div0('s + expansion_mrr + reactivation_mrr - contraction_mrr - churned_mrr', 's', '1.0'), 4)} AS nrr,
  {r(div0('s - contraction_mrr - churned_mrr', 's', '1.0'), 4)} AS grr,
  {r(div0('churned_accounts', 'starting_accounts'), 4)} AS logo_churn_rate,
  {r(div0('churned_mrr + contraction_mrr', 's'), 4)} AS revenue_churn_rate, active_accounts, new_accounts, churned_accounts,
  {r(div0('t', 'active_accounts'), 2)} AS arpa FROM roll_month""")
block("carry", f"""SELECT month_key, sum(mrr) AS t, {", ".join(f"sum({p}_mrr) AS {p}_mrr" for p in PARTS[:-1])}, sum(delta) AS net_new_mrr,
  count(*) FILTER (mtype <> 'churned') AS active_accounts, count(*) FILTER (mtype = 'churned') AS churned_accounts,
  count(*) FILTER (mtype IN ('retained', 'expansion', 'contraction')) AS starting_accounts,
  coalesce(sum(mrr) FILTER (mtype IN ('retained', 'expansion', 'contraction')), 0) AS s FROM moves GROUP BY ALL""")
check("exec_retained_base", f"""SELECT month_key, t::double AS total_mrr, (t * 12)::double AS total_arr, active_accounts,
  {r(div0('t', 'active_accounts'), 2)} AS arpa, {FIVE}, net_new_mrr::double AS net_new_mrr,
  {r(div0('s + expansion_mrr + reactivation_mrr - contraction_mrr - churned_mrr', 's', '1.0'), 4)} AS nrr,
  {r(div0('s - contraction_mrr - churned_mrr', 's', '1.0'), 4)} AS grr,
  {r(div0('churned_accounts', 'starting_accounts'), 4)} AS logo_churn_rate,
  {r(div0('churned_mrr + contraction_mrr', 's'), 4)} AS revenue_churn_rate,
  {r(div0('t - lag(t) OVER (ORDER BY month_key)', 'lag(t) OVER (ORDER BY month_key)'), 4)} AS mrr_mom_pct,
  churned_accounts, starting_accounts, s::double AS starting_mrr FROM carry""")
check("normalize_mrr", """SELECT subscription_id, billing_cycle, seats_purchased,
  round(CASE WHEN billing_cycle = 'annual' THEN cast(annual_price / 12.0 AS decimal(38,12)) ELSE monthly_price END, 2)::double AS list_mrr,
  round(round(CASE WHEN billing_cycle = 'annual' THEN cast(annual_price / 12.0 AS decimal(38,12)) ELSE monthly_price END, 2) * 12, 2)::double AS list_arr
  FROM subs LEFT JOIN plans_t USING (plan_name)""")
check("billing_schedule", f"""SELECT subscription_id, account_id, plan_name, billing_cycle, cast(m AS date) AS invoice_date,
  cast(m AS date) + CASE WHEN billing_cycle = 'annual' THEN 30 ELSE 15 END AS due_date, cast(m AS date) AS period_start,
  cast(m + CASE WHEN billing_cycle = 'annual' THEN INTERVAL 12 MONTH ELSE INTERVAL 1 MONTH END AS date) - 1 AS period_end,
  (mrr * CASE WHEN billing_cycle = 'annual' THEN 12 ELSE 1 END)::double AS amount, mrr::double AS mrr_equivalent
  FROM subs, unnest(generate_series(date_trunc('month', start_date)::timestamp, least(coalesce(end_date, {ASOF}), {ASOF})::timestamp,
    INTERVAL 1 MONTH)) AS g(m)
  WHERE billing_cycle = 'monthly' OR month(m) = month(start_date)""")
