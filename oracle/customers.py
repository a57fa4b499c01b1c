"""Staging, cohort, usage, support, health, funnel and success statements."""

from oracle import revenue  # noqa: F401  its statements are used again
from oracle.base import ASOF, ASOF_MONTH, CHECKS, block, check, div, div0, gap, key, over, r

AGE = lambda a, b: f"cast((year({b}) - year({a})) * 12 + month({b}) - month({a}) - (day({b}) < day({a}))::integer AS integer)"
TIERNO = "cast(CASE {c} WHEN 'starter' THEN 1 WHEN 'growth' THEN 2 WHEN 'business' THEN 3 WHEN 'enterprise' THEN 4 ELSE 99 END AS integer)"
ACTIVE_SUB = f"SELECT account_id, bool_or(end_date IS NULL OR end_date >= {ASOF}) AS alive FROM subs GROUP BY account_id"

check("stg_accounts", f"""SELECT account_id, company_name, industry, region, company_size, acquisition_channel, country,
  cast(CASE company_size WHEN '1-10' THEN 5 WHEN '11-50' THEN 30 WHEN '51-200' THEN 125 WHEN '201-1000' THEN 600 WHEN '1000+' THEN 2500 END AS integer) AS employee_midpoint,
  CASE WHEN company_size IN ('1-10', '11-50') THEN 'smb' WHEN company_size = '51-200' THEN 'mid_market'
    WHEN company_size IN ('201-1000', '1000+') THEN 'enterprise' ELSE 'unknown' END AS size_tier,
  created_day::timestamp AS created_at, created_day::timestamp AS updated_at, coalesce(alive, false) AS is_active,
  CASE WHEN alive THEN 'active' ELSE 'churned' END AS account_status
  FROM accounts_raw LEFT JOIN ({ACTIVE_SUB}) USING (account_id)""")
check("stg_calendar", f"""SELECT d AS calendar_date, cast(year(d) AS integer) AS year, cast(month(d) AS integer) AS month,
  cast(day(d) AS integer) AS day_of_month, cast(dayofweek(d) AS integer) AS day_of_week, cast(dayofyear(d) AS integer) AS day_of_year,
  cast(weekofyear(d) AS integer) AS week_of_year, cast(quarter(d) AS integer) AS quarter, strftime(d, '%Y-%m') AS month_key,
  cast(date_trunc('month', d) AS date) AS month_start_date, last_day(d) AS month_end_date,
  concat(year(d), '-Q', quarter(d)) AS quarter_key, cast(date_trunc('quarter', d) AS date) AS quarter_start_date,
  cast(year(d) AS integer) AS fiscal_year, strftime(d, '%B %Y') AS month_name_long, strftime(d, '%b %Y') AS month_name_short,
  strftime(d, '%A') AS day_name_long, strftime(d, '%a') AS day_name_short, dayofweek(d) IN (0, 6) AS is_weekend,
  dayofweek(d) NOT IN (0, 6) AS is_weekday, day(d) = 1 AS is_month_start, d = last_day(d) AS is_month_end,
  d = cast(date_trunc('quarter', d) AS date) AS is_quarter_start, d <= {ASOF} AS is_past_or_today, d = {ASOF} AS is_today,
  cast({ASOF} - d AS integer) AS days_ago,
  CASE WHEN d <= {ASOF} THEN {AGE('d', ASOF)} ELSE -{AGE(ASOF, 'd')} END AS months_ago,
  cast(quarter(d) AS integer) AS fiscal_quarter_num, cast(month(d) AS integer) AS fiscal_month_num
  FROM (SELECT cast(x AS date) AS d FROM (SELECT date_trunc('year', min(d))::timestamp AS f FROM ord),
    unnest(generate_series(f, ({ASOF} + 365)::timestamp, INTERVAL 1 DAY)) AS g(x))""")
check("stg_customers", f"""SELECT {key('account_id')} AS customer_id, account_id, company_name,
  'user' || account_id || '@example.com' AS email, 'First' || account_id % 13 || ' Last' || account_id % 17 AS full_name,
  'First' || account_id % 13 AS first_name, 'Last' || account_id % 17 AS last_name,
  CASE account_id % 8 WHEN 0 THEN 'CEO' WHEN 1 THEN 'Co-Founder' WHEN 2 THEN 'CTO' WHEN 3 THEN 'VP Sales' WHEN 4 THEN 'Account Manager'
    WHEN 5 THEN 'Team Lead' WHEN 6 THEN 'Software Engineer' ELSE 'Accountant' END AS job_title,
  CASE account_id % 8 WHEN 0 THEN 'C-Suite' WHEN 1 THEN 'C-Suite' WHEN 2 THEN 'VP / Director' WHEN 3 THEN 'VP / Director'
    WHEN 4 THEN 'Manager' WHEN 5 THEN 'Manager' WHEN 6 THEN 'Individual Contributor' ELSE 'Other' END AS persona_tier,
  created_day::timestamp AS created_at, cast({ASOF} - created_day AS integer) AS tenure_days,
  CASE WHEN {ASOF} - created_day < 90 THEN '0-3 months' WHEN {ASOF} - created_day < 180 THEN '3-6 months'
    WHEN {ASOF} - created_day < 365 THEN '6-12 months' WHEN {ASOF} - created_day < 730 THEN '1-2 years' ELSE '2+ years' END AS tenure_bucket,
  account_id % 6 = 0 AS is_churned FROM accounts_raw WHERE account_id % 11 <> 0""")
check("stg_features", f"""SELECT feature_id, feature_id AS feature_name, feature_id AS feature_slug, feature_category, feature_tier,
  {TIERNO.format(c='feature_tier')} AS tier_order, is_core, is_premium, is_beta, false AS is_deprecated,
  CASE WHEN is_core AND feature_tier IN ('starter', 'growth') THEN 'high' WHEN is_core OR is_premium THEN 'medium' ELSE 'low' END AS importance_tier,
  (CASE WHEN is_core AND feature_tier IN ('starter', 'growth') THEN 3.0 WHEN is_core THEN 2.0 WHEN is_premium THEN 1.5 ELSE 1.0 END)::double AS health_weight
  FROM feats""")
check("stg_invoices", f"""SELECT invoice_id, account_id, subscription_id, amount::double AS amount, status, 'usd' AS currency,
  invoice_date, due_date, paid_date, status = 'paid' AS is_paid, status = 'failed' AS is_failed, status = 'pending' AS is_pending,
  false AS is_refunded, cast(CASE WHEN status = 'paid' THEN paid_date - invoice_date END AS integer) AS days_to_pay,
  status NOT IN ('paid', 'void', 'refunded') AND due_date < {ASOF} AS is_overdue,
  cast(date_trunc('month', invoice_date) AS date) AS billing_month FROM inv WHERE amount > 0""")
check("stg_leads", """SELECT lead_id, account_id, acquisition_channel AS channel, industry, company_size, created_day::timestamp AS created_at,
  trial_started_day::timestamp AS trial_started_at, converted_day::timestamp AS converted_to_paid_at,
  trial_started_day IS NOT NULL AS started_trial, converted_day IS NOT NULL AS converted_paid,
  cast(converted_day - trial_started_day AS integer) AS trial_to_paid_days, cast(date_trunc('month', created_day) AS date) AS lead_month
  FROM lead_rows""")
check("stg_plans", f"""SELECT plan_name AS plan_id, plan_name, monthly_price::double AS monthly_price, annual_price::double AS annual_price,
  {TIERNO.format(c='plan_name')} AS plan_tier_order, plan_name = 'enterprise' AS is_enterprise
  FROM plans_t WHERE plan_name IN (SELECT plan_name FROM subs)""")
check("stg_subscriptions", f"""SELECT subscription_id, account_id, plan_name AS plan_id, plan_name, status, billing_cycle, mrr::double AS mrr,
  (mrr * 12)::double AS arr, seats_purchased, seats_used, start_date, end_date,
  status = 'active' AND (end_date IS NULL OR end_date >= {ASOF}) AS is_active, status = 'trial' AS is_trial,
  {AGE('start_date', f'coalesce(end_date, {ASOF})')} AS tenure_months, billing_cycle = 'annual' AS is_annual FROM subs""")
check("stg_usage_events", """SELECT event_id, account_id, user_id, session_id, event_type, feature_id, feature_id AS feature_name,
  f.feature_category, event_day AS event_date, duration_seconds, cast(date_trunc('month', event_day) AS date) AS event_month,
  cast(date_trunc('week', event_day) AS date) AS event_week, cast(dayofweek(event_day) AS integer) AS day_of_week,
  CASE WHEN duration_seconds >= 1800 THEN 'deep' WHEN duration_seconds >= 600 THEN 'medium' WHEN duration_seconds >= 60 THEN 'light' ELSE 'bounce' END AS session_quality,
  f.feature_category IN ('core', 'workflow', 'automation') AS is_core_feature FROM usage JOIN feats f USING (feature_id)""")
check("stg_support_tickets", """SELECT ticket_id, account_id, user_id, 'error' AS category, priority, t.status,
  csat_score::double AS csat_score, created_day::timestamp AS created_at,
  CASE WHEN solved THEN created_day::timestamp + INTERVAL 6 HOUR END AS resolved_at,
  created_day::timestamp + INTERVAL 1 HOUR AS first_response_at, t.status = 'escalated' AS is_escalated
  FROM tix t JOIN (SELECT event_id, user_id FROM events) ON event_id = ticket_id""")
STAMP = "TIMESTAMP '2001-07-31 06:00:00'"
NONE = lambda kind, *names: ", ".join(f"NULL::{kind} AS {n}" for n in names)
INVOICES = f"""invoice_id, account_id, subscription_id, amount::double AS amount, 'usd' AS currency, status, invoice_date, due_date, paid_date, failed_date,
  {NONE('varchar', 'payment_method', 'failure_reason')}, cast(0 AS integer) AS retry_count, {STAMP} AS _loaded_at FROM inv"""
USAGE = f"""account_id, event_id, user_id, feature_id, feature_id AS feature_name, event_type, 'web' AS platform, session_id, duration_seconds, cast(1 AS integer) AS actions_count,
  event_day::timestamp AS occurred_at, {STAMP} AS _loaded_at FROM usage"""
check("silver_latest_per_key", f"SELECT {INVOICES}")
check("silver_fk_guard", f"SELECT {USAGE} WHERE account_id IN (SELECT account_id FROM accounts_raw) AND account_id % 2 = 0")
check("silver_invoices", f"SELECT {INVOICES} WHERE subscription_id % 97 <> 0")
check("silver_usage_events", f"SELECT {USAGE} WHERE event_id % 97 <> 0")
check("silver_plans", f"""SELECT plan_name AS plan_id, plan_name, monthly_price::double AS monthly_price, annual_price::double AS annual_price, {NONE('integer', 'max_seats', 'max_workflows')},
  tier::varchar AS tier, true AS is_active, {STAMP} AS _loaded_at FROM plans_t WHERE plan_name <> 'growth'""")
check("silver_features", f"""SELECT feature_id, feature_id AS feature_name, feature_category, feature_tier, is_core, is_premium, is_beta, false AS is_deprecated, {STAMP} AS _loaded_at FROM feats WHERE feature_id <> 'click'""")
block("days", f"SELECT cast(unnest(generate_series((SELECT min(d) FROM ord)::timestamp, {ASOF}::timestamp, INTERVAL 1 DAY)) AS date) AS d")
check("silver_calendar", f"""SELECT cast(strftime(d, '%Y%m%d') AS integer) AS date_id, d AS full_date, cast(year(d) AS integer) AS year, cast(quarter(d) AS integer) AS quarter, cast(month(d) AS integer) AS month,
  strftime(d, '%B') AS month_name, cast(weekofyear(d) AS integer) AS week, cast(isodow(d) - 1 AS integer) AS day_of_week, strftime(d, '%A') AS day_name, isodow(d) >= 6 AS is_weekend, day(d) = 1 AS is_month_start,
  d = last_day(d) AS is_month_end, {STAMP} AS _loaded_at FROM days WHERE cast(strftime(d, '%Y%m%d') AS integer) % 97 <> 0""")
check("silver_accounts", f"""SELECT account_id, company_name, industry, company_size, region, country, acquisition_channel, {NONE('varchar', 'account_owner', 'website')}, created_day::timestamp AS created_at,
  {NONE('timestamp', 'updated_at')}, {NONE('double', 'annual_revenue_usd')}, {NONE('integer', 'employee_count')}, {STAMP} AS _loaded_at FROM accounts_raw WHERE account_id % 97 <> 0""")
check("silver_subscriptions", f"""SELECT subscription_id, account_id, plan_name AS plan_id, plan_name, status, billing_cycle, mrr::double AS mrr, (cast(mrr AS decimal(18,2)) * 12)::double AS arr, seats_purchased, seats_used, start_date, end_date,
  {NONE('date', 'trial_start', 'trial_end')}, CASE WHEN status = 'cancelled' THEN end_date::timestamp END AS cancelled_at, {NONE('varchar', 'cancellation_reason')}, {NONE('double', 'discount_pct')}, {STAMP} AS _loaded_at
  FROM subs WHERE subscription_id % 97 <> 0""")
check("silver_tickets", f"""SELECT ticket_id, account_id, user_id, {NONE('varchar', 'subject', 'agent_id')}, 'error' AS category, priority, t.status, csat_score::double AS csat_score, t.status = 'escalated' AS is_escalated,
  created_day::timestamp AS created_at, CASE WHEN solved THEN created_day::timestamp + INTERVAL 6 HOUR END AS resolved_at, created_day::timestamp + INTERVAL 1 HOUR AS first_response_at, {STAMP} AS _loaded_at
  FROM tix t JOIN (SELECT event_id, user_id FROM events) ON event_id = ticket_id WHERE ticket_id % 97 <> 0""")
check("silver_leads", f"""SELECT lead_id, account_id, {NONE('varchar', 'company_name', 'region', 'lead_source', 'plan_id', 'lost_reason')}, industry, company_size, acquisition_channel, lead_score, trial_engagement_score,
  {", ".join(f"{c}_day::timestamp AS {c}_at" for c in ("created", "qualified", "demo_requested", "demo_completed", "trial_started", "trial_ended", "converted", "lost"))},
  {NONE('double', 'first_mrr')}, {STAMP} AS _loaded_at FROM lead_rows WHERE lead_id % 97 <> 0""")
QUARANTINE = [("plans", "'growth'", "monthly_price", "(SELECT 1)"), ("features", "feature_id", "is_core", "feats WHERE feature_id = 'click'"),
              ("calendar", "strftime(d, '%Y%m%d')", "week", "days WHERE cast(strftime(d, '%Y%m%d') AS integer) % 97 = 0"), ("accounts", "account_id::varchar", "created_at", "accounts_raw WHERE account_id % 97 = 0"),
              ("subscriptions", "subscription_id::varchar", "seats_purchased", "subs WHERE subscription_id % 97 = 0"), ("invoices", "invoice_id", "amount", "inv WHERE subscription_id % 97 = 0"),
              ("usage_events", "event_id::varchar", "occurred_at", "usage WHERE event_id % 97 = 0"), ("tickets", "ticket_id::varchar", "csat_score", "tix WHERE ticket_id % 97 = 0"),
              ("leads", "lead_id::varchar", "converted_at", "lead_rows WHERE lead_id % 97 = 0")]
check("silver_quarantine", " UNION ALL ".join(f"SELECT '{e}' AS entity, {k} AS key, '{c}' AS columns, 'n/a' AS shown FROM {t}" for e, k, c, t in QUARANTINE))
check("pipeline_exec_summary", over(
    CHECKS["exec_revenue_summary"], accounts_raw="SELECT * FROM accounts_raw_all WHERE account_id % 97 <> 0",
    subs="SELECT * FROM subs_all WHERE subscription_id % 97 <> 0 AND account_id % 97 <> 0", inv="SELECT * FROM inv_all WHERE subscription_id % 97 <> 0 AND account_id % 97 <> 0 AND amount > 0"))
check("derived_durations", """SELECT 'ticket' AS entity, ticket_id AS id, CASE WHEN solved THEN 6.0::double END AS amount FROM tix
  UNION ALL SELECT 'lead_conversion', lead_id, (converted_day - created_day)::double FROM lead_rows
  UNION ALL SELECT 'lead_trial', lead_id, (trial_ended_day - trial_started_day)::double FROM lead_rows""")

# cohorts
block("coh", f"""SELECT d.*, {gap('created_day', 'month_start')} AS period, strftime(created_day, '%Y-%m') AS cohort_month,
  first_value(mrr) OVER w AS start_mrr, first_value(plan_name) OVER w AS start_plan,
  lag(mrr > 0) OVER w AS was,
  CASE WHEN row_number() OVER w = 1 THEN 'new' WHEN mrr > 0 AND prev_mrr > 0 THEN 'retained' WHEN mrr > 0 THEN 'reactivated'
    WHEN prev_mrr > 0 THEN 'churned' ELSE 'inactive' END AS rs
  FROM dense d WINDOW w AS (PARTITION BY account_id ORDER BY month_start)""")
block("coh_sum", f"""SELECT cohort_month, cohort_date, period, count(DISTINCT account_id) AS n,
  count(DISTINCT account_id) FILTER (rs IN ('new', 'retained', 'reactivated')) AS act,
  count(DISTINCT account_id) FILTER (rs = 'churned') AS churned, count(DISTINCT account_id) FILTER (rs = 'reactivated') AS react,
  sum(mrr) AS m, coalesce(sum(mrr) FILTER (rs IN ('new', 'retained', 'reactivated')), 0) AS am, sum(start_mrr) AS sm,
  mode(industry ORDER BY industry) AS d_ind, mode(company_size ORDER BY company_size) AS d_size,
  mode(acquisition_channel ORDER BY acquisition_channel) AS d_ch, mode(plan_name ORDER BY plan_name) AS d_plan
  FROM coh GROUP BY ALL""")
check("cohort_base", f"""SELECT {key('account_id', 'cohort_month', 'period')} AS cohort_record_key, account_id, company_name, industry,
  company_size, region, acquisition_channel, created_day AS account_created_date, month_start, strftime(month_start, '%Y-%m') AS month_key,
  cohort_month, c.cohort_date AS cohort_month_date, period AS months_since_created, period = 0 AS is_first_month, mrr::double AS mrr, plan_name,
  mrr > 0 AS is_active_this_month, was AS was_active_prev_month, start_mrr::double AS starting_mrr, start_plan AS starting_plan,
  rs AS retention_status, {r(div('mrr', 'start_mrr'), 6)} AS revenue_retention_rate, (mrr - start_mrr)::double AS mrr_vs_starting,
  cast(CASE plan_name WHEN 'starter' THEN 1 WHEN 'growth' THEN 2 WHEN 'business' THEN 3 WHEN 'enterprise' THEN 4 END AS integer) AS plan_tier_order,
  n AS cohort_size, sm::double AS cohort_starting_mrr, am::double AS cohort_active_mrr, act AS cohort_active_accounts,
  {r(div('act', 'n'), 6)} AS cohort_logo_retention_rate, {r(div('m', 'sm'), 6)} AS cohort_revenue_retention_rate, m::double AS cohort_total_mrr
  FROM coh c JOIN coh_sum USING (cohort_month, period)""")
check("cohort_period_summary", f"""SELECT cohort_month, cohort_date AS cohort_month_date, period AS months_since_created,
  n AS total_accounts_in_cohort, act AS active_accounts, churned AS churned_accounts, react AS reactivated_accounts,
  m::double AS cohort_mrr, am::double AS active_mrr, sm::double AS cohort_starting_mrr, d_ind AS dominant_industry,
  d_size AS dominant_company_size, d_ch AS dominant_channel, d_plan AS dominant_plan, {r(div('m', 'n'), 2)} AS avg_account_mrr,
  {r(div('act', 'n'), 6)} AS logo_retention_rate, {r(div('m', 'sm'), 6)} AS revenue_retention_rate FROM coh_sum""")
block("cohorts", f"""SELECT {key('cohort_month', 'period')} AS cohort_period_key, cohort_month, period AS months_since_created,
  d_size AS company_size, d_ch AS acquisition_channel, d_plan AS plan_name, n AS cohort_size, sm::double AS cohort_starting_mrr,
  act AS active_accounts, churned AS churned_accounts, am::double AS active_mrr, m::double AS cohort_mrr,
  {r(div('act', 'n'), 4)} AS logo_retention_rate, {r(div('m', 'sm'), 4)} AS revenue_retention_rate,
  {r(div('churned', 'n'), 4)} AS logo_churn_rate, {r('1 - ' + div('m', 'sm'), 4)} AS revenue_churn_rate,
  {r(div('m', 'sm'), 4)} AS nrr, {r(f"least(1.0::double, {div('m', 'sm')})", 4)} AS grr, {r(div('am', 'act'), 2)} AS arpa,
  CASE WHEN {div('act', 'n')} >= 0.9 THEN 'excellent' WHEN {div('act', 'n')} >= 0.75 THEN 'good' WHEN {div('act', 'n')} >= 0.6 THEN 'fair' ELSE 'poor' END AS cohort_health,
  period = 3 AS is_3_month_mark, period = 6 AS is_6_month_mark, period = 12 AS is_12_month_mark, period = 24 AS is_24_month_mark
  FROM coh_sum""")
check("fct_customer_cohorts", "SELECT * FROM cohorts")
check("cohort_segments", f"""SELECT cohort_month, period AS months_since_created, company_size, acquisition_channel, plan_name, region, industry,
  count(DISTINCT account_id) AS segment_cohort_size,
  count(DISTINCT account_id) FILTER (rs IN ('new', 'retained', 'reactivated')) AS segment_active_accounts,
  coalesce(sum(mrr) FILTER (rs IN ('new', 'retained', 'reactivated')), 0)::double AS segment_active_mrr, sum(mrr)::double AS segment_total_mrr,
  {r(div("count(DISTINCT account_id) FILTER (rs IN ('new', 'retained', 'reactivated'))", 'count(DISTINCT account_id)'), 4)} AS segment_logo_retention_rate,
  {r(div("coalesce(sum(mrr) FILTER (rs IN ('new', 'retained', 'reactivated')), 0)", 'any_value(sm)'), 4)} AS segment_revenue_retention_rate
  FROM (SELECT c.*, s.sm FROM coh c JOIN coh_sum s USING (cohort_month, period)) GROUP BY ALL""")
block("mcoh", f"""SELECT cohort_date, {gap('cohort_date', 'month_start')} AS period, count(*) FILTER (mtype <> 'churned') AS act, count(*) AS n,
  sum(mrr) AS m FROM moves GROUP BY ALL""")
block("mcoh0", """SELECT a.*, z.n AS size, z.m AS sm FROM mcoh a JOIN mcoh z ON a.cohort_date = z.cohort_date AND z.period = 0 WHERE a.period BETWEEN 0 AND 12""")
check("cohorts_from_movements", f"""SELECT strftime(cohort_date, '%Y-%m') AS cohort_month, period AS months_since_created, size AS cohort_size,
  act AS active_accounts, {r(div0('act', 'size'), 4)} AS logo_retention_rate, m::double AS cohort_mrr, sm::double AS starting_mrr,
  {r(div0('m', 'sm'), 4)} AS revenue_retention_rate, {r(div0('m', 'sm'), 4)} AS nrr, {r(f"least({div0('m', 'sm')}, 1.0)", 4)} AS grr,
  CASE WHEN {div0('act', 'size')} >= 0.85 THEN 'healthy' WHEN {div0('act', 'size')} >= 0.65 THEN 'at_risk' ELSE 'churning' END AS cohort_health
  FROM mcoh0""")
check("pivot_cohort_heatmap", f"""SELECT cohort_month, max(cohort_size) AS cohort_size,
  {", ".join(f"max(logo_retention_rate) FILTER (months_since_created = {p}) AS m{p}" for p in range(13))} FROM cohorts GROUP BY cohort_month""")

# usage
block("use_month", """SELECT account_id, cast(date_trunc('month', event_day) AS date) AS month_start, count(DISTINCT event_id) AS total_events,
  count(DISTINCT user_id) AS active_users, count(DISTINCT session_id) AS total_sessions, count(DISTINCT feature_id) AS distinct_features_used,
  cast(sum(duration_seconds) AS bigint) AS total_duration_seconds, count(duration_seconds) AS timed, count(DISTINCT event_day) AS active_days_in_month,
  count(DISTINCT CASE WHEN is_core THEN feature_id END) AS core_features_used, count(DISTINCT CASE WHEN is_premium THEN feature_id END) AS premium_features_used,
  sum(DISTINCT (CASE WHEN is_core AND feature_tier <> 'business' THEN 3.0 WHEN is_core THEN 2.0 WHEN is_premium THEN 1.5 ELSE 1.0 END)::double) AS feature_adoption_score,
  max(event_day) AS last_active_date FROM usage JOIN feats USING (feature_id) GROUP BY ALL""")
block("use_flag", f"""SELECT *, strftime(month_start, '%Y-%m') AS month_key, cast(last_day(month_start) - last_active_date AS integer) AS idle,
  lag(total_events) OVER w AS pe, lag(active_users) OVER w AS pu, lag(distinct_features_used) OVER w AS pf,
  CASE WHEN total_events >= 500 THEN 'power_user' WHEN total_events >= 100 THEN 'regular' WHEN total_events >= 20 THEN 'occasional'
    WHEN total_events > 0 THEN 'minimal' ELSE 'inactive' END AS intensity
  FROM use_month WINDOW w AS (PARTITION BY account_id ORDER BY month_start)""")
CHG = div("total_events - pe", "pe")
USE = f"""account_id, month_start, month_key, total_events, active_users, total_sessions, distinct_features_used, total_duration_seconds,
  {r(div('total_duration_seconds', 'timed'), 4)} AS avg_session_duration_seconds,
  {r(div('total_events', 'active_days_in_month'), 4)} AS avg_events_per_active_day, active_days_in_month, core_features_used,
  premium_features_used, feature_adoption_score, last_active_date, idle AS days_since_last_activity"""
check("usage_monthly", f"SELECT {USE} FROM use_flag")
check("usage_flags", f"""SELECT {USE}, {key('account_id', 'month_key')} AS account_month_key, pe AS prev_month_events, pu AS prev_month_active_users,
  pf AS prev_month_features_used, total_events - coalesce(pe, 0) AS events_mom_delta, {r(CHG, 6)} AS events_mom_pct_change,
  coalesce({CHG} < -0.4, false) AS has_usage_drop_flag, idle >= 14 AS has_no_login_flag, intensity AS usage_intensity FROM use_flag""")

# tickets
block("tix_month", """SELECT account_id, cast(date_trunc('month', created_day) AS date) AS month_start, count(*) AS total_tickets,
  count(*) FILTER (priority = 'critical') AS critical_tickets, count(*) FILTER (priority = 'high') AS high_tickets,
  count(*) FILTER (priority = 'medium') AS medium_tickets, count(*) FILTER (priority = 'low') AS low_tickets,
  count(*) FILTER (status IN ('open', 'in_progress')) AS open_tickets, count(*) FILTER (status = 'resolved') AS resolved_tickets,
  count(*) FILTER (status = 'escalated') AS escalated_tickets,
  count(*) FILTER (priority IN ('high', 'critical') AND status <> 'resolved') AS unresolved_high_priority,
  sum(csat_score)::double / nullif(count(csat_score), 0) AS csat, count(csat_score) AS csat_responses,
  count(*) FILTER (csat_score < 3) AS low_csat_count,
  CASE WHEN bool_or(solved) THEN 6.0::double END AS avg_resolution_hours, 1.0::double AS avg_first_response_hours FROM tix GROUP BY ALL""")
block("tix_flag", """SELECT *, strftime(month_start, '%Y-%m') AS month_key, lag(total_tickets) OVER (PARTITION BY account_id ORDER BY month_start) AS prior,
  cast(least(100, total_tickets * 5 + critical_tickets * 20 + high_tickets * 10 + unresolved_high_priority * 15 +
    CASE WHEN csat < 3 THEN 20 ELSE 0 END) AS integer) AS burden FROM tix_month""")
TIX = f"""account_id, month_start, month_key, total_tickets, critical_tickets, high_tickets, medium_tickets, low_tickets, open_tickets,
  resolved_tickets, escalated_tickets, unresolved_high_priority, {r('csat', 4)} AS avg_csat_score, csat_responses, low_csat_count,
  avg_resolution_hours, avg_first_response_hours, {r(div('escalated_tickets', 'total_tickets'), 6)} AS escalation_rate,
  {r(div('resolved_tickets', 'total_tickets'), 6)} AS resolution_rate"""
check("ticket_monthly", f"SELECT {TIX} FROM tix_flag")
check("ticket_burden", f"""SELECT {TIX}, {key('account_id', 'month_key')} AS account_month_key, prior AS prev_month_tickets,
  unresolved_high_priority >= 2 AS has_high_priority_flag, coalesce(csat < 3, false) AS has_low_csat_flag, burden AS support_burden_score,
  cast(100 - burden AS integer) AS support_health_score FROM tix_flag""")
check("invoice_monthly", """SELECT account_id, month_start, failed AS failed_payments, paid AS successful_payments,
  paid_amount::double AS total_invoiced_paid FROM inv_month""")

# health
block("sig", f"""SELECT d.account_id, d.company_name, d.industry, d.company_size, d.region, d.acquisition_channel, d.month_start,
  strftime(d.month_start, '%Y-%m') AS month_key, {gap('created_day', 'd.month_start')} AS months_since_created,
  strftime(created_day, '%Y-%m') AS cohort_month, d.mrr, d.prev_mrr, d.plan_name, d.util, d.seats_purchased, d.seats_used,
  coalesce(u.total_events, 0) AS total_events, coalesce(u.active_users, 0) AS active_users, coalesce(u.total_sessions, 0) AS total_sessions,
  coalesce(u.distinct_features_used, 0) AS distinct_features_used, coalesce(u.feature_adoption_score, 0) AS feature_adoption_score,
  coalesce(u.active_days_in_month, 0) AS active_days_in_month, u.last_active_date, coalesce(u.idle, 31) AS days_since_last_activity,
  coalesce(u.intensity, 'inactive') AS usage_intensity, coalesce({CHG} < -0.4, false) AS f_drop, coalesce(u.idle >= 14, true) AS f_idle,
  {CHG} AS chg, coalesce(t.total_tickets, 0) AS total_tickets, coalesce(t.open_tickets, 0) AS open_tickets,
  coalesce(t.unresolved_high_priority, 0) AS unresolved_high_priority, t.csat, coalesce(t.burden, 0) AS burden,
  coalesce(t.unresolved_high_priority >= 2, false) AS f_high, coalesce(t.csat < 3, false) AS f_csat,
  coalesce({div('t.escalated_tickets', 't.total_tickets')}, 0) AS esc, coalesce(i.failed, 0) AS failed_payments
  FROM dense d LEFT JOIN use_flag u USING (account_id, month_start) LEFT JOIN tix_flag t USING (account_id, month_start)
  LEFT JOIN inv_month i USING (account_id, month_start) WHERE d.mrr > 0""")
block("comp", """SELECT *, cast(CASE usage_intensity WHEN 'power_user' THEN 100 WHEN 'regular' THEN 80 WHEN 'occasional' THEN 50 WHEN 'minimal' THEN 20 ELSE 0 END AS integer) AS s1,
  cast(CASE WHEN util >= 0.8 THEN 100 WHEN util >= 0.6 THEN 80 WHEN util >= 0.4 THEN 60 WHEN util >= 0.25 THEN 40 ELSE 10 END AS integer) AS s2,
  least(100.0::double, feature_adoption_score * 10) AS s3, cast(100 - burden AS integer) AS s4,
  CASE WHEN csat IS NULL THEN 70.0::double ELSE (csat - 1) / 4 * 100 END AS s5,
  cast(CASE failed_payments WHEN 0 THEN 100 WHEN 1 THEN 50 ELSE 0 END AS integer) AS s6,
  cast(CASE WHEN months_since_created >= 24 THEN 100 WHEN months_since_created >= 12 THEN 80 WHEN months_since_created >= 6 THEN 60 WHEN months_since_created >= 3 THEN 40 ELSE 20 END AS integer) AS s7
  FROM sig""")
block("scored", f"""SELECT *, {r('s1::double * 0.25::double + s2::double * 0.2::double + s3 * 0.15::double + s4::double * 0.15::double + s5 * 0.1::double + s6::double * 0.1::double + s7::double * 0.05::double', 1)} AS hs,
  util < 0.25 AS f_seat, failed_payments > 0 AS f_pay,
  f_drop::integer + f_idle::integer + f_high::integer + (failed_payments > 0)::integer + f_csat::integer + (util < 0.25)::integer AS nf FROM comp""")
block("hlth", f"""SELECT *, CASE WHEN hs >= 80 THEN 'healthy' WHEN hs >= 60 THEN 'at_risk' WHEN hs >= 40 THEN 'high_risk' ELSE 'critical' END AS tier,
  CASE WHEN hs < 40 OR nf >= 4 THEN 'critical' WHEN hs < 60 OR nf >= 3 THEN 'high' WHEN hs < 75 OR nf >= 2 THEN 'medium'
    WHEN hs < 85 OR nf >= 1 THEN 'low' ELSE 'minimal' END AS lvl, {r('100 - hs', 1)} AS crs,
  concat_ws('|', CASE WHEN f_drop THEN 'Usage drop >40%' END, CASE WHEN f_idle THEN 'No login 14d' END, CASE WHEN f_high THEN '2+ high tickets' END,
    CASE WHEN f_pay THEN 'Payment failed' END, CASE WHEN f_csat THEN 'CSAT < 3' END, CASE WHEN f_seat THEN 'Seat util < 25%' END) AS reasons,
  concat_ws('|', CASE WHEN f_drop THEN 'usage_drop' END, CASE WHEN f_idle THEN 'no_login' END, CASE WHEN f_high THEN 'high_tickets' END,
    CASE WHEN f_pay THEN 'payment_failure' END, CASE WHEN f_csat THEN 'low_csat' END, CASE WHEN f_seat THEN 'low_seat_util' END) AS flags FROM scored""")
SIG = f"""{key('account_id', 'month_key')} AS account_month_key, account_id, company_name, industry, company_size, region, acquisition_channel, month_start, month_key,
  months_since_created, cohort_month, mrr::double AS mrr, prev_mrr::double AS prev_mrr, plan_name, {r('util', 6)} AS seat_utilization_rate,
  seats_purchased, seats_used, total_events, active_users, total_sessions, distinct_features_used, feature_adoption_score, active_days_in_month,
  last_active_date, days_since_last_activity, usage_intensity, f_drop AS has_usage_drop_flag, f_idle AS has_no_login_flag,
  {r('chg', 6)} AS events_mom_pct_change, total_tickets, open_tickets, unresolved_high_priority, {r('csat', 4)} AS avg_csat_score, burden AS support_burden_score,
  cast(100 - burden AS integer) AS support_health_score, f_high AS has_high_priority_flag, f_csat AS has_low_csat_flag,
  {r('esc', 6)} AS escalation_rate, failed_payments, failed_payments > 0 AS has_payment_failure"""
COMP = f"""s1 AS usage_score, s2 AS seat_util_score, s3 AS feature_score, s4 AS support_score, {r('s5', 4)} AS csat_score, s6 AS payment_score, s7 AS tenure_score"""
check("health_signals", f"SELECT {SIG} FROM sig")
check("health_components", f"SELECT account_id, month_start, {COMP} FROM comp")
check("fct_account_monthly_health", f"""SELECT {SIG}, {COMP}, hs AS health_score, f_drop AS risk_usage_drop, f_idle AS risk_no_login,
  f_high AS risk_high_tickets, f_pay AS risk_payment_failure, f_csat AS risk_low_csat, f_seat AS risk_low_seat_util, flags AS risk_flags,
  reasons AS risk_reasons, cast(nf AS integer) AS risk_flag_count, tier AS health_tier, lvl AS churn_risk_level, crs AS churn_risk_score FROM hlth""")
block("lin", """SELECT account_id, month_start, least(100.0::double, total_sessions::double / 100 * 100) AS a, util * 100 AS b,
  distinct_features_used::double / 12 * 100 AS c, greatest(0, 100 - open_tickets * 20)::double AS d, s5 AS e,
  greatest(0, 100 - failed_payments * 40)::double AS f, least(100.0::double, months_since_created::double / 24 * 100) AS g FROM comp""")
block("lin_s", f"SELECT *, {r('a * 0.25::double + b * 0.2::double + c * 0.15::double + d * 0.15::double + e * 0.1::double + f * 0.1::double + g * 0.05::double', 2)} AS hs FROM lin")
check("health_score_linear", f"""SELECT account_id, month_start, {r('a', 4)} AS usage_score, {r('b', 4)} AS seat_util_score, {r('c', 4)} AS feature_score,
  {r('d', 4)} AS support_score, {r('e', 4)} AS csat_score, {r('f', 4)} AS payment_score, {r('g', 4)} AS tenure_score, hs AS health_score,
  CASE WHEN hs >= 75 THEN 'healthy' WHEN hs >= 50 THEN 'at_risk' ELSE 'critical' END AS risk_level FROM lin_s""")

# funnel
block("first_paid", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY start_date, subscription_id) AS rn
  FROM subs WHERE status <> 'trial') WHERE rn = 1""")
block("fun", """SELECT l.*, f.subscription_id, f.plan_name AS converted_plan, f.mrr AS converted_sub_mrr, f.start_date AS paid_day,
  CASE WHEN converted_day IS NOT NULL OR f.start_date IS NOT NULL THEN 'paid' WHEN trial_started_day IS NOT NULL THEN 'trial'
    WHEN demo_completed_day IS NOT NULL THEN 'demo_completed' WHEN demo_requested_day IS NOT NULL THEN 'demo_requested'
    WHEN qualified_day IS NOT NULL THEN 'qualified' WHEN lost_day IS NOT NULL THEN 'lost' ELSE 'lead' END AS stage,
  converted_day IS NOT NULL OR f.start_date IS NOT NULL AS won, cast(f.start_date - created_day AS integer) AS d_paid,
  coalesce(converted_day, f.start_date) AS won_day FROM lead_rows l LEFT JOIN first_paid f USING (account_id)""")
VEL = """CASE WHEN d_paid IS NULL THEN 'in_progress' WHEN d_paid <= 14 THEN 'fast' WHEN d_paid <= 30 THEN 'normal' WHEN d_paid <= 60 THEN 'slow' ELSE 'very_slow' END"""
ORD = """cast(CASE stage WHEN 'lost' THEN 0 WHEN 'lead' THEN 1 WHEN 'qualified' THEN 2 WHEN 'demo_requested' THEN 3 WHEN 'demo_completed' THEN 4 WHEN 'trial' THEN 5 ELSE 6 END AS integer)"""
check("funnel_progression", f"""SELECT lead_id, account_id, acquisition_channel, industry, company_size, lead_score, trial_engagement_score,
  created_day::timestamp AS lead_created_at, qualified_day::timestamp AS qualified_at, demo_requested_day::timestamp AS demo_requested_at,
  demo_completed_day::timestamp AS demo_completed_at, trial_started_day::timestamp AS trial_started_at, trial_ended_day::timestamp AS trial_ended_at,
  won_day::timestamp AS paid_converted_at, lost_day::timestamp AS lost_at, subscription_id, converted_plan, converted_sub_mrr::double AS converted_mrr,
  paid_day::timestamp AS paid_started_at, stage AS funnel_stage, {ORD} AS funnel_stage_order, true AS is_lead, qualified_day IS NOT NULL AS is_qualified,
  demo_requested_day IS NOT NULL AS is_demo_requested, demo_completed_day IS NOT NULL AS is_demo_completed, trial_started_day IS NOT NULL AS is_trial,
  won AS is_paid, lost_day IS NOT NULL AS is_lost, cast(qualified_day - created_day AS integer) AS days_lead_to_qualified,
  cast(demo_completed_day - qualified_day AS integer) AS days_qualified_to_demo, cast(trial_started_day - demo_completed_day AS integer) AS days_demo_to_trial,
  cast(trial_started_day - created_day AS integer) AS days_lead_to_trial, cast(paid_day - trial_started_day AS integer) AS days_trial_to_paid,
  d_paid AS days_lead_to_paid, cast(trial_ended_day - trial_started_day AS integer) AS trial_duration_days, {VEL} AS conversion_velocity,
  strftime(created_day, '%Y-%m') AS lead_month, strftime(trial_started_day, '%Y-%m') AS trial_month, strftime(won_day, '%Y-%m') AS conversion_month FROM fun""")
block("act_sub", """SELECT account_id, min(start_date) AS first_sub_date, sum(mrr) AS amrr, max(plan_name) AS aplan FROM subs WHERE status = 'active' GROUP BY account_id""")
block("conv", f"""SELECT f.lead_id, f.account_id, f.acquisition_channel, stage, f.created_day, trial_started_day, won_day, won, lost_day, d_paid,
  f.trial_engagement_score, lead_score, coalesce(a.company_name, 'Unknown') AS company_name, coalesce(a.company_size, 'unknown') AS company_size,
  coalesce(a.industry, 'unknown') AS industry, coalesce(a.region, 'unknown') AS region, first_sub_date, coalesce(amrr, 0) AS fm,
  coalesce(aplan, converted_plan) AS plan_name, CASE WHEN won THEN coalesce(amrr, 0) ELSE 0 END AS cmrr, strftime(f.created_day, '%Y-%m') AS mk
  FROM fun f LEFT JOIN accounts_raw a ON a.account_id = f.account_id LEFT JOIN act_sub s ON s.account_id = f.account_id""")
block("conv_sum", f"""SELECT mk, acquisition_channel, company_size, plan_name, count(*) AS total_leads, count(trial_started_day) AS trial_starts,
  count(*) FILTER (won) AS paid_conversions, count(lost_day) AS lost_leads, {r(div('count(trial_started_day)', 'count(*)'), 4)} AS lead_to_trial_rate,
  {r(div('count(*) FILTER (won)', 'count(trial_started_day)'), 4)} AS trial_to_paid_rate, {r(div('count(*) FILTER (won)', 'count(*)'), 4)} AS overall_conversion_rate,
  {r(div('sum(d_paid) FILTER (won)', 'count(d_paid) FILTER (won)'), 1)} AS avg_days_to_convert,
  {r(div('sum(trial_engagement_score) FILTER (trial_started_day IS NOT NULL)', 'count(trial_started_day)'), 1)} AS avg_trial_engagement,
  sum(cmrr)::double AS total_converted_mrr, {r(div('sum(fm) FILTER (won)', 'count(*) FILTER (won)'), 2)} AS avg_first_month_mrr FROM conv GROUP BY ALL""")
check("conversion_monthly", "SELECT * EXCLUDE (mk), mk AS month_key FROM conv_sum")
check("fct_sales_conversion", f"""SELECT {key('lead_id')} AS conversion_key, lead_id, account_id, c.acquisition_channel, stage AS funnel_stage, {ORD} AS funnel_stage_order,
  created_day::timestamp AS lead_created_at, trial_started_day::timestamp AS trial_started_at, won_day::timestamp AS paid_converted_at,
  mk AS lead_created_month, strftime(trial_started_day, '%Y-%m') AS trial_started_month, strftime(won_day, '%Y-%m') AS paid_converted_month,
  true AS is_lead, trial_started_day IS NOT NULL AS is_trial, won AS is_paid_conversion, lost_day IS NOT NULL AS is_lost,
  cast(trial_started_day - created_day AS integer) AS days_lead_to_trial, cast(d_paid - (trial_started_day - created_day) AS integer) AS days_trial_to_paid,
  d_paid AS days_lead_to_paid, {VEL} AS conversion_velocity, {VEL} AS sales_cycle_bucket, trial_engagement_score, lead_score, company_name, c.company_size, industry, region,
  first_sub_date, fm::double AS first_month_mrr, c.plan_name, cmrr::double AS converted_mrr, (cmrr * 12)::double AS converted_arr,
  CASE WHEN trial_engagement_score >= 80 THEN 'high_engagement' WHEN trial_engagement_score >= 50 THEN 'medium_engagement'
    WHEN trial_engagement_score >= 20 THEN 'low_engagement' WHEN trial_engagement_score IS NOT NULL THEN 'minimal_engagement' ELSE 'no_trial' END AS trial_quality,
  total_leads AS channel_month_total_leads, trial_starts AS channel_month_trial_starts, paid_conversions AS channel_month_paid_conversions,
  lead_to_trial_rate AS channel_lead_to_trial_rate, trial_to_paid_rate AS channel_trial_to_paid_rate, overall_conversion_rate AS channel_overall_conversion_rate,
  avg_days_to_convert AS channel_avg_days_to_convert, avg_trial_engagement AS channel_avg_trial_engagement,
  total_converted_mrr AS channel_month_converted_mrr, avg_first_month_mrr AS channel_avg_first_month_mrr
  FROM conv c JOIN conv_sum s ON s.mk = c.mk AND s.acquisition_channel = c.acquisition_channel AND s.company_size = c.company_size
    AND s.plan_name IS NOT DISTINCT FROM c.plan_name""".replace("SELECT md5", "SELECT md5", 1).replace(" mk AS lead_created_month", " c.mk AS lead_created_month"))
check("conversion_simple", """SELECT lead_id, created_day AS lead_date, trial_started_day AS trial_start_date, converted_day AS converted_date,
  acquisition_channel, company_size, industry, trial_started_day IS NOT NULL AS had_trial, converted_day IS NOT NULL AS converted,
  cast(trial_started_day - created_day AS integer) AS days_lead_to_trial, cast(converted_day - trial_started_day AS integer) AS days_trial_to_paid,
  cast(converted_day - created_day AS integer) AS days_lead_to_paid FROM lead_rows""")

# success
block("ranked", "SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY month_start DESC) AS rk FROM hlth")
block("trend", """SELECT account_id, max(hs) FILTER (rk = 1) AS h0, max(hs) FILTER (rk = 2) AS h1, max(hs) FILTER (rk = 3) AS h2, max(mrr) FILTER (rk = 3) AS m2,
  max(total_events) FILTER (rk = 2) AS e1, max(total_events) FILTER (rk = 3) AS e2 FROM ranked WHERE rk <= 3 GROUP BY account_id""")
TREND = "CASE WHEN h0 > coalesce(h1, h0) + 5 THEN 'improving' WHEN h0 < coalesce(h1, h0) - 5 THEN 'declining' ELSE 'stable' END"
check("health_trend", f"""SELECT account_id, h2 AS health_score_3m_ago, h1 AS health_score_1m_ago, m2::double AS mrr_3m_ago, e2 AS events_3m_ago,
  e1 AS events_1m_ago, {TREND} AS health_trend FROM trend""")
block("life", """SELECT account_id, min(start_date) AS first_subscription_date, max(end_date) AS latest_subscription_date, sum(mrr) AS lm,
  count(DISTINCT subscription_id) AS total_subscriptions FROM subs GROUP BY account_id""")
check("account_lifetime", """SELECT account_id, first_subscription_date, latest_subscription_date, lm::double AS lifetime_mrr_sum, total_subscriptions FROM life""")
block("ctx", """SELECT account_id, cohort_month, max(rs) FILTER (period = 3) AS r3, max(rs) FILTER (period = 6) AS r6, max(rs) FILTER (period = 12) AS r12
  FROM coh GROUP BY ALL""")
check("cohort_context", """SELECT account_id, cohort_month, r3 AS retention_status_3m, r6 AS retention_status_6m, r12 AS retention_status_12m FROM ctx""")
block("css", f"""SELECT {key('l.account_id')} AS customer_success_key, l.account_id, company_name, industry, company_size, region, l.acquisition_channel,
  plan_name, month_start AS snapshot_date, month_key AS snapshot_month, months_since_created, l.cohort_month, mrr::double AS mrr, (mrr * 12)::double AS arr,
  prev_mrr::double AS prev_mrr, (mrr - prev_mrr)::double AS mrr_delta, seats_purchased, seats_used, {r('util', 3)} AS seat_utilization_rate, total_events,
  active_users, distinct_features_used, {r('feature_adoption_score', 1)} AS feature_adoption_score, active_days_in_month, last_active_date,
  days_since_last_activity, usage_intensity, {r('coalesce(chg, 0)', 2)} AS events_mom_pct_change, total_tickets, unresolved_high_priority,
  {r('coalesce(csat, 0)', 2)} AS avg_csat_score, burden AS support_burden_score, s4 AS support_health_score, {r('esc', 3)} AS escalation_rate,
  failed_payments, hs AS health_score, tier AS health_tier, lvl AS churn_risk_level, crs AS churn_risk_score, cast(nf AS integer) AS risk_flag_count,
  flags AS risk_flags, reasons AS risk_reasons, f_drop AS risk_usage_drop, f_idle AS risk_no_login, f_high AS risk_high_tickets, f_pay AS risk_payment_failure,
  f_csat AS risk_low_csat, f_seat AS risk_low_seat_util, s1 AS usage_score, s2 AS seat_util_score, {r('s3', 1)} AS feature_score, s4 AS support_score,
  {r('s5', 1)} AS csat_score, s6 AS payment_score, s7 AS tenure_score, coalesce(h1, hs) AS health_score_1m_ago, coalesce(h2, hs) AS health_score_3m_ago,
  {r('hs - coalesce(h1, hs)', 1)} AS health_score_mom_delta, {r('hs - coalesce(h2, hs)', 1)} AS health_score_3m_delta, {TREND} AS health_trend,
  coalesce(e2, 0) AS events_3m_ago, coalesce(e1, 0) AS events_1m_ago, first_subscription_date, total_subscriptions, lm::double AS lifetime_mrr_sum,
  coalesce(w.ch, l.acquisition_channel) AS lead_channel, w.dtc AS days_to_convert, {r('coalesce(w.eng, 0)', 1)} AS trial_engagement_score,
  r3 AS retention_status_3m, r6 AS retention_status_6m, r12 AS retention_status_12m,
  {r('crs * 0.5::double + mrr::double * 0.0001::double + nf * 5', 1)} AS risk_priority_score
  FROM ranked l JOIN trend t ON t.account_id = l.account_id LEFT JOIN life ON life.account_id = l.account_id
  LEFT JOIN ctx ON ctx.account_id = l.account_id
  LEFT JOIN (SELECT account_id, max(acquisition_channel) AS ch, max(d_paid) AS dtc, max(trial_engagement_score) AS eng FROM conv
    WHERE won AND account_id IS NOT NULL GROUP BY account_id) w ON w.account_id = l.account_id WHERE rk = 1""")
check("mart_customer_success_summary", "SELECT * FROM css")
check("latest_snapshot_simple", """SELECT account_id, month_key AS snapshot_month, company_name, hs AS health_score, tier AS health_tier, lvl AS churn_risk_level,
  mrr::double AS mrr, plan_name, company_size, region, industry, reasons AS risk_reasons, acquisition_channel, crs AS risk_priority_score,
  (mrr * 12)::double AS arr, CASE WHEN hs >= 70 THEN 'improving' WHEN hs >= 50 THEN 'stable' ELSE 'declining' END AS health_trend FROM ranked WHERE rk = 1""")
check("cs_monthly_rollup", f"""SELECT month_start, count(*) FILTER (tier = 'healthy') AS healthy_accounts, count(*) FILTER (tier = 'at_risk') AS at_risk_accounts,
  count(*) FILTER (tier = 'high_risk') AS high_risk_accounts, count(*) FILTER (tier = 'critical') AS critical_accounts,
  {r(div('sum(cast(hs AS decimal(38,12)))', 'count(*)'), 2)} AS avg_health_score, count(*) FILTER (f_drop) AS accounts_usage_drop,
  count(*) FILTER (f_idle) AS accounts_no_login, count(*) FILTER (f_high) AS accounts_high_tickets, count(*) FILTER (f_pay) AS accounts_payment_failure,
  count(*) FILTER (f_csat) AS accounts_low_csat, count(*) FILTER (f_seat) AS accounts_low_seat_util, cast(sum(open_tickets) AS bigint) AS total_open_tickets,
  {r(div('sum(cast(csat AS decimal(38,12)))', 'count(csat)'), 1)} AS avg_csat_score, {r(div('sum(total_sessions)', 'count(*)'), 2)} AS avg_monthly_sessions,
  {r(div('sum(cast(util AS decimal(38,12)))', 'count(*)'), 4)} AS avg_seat_utilization, {r(div('sum(distinct_features_used)', 'count(*)'), 2)} AS avg_features_used
  FROM hlth GROUP BY month_start""")
