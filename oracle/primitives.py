"""Statements for relational shapes, scalar functions, quality checks and glossary measures."""

from oracle.base import ASOF, CHECKS, block, check, div, div0, key, r
from oracle.customers import AGE
from oracle.quality_rules import MART_CHECKS

# joins
check("join_inner", """SELECT subscription_id, account_id, region, plan_name, monthly_price::double AS monthly_price, mrr::double AS mrr
  FROM subs JOIN accounts_raw USING (account_id) JOIN plans_t USING (plan_name)""")
check("join_left_multi", """SELECT account_id, month_start, d.mrr::double AS mrr, coalesce(e.n, 0) AS events, coalesce(t.total_tickets, 0) AS tickets,
  coalesce(i.failed, 0) AS failed_payments FROM dense d LEFT JOIN (SELECT account_id, cast(date_trunc('month', event_day) AS date) AS month_start, count(*) AS n FROM usage GROUP BY ALL) e USING (account_id, month_start)
  LEFT JOIN tix_month t USING (account_id, month_start) LEFT JOIN inv_month i USING (account_id, month_start)""")
THETA = f"""SELECT subscription_id, month_start FROM subs JOIN (SELECT DISTINCT month_start FROM grid) ON month_start >= date_trunc('month', start_date)
  AND month_start <= least(coalesce(end_date, {ASOF}), {ASOF})"""
check("join_month_spine", THETA)
check("join_theta_spine", THETA)
check("join_truncated_key", """SELECT account_id, cast(date_trunc('month', event_day) AS date) AS month_start, strftime(event_day, '%Y-%m') AS month_key, count(*) AS events
  FROM usage GROUP BY ALL""")
check("join_shifted_self", """SELECT a.account_id, a.month_start, a.mrr::double AS mrr, b.mrr::double AS next_mrr FROM acct_month a JOIN acct_month b
  ON b.account_id = a.account_id AND b.month_start = a.month_start + INTERVAL 1 MONTH""")
check("join_anti_correlated", """SELECT account_id, month_start, mrr::double AS mrr FROM acct_month a WHERE mrr > 0 AND NOT EXISTS (SELECT 1 FROM acct_month b
  WHERE b.account_id = a.account_id AND b.month_start = a.month_start + INTERVAL 1 MONTH AND b.mrr > 0)""")
check("join_anti_fk", """SELECT invoice_id, subscription_id, amount::double AS amount FROM inv i WHERE NOT EXISTS (SELECT 1 FROM subs s WHERE s.subscription_id = i.subscription_id)""")
check("join_semi", """SELECT event_id, account_id, event_type FROM usage WHERE account_id IN (SELECT account_id FROM inv WHERE status = 'failed')""")
check("join_null_coalesced", """SELECT lead_id, aplan AS plan_name, count(*) OVER (PARTITION BY aplan) AS group_size FROM lead_rows LEFT JOIN act_sub USING (account_id)""")
check("join_left_on_filter", """SELECT a.account_id, count(t.ticket_id) AS critical_tickets FROM accounts_raw a LEFT JOIN tix t ON t.account_id = a.account_id AND t.priority = 'critical' GROUP BY 1""")
check("join_scalar_subquery", """SELECT account_id, month_start, mrr::double AS mrr, plan_name FROM acct_month WHERE month_start = (SELECT max(month_start) FROM acct_month)""")
check("join_left_first_match", """SELECT lead_id, account_id, f.subscription_id, f.plan_name AS converted_plan, f.mrr::double AS converted_mrr, f.start_date::timestamp AS paid_started_at
  FROM lead_rows LEFT JOIN first_paid f USING (account_id)""")


def change(c):
    return r(f"CASE WHEN lag({c}) OVER w > 0 THEN ({c} - lag({c}) OVER w) / lag({c}) OVER w ELSE 0 END", 6)


check("join_update_from", f"""SELECT month_start, total_mrr, active_accounts, {change('total_mrr')} AS mrr_mom_change, {change('active_accounts')} AS accounts_mom_change
  FROM exec WINDOW w AS (ORDER BY month_start)""")
check("fn_refresh_exec_summary", f"""SELECT month_start, total_mrr, total_arr, active_accounts, {change('total_mrr')} AS mrr_mom_change, {change('total_arr')} AS arr_mom_change,
  {change('active_accounts')} AS accounts_mom_change FROM exec WINDOW w AS (ORDER BY month_start)""")
check("join_denormalize_back", f"""SELECT subscription_id, plan_name, status, mrr::double AS mrr, count(*) OVER w AS group_rows, (sum(mrr) OVER w)::double AS group_mrr,
  {r(div('mrr', 'sum(mrr) OVER w'), 8)} AS mrr_share FROM subs WINDOW w AS (PARTITION BY plan_name, status)""")

# aggregations
check("agg_sum_count_avg", f"""SELECT plan_name, sum(mrr)::double AS total, count(*) AS n, {r(div('sum(mrr)', 'count(*)'), 2)} AS mean, min(mrr)::double AS low, max(mrr)::double AS high FROM subs GROUP BY 1""")
check("agg_conditional_count", "SELECT account_id, " + ", ".join(f"count(*) FILTER (priority = '{p}') AS n_{p}" for p in ("low", "medium", "high", "critical")) + " FROM tix GROUP BY 1")
check("agg_conditional_sum", "SELECT account_id, " + ", ".join(f"coalesce(sum(amount) FILTER (status = '{p}'), 0)::double AS {p}_amount" for p in ("paid", "failed", "pending")) + " FROM inv GROUP BY 1")
check("agg_filter_clause", """SELECT account_id, count(CASE WHEN status = 'paid' THEN 1 END) AS paid_invoices, sum(CASE WHEN status = 'failed' THEN amount END)::double AS failed_amount,
  max(CASE WHEN status = 'paid' THEN paid_date END) AS last_paid FROM inv GROUP BY 1""")
check("agg_count_distinct", """SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions, count(DISTINCT account_id) AS accounts, count(DISTINCT event_day) AS days FROM usage GROUP BY 1""")
check("agg_count_distinct_if", """SELECT strftime(invoice_date, '%Y-%m') AS month_key, count(DISTINCT account_id) FILTER (status = 'failed') AS failing_accounts,
  count(DISTINCT account_id) FILTER (status = 'paid') AS paying_accounts FROM inv GROUP BY 1""")
check("agg_sum_distinct", "SELECT account_id, cast(sum(DISTINCT seats_purchased) AS bigint) AS distinct_seat_sum FROM subs GROUP BY 1")
check("agg_mode", """SELECT region, mode(industry ORDER BY industry) AS top_industry, mode(company_size ORDER BY company_size) AS top_size, mode(acquisition_channel ORDER BY acquisition_channel) AS top_channel
  FROM accounts_raw GROUP BY 1""")
check("agg_median", "SELECT strftime(invoice_date, '%Y-%m') AS month_key, quantile_cont(paid_date - invoice_date, 0.5)::double AS median_days FROM inv GROUP BY 1")
check("agg_ratio", f"""SELECT account_id, {r(div("sum(CASE WHEN status = 'paid' THEN amount END)", 'sum(amount)'), 6)} AS collection_rate,
  {r(div("count(*) FILTER (status = 'failed')", 'count(*)'), 6)} AS failure_rate FROM inv GROUP BY 1""")
DUPS = "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1"
check("agg_having_dups", DUPS)
check("agg_global", """SELECT count(*) AS subscriptions, sum(mrr)::double AS mrr, count(*) FILTER (status = 'trial') AS trials, min(start_date) AS first_start, max(start_date) AS last_start FROM subs""")
check("agg_pct_of_total", f"SELECT plan_name, sum(mrr)::double AS mrr, {r(div('sum(mrr)', '(SELECT sum(mrr) FROM subs)') + '*100', 2)} AS pct_of_total FROM subs GROUP BY 1")
block("ch_mean", f"SELECT acquisition_channel AS ch, {r(div('sum(mrr)', 'count(*)'), 2)} AS m FROM subs JOIN accounts_raw USING (account_id) GROUP BY 1")
check("agg_avg_of_groups", f"""SELECT {r(div('sum(cast(m AS decimal(38,12)))', 'count(*)'), 2)} AS mean_of_means, list_sort(list(m))[cast(floor(count(*) / 2.0) AS integer) + 1] AS middle_mean FROM ch_mean""")
check("agg_explode_count", "SELECT unnest(string_split(flags, '|')) AS reason, count(*) AS n, sum(mrr)::double AS mrr FROM hlth WHERE flags <> '' GROUP BY 1"
      .replace("SELECT unnest(string_split(flags, '|')) AS reason, count(*) AS n, sum(mrr)::double AS mrr FROM hlth WHERE flags <> '' GROUP BY 1",
               "SELECT reason, count(*) AS n, sum(mrr)::double AS mrr FROM (SELECT unnest(string_split(flags, '|')) AS reason, mrr FROM hlth WHERE flags <> '') GROUP BY 1"))
check("agg_pivot_case", "SELECT priority, " + ", ".join(f"count(*) FILTER (status = '{p}') AS {p}" for p in ("open", "in_progress", "escalated", "resolved")) + " FROM tix GROUP BY 1")
check("agg_multi_dim", "SELECT company_size, acquisition_channel, region, industry, plan_name, count(*) AS subscriptions, sum(mrr)::double AS mrr FROM subs JOIN accounts_raw USING (account_id) GROUP BY ALL")
check("agg_argmax", """SELECT region, best_channel, mrr::double AS mrr FROM (SELECT region, acquisition_channel AS best_channel, sum(mrr) AS mrr,
  row_number() OVER (PARTITION BY region ORDER BY sum(mrr) DESC, acquisition_channel) AS rn FROM subs JOIN accounts_raw USING (account_id) GROUP BY 1, 2) WHERE rn = 1""")

# windows, ordering, sets
check("win_lag_partition", "SELECT account_id, month_start, mrr::double AS mrr, (lag(mrr) OVER (PARTITION BY account_id ORDER BY month_start))::double AS prev_mrr FROM acct_month")
check("win_lag_global", "SELECT month_start, total_mrr, lag(total_mrr) OVER (ORDER BY month_start) AS prev_total_mrr FROM exec")
check("win_row_number", "SELECT account_id, month_start, cast(row_number() OVER (PARTITION BY account_id ORDER BY month_start) AS integer) AS month_rank FROM acct_month")
check("win_latest_n", """SELECT account_id, month_start, mrr::double AS mrr, cast(row_number() OVER (PARTITION BY account_id ORDER BY month_start DESC) AS integer) AS month_rank FROM acct_month
  QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY month_start DESC) <= 3""")
check("win_distinct_on_first", "SELECT DISTINCT ON (account_id) account_id, start_date, subscription_id, plan_name FROM subs ORDER BY account_id, start_date, subscription_id")
check("win_distinct_on_latest", "SELECT DISTINCT ON (account_id) account_id, start_date, subscription_id, plan_name FROM subs ORDER BY account_id, start_date DESC, subscription_id DESC")
check("win_top_per_month", """SELECT month_key, account_id, expansion_mrr::double AS expansion_mrr, cast(row_number() OVER w AS integer) AS expansion_rank FROM moves WHERE expansion_mrr > 0
  QUALIFY row_number() OVER w <= 10 WINDOW w AS (PARTITION BY month_key ORDER BY expansion_mrr DESC, account_id)""".replace(
    "QUALIFY row_number() OVER w <= 10 WINDOW w AS (PARTITION BY month_key ORDER BY expansion_mrr DESC, account_id)",
    "WINDOW w AS (PARTITION BY month_key ORDER BY expansion_mrr DESC, account_id) QUALIFY row_number() OVER w <= 10"))
check("win_lag_before_limit", "SELECT month_key, total_mrr, lag(total_mrr) OVER (ORDER BY month_key) AS starting_mrr FROM exec ORDER BY month_key DESC LIMIT 6")
check("win_running_total", """SELECT month_start, c::double AS collected, (sum(c) OVER (ORDER BY month_start))::double AS cumulative FROM
  (SELECT cast(date_trunc('month', invoice_date) AS date) AS month_start, sum(amount) AS c FROM inv WHERE status = 'paid' GROUP BY 1)""")
check("win_prior_activity", "SELECT account_id, month_start, mrr::double AS mrr, seen AS paid_before FROM dense")
check("sort_nulls_last", f"""SELECT account_id, month_start, {r(div('total_events - pe', 'pe'), 6)} AS events_mom_pct_change,
  row_number() OVER (ORDER BY {r(div('total_events - pe', 'pe'), 6)} DESC NULLS LAST, account_id, month_start) AS position FROM use_flag""")
check("topk_limit", "SELECT subscription_id, account_id, mrr::double AS mrr FROM subs ORDER BY subs.mrr DESC, subscription_id LIMIT 20")
check("page_offset", "SELECT subscription_id, mrr::double AS mrr, start_date, (SELECT count(*) FROM subs) AS total_count FROM subs ORDER BY start_date DESC, subscription_id LIMIT 50 OFFSET 100")
check("last_n_months_asc", "SELECT month_key, total_mrr FROM exec ORDER BY month_key DESC LIMIT 12")
check("sort_abs", "SELECT account_id, month_start, delta::double AS net_mrr_contribution, row_number() OVER (ORDER BY abs(delta) DESC, account_id, month_start) AS position FROM moves")
check("sort_multi", "SELECT account_id, month_start, hs AS health_score, h.mrr::double AS mrr, row_number() OVER (ORDER BY hs, h.mrr DESC, account_id, month_start) AS position FROM hlth h")
check("union_all_typed_nulls", """SELECT account_id, month_start, mrr::double AS mrr, mtype AS mrr_movement_type, plan_now AS plan_name, mtype = 'churned' AS is_churned FROM moves""")
check("distinct_months", "SELECT DISTINCT cast(date_trunc('month', start_date) AS date) AS month_start FROM subs")
check("distinct_sorted_values", "SELECT DISTINCT strftime(created_day, '%Y-%m') AS cohort_month FROM accounts_raw")
check("tenant_filter", """SELECT industry AS tenant_id, account_id, count(*) AS subscriptions, sum(mrr)::double AS mrr FROM subs JOIN accounts_raw USING (account_id)
  WHERE industry = 'automobile' GROUP BY 1, 2""")

# scalar functions
check("scalar_string", """SELECT c_custkey, c_name AS trimmed, lower(c_name) AS lowered, upper(c_mktsegment) AS uppered, split_part(c_name, '#', 2) AS part,
  c_name || ' / ' || c_mktsegment AS joined, trim('|' || c_name || '||', '|') AS unpiped, c_name LIKE '%#00%' AS is_like, replace(c_name, '#', '_') AS replaced,
  substr(c_name, 1, 4) AS head, suffix(c_name, '7') AS ends FROM customer""")
block("od", "SELECT o_orderkey, cast(o_orderdate AS date) AS d FROM orders")
I = lambda e: f"cast({e} AS integer)"
check("scalar_date_parts", f"""SELECT o_orderkey, {I('year(d)')} AS y, {I('month(d)')} AS m, {I('day(d)')} AS dom, {I('dayofweek(d)')} AS dow, {I('dayofyear(d)')} AS doy,
  {I('weekofyear(d)')} AS week, {I('quarter(d)')} AS q FROM od""")
check("scalar_date_trunc", """SELECT o_orderkey, cast(date_trunc('month', d) AS date) AS month_start, cast(date_trunc('quarter', d) AS date) AS quarter_start,
  cast(date_trunc('week', d) AS date) AS week_start, d AS day_start FROM od""")
check("scalar_date_format", """SELECT o_orderkey, strftime(d, '%Y-%m') AS month_key, strftime(d, '%b %Y') AS short_label, strftime(d, '%B %Y') AS long_label, strftime(d, '%A') AS day_long,
  strftime(d, '%a') AS day_short, year(d) || '-Q' || quarter(d) AS quarter_key FROM od""")
check("scalar_date_arith", f"""SELECT subscription_id, last_day(start_date) AS month_end, cast(start_date + INTERVAL 3 MONTH AS date) AS plus_3, {I('end_date - start_date')} AS days,
  {AGE('start_date', 'end_date')} AS months, cast(end_date - start_date AS bigint) * 24 AS hours FROM subs""")
check("scalar_math", f"""SELECT c_custkey, abs(c_acctbal) AS absolute, {r('c_acctbal / 7', 2)} AS rounded, least(5000.0::double, c_acctbal) AS capped, greatest(0.0::double, c_acctbal) AS floored,
  greatest(0.0::double, least(50.0::double, c_acctbal / 100)) AS clamped, {I('c_acctbal > 0')} AS flag, {r('(c_custkey % 5)::double / 4 * 100', 2)} AS normalised FROM customer""")
check("scalar_null", f"""SELECT invoice_id, coalesce(paid_date, due_date) AS settled, nullif(status, 'failed') AS not_failed, {r(div('amount', 'paid_date - invoice_date'), 4)} AS per_day,
  {r(div0('amount', 'paid_date - invoice_date'), 4)} AS per_day_or_zero, coalesce(failed_date, DATE '1970-01-01') AS failed_or_epoch FROM inv""")
check("scalar_case", f"""SELECT subscription_id, cast(tier AS integer) AS tier, CASE WHEN seats_purchased >= 40 THEN 'xl' WHEN seats_purchased >= 20 THEN 'l' WHEN seats_purchased >= 5 THEN 'm' ELSE 's' END AS seat_band,
  CASE WHEN end_date IS NULL THEN 'open' WHEN end_date < {ASOF} THEN 'ended' ELSE 'running' END AS phase FROM subs JOIN plans_t USING (plan_name)""")
check("scalar_cast", """SELECT ticket_id, csat_score::double AS csat_score, status = 'escalated' AS is_escalated, created_day FROM tix
  UNION ALL SELECT NULL, NULL, status = 'escalated', NULL FROM tix""")
check("scalar_surrogate_key", f"SELECT invoice_id, {key('invoice_id', 'account_id', 'paid_date')} AS key_3 FROM inv")
check("scalar_array_reasons", """SELECT ticket_id, cast(urgent::integer + esc::integer + unhappy::integer + (NOT solved)::integer AS integer) AS n, urgent AS is_urgent,
  concat_ws('|', CASE WHEN urgent THEN 'urgent' END, CASE WHEN esc THEN 'escalated' END, CASE WHEN unhappy THEN 'unhappy' END, CASE WHEN NOT solved THEN 'unresolved' END) AS shown
  FROM (SELECT *, priority IN ('high', 'critical') AS urgent, status = 'escalated' AS esc, coalesce(csat_score < 3, false) AS unhappy FROM tix)""")
check("scalar_json", "SELECT event_id, cast(props->>'$.k' AS integer) AS k, cast(props->>'$.k' AS integer) AS k_typed, 'none' AS first_tag FROM events")
check("scalar_epoch", "SELECT event_id, date_trunc('second', ts) AS at, NULL::timestamp AS bad FROM events")
check("scalar_safe_parse", """SELECT event_id, coalesce(try_cast(props->>'$.k' AS double), 0) AS as_float, coalesce(try_cast(props->>'$.k' AS integer), 0) AS as_int,
  0::double AS float_default, cast(7 AS integer) AS int_default FROM events""")


def short(e):
    big = r(f"({e}) / 1000000", 1)
    mid = r(f"({e}) / 1000", 1)
    return (f"CASE WHEN {e} >= 1000000 THEN '$' || printf('%.1f', {big}) || 'm' WHEN {e} >= 1000 THEN '$' || printf('%.1f', {mid}) || 'k' "
            f"ELSE '$' || printf('%.0f', {r(e, 0)}) END")


check("scalar_format", f"""SELECT o_orderkey, {short('o_totalprice')} AS small, {short('o_totalprice * 12')} AS large,
  CASE WHEN o_totalprice - 200000 >= 0 THEN '+' ELSE '-' END || {short('abs(o_totalprice - 200000)')} AS delta, printf('%.1f', {r('o_totalprice / 400000 * 100', 1)}) || '%' AS pct,
  'M' || (o_orderkey % 13) AS period, CASE WHEN q >= 0.9 THEN '#10b981' WHEN q >= 0.75 THEN '#f59e0b' WHEN q >= 0.5 THEN '#f97316' ELSE '#ef4444' END AS retention,
  CASE WHEN q >= 1.1 THEN '#10b981' WHEN q >= 1.0 THEN '#3b82f6' WHEN q >= 0.9 THEN '#f59e0b' ELSE '#ef4444' END AS nrr FROM (SELECT *, o_totalprice / 400000 AS q FROM orders)""")
check("scalar_pct", f"SELECT l_orderkey, l_linenumber, l_partkey, {r('coalesce(l_discount, 0) * 100', 2)} AS discount_pct FROM lineitem")

# callables
check("fn_mrr_for_month", "SELECT sum(mrr)::double AS mrr FROM moves WHERE month_start = DATE '2001-06-01' AND mtype <> 'churned'")
check("fn_compute_nrr", f"""SELECT {r(div0('sum(prev_mrr) + sum(expansion_mrr) + sum(reactivation_mrr) - sum(contraction_mrr) - sum(churned_mrr)', 'sum(prev_mrr)', '1.0'), 6)} AS nrr
  FROM moves WHERE month_start = DATE '2001-06-01'""")
check("fn_health_score_label", "SELECT CASE WHEN hs >= 75 THEN 'Healthy' WHEN hs >= 50 THEN 'At Risk' ELSE 'Critical' END AS label, count(*) AS n, round(avg(nf / 6), 6) AS share FROM hlth GROUP BY 1")
check("udtf_month_spine", "SELECT account_id, month_start FROM grid")
check("udaf_mode", "SELECT country, mode(industry ORDER BY industry) AS mode_builtin, mode(industry ORDER BY industry) AS mode_udaf FROM accounts_raw GROUP BY 1")

# quality
NN = ["invoice_id", "account_id", "amount", "status", "paid_date", "failed_date"]
check("dq_not_null", " UNION ALL ".join(f"SELECT 'invoices' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS failing, CASE WHEN count(*) = count({c}) THEN 'PASS' ELSE 'FAIL' END AS status FROM inv" for c in NN))
check("dq_unique", DUPS)
check("dq_accepted_values", "SELECT status AS value, count(*) AS failing FROM subs WHERE status NOT IN ('active', 'cancelled') GROUP BY 1")
check("dq_relationships", "SELECT subscription_id, count(*) AS rows FROM inv WHERE subscription_id NOT IN (SELECT subscription_id FROM subs) GROUP BY 1")
check("dq_expression", "SELECT subscription_id, seats_used, seats_purchased FROM subs WHERE NOT seats_used * 2 <= seats_purchased")
check("dq_between_mostly", """SELECT 'invoices' AS table_name, 'amount' AS column_name, count(amount) AS checked, count(*) FILTER (amount BETWEEN 1000 AND 90000) AS in_range,
  CASE WHEN count(*) FILTER (amount BETWEEN 1000 AND 90000) / count(amount) >= 0.95 THEN 'PASS' ELSE 'FAIL' END AS status FROM inv UNION ALL
  SELECT 'tickets', 'csat_score', count(csat_score), count(*) FILTER (csat_score BETWEEN 1 AND 5), CASE WHEN count(*) FILTER (csat_score BETWEEN 1 AND 5) = count(csat_score) THEN 'PASS' ELSE 'FAIL' END FROM tix""")
check("dq_positive_values", "SELECT seats_used AS value, count(*) AS failing FROM subs WHERE seats_used <= 0 GROUP BY 1")
TABLES = [("raw", f"raw_{n}", f"(SELECT * FROM {t}, (VALUES (0), (1)) v(older))", a, b) for n, t, a, b in (
    ("plans", "plans_t", 4, 20), ("features", "feats", 10, 100), ("calendar", "days", 700, 1000), ("accounts", "accounts_raw", 200, 500), ("subscriptions", "subs", 200, 600),
    ("invoices", "inv", 1000, 10000), ("usage_events", "usage", 5000, 100000), ("tickets", "tix", 500, 5000), ("leads", "lead_rows", 500, 3000))]
TABLES += [("staging", n, f"({CHECKS[n]})", a, b) for n, a, b in (
    ("stg_plans", 4, 20), ("stg_features", 10, 100), ("stg_calendar", 700, 1000), ("stg_accounts", 200, 500), ("stg_subscriptions", 200, 600), ("stg_invoices", 1000, 10000),
    ("stg_usage_events", 5000, 100000), ("stg_support_tickets", 500, 5000), ("stg_leads", 500, 3000))]
TABLES += [("marts", "fct_mrr_movements", "moves", 500, 10000), ("marts", "exec_revenue_summary", "exec", 12, 36), ("marts", "fct_sales_conversion", f"({CHECKS['fct_sales_conversion']})", 500, 3000)]
ROWS_BROKEN = [("raw", "raw_subscriptions", "seats unreadable", "subs WHERE subscription_id % 97 = 0"), ("staging", "stg_subscriptions", "mrr negative", "subs WHERE mrr < 0"),
               ("staging", "stg_subscriptions", "account missing", "subs WHERE account_id IS NULL"), ("staging", "stg_invoices", "amount not positive", f"({CHECKS['stg_invoices']}) WHERE amount <= 0"),
               ("staging", "stg_support_tickets", "csat out of range", "tix WHERE csat_score NOT BETWEEN 1 AND 5"), ("marts", "fct_mrr_movements", "mrr negative", "moves WHERE mrr < 0"),
               ("marts", "fct_mrr_movements", "payment failed", "moves WHERE failed > 0"), ("marts", "exec_revenue_summary", "nrr out of range", "exec WHERE nrr NOT BETWEEN 0.5 AND 2")]
block("table_checks", "SELECT *, CASE WHEN measured BETWEEN low AND high THEN 'PASS' ELSE 'FAIL' END AS status FROM (" + " UNION ALL ".join(
    [f"SELECT '{layer}' AS layer, '{n}' AS table_name, 'row_count' AS check_name, count(*) AS measured, {a}::bigint AS low, {b}::bigint AS high FROM {t}" for layer, n, t, a, b in TABLES]
    + [f"SELECT '{layer}', '{n}', '{c}', count(*), 0::bigint, 0::bigint FROM {t}" for layer, n, c, t in ROWS_BROKEN]) + ")")
check("dq_table_checks", "SELECT * FROM table_checks")
check("dq_row_count_range", "SELECT layer, table_name, measured AS row_count, low AS min_expected, high AS max_expected, status FROM table_checks WHERE check_name = 'row_count'")
TEN = [("no null account_id", "subscriptions", "SELECT count(*) FROM subs WHERE account_id IS NULL"),
       ("no negative mrr", "subscriptions", "SELECT count(*) FROM subs WHERE mrr < 0"),
       ("all accounts exist", "subscriptions", "SELECT count(*) FROM subs WHERE account_id NOT IN (SELECT account_id FROM accounts_raw)"),
       ("all plans exist", "subscriptions", "SELECT count(*) FROM subs WHERE plan_name NOT IN (SELECT plan_name FROM plans_t)"),
       ("no duplicate account and month", "fct_mrr_movements", "SELECT count(*) - count(DISTINCT (account_id, month_start)) FROM moves"),
       ("total_mrr above zero", "mart_exec_revenue_summary", "SELECT count(*) FROM exec WHERE total_mrr <= 0"),
       ("nrr in valid range", "mart_exec_revenue_summary", "SELECT count(*) FROM exec WHERE nrr < 0.5 OR nrr > 2"),
       ("csat in valid range", "tickets", "SELECT count(*) FROM tix WHERE csat_score < 1 OR csat_score > 5"),
       ("no far-future invoice dates", "invoices", f"SELECT count(*) FROM inv WHERE invoice_date > {ASOF} + 365"),
       ("converted leads have an account", "leads", "SELECT count(*) FROM lead_rows WHERE converted_day IS NOT NULL AND account_id IS NULL")]
block("ten", " UNION ALL ".join(f"SELECT '{n}' AS check_name, '{t}' AS table_name, ({q})::double AS result" for n, t, q in TEN))
check("dq_sql_checks", "SELECT check_name, table_name, result, 'eq 0' AS expected, CASE WHEN result = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ten")
block("all_checks", "SELECT table_name, check_name, CASE WHEN result = 0 THEN 0 ELSE 1 END AS failed FROM ten UNION ALL SELECT table_name, check_name, CASE status WHEN 'FAIL' THEN 1 ELSE 0 END FROM table_checks")
SUMS = "cast(count(*) AS bigint) AS checks, cast(sum(failed) AS bigint) AS failed, CASE WHEN sum(failed) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM all_checks"
check("dq_report", f"SELECT 'check' AS level, table_name, check_name, {SUMS} GROUP BY table_name, check_name UNION ALL SELECT 'table', table_name, 'all', {SUMS} GROUP BY table_name UNION ALL SELECT 'overall', 'all', 'all', {SUMS}")
check("dq_freshness", "SELECT 'invoices' AS table_name, 30::bigint AS age_hours, 'WARN' AS status FROM inv HAVING count(*) > 0")
ENUM = [("subscriptions", "status", "subs", "status NOT IN ('active', 'trial', 'cancelled', 'past_due', 'paused')"), ("subscriptions", "billing_cycle", "subs", "billing_cycle NOT IN ('monthly', 'annual')"),
        ("invoices", "status", "inv", "status NOT IN ('paid', 'failed', 'pending', 'refunded')"), ("tickets", "priority", "tix", "priority NOT IN ('low', 'medium', 'high', 'critical')"),
        ("tickets", "status", "tix", "status NOT IN ('open', 'in_progress', 'resolved', 'closed', 'escalated')"), ("tickets", "csat_score", "tix", "csat_score NOT BETWEEN 1 AND 5")]
check("dq_enum_constraints", " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS failing, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {s} WHERE {w}" for t, c, s, w in ENUM))
check("dq_mart_rules", MART_CHECKS)

# glossary measures
check("arpu", f"SELECT month_start, sum(mrr)::double AS mrr, cast(sum(active_users) AS bigint) AS active_users, {r(div('sum(mrr)', 'sum(active_users)'), 2)} AS arpu FROM hlth GROUP BY 1")
check("time_to_value", f"""SELECT count(*) AS leads, {r(div('sum(v - trial_started_day)', 'count(*)'), 2)} AS avg_days_to_value FROM (SELECT lead_id, trial_started_day, min(event_day) AS v
  FROM lead_rows l JOIN usage u ON u.account_id = l.account_id AND u.event_day >= l.trial_started_day WHERE u.event_type IN ('view', 'click', 'signup') GROUP BY 1, 2)""")
check("flag_feature_stagnation", f"""SELECT account_id, count(*) AS features_adopted, max(f) AS last_adoption, cast({ASOF} - max(f) AS integer) AS days_since_adoption, {ASOF} - max(f) > 60 AS is_stagnant
  FROM (SELECT account_id, feature_id, min(event_day) AS f FROM usage GROUP BY 1, 2) GROUP BY 1""")
check("flag_downgrade_signal", """SELECT account_id, month_start, contraction_mrr::double AS contraction_mrr, contraction_mrr > 0 OR EXISTS (SELECT 1 FROM moves p WHERE p.account_id = m.account_id
  AND p.month_start = m.month_start - INTERVAL 1 MONTH AND p.contraction_mrr > 0) AS has_downgrade_signal FROM moves m""")
check("account_profile", """SELECT account_id, month_start, company_name, plan_name, coalesce(mrr, 0)::double AS mrr, coalesce(n, 0) AS events, coalesce(total_tickets, 0) AS tickets, coalesce(failed, 0) AS failed_payments,
  coalesce(paid_amount, 0)::double AS total_invoiced_paid FROM (SELECT account_id, month_start, mrr, plan_name FROM acct_month) FULL JOIN
  (SELECT account_id, cast(date_trunc('month', event_day) AS date) AS month_start, count(*) AS n FROM usage GROUP BY ALL) USING (account_id, month_start)
  FULL JOIN (SELECT account_id, month_start, total_tickets FROM tix_month) USING (account_id, month_start) FULL JOIN inv_month USING (account_id, month_start)
  JOIN (SELECT account_id, company_name FROM accounts_raw) USING (account_id)""")
check("filter_values", " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS filter_name, {c} AS value FROM {t}" for c, t in
      [("region", "accounts_raw"), ("industry", "accounts_raw"), ("acquisition_channel", "accounts_raw"), ("company_size", "accounts_raw"), ("plan_name", "subs")]))
block("reqs", "SELECT '/api/' || event_type || CASE WHEN event_id % 3 = 0 THEN '/list' ELSE '/:id' END AS path, event_id % 20 = 0 AS bad, round(cast(value AS decimal(18,6)), 2)::double AS ms FROM events")
check("request_log_rollup", f"""SELECT path, count(*) AS requests, count(*) FILTER (bad) AS errors, {r(div('sum(cast(ms AS decimal(38,12)))', 'count(*)'), 2)} AS avg_ms,
  list_sort(list(ms))[cast(floor(count(*) * 0.5) AS integer) + 1] AS p50_ms, list_sort(list(ms))[cast(floor(count(*) * 0.95::double) AS integer) + 1] AS p95_ms,
  list_sort(list(ms))[least(cast(floor(count(*) * 0.99::double) AS integer), count(*) - 1) + 1] AS p99_ms, {r(div('count(*) FILTER (bad)', 'count(*)') + '*100', 2)} AS error_rate_pct
  FROM reqs GROUP BY 1 ORDER BY count(*) DESC, path LIMIT 10""")
check("scd2_snapshot", """SELECT account_id, plan_name, mrr::double AS mrr, start_date AS valid_from, lead(start_date) OVER w AS valid_to, lead(start_date) OVER w IS NULL AS is_current
  FROM (SELECT DISTINCT ON (account_id, start_date) * FROM subs ORDER BY account_id, start_date, plan_name DESC, mrr DESC) WINDOW w AS (PARTITION BY account_id ORDER BY start_date)""")
check("flag_inactive_churn", f"""SELECT account_id, max(event_day) AS last_active_date, cast({ASOF} - max(event_day) AS integer) AS days_inactive, coalesce({ASOF} - max(event_day) >= 90, true) AS is_inactive_churn
  FROM accounts_raw LEFT JOIN usage USING (account_id) GROUP BY 1""")
