"""Statements for files, validation, webhooks, keyed updates and streams."""

from oracle import customers, revenue  # noqa: F401  their statements are used again
from oracle.base import CHECKS, block, check
from oracle.revenue import PART_COLS

STAMP = "TIMESTAMP '2001-07-31 06:00:00'"
check("csv_text_scan", f"""SELECT invoice_id, account_id::varchar AS account_id, subscription_id::varchar AS subscription_id, amount::varchar AS amount, status,
  invoice_date::varchar AS invoice_date, paid_date::varchar AS paid_date, NULL::varchar AS payment_method, {STAMP} AS _loaded_at, true AS has_lineage FROM inv""")
check("csv_typed_scan", """SELECT invoice_id, account_id::varchar AS account_id, amount::double AS amount, invoice_date, paid_date, status = 'paid' AS payment_succeeded, status FROM inv""")
RAW = [("raw_plans", "(SELECT DISTINCT plan_name FROM subs)"), ("raw_features", "feats"), ("raw_calendar", "(SELECT unnest(generate_series(min(month_start)::timestamp, TIMESTAMP '2001-07-31', INTERVAL 1 DAY)) FROM grid)"), ("raw_accounts", "accounts_raw"),
       ("raw_subscriptions", "subs"), ("raw_invoices", "inv"), ("raw_usage_events", "usage"), ("raw_tickets", "tix"), ("raw_leads", "lead_rows")]
check("load_raw_layer", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count, count(*) AS keyed_rows FROM {t}" for n, t in RAW))
VIEWS = [("accounts", "accounts_raw"), ("subscriptions", "subs"), ("invoices", "inv"), ("usage_events", "usage"), ("tickets", "tix"), ("leads", "lead_rows")]
check("bronze_views", " UNION ALL ".join(f"SELECT '{n}' AS view, h AS _loaded_at, count(*) AS row_count, count(*) AS keys FROM {t}, (VALUES ({STAMP}), ({STAMP} - INTERVAL 1 HOUR)) v(h) GROUP BY h" for n, t in VIEWS))


def reasons(*pairs):
    return "concat_ws('|', " + ", ".join(f"CASE WHEN {w} THEN '{n}' END" for n, w in pairs) + ")"


check("ingest_validate", f"""SELECT 'subscription' AS record_type, o_orderkey::varchar AS record_id,
  {reasons(('account_id missing', 'o_orderkey % 97 = 0'), ('mrr unreadable', 'o_orderkey % 89 = 0'), ('mrr above limit', 'o_orderkey % 89 <> 0 AND cast(o_totalprice * 3 AS decimal(14,2)) > 1000000'),
           ('status unknown', "o_orderstatus = 'P' AND o_orderkey % 2 = 0"), ('seats negative', 'o_orderkey % 50 = 0'))} AS reject_reason,
  CASE o_orderstatus WHEN 'F' THEN 'canceled' WHEN 'O' THEN 'active' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'active' END END AS shown FROM orders
 UNION ALL SELECT 'invoice', invoice_id, {reasons(('amount negative', 'amount < 2000'), ('currency too long', 'account_id % 10 = 0'))}, CASE WHEN account_id % 10 = 0 THEN 'EURO' ELSE 'USD' END FROM inv
 UNION ALL SELECT 'account', c_custkey::varchar, {reasons(('company_name missing', 'c_custkey % 31 = 0'), ('company_size unknown', 'c_acctbal < 0'))}, c_custkey::varchar FROM customer
 UNION ALL SELECT 'usage_event', event_id::varchar, {reasons(('event_count negative', 'event_id % 40 = 0'), ('occurred_at unreadable', 'event_id % 71 = 0'))}, 'my_' || event_type FROM events
 UNION ALL SELECT 'ticket', ticket_id::varchar, {reasons(('status unknown', "status IN ('in_progress', 'escalated')"), ('csat_score out of range', 'ticket_id % 7 IN (0, 6)'))}, priority FROM tix
 UNION ALL SELECT 'lead', lead_id::varchar, {reasons(('funnel_stage unknown', 'converted_day IS NULL AND lost_day IS NOT NULL'), ('lead_score out of range', 'lead_id % 101 + 3 > 100'), ('days_lead_to_paid negative', 'lead_id % 9 = 0'))},
  account_id::varchar FROM lead_rows""")

block("stripe_sub", """SELECT 'sub_' || subscription_id AS key, account_id::varchar AS account_id, mrr::double AS amount,
  CASE WHEN subscription_id % 4 = 2 THEN 'canceled' ELSE 'active' END AS status, CASE WHEN subscription_id % 5 = 0 THEN 'price_' || plan_name ELSE plan_name END AS plan_id,
  CASE WHEN subscription_id % 5 = 0 THEN 'Stripe Plan' ELSE plan_name END AS plan, CASE WHEN subscription_id % 5 <> 0 AND subscription_id % 3 = 0 THEN 'annual' ELSE 'monthly' END AS every,
  cast(CASE WHEN subscription_id % 6 = 0 THEN 1 ELSE seats_purchased END AS integer) AS seats, start_date, end_date FROM subs WHERE subscription_id % 4 <> 3""")
check("stripe_events_normalize", """SELECT 'subscription' AS kind, key, account_id, amount, status, concat_ws('/', plan_id, plan, every, seats) AS label, start_date AS starts, end_date AS ends FROM stripe_sub
  UNION ALL SELECT 'invoice', invoice_id, account_id::varchar, amount::double, status, concat_ws('/', 'sub_' || subscription_id, 'USD', CASE WHEN account_id % 5 = 0 THEN 'sepa' ELSE 'card' END, CASE WHEN account_id % 4 = 0 THEN 3 ELSE 1 END), invoice_date, paid_date FROM inv WHERE status <> 'pending'
  UNION ALL SELECT 'account', account_id::varchar, account_id::varchar, NULL, 'stripe', concat_ws('/', CASE WHEN account_id % 3 = 0 THEN 'Unknown Company' ELSE company_name END, country), created_day, NULL FROM accounts_raw
  UNION ALL SELECT 'unprocessed', 'evt_s' || subscription_id, NULL, NULL, NULL, 'customer.tax_id.created', NULL, NULL FROM subs WHERE subscription_id % 4 = 3
  UNION ALL SELECT 'unprocessed', 'evt_i' || invoice_id, NULL, NULL, NULL, 'invoice.created', NULL, NULL FROM inv WHERE status = 'pending'""")
check("chargebee_events_normalize", """SELECT 'subscription' AS kind, 'cb_' || subscription_id AS key, account_id::varchar AS account_id, mrr::double AS amount, CASE WHEN subscription_id % 4 = 2 THEN 'canceled' ELSE 'active' END AS status,
  concat_ws('/', plan_name, CASE WHEN subscription_id % 5 = 0 THEN plan_name ELSE upper(plan_name) END, CASE WHEN subscription_id % 3 = 0 THEN 'annual' ELSE 'monthly' END,
    CASE WHEN subscription_id % 6 = 0 THEN 1 ELSE seats_purchased END, CASE WHEN status = 'trial' THEN start_date END, CASE WHEN status = 'trial' THEN start_date + 14 END) AS label, start_date AS starts FROM subs WHERE subscription_id % 4 <> 3
  UNION ALL SELECT 'invoice', invoice_id, account_id::varchar, (CASE WHEN amount > 5000 THEN amount ELSE round(cast(amount / 100 AS decimal(18,6)), 2) END)::double, status, 'USD/card/1', invoice_date FROM inv WHERE status <> 'pending'
  UNION ALL SELECT 'unprocessed', 'ev_' || subscription_id, NULL, NULL, NULL, 'card_added', NULL FROM subs WHERE subscription_id % 4 = 3
  UNION ALL SELECT 'unprocessed', 'ev_i' || invoice_id, NULL, NULL, NULL, 'invoice_generated', NULL FROM inv WHERE status = 'pending'""")

check("write_full_refresh", "SELECT account_id, mrr::double AS mrr, mtype AS mrr_movement_type, month_start FROM moves")
check("write_append", "SELECT subscription_id, status, mrr::double AS mrr FROM subs")
check("csv_sink", "SELECT subscription_id, plan_name, mrr::double AS mrr, start_date, end_date FROM subs")
check("json_sink", "SELECT lead_id, account_id, acquisition_channel, created_day AS day FROM lead_rows")
check("dq_csv_vs_table", "SELECT 'subscriptions' AS table_name, count(*) AS source_rows, count(*) AS loaded_rows, 'PASS' AS status FROM subs")

LATE = "start_date >= DATE '2000-01-01'"
check("upsert_by_key", f"""SELECT subscription_id, account_id, CASE WHEN status = 'cancelled' THEN 'closed' ELSE status END AS status, CASE WHEN status = 'cancelled' THEN 0 ELSE mrr::double END AS mrr, start_date,
  (SELECT count(*) FROM subs WHERE {LATE}) AS inserted, (SELECT count(*) FROM subs WHERE NOT {LATE} AND status = 'cancelled') AS updated FROM subs""")
check("insert_ignore", f"""SELECT subscription_id, account_id, CASE WHEN status = 'cancelled' THEN 'closed' ELSE status END AS status, CASE WHEN status = 'cancelled' THEN 0 ELSE mrr::double END AS mrr, start_date FROM subs WHERE {LATE}""")
check("upsert_partial_columns", f"""SELECT subscription_id, CASE WHEN {LATE} THEN -1 ELSE account_id END AS account_id, CASE WHEN status = 'cancelled' THEN 'closed' ELSE status END AS status,
  CASE WHEN status = 'cancelled' THEN 0 ELSE mrr::double END AS mrr, start_date FROM subs""")
check("incremental_lookback", f"SELECT account_id, month_start, mrr::double AS mrr, prev_mrr::double AS prev_mrr, mtype AS mrr_movement_type, {PART_COLS} FROM moves")
for name, full in {"account_months": "account_months", "usage_monthly": "usage_monthly", "ticket_monthly": "ticket_monthly", "health": "fct_account_monthly_health"}.items():
    check(f"lookback_{name}", CHECKS[full])
check("stored_exec_summary", CHECKS["exec_revenue_summary"])
check("stream_webhook_upsert", """SELECT 'evt_s' || subscription_id AS event_id, 'sub_' || subscription_id AS subscription_id, s.account_id, plan_id, plan AS plan_name, s.status, amount AS mrr, (cast(mrr AS decimal(14,2)) * 12)::double AS arr,
  s.seats, s.start_date AS started_at, s.end_date AS canceled_at, CASE WHEN b.status = 'trial' THEN s.start_date END AS trial_started_at, CASE WHEN b.status = 'trial' THEN s.start_date + 14 END AS trial_ended_at, every AS billing_interval
  FROM stripe_sub s JOIN subs b ON key = 'sub_' || subscription_id""")
check("stream_webhook_invoices", f"""SELECT 'evt_i' || invoice_id AS event_id, invoice_id, account_id::varchar AS account_id, 'sub_' || subscription_id AS subscription_id, amount::double AS amount, 'USD' AS currency, status,
  CASE WHEN account_id % 5 = 0 THEN 'sepa' ELSE 'card' END AS payment_method, cast(CASE WHEN account_id % 4 = 0 THEN 3 ELSE 1 END AS integer) AS attempt_count, invoice_date, due_date, paid_date AS paid_at,
  CASE WHEN status = 'failed' THEN cast({STAMP} AS date) END AS failed_at, invoice_date AS created_at FROM inv WHERE status <> 'pending'""")
check("stream_webhook_accounts", """SELECT 'evt_a' || account_id AS event_id, account_id::varchar AS account_id, CASE WHEN account_id % 3 = 0 THEN 'Unknown Company' ELSE company_name END AS company_name, 'stripe' AS acquisition_channel,
  CASE WHEN account_id % 3 <> 0 THEN company_name END AS account_owner, CASE WHEN account_id % 2 = 0 THEN 'https://' || account_id || '.example' END AS website, country, created_day AS created_at FROM accounts_raw""")
check("stream_dedupe_events", "SELECT event_id, user_id, event_type, cast(ts AS date) AS day FROM events")
check("stream_usage_counts", """SELECT account_id, event_day AS day, count(*) AS events, cast(sum(duration_seconds) AS bigint) AS duration_seconds, max(duration_seconds) AS longest_seconds, count(DISTINCT user_id) AS users FROM usage GROUP BY 1, 2""")
check("full_refresh", """SELECT month_start, sum(new_mrr)::double AS new_mrr, sum(expansion_mrr)::double AS expansion_mrr, sum(contraction_mrr)::double AS contraction_mrr, sum(churned_mrr)::double AS churned_mrr,
  sum(reactivation_mrr)::double AS reactivation_mrr, sum(delta)::double AS net_new_mrr, sum(mrr)::double AS total_mrr FROM moves GROUP BY month_start""")
