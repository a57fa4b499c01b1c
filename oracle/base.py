"""DuckDB statements the Spark results are compared with.

``ENTITIES`` restates the table mapping in SQL; later modules add named building
blocks with :func:`block` and one statement per query with :func:`check`.
``render`` puts only the blocks a statement mentions in front of it.
"""

from __future__ import annotations

import re

BLOCKS: dict[str, str] = {}
CHECKS: dict[str, str] = {}


def block(name: str, sql: str) -> None:
    BLOCKS[name] = sql


def check(name: str, sql: str) -> None:
    CHECKS[name] = sql


def _mentions(sql: str) -> set[str]:
    return {w for w in re.findall(r"\b[a-z_][a-z0-9_]*\b", sql) if w in BLOCKS}


def render(sql: str) -> str:
    needed: set[str] = set()
    todo = list(_mentions(sql))
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo.extend(_mentions(BLOCKS[name]) - {name})
    parts = [f"{n} AS ({b})" for n, b in BLOCKS.items() if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql


def over(sql: str, **blocks: str) -> str:
    """``sql`` with other definitions of some blocks; a definition may read its own block as it was, as ``<name>_all``."""
    kept = dict(BLOCKS)
    changed = {}
    for k, body in kept.items():  # a block stands before those that read it
        changed |= {f"{k}_all": body, k: blocks[k]} if k in blocks else {k: body}
    try:
        BLOCKS.clear()
        BLOCKS.update(changed)
        return f"SELECT * FROM ({render(sql)})"
    finally:
        BLOCKS.clear()
        BLOCKS.update(kept)


def r(expr: str, digits: int) -> str:
    """Half-up rounding through decimal, as a double."""
    return f"round(cast(({expr}) AS decimal(38,{digits + 4})), {digits})::double"


def div(n: str, d: str) -> str:
    return f"(({n})::double / nullif(({d})::double, 0))"


def div0(n: str, d: str, default: str = "0.0") -> str:
    return f"coalesce({div(n, d)}, {default})"


def key(*cols: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} AS varchar), '_dbt_utils_surrogate_key_null_')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def gap(a: str, b: str) -> str:
    """Calendar months from a to b."""
    return f"cast((year({b}) - year({a})) * 12 + month({b}) - month({a}) AS integer)"


ASOF = "DATE '2001-07-31'"
ASOF_MONTH = "DATE '2001-07-01'"

CHANNEL = """CASE c_custkey % 5 WHEN 0 THEN 'organic' WHEN 1 THEN 'paid_search' WHEN 2 THEN 'referral'
  WHEN 3 THEN 'partner' WHEN 4 THEN 'content' END"""
SIZE = """CASE WHEN c_acctbal < 1000 THEN '1-10' WHEN c_acctbal < 3000 THEN '11-50' WHEN c_acctbal < 5500 THEN '51-200'
  WHEN c_acctbal < 8000 THEN '201-1000' ELSE '1000+' END"""

block("ord", f"SELECT *, cast(o_orderdate AS date) AS d FROM orders WHERE cast(o_orderdate AS date) <= {ASOF}")
block("first_ord", "SELECT o_custkey, min(d) AS d0 FROM ord GROUP BY o_custkey")
block("accounts_raw", f"""SELECT c_custkey AS account_id, trim(c_name) AS company_name, lower(c_mktsegment) AS industry,
  upper(r_name) AS region, lower(n_name) AS country, {SIZE} AS company_size, {CHANNEL} AS acquisition_channel,
  d0 AS created_day
  FROM customer JOIN first_ord ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey""")
block("plans_t", """SELECT * FROM (VALUES ('starter', 99, 990, 1), ('growth', 299, 2990, 2), ('business', 799, 7990, 3),
  ('enterprise', 2499, 24990, 4)) AS v(plan_name, monthly_price, annual_price, tier)""")
block("subs", """SELECT o_orderkey AS subscription_id, o_custkey AS account_id,
  CASE WHEN o_totalprice < 75000 THEN 'starter' WHEN o_totalprice < 175000 THEN 'growth'
       WHEN o_totalprice < 325000 THEN 'business' ELSE 'enterprise' END AS plan_name,
  CASE o_orderstatus WHEN 'F' THEN 'cancelled' WHEN 'O' THEN 'active' WHEN 'P' THEN 'trial' END AS status,
  CASE WHEN o_orderkey % 3 = 0 THEN 'annual' ELSE 'monthly' END AS billing_cycle,
  cast(o_totalprice AS decimal(12,2)) AS mrr,
  cast(1 + o_orderkey % 50 AS integer) AS seats_purchased,
  cast(o_orderkey % 37 % (1 + o_orderkey % 50) AS integer) AS seats_used,
  d AS start_date,
  CASE WHEN o_orderstatus = 'F' THEN d + 90 WHEN o_orderstatus = 'O' AND o_orderkey % 10 <> 0 THEN d + 365 END AS end_date
  FROM ord""")
block("inv", """SELECT concat_ws('-', l_orderkey, l_linenumber) AS invoice_id, o_custkey AS account_id,
  l_orderkey AS subscription_id, amount,
  CASE flag WHEN 'A' THEN 'paid' WHEN 'N' THEN 'pending' WHEN 'R' THEN 'failed' END AS status,
  day AS invoice_date, day + 30 AS due_date,
  CASE WHEN flag = 'A' THEN day + cast(l_linenumber % 5 AS integer) END AS paid_date,
  CASE WHEN flag = 'R' THEN day END AS failed_date
  FROM (SELECT l_orderkey, l_linenumber, cast(sum(cast(l_extendedprice AS decimal(12,2))) AS decimal(12,2)) AS amount,
          min(l_returnflag) AS flag, cast(min(l_shipdate) AS date) AS day
        FROM lineitem GROUP BY ALL) JOIN orders ON o_orderkey = l_orderkey""")
block("ev_days", """SELECT *, cast(cast(ts AS date) - 8219 - to_months(cast(
  CASE WHEN user_id % 2 = 1 THEN event_id % 6 ELSE floor(sqrt(event_id % 36)) END AS integer)) AS date) AS d FROM events""")
block("feats", """SELECT event_type AS feature_id,
  CASE event_type WHEN 'view' THEN 'core' WHEN 'click' THEN 'workflow' WHEN 'signup' THEN 'automation'
    WHEN 'purchase' THEN 'commerce' ELSE 'system' END AS feature_category,
  CASE event_type WHEN 'signup' THEN 'business' WHEN 'purchase' THEN 'growth' ELSE 'starter' END AS feature_tier,
  event_type IN ('view', 'click', 'signup') AS is_core, event_type = 'purchase' AS is_premium, event_type = 'error' AS is_beta
  FROM (SELECT DISTINCT event_type FROM events)""")
block("usage", """SELECT event_id, user_id % 50 AS account_id, user_id, event_type AS feature_id, event_type, d AS event_day,
  concat_ws('-', user_id, d) AS session_id, cast(floor(value * 10) AS integer) AS duration_seconds FROM ev_days""")
block("tix", """SELECT event_id AS ticket_id, user_id % 50 AS account_id,
  CASE event_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'critical' END AS priority,
  CASE event_id % 5 WHEN 0 THEN 'open' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'escalated' ELSE 'resolved' END AS status,
  CASE WHEN event_id % 5 < 3 THEN NULL WHEN event_id % 7 = 0 THEN 2 ELSE 1 + event_id % 5 END AS csat_score,
  d AS created_day, event_id % 5 >= 3 AS solved FROM ev_days WHERE event_type = 'error'""")
block("lead_days", f"""SELECT c_custkey AS c, d0, d0 - cast(c_custkey % 75 AS integer) AS created,
  lower(c_mktsegment) AS industry, {SIZE} AS company_size, {CHANNEL} AS acquisition_channel,
  c_custkey % 3 <> 0 AS q, c_custkey % 3 <> 0 AND c_custkey % 7 <> 0 AS tr,
  c_custkey % 3 <> 0 AND c_custkey % 7 <> 0 AND c_custkey % 2 = 0 AS cv
  FROM customer JOIN first_ord ON o_custkey = c_custkey""")
block("lead_rows", """SELECT c AS lead_id, CASE WHEN cv THEN c END AS account_id, industry, company_size, acquisition_channel,
  cast(c % 100 AS integer) AS lead_score, (c % 101)::double AS trial_engagement_score, created AS created_day,
  CASE WHEN q THEN created + cast(c % 5 AS integer) END AS qualified_day,
  CASE WHEN q AND c % 4 <> 0 THEN created + 6 END AS demo_requested_day,
  CASE WHEN q AND c % 4 IN (1, 2) THEN created + 7 END AS demo_completed_day,
  CASE WHEN tr THEN created + 8 END AS trial_started_day, CASE WHEN tr THEN created + 22 END AS trial_ended_day,
  CASE WHEN cv THEN created + cast(9 + c % 60 AS integer) END AS converted_day,
  CASE WHEN NOT cv AND c % 5 = 0 THEN created + 30 END AS lost_day FROM lead_days""")
