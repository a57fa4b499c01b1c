import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from recurra.config import HealthWeights, MetricConfig, RISK_LABELS
from recurra.operators import cohorts, funnel, health, support

CFG = MetricConfig()


def signals(spark, **over):
    base = dict(
        account_id=1, usage_intensity="power_user", seat_utilization_rate=0.9, feature_adoption_score=12.0, support_health_score=100,
        avg_csat_score=5.0, failed_payments=0, months_since_created=30, has_usage_drop_flag=False, has_no_login_flag=False,
        has_high_priority_flag=False, has_payment_failure=False, has_low_csat_flag=False,
    )
    base.update(over)
    schema = ("account_id long, usage_intensity string, seat_utilization_rate double, feature_adoption_score double, support_health_score int,"
              "avg_csat_score double, failed_payments long, months_since_created int, has_usage_drop_flag boolean, has_no_login_flag boolean,"
              "has_high_priority_flag boolean, has_payment_failure boolean, has_low_csat_flag boolean")
    return spark.createDataFrame([tuple(base.values())], schema)


def score(df, cfg=CFG):
    return health.score_health(health.health_components(df), cfg).collect()[0]


def test_best_signals_score_full(spark):
    r = score(signals(spark))
    assert (r["health_score"], r["health_tier"], r["churn_risk_level"], r["risk_flag_count"]) == (100.0, "healthy", "minimal", 0)


def test_defaults_of_an_account_without_signals(spark):
    r = score(signals(spark, usage_intensity="inactive", seat_utilization_rate=0.0, feature_adoption_score=0.0, avg_csat_score=None,
                      months_since_created=0, has_no_login_flag=True))
    # 0 + 2 + 0 + 15 + 7 + 10 + 1
    assert r["health_score"] == 35.0 and r["health_tier"] == "critical"
    assert r["risk_flags"] == ["no_login", "low_seat_util"]
    assert r["risk_reasons"] == f"{RISK_LABELS['no_login']}|{RISK_LABELS['low_seat_util']}"


def test_weights_come_from_the_config(spark):
    only_csat = dataclasses.replace(CFG, weights=HealthWeights(0, 0, 0, 0, 1, 0, 0))
    assert score(signals(spark, avg_csat_score=3.0), only_csat)["health_score"] == 50.0


def test_burden_of_one_unresolved_critical_ticket(spark):
    t = spark.createDataFrame(
        [(1, 1, "critical", "open", 2.0, False)], "ticket_id long, account_id long, priority string, status string, csat_score double, is_escalated boolean"
    ).withColumns({c: F.lit(dt.datetime(2020, 1, 5)).cast("timestamp_ntz") for c in ("created_at", "first_response_at")}).withColumn(
        "resolved_at", F.lit(None).cast("timestamp_ntz")
    )
    r = support.ticket_burden(support.ticket_monthly(t), CFG).collect()[0]
    assert (r["support_burden_score"], r["support_health_score"], r["has_low_csat_flag"], r["has_high_priority_flag"]) == (60, 40, True, False)
    assert r["avg_resolution_hours"] is None


def test_cohort_halves_when_one_of_two_leaves(spark, subs):
    from recurra.config import Tables

    accounts = spark.createDataFrame(
        [(i, f"a{i}", "x", "EU", "xx", "1-10", "organic", dt.datetime(2020, 6, 1)) for i in (1, 2)],
        "account_id long, company_name string, industry string, region string, country string, company_size string,"
        "acquisition_channel string, created_at timestamp_ntz",
    )
    s = subs((1, 1, "starter", 100, "2020-06-01", None), (2, 2, "growth", 300, "2020-06-01", "2020-06-30"))
    t = Tables(accounts, None, None, s, None, None, None, None)
    rows = {r["months_since_created"]: r for r in cohorts.fct_customer_cohorts(cohorts.cohort_rows(t, dt.date(2020, 7, 31))).collect()}
    assert rows[0]["logo_retention_rate"] == 1.0 and rows[0]["cohort_health"] == "excellent"
    assert rows[1]["logo_retention_rate"] == 0.5 and rows[1]["revenue_retention_rate"] == 0.25 and rows[1]["churned_accounts"] == 1
    # one size each: the lowest value wins the tie
    assert rows[0]["plan_name"] == "growth"


STAGES = ["created_at", "qualified_at", "demo_requested_at", "demo_completed_at", "trial_started_at", "trial_ended_at", "converted_at", "lost_at"]


@pytest.mark.parametrize(
    "reached, stage, order",
    [([], "lead", 1), (["qualified_at"], "qualified", 2), (["demo_requested_at"], "demo_requested", 3),
     (["demo_completed_at"], "demo_completed", 4), (["trial_started_at"], "trial", 5), (["converted_at", "lost_at"], "paid", 6), (["lost_at"], "lost", 0)],
)
def test_funnel_stages(spark, subs, reached, stage, order):
    from recurra.config import Tables

    when = dt.datetime(2020, 1, 1)
    lead = spark.createDataFrame([(1, None, "organic", "x", "1-10", 5, 1.0)],
                                 "lead_id long, account_id long, acquisition_channel string, industry string, company_size string, lead_score int, trial_engagement_score double")
    lead = lead.withColumns({c: F.lit(when if c in [*reached, "created_at"] else None).cast("timestamp_ntz") for c in STAGES})
    t = Tables(None, None, None, subs((1, 9, "starter", 1, "2020-01-01", None)), None, None, None, lead)
    r = funnel.funnel_progression(t).collect()[0]
    assert (r["funnel_stage"], r["funnel_stage_order"], r["conversion_velocity"]) == (stage, order, "in_progress")


def test_checks_are_measured_while_rows_are_written(spark, tmp_path):
    from pyspark.sql import functions as F
    from recurra.operators import quality as dq

    rows = spark.createDataFrame([(1, 5.0), (2, -1.0), (None, 3.0)], "id int, mrr double")
    checks = dq.TableChecks(rows, "id", 1, 10, "marts", {"mrr negative": F.col("mrr") < 0, "id missing": F.col("id").isNull()})
    seen, results = dq.observed("t", checks)
    seen.write.parquet(str(tmp_path / "t"))
    want = dq.table_results({"t": checks}).collect()
    assert results() == [r.asDict() for r in want]
    assert [(r.check_name, r.measured, r.status) for r in want] == [("row_count", 2, "PASS"), ("mrr negative", 1, "FAIL"), ("id missing", 1, "FAIL")]
    lines = {(r.level, r.check_name): (r.checks, r.failed, r.status) for r in dq.report(dq.table_results({"t": checks})).collect()}
    assert lines[("overall", "all")] == lines[("table", "all")] == (3, 2, "FAIL") and lines[("check", "row_count")] == (1, 0, "PASS")


def test_fail_fast_stops_before_the_next_table(spark):
    import pytest
    from pyspark.sql import functions as F
    from recurra.operators import quality as dq

    few = spark.range(2)
    unread = spark.range(3).select(F.raise_error(F.lit("read")).cast("long").alias("id"))
    with pytest.raises(AssertionError, match="data quality check failed"):
        dq.fail_fast_tables({"a": dq.TableChecks(few, "id", 5, 9), "b": dq.TableChecks(unread, "id", 0, 9)})
    dq.fail_fast_tables({"a": dq.TableChecks(few, "id", 1, 9)})
