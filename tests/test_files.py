import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from recurra.sources import files, ingest, webhooks

NOW = dt.datetime(2020, 1, 1)


def test_text_scan_lists_columns_and_blanks(spark, tmp_path):
    p = tmp_path / "plans.csv"
    p.write_text('plan_id,extra,name\n1,x,""\n2,y,Growth\n')
    df = files.csv_text_scan(spark, str(p), ["plan_id", "name", "tier"], NOW)
    assert [tuple(r) for r in df.select("plan_id", "name", "tier", "_source_file").orderBy("plan_id").collect()] == [
        ("1", None, None, "plans.csv"), ("2", "Growth", None, "plans.csv")
    ]


def test_missing_file_is_skipped_with_a_warning(spark, tmp_path):
    with pytest.warns(UserWarning, match="skipped"):
        df = files.csv_text_scan(spark, str(tmp_path / "none.csv"), ["a"])
    assert df.count() == 0 and df.columns == ["a", "_row_id", "_loaded_at", "_source_file"]


@pytest.mark.parametrize("name, kind", [("due_date", "date"), ("open_month", "date"), ("plan_id", "string"), ("mrr", "decimal(12,4)"),
                                         ("is_lost", "boolean"), ("csat_score", "int"), ("company_name", "string")])
def test_types_follow_names(name, kind):
    assert files.type_for(name) == kind


def test_typed_scan(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a_id,due_date,amount,is_lost,seats\n01,2020-01-31,1.5,True,3\n02,None,oops,false,\n")
    rows = files.csv_typed_scan(spark, str(p)).orderBy("a_id").collect()
    assert (rows[0]["a_id"], rows[0]["due_date"], float(rows[0]["amount"]), rows[0]["is_lost"], rows[0]["seats"]) == ("01", dt.date(2020, 1, 31), 1.5, True, 3)
    assert tuple(rows[1])[1:] == (None, None, False, None)


def test_jdbc_options_without_a_database():
    o = files.jdbc_options(host="db", database="bi", table="raw.accounts", user="u", password="p", partition=("account_id", 0, 100, 8))
    assert o["url"] == "jdbc:postgresql://db:5432/bi" and o["numPartitions"] == "8" and o["partitionColumn"] == "account_id"
    assert files.jdbc_options("jdbc:x:y", table="t")["url"] == "jdbc:x:y"


def test_schema_names():
    assert files.schema_name("prod", "marts", "public") == "marts"
    assert files.schema_name("dev", "marts", "public") == "public_marts"
    assert files.schema_name("dev", None, "public") == "public"


def test_append_and_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    mk = lambda *rows: spark.createDataFrame(rows, "v int, p string")
    files.write_full_refresh(mk((1, "a"), (2, "b")), path, "p")
    files.write_partitions(mk((9, "b")), path, "p")
    assert sorted((r["v"], r["p"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_validation_splits_and_normalises(spark):
    rows = [("s1", " a1 ", "Growth", "10.005", None), ("s2", "a1", "Growth", "2000000", "active"), ("s3", "", "Growth", "-1", "weird")]
    df = ingest.ingest_validate(spark.createDataFrame(rows, "subscription_id string, account_id string, plan_name string, mrr string, status string"), "subscription")
    good = ingest.accepted(df).collect()
    assert [(r["subscription_id"], float(r["mrr"]), float(r["arr"]), r["status"], r["billing_interval"]) for r in good] == [("s1", 10.01, 120.12, "active", "monthly")]
    bad = {r["subscription_id"]: r["reject_reason"] for r in ingest.rejected(df).collect()}
    assert bad == {"s2": ["mrr above limit"], "s3": ["account_id missing", "mrr negative", "status unknown"]}


def test_stripe_fallbacks(spark):
    body = {"id": "e1", "type": "customer.subscription.deleted", "created": 10,
            "data": {"object": {"id": "s", "customer": "c", "status": "active", "items": {"data": [{"price": {"id": "p", "unit_amount": 1999}}]}, "start_date": "bad"}}}
    df = spark.createDataFrame([(json.dumps(body),), ("not json",)], "body string")
    parsed = webhooks.parse_stripe(df)
    r = webhooks.stripe_subscriptions(parsed, NOW).collect()[0]
    assert (r["status"], float(r["mrr"]), r["plan_id"], r["plan_name"], r["seats"], r["started_at"]) == ("canceled", 19.99, "p", "Stripe Plan", 1, NOW)
    assert parsed.where(~F.col("processed")).count() == 1


def test_quotes_and_line_breaks_survive_a_round_trip(spark, tmp_path):
    p = tmp_path / "accounts.csv"
    p.write_text('account_id,company_name\n1,"Acme ""Best"" Co, Inc"\n2,"two\nlines"\n3,back\\slash\n')
    read = lambda path: {r["account_id"]: r["company_name"] for r in files.csv_text_scan(spark, path, ["account_id", "company_name"], NOW).collect()}
    want = {"1": 'Acme "Best" Co, Inc', "2": "two\nlines", "3": "back\\slash"}
    assert read(str(p)) == want
    files.csv_sink(spark.createDataFrame(sorted(want.items()), "account_id string, company_name string"), str(tmp_path / "out"))
    assert read(str(tmp_path / "out")) == want


def test_finished_columns_are_added_behind_the_shuffle(spark, tmp_path):
    df = spark.createDataFrame([(k, k % 3) for k in range(30)], "v int, p int")
    written = files.write_full_refresh(df, str(tmp_path / "t"), "p", lambda rows: rows.select(F.sha2(F.col("v").cast("string"), 256).alias("k"), "*"))
    plan = written._jdf.queryExecution().executedPlan().toString()
    assert "sha2" in plan.split("Exchange")[0] and "sha2" not in "".join(plan.split("Exchange")[1:])
    want = df.select(F.sha2(F.col("v").cast("string"), 256).alias("k"), "v", "p")
    got = spark.read.parquet(str(tmp_path / "t")).select("k", "v", "p")
    assert got.count() == 30 and got.exceptAll(want).isEmpty()
