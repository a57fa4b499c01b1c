"""Keyed updates with repeated keys and equal load times; positions over a whole table."""

import datetime as dt

from pyspark.sql import functions as F

from recurra.operators import incremental as inc, silver
from recurra.operators.ranking import positions

AT = dt.datetime(2020, 1, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_key_repeated_in_one_batch_changes_its_row_once(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, fixed string")
    batch = spark.createDataFrame([(1, "old", "-", 1, AT), (1, "new", "-", 2, AT), (3, "p", "q", 3, AT), (3, None, "q", 2, AT)], "id int, v string, fixed string, _row_id long, _loaded_at timestamp")
    for order in (batch, batch.orderBy(F.desc("_row_id"))):
        assert rows(inc.upsert_partial_columns(target, order, ["id"], ["v"], "_loaded_at")) == [(1, "new", "x"), (2, "b", "y"), (3, "p", "q")]
        assert rows(inc.upsert_by_key(target, order, ["id"], "_loaded_at")) == [(1, "new", "-"), (2, "b", "y"), (3, "p", "q")]
        assert rows(inc.insert_ignore(target, order, ["id"], "_loaded_at")) == [(3, "p", "q")]


def test_equal_load_times_are_settled_by_file_and_row(spark):
    raw = spark.createDataFrame(
        [("1", "x", AT, "a.csv", 9), ("1", "y", AT, "b.csv", 1), ("1", "z", AT, "b.csv", 2), ("", "w", AT, "c.csv", 5)],
        "plan_id string, plan_name string, _loaded_at timestamp, _source_file string, _row_id long")
    assert [(r["plan_id"], r["plan_name"], r["is_active"]) for r in silver.silver(raw, "plans").collect()] == [("1", "z", True)]


def test_positions_number_every_row_of_a_tied_table(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("v")).repartition(7)
    got = positions(df, [F.desc("v"), F.asc("id")], "place").orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(1, 5001))
    assert [(r["v"], r["id"]) for r in got] == sorted(((i % 3, i) for i in range(5000)), key=lambda x: (-x[0], x[1]))


def test_rows_that_do_not_parse_go_to_quarantine(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", "9", "x", "2020-01-01", AT, 1), ("2", "9", "12.5", "2020-13-01", AT, 2), ("3", "", "", "", AT, 3), ("oops", "9", "1", "", AT, 4), ("", "9", "1", "", AT, 5),
         ("4", "9", "bad", "", AT, 6), ("4", "9", "7", "", AT + dt.timedelta(days=1), 7)],
        "subscription_id string, account_id string, mrr string, start_date string, _loaded_at timestamp_ntz, _row_id long")
    good, bad = silver.write_typed(raw, "subscriptions", str(tmp_path / "typed"))
    assert [(r.subscription_id, r.account_id, r.mrr and float(r.mrr), r.start_date) for r in good.orderBy("subscription_id").collect()] == [(3, None, None, None), (4, 9, 7.0, None)]
    assert sorted((r.entity, r.key, r["columns"]) for r in bad.collect()) == [("subscriptions", "1", "mrr"), ("subscriptions", "2", "start_date"), ("subscriptions", "oops", "subscription_id")]
    assert set(good.columns) == {*silver.TYPED["subscriptions"], "_loaded_at"}
    assert '"mrr":"x"' in bad.where("key = '1'").first().text


def test_typed_tables_of_empty_sources(spark, tmp_path):
    for entity, columns in silver.TYPED.items():
        raw = spark.createDataFrame([], ", ".join(f"{c} string" for c in columns) + ", _loaded_at timestamp_ntz")
        good, bad = silver.write_typed(raw, entity, str(tmp_path / entity))
        assert good.count() == bad.count() == 0 and dict(good.dtypes)[silver.KEYS[entity]] == columns[silver.KEYS[entity]]
