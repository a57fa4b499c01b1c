"""Streams fed in two steps must end where one batch ends."""

import datetime as dt
import json

from recurra.streaming import changes

NOW = dt.datetime(2020, 1, 1)


def event(n, sub, created, amount, kind="updated"):
    return json.dumps({"id": f"e{n}", "type": f"customer.subscription.{kind}", "created": created,
                       "data": {"object": {"id": sub, "customer": "c", "status": "active", "plan": {"amount": amount}}}})


def test_webhooks_arriving_later_supersede_earlier_ones(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.json").write_text("\n".join([event(1, "s1", 10, 1000), event(2, "s2", 10, 2000)]))
    changes.stream_webhook_upsert(spark, str(folder), NOW, out)
    (folder / "b.json").write_text("\n".join([event(3, "s1", 20, 1500), event(4, "s2", 5, 9900), event(5, "s3", 7, 700, "deleted")]))
    got = changes.stream_webhook_upsert(spark, str(folder), NOW, out)
    want = [("s1", 15.0, "active"), ("s2", 20.0, "active"), ("s3", 7.0, "canceled")]
    assert sorted((r["subscription_id"], float(r["mrr"]), r["status"]) for r in got.collect()) == want
    changes.compact(spark, f"{out}/log/subscription", f"{out}/folded", ["subscription_id"], ["event_at", "event_id"])
    folded = changes.current_rows(spark, f"{out}/folded", ["subscription_id"], ["event_at", "event_id"])
    assert sorted((r["subscription_id"], float(r["mrr"]), r["status"]) for r in folded.collect()) == want


def test_window_counts_grow_over_batches(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "account_id long, user_id long, duration_seconds int, occurred_at timestamp_ntz"
    at = lambda h: dt.datetime(2020, 1, 1, h)

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        return changes.stream_usage_counts(stream, out).collect()

    arrive((1, 1, 10, at(1)), (1, 2, 30, at(2)))
    got = arrive((1, 1, 5, at(3)), (2, 9, 7, at(4)))
    assert sorted((r["account_id"], r["events"], r["duration_seconds"], r["longest_seconds"]) for r in got) == [(1, 3, 45, 30), (2, 1, 7, 7)]


def events_in_files(spark, folder, files, n=400):
    """Events whose dates are shuffled over the files."""
    schema = "event_id long, account_id long, user_id long, duration_seconds int, occurred_at timestamp_ntz"
    rows = [(i, i % 7, i % 11, i % 50, dt.datetime(2020, 1 + i * 5 % 9, 1 + i * 17 % 28, i % 24)) for i in range(n)]
    for k in range(files):
        spark.createDataFrame([r for r in rows if r[0] * 31 % files == k], schema).coalesce(1).write.mode("append").parquet(folder)
    return rows, schema


def test_no_row_is_lost_however_batches_arrive(spark, tmp_path):
    from recurra.plans.loading import table_stream

    folder = str(tmp_path / "events.parquet")
    rows, schema = events_in_files(spark, folder, 6)
    events_in_files(spark, folder, 3)  # every event once more, in other company
    stream = lambda: table_stream(spark, folder, spark.read.parquet(folder).schema)
    once = changes.stream_dedupe_events(stream(), str(tmp_path / "once")).collect()
    assert sorted(tuple(r) for r in once) == rows
    got = {(r["account_id"], r["day"]): (r["events"], r["duration_seconds"], r["longest_seconds"], r["users"]) for r in changes.stream_usage_counts(stream(), str(tmp_path / "use")).collect()}
    want = {}
    for _, a, u, d, t in rows:
        want.setdefault((a, t.date()), []).append((u, d))
    assert got == {k: (2 * len(v), 2 * sum(d for _, d in v), max(d for _, d in v), len({u for u, _ in v})) for k, v in want.items()}


def test_streams_without_input_are_empty_tables(spark, tmp_path):
    folder = str(tmp_path / "events.parquet")
    schema = "event_id long, account_id long, user_id long, duration_seconds int, occurred_at timestamp_ntz"
    spark.createDataFrame([], schema).write.parquet(folder)
    stream = lambda: spark.readStream.schema(schema).parquet(folder)
    assert changes.stream_dedupe_events(stream(), str(tmp_path / "a")).columns == [c.split()[0] for c in schema.split(", ")]
    got = changes.stream_usage_counts(stream(), str(tmp_path / "b"))
    assert got.count() == 0 and got.columns == ["account_id", "day", "events", "duration_seconds", "longest_seconds", "users"]


def body_of(kind, key, at, **fields):
    return json.dumps({"id": f"e-{key}-{at}", "type": kind, "created": at, "data": {"object": {"id": key, "customer": "c1", **fields}}})


def test_webhooks_fill_three_tables_and_settle_copies(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.json").write_text("\n".join([
        body_of("customer.subscription.created", "s1", 200, status="active", quantity="4"), body_of("invoice.payment_succeeded", "i1", 100, amount_due="1250", currency="eur"),
        body_of("customer.updated", "c1", 300, name="New", metadata={"website": "w.example"}), "not json", body_of("invoice.created", "i9", 1)]))
    first = changes.stream_webhooks(spark, str(folder), NOW, out)
    assert {k: v.count() for k, v in first.items()} == {"subscription": 1, "invoice": 1, "account": 1}
    (folder / "b.json").write_text("\n".join([
        body_of("customer.subscription.updated", "s1", 150, status="stale"), body_of("invoice.payment_failed", "i1", 400, amount_due="1250"), body_of("customer.created", "c1", 50, name="Old"),
        body_of("customer.subscription.created", "s1", 200, status="active", quantity="4"), body_of("customer.subscription.deleted", "s2", 10)]))
    got = changes.stream_webhooks(spark, str(folder), NOW, out)
    assert [(r.subscription_id, r.status, r.seats) for r in got["subscription"].orderBy("subscription_id").collect()] == [("s1", "active", 4), ("s2", "canceled", 1)]
    assert [(r.invoice_id, r.status, float(r.amount), r.failed_at) for r in got["invoice"].collect()] == [("i1", "failed", 12.5, NOW)]
    assert [(r.account_id, r.company_name, r.account_owner, r.website) for r in got["account"].collect()] == [("c1", "New", "New", "w.example")]


def test_webhooks_without_input_are_empty(spark, tmp_path):
    (tmp_path / "in").mkdir()
    got = changes.stream_webhooks(spark, str(tmp_path / "in"), NOW, str(tmp_path / "out"))
    assert {k: v.count() for k, v in got.items()} == {"subscription": 0, "invoice": 0, "account": 0}
    assert "website" in got["account"].columns and changes.stream_webhook_upsert(spark, str(tmp_path / "in"), NOW).count() == 0


def test_a_batch_shows_in_all_logs_or_in_none(spark, tmp_path):
    table = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    logs = changes.CommittedLogs(spark, str(tmp_path), {"a": table().schema, "b": table().schema})
    assert logs.read("a").count() == logs.read("b").count() == 0
    logs.write({"a": table(1), "b": table(2, 3)}, 0)
    changes.append_batch(table(9), 1, f"{tmp_path}/a")  # the second log of this batch is never written
    assert [logs.read(n).count() for n in "ab"] == [1, 2]
    logs.write({"a": table(4), "b": table()}, 1)  # replayed
    logs.write({"a": table(4), "b": table()}, 1)
    assert sorted(r.id for r in logs.read("a").collect()) == [1, 4] and logs.read("b").count() == 2


def test_a_batch_fills_its_logs_without_a_shuffle_and_leaves_no_parsed_rows(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    retried = [event(1, "s1", 10, 1000), event(2, "s1", 20, 1500), event(2, "s1", 20, 1500)]
    (folder / "a.json").write_text("\n".join(retried))
    got = changes.stream_webhook_upsert(spark, str(folder), NOW, out)
    assert [(r["event_id"], float(r["mrr"])) for r in got.collect()] == [("e2", 15.0)]
    # the log keeps what arrived, a reader settles it
    assert spark.read.parquet(f"{out}/log/subscription").count() == 3
    assert not changes.Folder(spark, f"{out}/parsed").names()


def test_a_batch_is_parsed_by_code_that_the_jvm_compiles(spark, tmp_path, monkeypatch):
    folder, limit = tmp_path / "in", "spark.sql.codegen.hugeMethodLimit"
    folder.mkdir()
    (folder / "a.json").write_text(event(1, "s1", 10, 1000))
    seen, before = [], spark.conf.get(limit)
    write = changes.append_batch
    monkeypatch.setattr(changes, "append_batch", lambda rows, n, path: (seen.append((path, int(rows.sparkSession.conf.get(limit)))), write(rows, n, path)))
    got = changes.stream_webhook_upsert(spark, str(folder), NOW, str(tmp_path / "out"))
    assert [n for path, n in seen if path.endswith("/parsed")] == [changes.JIT_BYTES]
    assert got.count() == 1 and spark.conf.get(limit) == before


def test_webhook_bodies_are_made_once_and_sent_twice(spark, monkeypatch):
    from recurra.plans import loading

    body = lambda n: spark.createDataFrame([(json.dumps({"id": n, "created": 5, "status": "active"}, separators=(",", ":")),)], "body string")
    monkeypatch.setattr(loading, "stripe_bodies", lambda s: (body("s"), body("i"), body("a")))
    monkeypatch.setattr(changes, "stream_webhooks", lambda spark, folder, now: spark.read.text(folder))
    source = type("S", (), {"spark": spark})()
    got = sorted((json.loads(r.value)["id"], json.loads(r.value)["created"], json.loads(r.value)["status"]) for r in loading.webhook_stream(source).collect())
    assert got == [("a", 5, "active")] * 2 + [("i", 5, "active")] * 2 + [("s", 5, "active")] * 2 + [("s", 86400, "stale")]
