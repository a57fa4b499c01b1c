"""Quoted CSV read by byte ranges against Python's csv reader and Spark's reader of whole files."""

import csv
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from recurra.sources import files
from recurra.sources.quoted import quoted_records, quoted_rows

NOW = dt.datetime(2020, 1, 1)
PIECES = ["a", "b c", '"', '""', ",", "\n", "\n\n", "é", '",', ',"', "x\n", "back\\slash"]


@pytest.fixture
def ranges(spark):
    """Byte ranges of a few lines, so that records span several of them."""
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "32"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def written(path, rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([["id", "text", "more"], *rows])
    path.write_text(out.getvalue(), newline="")


def read(spark, path):
    columns = ["id", "text", "more"]
    return sorted(tuple(r)[:3] for r in quoted_rows(spark, str(path), columns, files.QUOTING).collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_random_values_are_read_whole(spark, tmp_path, ranges, end):
    rng = random.Random(7)
    value = lambda: "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 6))) + "z"
    for n in range(2):
        rows = [[f"{k:03d}", value(), value()] for k in range(60)]
        written(tmp_path / f"{n}.csv", rows, end)
        assert read(spark, tmp_path / f"{n}.csv") == sorted(map(tuple, rows))


def test_several_tasks_read_one_file(spark, tmp_path, ranges):
    rows = [[f"{k:03d}", "long\n" * 20 + "end" if k % 5 == 0 else "short", 'say "hi"'] for k in range(100)]
    written(tmp_path / "a.csv", rows)
    records = quoted_records(spark, str(tmp_path / "a.csv"))
    assert records.select("block").distinct().count() > 10
    assert read(spark, tmp_path / "a.csv") == sorted(map(tuple, rows))
    whole = spark.read.options(header=True, multiLine=True, **files.QUOTING).csv(str(tmp_path / "a.csv"))
    assert read(spark, tmp_path / "a.csv") == sorted(map(tuple, whole.collect()))


def test_quotes_amid_plain_values_are_text(spark, tmp_path, ranges):
    lines = ["id,text,more"] + [f'{k:03d},5" pipe,"two\nlines, 3"" wide"' for k in range(40)]
    (tmp_path / "p.csv").write_text("\n".join(lines) + "\n")
    assert read(spark, tmp_path / "p.csv") == [(f"{k:03d}", '5" pipe', 'two\nlines, 3" wide') for k in range(40)]


def test_files_of_a_folder_keep_their_own_states_and_headers(spark, tmp_path, ranges):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text('id,text,more\n1,"never\nclosed,3\n4,x,y\n')
    written(folder / "b.csv", [["7", "one\ntwo", "q"]])
    got = {r["_source_file"]: (r["id"], r["text"]) for r in files.csv_text_scan(spark, str(folder), ["id", "text"], NOW).collect()}
    assert got["b.csv"] == ("7", "one\ntwo") and got["a.csv"][0] == "1" and len(got) == 2


@pytest.mark.parametrize("text", ["id,text,more\n", "id,text,more\n\n\n"])
def test_headers_alone_give_no_rows(spark, tmp_path, text):
    (tmp_path / "e.csv").write_text(text)
    df = files.csv_text_scan(spark, str(tmp_path / "e.csv"), ["id", "none"], NOW)
    assert df.count() == 0 and df.columns == ["id", "none", "_row_id", "_loaded_at", "_source_file"]


def test_last_line_without_an_end_and_short_rows(spark, tmp_path):
    (tmp_path / "s.csv").write_text('id,text,more\n1\n2,"",x\n3,"a\nb",c')
    rows = files.csv_text_scan(spark, str(tmp_path / "s.csv"), ["id", "text", "more"], NOW).orderBy("id").collect()
    assert [tuple(r)[:3] for r in rows] == [("1", None, None), ("2", None, "x"), ("3", "a\nb", "c")]
    assert len({r["_row_id"] for r in rows}) == 3


def test_long_files_are_read_by_ranges_and_short_ones_whole(spark, tmp_path, ranges):
    written(tmp_path / "long.csv", [[str(k), "two\nlines", "x"] for k in range(50)])
    written(tmp_path / "short.csv", [["1", "two\nlines", "x"]])
    plans = [files.csv_text_scan(spark, str(tmp_path / f"{n}.csv"), ["id", "text"], NOW) for n in ("long", "short")]
    by_range = ["from_csv" in df._jdf.queryExecution().analyzed().toString() for df in plans]
    assert by_range == [True, False] and [df.count() for df in plans] == [50, 1]
