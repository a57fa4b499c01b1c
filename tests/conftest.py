import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from recurra.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("tests", cpus="4", partitions=4, memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def day(text):
    return dt.date.fromisoformat(text) if text else None


@pytest.fixture
def subs(spark):
    """Subscriptions from (id, account, plan, mrr, start, end[, status])."""

    def make(*rows):
        full = [
            (i, a, p, p, (r[0] if r else "active"), "monthly", float(m), 10, 5, day(s), day(e))
            for i, a, p, m, s, e, *r in rows
        ]
        df = spark.createDataFrame(
            full,
            "subscription_id long, account_id long, plan_id string, plan_name string, status string, billing_cycle string,"
            "mrr double, seats_purchased int, seats_used int, start_date date, end_date date",
        )
        return df.withColumn("mrr", df.mrr.cast("decimal(12,2)"))

    return make
