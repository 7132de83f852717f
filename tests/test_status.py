"""Payment-status topology and burn rates (reference topology / updater tests)."""

import datetime as dt

from pyspark.sql import functions as F

from eventide.functions.json_fields import payment_status
from eventide.operators import status_counts as sc


def test_status_extraction(spark):
    rows = [
        ('{"payload":"{\\"status\\":\\"CHARGED\\"}"}', "CHARGED"),
        ('{"payload":{"status":"CHARGE_FAILED"}}', "CHARGE_FAILED"),
        ("not-valid-json", "UNKNOWN"),
        ('{"payload":{"other":"field"}}', "UNKNOWN"),
        ('{"payload":{"status":"CHAR', "UNKNOWN"),  # truncated
        ('{"payload":{"status":null}}', "UNKNOWN"),
        (None, "UNKNOWN"),
        ("", "UNKNOWN"),
    ]
    df = spark.createDataFrame(rows, "value string, want string")
    got = df.select(payment_status("value").alias("s"), "want").collect()
    assert all(r.s == r.want for r in got), got


def test_running_counts(spark):
    vals = ['{"payload":{"status":"CHARGED"}}'] * 2 + ['{"payload":{"status":"CHARGE_FAILED"}}']
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    got = {r.status: r.cnt for r in sc.status_count(df).collect()}
    assert got == {"CHARGED": 2, "CHARGE_FAILED": 1}


def _counts(spark, ok, bad):
    s = dt.datetime(2024, 1, 1)
    e = s + dt.timedelta(hours=1)
    return spark.createDataFrame([(s, e, "CHARGED", ok), (s, e, "CHARGE_FAILED", bad)],
                                 "window_start timestamp, window_end timestamp, status string, cnt bigint")


def test_burn_rate_cases(spark):
    for ok, bad, want in [(100, 10, 9), (500, 50, 9), (0, 0, 0), (0, 100, 100)]:
        r = sc.burn_rate(_counts(spark, ok, bad)).collect()[0]
        assert r.burn_rate == want, (ok, bad, r)


def test_burn_rate_at_and_store_fetch(spark):
    c = _counts(spark, 3, 1)
    assert sc.burn_rate_at(c, "2024-01-01 00:30:00").collect()[0].burn_rate == 25
    assert sc.burn_rate_at(c, "2024-01-01 02:00:00").count() == 0
    assert sc.query_window_store(c, "CHARGED", "2024-01-01 00:00:00", "2024-01-01 01:00:00").count() == 1


def test_windows_are_epoch_aligned(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 30), '{"payload":{"status":"CHARGED"}}')],
                               "timestamp timestamp, value string")
    r = sc.status_count_window(df, "6 hours").collect()[0]
    assert r.window_start == dt.datetime(2024, 1, 1, 0, 0)
    assert sc.status_count_window(df, "1 hour").collect()[0].window_start == dt.datetime(2024, 1, 1, 5, 0)


def test_cumulative_burn_rate(spark):
    df = spark.createDataFrame([(10, 3), (0, 0)], "started long, failed long")
    got = [r.b for r in df.select(sc.burn_rate_cumulative(F.col("failed"), F.col("started")).alias("b")).collect()]
    assert got == [30, None]
