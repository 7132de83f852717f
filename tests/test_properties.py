"""Seeded property checks (SURVEY test strategy d)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from eventide.operators import dedup, faults

T0 = dt.datetime(2024, 1, 1)


def _records(spark, seed, n=600):
    rnd = random.Random(seed)
    rows = [(f"k{rnd.randrange(40)}", f'{{"type":"{rnd.choice("ABC")}","n":{i}}}', rnd.choice(["t1", "t2"]),
             rnd.randrange(3), i, T0 + dt.timedelta(seconds=rnd.randrange(7200))) for i in range(n)]
    return spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long, "
                                       "timestamp timestamp")


def test_dedup_is_idempotent(spark):
    for seed in (1, 2, 3):
        r = _records(spark, seed)
        once = dedup.dedup_first_seen(r, ["key"], ["timestamp", "offset"], ["topic"])
        twice = dedup.dedup_first_seen(once, ["key"], ["timestamp", "offset"], ["topic"])
        a = sorted(tuple(x) for x in once.collect())
        assert a == sorted(tuple(x) for x in twice.collect())
        assert len(a) == r.select("topic", "key").distinct().count()


def test_ttl_dedup_is_idempotent_and_spaced(spark):
    r = _records(spark, 9)
    once = dedup.dedup_outbound_ttl(r, "key", "timestamp", 300)
    twice = dedup.dedup_outbound_ttl(once, "key", "timestamp", 300)
    a = sorted(x.offset for x in once.collect())
    assert a == sorted(x.offset for x in twice.collect())
    by_key = {}
    for x in once.collect():
        by_key.setdefault(x.key, []).append(x.timestamp)
    for ts in by_key.values():
        ts.sort()
        assert all((b - a_).total_seconds() >= 300 for a_, b in zip(ts, ts[1:]))


def test_fault_counts_add_up(spark):
    rules = spark.createDataFrame([("topic:t1", 0.2, 0.3, 100, 0.1), ("type:B", 0.1, 0.5, 0, 0.0)],
                                  faults.RULES_SCHEMA)
    for seed in (11, 12):
        r = _records(spark, seed)
        out = faults.inject_faults(r, rules, seed=seed)
        n_in = r.count()
        kept = out.where("copy = 1").count()
        dups = out.where("copy = 2").count()
        assert out.count() == kept + dups and kept <= n_in
        # every kept record is an input record; nothing is invented
        assert out.join(r.select("topic", "partition", "offset"), ["topic", "partition", "offset"], "left_anti").count() == 0
        # delays stay within the rule's bound
        j = out.alias("o").join(r.alias("i"), ["topic", "partition", "offset"])
        lag = j.select((F.unix_micros(F.col("o.timestamp")) - F.unix_micros(F.col("i.timestamp"))).alias("d"))
        assert lag.agg(F.min("d"), F.max("d")).first()[0] >= 0
        assert lag.agg(F.max("d")).first()[0] <= 100_000
