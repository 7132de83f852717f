"""Envelope, quarantine, de-duplication, fault rules (reference messaging tests)."""

import datetime as dt

from pyspark.sql import functions as F

from eventide.operators import dedup, envelope, faults


def test_build_and_parse_envelope(spark):
    rows = [("o1", "e1", "T", '{"a":1}'), ("o2", "e2", "T", None), ("o3", "e3", "T", "  "),
            ("o4", "e4", "T", "not json"), (None, "e5", "T", '{"s":"x\\"y"}')]
    df = spark.createDataFrame(rows, "order_id string, event_id string, type string, payload string")
    b = {r.event_id: r for r in envelope.build_envelope(df).collect()}
    assert b["e2"].envelope == '{"orderId":"o2","eventId":"e2","type":"T","payload":"{}"}'
    assert b["e3"].envelope.endswith('"payload":"{}"}')
    assert b["e4"].envelope is None and b["e4"].error_reason == "Envelope build failed"
    assert b["e5"].envelope.startswith('{"orderId":null')
    back = envelope.parse_envelope(envelope.build_envelope(df).where("envelope is not null")
                                   .select(F.col("envelope").alias("value")))
    got = {r.event_id: (r.order_id, r.payload) for r in back.collect()}
    assert got["e1"] == ("o1", '{"a":1}') and got["e5"] == (None, '{"s":"x\\"y"}')
    bad = envelope.parse_envelope(spark.createDataFrame([("{oops",), ('{"orderId":"x"}',)], "value string"))
    r = {x.value: x for x in bad.collect()}
    assert r["{oops"].error_reason == "Envelope parse failed"
    assert r['{"orderId":"x"}'].payload == "{}" and r['{"orderId":"x"}'].type is None
    good, q = envelope.split_quarantine(bad)
    assert good.count() == 1 and q.count() == 1
    blanks = spark.createDataFrame([("a",), (" ",), (None,)], "order_id string")
    assert [r.order_id for r in envelope.non_blank_order_id(blanks).collect()] == ["a"]


def test_dedup_first_seen(spark):
    df = spark.createDataFrame([("t", "k1", 2, "b"), ("t", "k1", 1, "a"), ("u", "k1", 5, "c"), ("t", None, 9, "n")],
                               "topic string, key string, seq int, v string")
    got = sorted((r.topic, r.key or "", r.v) for r in dedup.dedup_first_seen(df, ["key"], ["seq"], ["topic"]).collect())
    assert got == [("t", "", "n"), ("t", "k1", "a"), ("u", "k1", "c")]
    seen = spark.createDataFrame([("u", "k1")], "topic string, key string")
    got = sorted((r.topic, r.key or "") for r in dedup.dedup_first_seen(df, ["key"], ["seq"], ["topic"], seen).collect())
    assert got == [("t", ""), ("t", "k1")]


def test_ttl_greedy_chain(spark):
    t0 = dt.datetime(2024, 1, 1)
    secs = [0, 5, 9, 11, 15, 21]
    df = spark.createDataFrame([("k", i, t0 + dt.timedelta(seconds=s)) for i, s in enumerate(secs)],
                               "key string, id long, ts timestamp")
    got = sorted(r.id for r in dedup.dedup_outbound_ttl(df, "key", "ts", 10, id_cols=["id"]).collect())
    assert [secs[i] for i in got] == [0, 11, 21]


def test_ttl_chain_brute_force(spark):
    import random

    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(f"k{rnd.randrange(4)}", i, t0 + dt.timedelta(seconds=rnd.randrange(0, 3000))) for i in range(400)]
    df = spark.createDataFrame(rows, "key string, id long, ts timestamp")
    got = {r.id for r in dedup.dedup_outbound_ttl(df, "key", "ts", 60, id_cols=["id"]).collect()}
    want = set()
    for k in {r[0] for r in rows}:
        last = None
        for _, i, ts in sorted((r for r in rows if r[0] == k), key=lambda r: (r[2], r[1])):
            if last is None or ts >= last + dt.timedelta(seconds=60):
                want.add(i)
                last = ts
    assert got == want


def test_rules_resolution_and_faults(spark):
    rules = spark.createDataFrame([("topic:a", 1.0, 0.0, 0, 0.0), ("type:T", 0.0, 1.0, 0, 1.0)], faults.RULES_SCHEMA)
    recs = spark.createDataFrame(
        [("k", '{"type":"T"}', "a", 0, 1, dt.datetime(2024, 1, 1)),
         ("k", '{"type":"T"}', "b", 0, 2, dt.datetime(2024, 1, 1)),
         ("k", "x", "c", 0, 3, dt.datetime(2024, 1, 1))],
        "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    r = {x.topic: x.rule for x in faults.resolve_fault_rule(recs, rules).collect()}
    assert r["a"].p_drop == 1.0 and r["b"].p_dup == 1.0 and r["c"].p_drop == 0.0
    out = faults.inject_faults(recs, rules).collect()
    assert sorted((x.topic, x.copy) for x in out) == [("b", 1), ("b", 2), ("c", 1)]
    assert {x.value for x in out if x.topic == "b"} == {'{"type'}  # 12 chars truncated to 6
    one = faults.inject_faults(recs.where("topic = 'b'").withColumn("value", F.lit("z")), rules).collect()
    assert {x.value for x in one} == {"z"}  # one character stays one character


def test_rules_json_and_merge(spark):
    js = spark.createDataFrame([('{"topic:a":{"pDrop":0.5},"type:T":{"pDup":0.1,"maxDelayMs":20}}',)],
                               "rules_json string")
    r = {x.key: x for x in faults.read_rules_json(js).collect()}
    assert r["topic:a"].p_dup == 0.0 and r["type:T"].max_delay_ms == 20
    cur = faults.read_rules_json(js)
    ch = spark.createDataFrame([("topic:a", "delete", 1, None, None, None, None),
                                ("topic:z", "put", 2, 0.1, 0.0, 0, 0.0),
                                ("topic:q", "delete", 3, None, None, None, None)],
                               "key string, op string, seq long, p_drop double, p_dup double, max_delay_ms int, "
                               "p_corrupt double")
    assert sorted(x.key for x in faults.merge_rules(cur, ch).collect()) == ["topic:z", "type:T"]
    reset = ch.unionByName(spark.createDataFrame([(None, "replace_all", 2, None, None, None, None)], ch.schema))
    assert sorted(x.key for x in faults.merge_rules(cur, reset).collect()) == []


def test_canary_split(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("key"))
    share = faults.canary_split(df, 0.1).where("channel = 'canary'").count() / 2000
    assert 0.07 < share < 0.13
    assert faults.canary_split(df, 0.0).where("channel = 'canary'").count() == 0


def _brute_ttl(rows, ttl):
    """rows: (key, id, time); accepted ids."""
    kept, last = set(), {}
    for k, i, t in sorted(rows, key=lambda r: (r[2], r[1])):
        if k is None or k not in last or (t - last[k]).total_seconds() >= ttl:
            kept.add(i)
            last[k] = t
    return kept


def test_ttl_retry_storm_equals_brute_force(spark):
    """One key with most rows inside a few TTLs, ties at one instant, rows without a key."""
    import random

    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", i, t0 + dt.timedelta(milliseconds=rnd.randrange(0, 120_000))) for i in range(1500)]
    rows += [("hot", 5000 + i, t0 + dt.timedelta(seconds=14)) for i in range(12)]
    rows += [(f"k{rnd.randrange(5)}", 10_000 + i, t0 + dt.timedelta(seconds=rnd.randrange(0, 900))) for i in range(300)]
    rows += [(None, 20_000 + i, t0) for i in range(5)]
    df = spark.createDataFrame(rows, "key string, id long, ts timestamp")
    assert {r.id for r in dedup.dedup_outbound_ttl(df, "key", "ts", 7, id_cols=["id"]).collect()} == _brute_ttl(rows, 7)


def test_ttl_long_chain_and_spaced_messages(spark):
    """A chain of many accepted messages, none of them dropped by a bound on rounds."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [("k", i, t0 + dt.timedelta(seconds=250 * i)) for i in range(120)]
    rows += [("far", 1000 + i, t0 + dt.timedelta(seconds=700 * i)) for i in range(40)]
    df = spark.createDataFrame(rows, "key string, id long, ts timestamp")
    got = {r.id for r in dedup.dedup_outbound_ttl(df, "key", "ts", 600, id_cols=["id"]).collect()}
    assert got == _brute_ttl(rows, 600) and len([i for i in got if i >= 1000]) == 40


def test_ttl_offsets_repeat_across_partitions(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", "t", 0, 5, t0), ("b", "t", 1, 5, t0), ("a", "t", 0, 6, t0 + dt.timedelta(seconds=10)),
            ("b", "t", 1, 6, t0 + dt.timedelta(seconds=700))]
    df = spark.createDataFrame(rows, "key string, topic string, partition int, offset long, ts timestamp")
    got = sorted((r.key, r.offset) for r in dedup.dedup_outbound_ttl(df, "key", "ts", 600).collect())
    assert got == [("a", 5), ("b", 5), ("b", 6)]


def test_canary_edges_and_outbox_feed(spark):
    from eventide.operators import tables

    df = spark.range(500).select(F.col("id").cast("string").alias("key"))
    assert faults.canary_split(df, 1.0).where("channel = 'main'").count() == 0
    ob = spark.createDataFrame(
        [("i1", "o1", "OrderCreated", '{"a":1}', dt.datetime(2024, 1, 1)),
         ("i1", "o1", "OrderCreated", '{"a":1}', dt.datetime(2024, 1, 1)),
         ("i2", "o2", "OrderShipped", '{"b":2}', dt.datetime(2024, 1, 2))],
        "id string, aggregate_id string, type string, payload string, occurred_at timestamp")
    feed = {r.key: r for r in tables.outbox_change_feed(ob).collect()}
    assert len(feed) == 2 and feed["o1"].topic == "order.created" and feed["o2"].topic == "outbox.OrderShipped"
    assert bytes(feed["o1"].headers[0]["value"]) == b"i1"
