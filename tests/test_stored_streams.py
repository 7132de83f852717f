"""Tables kept by micro-batches: replays, crashes, compaction, pruning; paging and counters in pieces."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from eventide.operators import orders, promql
from eventide.sources import driver_tables as tables
from eventide.streaming import key_store, streams
from eventide.streaming.key_store import KeyStore
from eventide.streaming.layers import UpsertedTable
from eventide.streaming.metrics_table import MetricsTable
from eventide.streaming.outbox import OutboxFeed
from eventide.streaming.saga_timers import apply_event, due, fire_timer, saga_timers_stream
from eventide.streaming.stateful import outbound_ttl_dedup_stream
from eventide.streaming.window_store import WindowStore

T0 = dt.datetime(2024, 1, 1)


def _upserted(spark, base):
    return UpsertedTable(spark, f"{base}/t", "k string, ts bigint, v string", ["k"], ["ts", "v"], buckets=4, max_layers=2)


def test_upserted_table_over_batches_crashes_and_compaction(spark, tmpdir_fresh):
    rnd, want = random.Random(1), {}
    for b in range(6):
        rows = [(f"k{rnd.randrange(15)}", rnd.randrange(50), f"{b}-{j}") for j in range(5)]
        batch = spark.createDataFrame(rows, "k string, ts bigint, v string")
        table = _upserted(spark, tmpdir_fresh)
        if b == 3:  # a writer died after its folder and before its manifest
            n = table.state()["commit"] + 1
            spark.createDataFrame([("k0", 10**9, "lost", "b0000")], "k string, ts bigint, v string, part string").write.partitionBy("part").parquet(
                f"{tmpdir_fresh}/t/data/layer={n:012d}")
            assert "lost" not in {r.v for r in table.read().collect()}
        assert table.upsert(batch, b) and not _upserted(spark, tmpdir_fresh).upsert(batch, b)
        want |= {k: max((ts, v) for kk, ts, v in rows if kk == k) for k, _, _ in rows}
        assert {r.k: (r.ts, r.v) for r in table.read().collect()} == want
    state = table.state()
    assert max(map(len, state["layers"].values())) <= 2 and len(table.commits()) <= 2
    live = {f"layer={x}" for c in table.commits() for xs in json.loads(table.folder.read(f"log/{c}.json"))["layers"].values() for x in xs}
    assert set(table.folder.names("data")) == live  # old layers are gone
    assert [(r.ts, r.v) for r in table.lookup(k="k3").collect()] == ([want["k3"]] if "k3" in want else [])
    one = spark.createDataFrame([("k1", 1, "x")], "k string, ts bigint, v string")
    table.upsert(one, 99)
    newest = max(x for xs in table.state()["layers"].values() for x in xs)
    assert sum(newest in xs for xs in table.state()["layers"].values()) == 1  # one bucket was touched


def test_key_store_finds_replays_of_any_age(spark, tmpdir_fresh):
    def rows(ids, b):
        return spark.createDataFrame([("c", f"id{i}", b) for i in ids] + [(None, "x", b)], "c string, id string, n int")

    for b in range(5):
        store = KeyStore(spark, f"{tmpdir_fresh}/k", ["c", "id"], buckets=4, max_layers=2)
        batch = rows([*range(b * 40, b * 40 + 40), *range(0, b * 40, 13)], b)
        assert store.consume(batch, b, ["n"]) and not store.consume(batch, b, ["n"])
    got = [tuple(r)[:3] for r in store.accepted().where("c IS NOT NULL").collect()]
    assert sorted(got) == sorted(("c", f"id{i}", i // 40) for i in range(200))
    assert store.accepted().where("c IS NULL").count() == 5
    old, n_read, n_files = store.seen(rows([7], 9).dropna())
    assert [r.id for r in old.collect()] == ["id7"] and n_read == 1 < n_files
    new, n_read, _ = store.seen(rows(range(1000, 1050), 9).dropna())
    assert new.count() == 0 and n_read == 0


def test_bloom_pages_are_those_of_the_bitmap_aggregate(spark, tmpdir_fresh):
    store = KeyStore(spark, f"{tmpdir_fresh}/k", ["c", "id"], buckets=3)
    rows = spark.range(20_000).select(F.concat(F.lit("c"), F.col("id") % 3).alias("c"), F.concat(F.lit("id"), "id").alias("id"), F.lit(1).alias("n"))
    store.consume(rows.unionByName(rows), 0, ["n"])
    pages = spark.read.parquet(f"{tmpdir_fresh}/k/keys/bloom/*")
    held = spark.read.option("basePath", f"{tmpdir_fresh}/k/keys/data").parquet(f"{tmpdir_fresh}/k/keys/data").select("c", "id", "part")
    at = held.join(pages.select("part", "pages").distinct(), "part").select(
        "part", "pages", key_store._page(store.key, F.col("pages")).alias("page"), F.explode(key_store._bits(store.key)).alias("at"))
    want = at.groupBy("part", "pages", "page").agg(F.bitmap_construct_agg("at").alias("bits"))
    assert held.count() == 20_000 and pages.count() > 15
    assert sorted(map(tuple, pages.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def _records(spark, rows):
    value = lambda s: json.dumps({"payload": {"status": s}})
    return spark.createDataFrame([(T0 + dt.timedelta(hours=h), value(s)) for h, s in rows], "timestamp timestamp_ntz, value string")


def test_window_store_late_rows_fetch_and_expiry(spark, tmpdir_fresh):
    store = WindowStore(spark, f"{tmpdir_fresh}/w", max_layers=2)
    first = _records(spark, [(0, "CHARGED"), (0.5, "CHARGED"), (30, "CHARGED"), (47.5, "CHARGE_FAILED")])
    assert store.add(first, 0) and not store.add(first, 0)
    # the stream time is 47.5 h: windows that began at 23.5 h or before are closed for both sizes
    second = _records(spark, [(23.4, "CHARGED"), (24.1, "CHARGED"), (18.5, "CHARGED"), (47.7, "CHARGED")])
    store.add(second, 1)
    late = sorted((r.size, r.window_start, r.timestamp) for r in store.late().collect())
    assert [(s, (t - T0).total_seconds() / 3600) for s, _, t in late] == [("1 hour", 18.5), ("1 hour", 23.4), ("6 hours", 18.5), ("6 hours", 23.4)]
    assert store.table.state()["notes"]["late"] == 4
    got = {(r.size, (r.window_start - T0).total_seconds() // 3600, r.status): r.cnt for r in store.counts().collect()}
    assert got == {("1 hour", 0, "CHARGED"): 2, ("6 hours", 0, "CHARGED"): 2, ("1 hour", 24, "CHARGED"): 1, ("1 hour", 30, "CHARGED"): 1,
                   ("6 hours", 24, "CHARGED"): 1, ("6 hours", 30, "CHARGED"): 1, ("1 hour", 47, "CHARGED"): 1, ("1 hour", 47, "CHARGE_FAILED"): 1,
                   ("6 hours", 42, "CHARGED"): 1, ("6 hours", 42, "CHARGE_FAILED"): 1}
    found = store.fetch("CHARGED", "1 hour", T0 + dt.timedelta(hours=24), T0 + dt.timedelta(hours=47))
    assert sorted(r.cnt for r in found.collect()) == [1, 1, 1]
    assert all("1hourd20240102" in f for f in found.inputFiles())  # one day of one size is read
    store.expire(0)
    assert {p[-8:] for p in store.table.files()} == {"20240102"}


def test_outbox_runs_publish_once(spark, tmpdir_fresh):
    def outbox(rows):
        return spark.createDataFrame([(i, "a", "Order", "OrderCreated", "{}", T0 + dt.timedelta(hours=h)) for i, h in rows],
                                     "id string, aggregate_id string, aggregate_type string, type string, payload string, occurred_at timestamp_ntz")

    feed = OutboxFeed(spark, f"{tmpdir_fresh}/o", overlap="6 hours")
    assert feed.publish(outbox([("a", 0), ("b", 20)]), 0)
    # a run that died before its commit left records behind
    spark.createDataFrame([("old",)], "key string").write.parquet(f"{tmpdir_fresh}/o/records/run_id=1")
    # c commits late with an older time, d is new
    feed = OutboxFeed(spark, f"{tmpdir_fresh}/o", overlap="6 hours")
    assert feed.publish(outbox([("a", 0), ("b", 20), ("c", 19), ("d", 23)]), 1)
    assert not feed.publish(outbox([("a", 0), ("b", 20), ("c", 19), ("d", 23), ("e", 24)]), 1)
    ids = feed.records().select(F.col("headers")[0]["value"].cast("string").alias("id"), "run_id").collect()
    assert sorted(tuple(r) for r in ids) == [("a", 0), ("b", 0), ("c", 1), ("d", 1)]


def test_metrics_go_on_after_a_restart(spark, tmpdir_fresh):
    def batch(n, hour):
        return spark.createDataFrame([("x" if i % 3 else "y", T0 + dt.timedelta(hours=hour, seconds=i)) for i in range(n)], "app string, ts timestamp_ntz")

    for k, n in enumerate((6, 9, 3)):
        kept = MetricsTable(spark, f"{tmpdir_fresh}/m", ["app"], max_layers=2)  # a new writer each time
        assert kept.record(batch(n, k), k, {"seen": F.lit(True)}, ts="ts") and not kept.record(batch(n, k), k, {"seen": F.lit(True)}, ts="ts")
    got = sorted((r.app, r.ts, r.value) for r in kept.samples().collect())
    assert [v for a, _, v in got if a == "x"] == [4, 10, 12] and [v for a, _, v in got if a == "y"] == [2, 5, 6]


def test_saga_moves_and_timers():
    saga = {"state": None, "failed_state": None, "payment_id": None, "reservation_id": None, "shipping_id": None, "failure_reason": None, "retry_count": 0, "at_us": 0}
    assert apply_event(saga, "OrderCreated", None, None) == [] and due(saga) == 600_000_000
    apply_event(saga, "PaymentCompleted", "p", None)
    assert due(saga) is None
    apply_event(saga, "InventoryRequested", None, None)
    sent = fire_timer(saga)
    assert [(c["kind"], c.get("type"), c.get("ref_id")) for c in sent] == [("status", None, None), ("command", "REFUND", "p"), ("command", "CANCEL", None)]
    assert saga["failure_reason"] == "Timeout waiting for INVENTORY_PENDING response" and due(saga) == 300_000_000
    assert [c["failure_reason"] for c in fire_timer(saga)] == ["Retry compensation attempt #1"] * 2
    assert apply_event(saga, "CompensationCompleted", None, None)[0]["status"] == "CANCELLED" and saga["state"] == "COMPENSATED"


def test_saga_state_shrinks_when_sagas_finish(spark, tmpdir_fresh):
    schema = "order_id string, seq bigint, ts timestamp, event_type string, ref_id string, reason string"

    def event(o, seq, minute, kind):
        return (o, seq, T0 + dt.timedelta(minutes=minute), kind, f"{kind}-{seq}", None)

    blocks = [[event("a", 1, 0, "OrderCreated"), event("b", 2, 0, "OrderCreated"), event("c", 3, 0, "PaymentCompleted")],
              [event("a", 4, 2, "ShippingCompleted"), event("d", 5, 30, "OrderCreated")],
              [event("b", 6, 31, "CompensationCompleted"), event("d", 7, 32, "PaymentCompleted")]]
    left = []
    for k, rows in enumerate(blocks):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmpdir_fresh}/src")
        source = spark.readStream.schema(schema).parquet(f"{tmpdir_fresh}/src")

        def write(batch, n, k=k):
            batch.write.mode("overwrite").parquet(f"{tmpdir_fresh}/out/batch_id={n}")

        saga_timers_stream(source).writeStream.outputMode("update").foreachBatch(write).option(
            "checkpointLocation", f"{tmpdir_fresh}/cp").trigger(availableNow=True).start().awaitTermination()
        left.append({r.id for r in streams.read_state_store(spark, f"{tmpdir_fresh}/cp").select(F.col("key.order_id").alias("id")).collect()})
    assert left == [{"a", "b"}, {"b", "d"}, {"d"}]  # finished sagas leave, orders never started don't enter
    rows = spark.read.parquet(f"{tmpdir_fresh}/out").where("kind = 'status'").orderBy("order_id", "n").collect()
    assert [(r.order_id, r.status) for r in rows] == [("a", "COMPLETED"), ("b", "PAYMENT_FAILED"), ("b", "CANCELLED")]


def _run(spark, df, base, mode):
    def write(batch, n):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={n}")

    df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


def _sent_to_python(df):
    """Columns that Spark turns into pandas for every key."""
    plan = df._jdf.queryExecution().analyzed()
    while "FlatMapGroupsInPandasWithState" not in plan.nodeName():
        plan = plan.children().head()
    return plan.children().head().output().size()


ODD = 'q"uo\\te\n\u00e9\U0001f600\x01'


def test_saga_events_go_to_python_as_one_column(spark, tmpdir_fresh):
    schema = "order_id string, seq bigint, ts timestamp, event_type string, ref_id string, reason string"
    at = [T0 + dt.timedelta(minutes=m) for m in (0, 1, 90)]
    rows = [(ODD, 2, at[1], "PaymentFailed", None, ODD), (ODD, 1, at[0], "OrderCreated", None, None), ("b", None, at[2], "OrderCreated", None, None)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmpdir_fresh}/src")
    stream = saga_timers_stream(spark.readStream.schema(schema).parquet(f"{tmpdir_fresh}/src"))
    assert _sent_to_python(stream) <= 4  # the key (twice), the event, its time
    got = _run(spark, stream, tmpdir_fresh, "update").orderBy("order_id", "n").collect()
    mine = [(r.kind, r.state, r.failure_reason, r.retry_count, r.type) for r in got if r.order_id == ODD]
    retry = "Retry compensation attempt #1"
    assert mine == [("state", "PAYMENT_PENDING", None, 0, None), ("status", None, ODD, None, None), ("command", None, ODD, None, "CANCEL"),
                    ("state", "COMPENSATING", ODD, 0, None), ("command", None, retry, None, "CANCEL"), ("state", "COMPENSATING", ODD, 1, None)]
    assert {r.at_us for r in got if r.order_id == "b"} == {int((at[2] - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000}


def test_ttl_messages_go_to_python_as_one_column(spark, tmpdir_fresh):
    schema = "key string, topic string, partition int, offset bigint, ts timestamp"
    files = [[(ODD, ODD, 0, 2, 0), (ODD, ODD, 0, 1, 0), (ODD, None, 1, 3, 600), (None, "t", 0, 4, 0), (None, "t", 0, 5, 0)], [("z", "t", 0, 6, 7200)],
             [(ODD, "t", 0, 7, 1200), (ODD, "t", 0, 8, 7100)]]  # offset 7 comes after the watermark
    for k, rows in enumerate(files):
        spark.createDataFrame([(*r[:4], T0 + dt.timedelta(seconds=r[4])) for r in rows], schema).coalesce(1).write.mode("append").parquet(f"{tmpdir_fresh}/src")
        stream = outbound_ttl_dedup_stream(spark.readStream.schema(schema).parquet(f"{tmpdir_fresh}/src"), "key", "ts")
        assert _sent_to_python(stream) <= 4
        out = _run(spark, stream, tmpdir_fresh, "append")
    got = [(r.k, r.topic, r.partition, r.offset) for r in out.orderBy("offset").collect()]
    assert got == [(ODD, ODD, 0, 1), (ODD, None, 1, 3), (None, "t", 0, 4), (None, "t", 0, 5), ("z", "t", 0, 6), (ODD, "t", 0, 8)]


def test_counters_by_blocks_equal_one_window(spark):
    """One series holds most samples and is cut into many blocks; resets fall on block ends too."""
    rnd, rows, value = random.Random(3), [], 0
    for i in range(3000):
        value = 0 if i % 480 == 0 or rnd.random() < 0.01 else value + rnd.randrange(5)
        rows.append((T0 + dt.timedelta(minutes=i), "hot", float(value)))
    rows += [(T0 + dt.timedelta(minutes=7 * i), f"s{i % 4}", float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, s string, value double")
    got = {(r.s, r.ts): r.increase for r in promql.counter_increase(df, "5 minutes", ["s"]).collect()}
    assert len(got) == len(rows)
    for s in ("hot", "s1"):
        mine = sorted((t, v) for t, x, v in rows if x == s)
        for k, (t, _) in enumerate(mine):
            inside = [v for u, v in mine[max(0, k - 6) : k + 1] if u > t - dt.timedelta(minutes=5)]
            want = None if len(inside) < 2 else sum(b if b < a else b - a for a, b in zip(inside, inside[1:]))
            assert got[(s, t)] == want


@pytest.mark.parametrize("start", [0, 90, 100, 140, 195, 230])
def test_deep_pages(spark, monkeypatch, start):
    monkeypatch.setattr(orders, "SHALLOW", 10)
    rnd = random.Random(5)
    rows = [(i, None if i % 9 == 0 else T0 + dt.timedelta(days=rnd.randrange(3), seconds=rnd.randrange(4))) for i in range(210)]
    df = spark.createDataFrame(rows, "id bigint, created_at timestamp_ntz")
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or T0, r[0]), reverse=True)[start : start + 10]
    assert [tuple(r) for r in orders.orders_page(df, start // 10, 10).collect()] == want if start % 10 == 0 else True
    assert [tuple(r) for r in orders.orders_page(df, start // 5, 5).collect()] == want[:5]
