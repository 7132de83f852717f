"""Topic I/O fallback, foreachBatch sinks, late data, restart, observed counters."""

import datetime as dt

from pyspark.sql import functions as F

from eventide.operators import metrics
from eventide.sources import topics
from eventide.streaming import sinks, streams

T0 = dt.datetime(2024, 1, 1)
REC = "key string, value string, topic string, partition int, offset long, timestamp timestamp"


def _recs(spark, rows):
    return spark.createDataFrame(rows, REC).withColumn(
        "headers", F.array().cast("array<struct<key:string,value:binary>>"))


def test_topic_roundtrip_files(spark, tmpdir_fresh):
    r = _recs(spark, [("k", "v1", "a", 0, 0, T0), ("k", "v2", "b", 0, 1, T0)])
    out_recs = topics.to_records(r, F.col("topic"))
    assert out_recs.columns == ["key", "value", "topic", "headers", "partition", "offset", "timestamp"]
    topics.write_topic(out_recs, path=f"{tmpdir_fresh}/t")
    back = topics.read_topic_batch(spark, ["a"], path=f"{tmpdir_fresh}/t")
    assert [x.value for x in back.collect()] == ["v1"]
    s = topics.read_topic_stream(spark, ["b"], path=f"{tmpdir_fresh}/t")
    out = streams.run_available_now(s.select("key", "value", "topic"), "rt", root=f"{tmpdir_fresh}/q")
    assert [x.value for x in spark.read.parquet(out).collect()] == ["v2"]


def test_late_records_are_dropped(spark, tmpdir_fresh):
    ok = '{"payload":{"status":"CHARGED"}}'
    first = spark.createDataFrame([("k", ok, "p", 0, 0, T0 + dt.timedelta(days=3))], REC)
    late = spark.createDataFrame([("k", ok, "p", 0, 1, T0), ("k", ok, "p", 0, 2, T0 + dt.timedelta(days=5))], REC)
    # lateness is judged by the watermark of the batch before, so one more batch on time comes between
    between = spark.createDataFrame([("k", ok, "p", 0, 3, T0 + dt.timedelta(days=3, hours=1))], REC)
    src = f"{tmpdir_fresh}/src"
    import time
    for k, batch in enumerate((first, between, late)):
        batch.coalesce(1).write.parquet(f"{src}/{k}")
        time.sleep(1.1)
    stream = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    out = streams.run_available_now(streams.status_counts_stream(stream, "1 hour"), "late", root=f"{tmpdir_fresh}/q")
    starts = {r.window_start for r in spark.read.parquet(out).collect()}
    assert T0 not in starts  # 3 days behind the watermark: dropped, no side output
    assert T0 + dt.timedelta(days=3) in starts


def test_split_writer_and_restart(spark, tmpdir_fresh):
    good, dead = f"{tmpdir_fresh}/good", f"{tmpdir_fresh}/dead"
    src = f"{tmpdir_fresh}/in"
    spark.createDataFrame([("k", '{"a":1}', "t", 0, 0, T0), ("k", "{bad", "t", 0, 1, T0)], REC).write.parquet(src + "/1")
    from eventide.operators.envelope import parse_envelope

    def run():
        s = spark.readStream.schema(REC).parquet(src + "/*")
        q = parse_envelope(s).writeStream.foreachBatch(sinks.split_writer(good, dead)).option(
            "checkpointLocation", f"{tmpdir_fresh}/ckpt").trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    spark.createDataFrame([("k", '{"a":2}', "t", 0, 2, T0)], REC).write.parquet(src + "/2")
    run()  # restart from the checkpoint: only the new file is processed
    assert sorted(r.offset for r in spark.read.parquet(good).collect()) == [0, 2]
    d = spark.read.parquet(dead).collect()
    assert [(r.offset, r.topic) for r in d] == [(1, "t.dlt")]


def test_upsert_writer(spark, tmpdir_fresh):
    table = f"{tmpdir_fresh}/tbl"
    w = sinks.upsert_writer(table, ["id"], ["v"])
    w(spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int"), 0)
    w(spark.createDataFrame([("a", 2), ("a", 3), ("c", 1)], "id string, v int"), 1)
    got = sorted((r.id, r.v) for r in sinks.latest_version(spark, table).collect())
    assert got == [("a", 3), ("b", 1), ("c", 1)]


def test_observed_counters(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([("x", None), ("y", "bad")], "v string, error_reason string")
    obs = Observation("consumer")
    df.observe(obs, F.count(F.lit(1)).alias("received"),
               F.count_if(F.col("error_reason").isNotNull()).alias("failed")).collect()
    assert obs.get == {"received": 2, "failed": 1}
    out = metrics.observe_counters(df, "c2", F.col("error_reason").isNotNull())
    assert out.count() == 2


def test_read_write_table(spark, tmpdir_fresh):
    from eventide.sources import tables

    df = spark.createDataFrame([("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")], "id string, v int, day string")
    tables.write_table(df, f"{tmpdir_fresh}/t", partition_by=["day"])
    back = tables.read_table(spark, f"{tmpdir_fresh}/t").where("day = '2024-01-02'")
    assert [r.id for r in back.collect()] == ["b"]
