"""Queries: topics, tables and sinks written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codes import EXCEPTION_HEADER
from ..functions.columns import ntz_as_utc
from ..operators import dlq, envelope
from ..sources import driver_tables as dt
from ..sources import tables, topics
from ..streaming import sinks, streams
from .q_hygiene import PARSED, _faulted
from .q_streams import BLOCKS, _block, _each_batch, _fresh
from .registry import query
from .sql_inputs import TOPIC_RECORDS, with_

READ = ["order.created", "payment.requested-dlt"]
FROM_TIME, FROM_MS = "2024-01-12 00:00:00", 1_705_017_600_000
_READ_SQL = with_(TOPIC_RECORDS) + """
SELECT key, value, topic, "partition", "offset", epoch_us("timestamp") AS ts_us, exception_message AS cause
FROM topic_records WHERE topic IN ('order.created', 'payment.requested-dlt')"""


def _written(spark, sf_dir, name):
    """All topics of the records, written to a fresh record folder."""
    path = f"{_fresh(spark, name)}/topics"
    records = dt.topic_records(dt.table(spark, sf_dir, "events")).withColumn("timestamp", ntz_as_utc("timestamp"))
    topics.write_topic(topics.to_records(records, F.col("topic")), path=path)
    return path


def _shown(records):
    return records.select("key", "value", "topic", "partition", "offset", F.unix_micros("timestamp").alias("ts_us"),
                          dlq.header_text("headers", EXCEPTION_HEADER).alias("cause"))


@query("read_topic_batch", _READ_SQL)
def q_read_topic_batch(spark, sf_dir):
    """Records of every topic are written; two topics are read back (the others' folders are not opened)."""
    return _shown(topics.read_topic_batch(spark, READ, path=_written(spark, sf_dir, "topic_batch")))


@query("read_topic_stream", _READ_SQL + f""" AND "timestamp" >= TIMESTAMP '{FROM_TIME}'""")
def q_read_topic_stream(spark, sf_dir):
    """The same topics as a stream from a point in time, a few files a micro-batch."""
    path = _written(spark, sf_dir, "topic_stream")
    stream = topics.read_topic_stream(spark, READ, path=path, max_per_trigger=4, from_timestamp_ms=FROM_MS)
    return _shown(spark.read.parquet(streams.run_available_now(stream, "topic_stream", root=f"{path}-run")))


@query("read_table", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_totalprice > 1000""")
def q_read_table(spark, sf_dir):
    """The orders written as a table by status and read back: two folders, four columns, one pushed filter."""
    path = f"{_fresh(spark, 'table')}/orders"
    tables.write_table(dt.table(spark, sf_dir, "orders"), path, partition_by=["o_orderstatus"])
    kept = tables.read_table(spark, path).where(F.col("o_orderstatus").isin("F", "P") & (F.col("o_totalprice") > 1000))
    return kept.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query("write_dead_letter", PARSED + """
SELECT key, value, topic || '.dlt' AS topic, "partition", "offset", copy, error_reason AS cause FROM parsed WHERE error_reason IS NOT NULL""")
def q_write_dead_letter(spark, sf_dir):
    """Unparsable records of a stream of several micro-batches on their dead-letter topics, with the cause as a header."""
    base = _fresh(spark, "dead_letter")
    split = sinks.split_writer(f"{base}/good", f"{base}/dead")
    _each_batch(_faulted(spark, sf_dir), base, _block(F.col("timestamp")), lambda batch, k: split(envelope.parse_envelope(batch), k))
    dead = spark.read.parquet(f"{base}/dead")
    return dead.select("key", "value", "topic", "partition", "offset", "copy", dlq.header_text("headers", EXCEPTION_HEADER).alias("cause"))


@query("delivery", """
SELECT event_type, user_id % 16 AS slot, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY ALL""")
def q_delivery(spark, sf_dir):
    """A sink that gets its last batch twice, as after a crash between the write and the commit: each row counts once."""
    base = _fresh(spark, "delivery")
    events = dt.table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 16).alias("slot"), "event_id", "value", "ts")
    write = sinks.upsert_writer(f"{base}/table", ["event_type", "slot"], ["event_id"])
    _each_batch(events, base, _block(F.col("ts")), write)
    again = spark.read.parquet(f"{base}/src").where(F.col("block") == BLOCKS - 1)
    write(again, BLOCKS - 1)
    return sinks.latest_version(spark, f"{base}/table").select("event_type", "slot", "event_id", "value")
