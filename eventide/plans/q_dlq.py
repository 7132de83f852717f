"""Queries: dead-letter listing, counts, peek, replay, causes, lag."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import is_dlt_topic
from ..operators import dlq, metrics
from ..sources import driver_tables as dt
from .registry import query
from .sql_inputs import TOPIC_RECORDS, with_

DLT_SQL = "regexp_matches(topic, '(-dlt|-DLT|\\.DLT|\\.dlt)$')"
ORIGIN_SQL = "substr(topic, 1, length(topic) - 4)"
AS_OF = "2024-01-20 00:00:00"
TR = with_(TOPIC_RECORDS)


def _records(spark, sf_dir):
    return dt.topic_records(dt.table(spark, sf_dir, "events"))


@query("dlt_topics", TR + f"SELECT DISTINCT topic FROM topic_records WHERE {DLT_SQL} ORDER BY topic")
def q_dlt_topics(spark, sf_dir):
    return dlq.dlt_topics(_records(spark, sf_dir))


ASKED = ["order.created.dlt", "payment.requested-dlt", "missing.dlt", "orders"]


@query("dlt_count", TR + f""",
asked AS (SELECT unnest({ASKED!r}) AS topic),
c AS (SELECT topic, count(*) AS cnt FROM topic_records WHERE {DLT_SQL} GROUP BY topic)
SELECT a.topic, CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt
FROM (SELECT DISTINCT topic FROM asked WHERE {DLT_SQL}) a LEFT JOIN c USING (topic)""")
def q_dlt_count(spark, sf_dir):
    asked = spark.createDataFrame([(t,) for t in ASKED], "topic string")
    return dlq.dlt_count(_records(spark, sf_dir), asked)


@query("dlt_purge_count", TR + f"SELECT topic, count(*) AS cnt FROM topic_records WHERE {DLT_SQL} GROUP BY topic")
def q_dlt_purge_count(spark, sf_dir):
    return dlq.dlt_purge_count(_records(spark, sf_dir))


@query("dlt_peek", TR + f"""
SELECT topic, "partition", "offset", rn, key, value FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY topic ORDER BY "partition", "offset") AS INTEGER) AS rn
  FROM topic_records WHERE {DLT_SQL}) WHERE rn <= 10""")
def q_dlt_peek(spark, sf_dir):
    return dlq.dlt_peek(_records(spark, sf_dir), 10)


REPLAY_COLS = f"""{ORIGIN_SQL} AS topic, key, value, CAST(NULL AS INTEGER) AS "partition", "timestamp",
       topic AS source_topic, "offset" AS source_offset"""


@query("dlt_replay", TR + f"SELECT {REPLAY_COLS} FROM topic_records WHERE {DLT_SQL}")
def q_dlt_replay(spark, sf_dir):
    return dlq.dlt_replay(_records(spark, sf_dir)).drop("headers")


@query("dlt_replay_range", TR + f"""
SELECT {REPLAY_COLS} FROM topic_records
WHERE topic = 'payment.requested-dlt' AND "partition" = 0 AND "offset" BETWEEN 100 AND 5000""")
def q_dlt_replay_range(spark, sf_dir):
    return dlq.dlt_replay_range(_records(spark, sf_dir), "payment.requested-dlt", 100, 5000, 0).drop("headers")


@query("dlt_causes", TR + f"""
SELECT exception_message AS cause, count(*) AS cnt FROM topic_records WHERE {DLT_SQL} GROUP BY 1""")
def q_dlt_causes(spark, sf_dir):
    return dlq.dlt_causes(_records(spark, sf_dir))


@query("dlt_total", TR + f"""
SELECT count(*) FILTER (WHERE {DLT_SQL}) AS dlt_total, count(*) AS messages,
       CASE WHEN count(*) > 0 THEN round(100.0 * count(*) FILTER (WHERE {DLT_SQL}) / count(*), 6) ELSE 0.0 END
         AS dlt_ratio_pct
FROM topic_records""")
def q_dlt_total(spark, sf_dir):
    return metrics.dlt_totals(_records(spark, sf_dir), is_dlt_topic("topic"))


def _committed(records, as_of=AS_OF):
    """Stand-in consumer positions: a group that has read everything before ``as_of``."""
    return (records.where(F.col("timestamp") < F.lit(as_of).cast("timestamp_ntz"))
            .groupBy("topic", "partition").agg((F.max("offset") + 1).alias("committed"))
            .select(F.lit("analytics").alias("group_id"), "topic", "partition", "committed"))


COMMITTED_SQL = f""",
committed AS (
  SELECT 'analytics' AS group_id, topic, "partition", max("offset") + 1 AS committed
  FROM topic_records WHERE "timestamp" < TIMESTAMP '{AS_OF}' GROUP BY topic, "partition"
)
"""


@query("consumer_lag", TR + COMMITTED_SQL + """,
ends AS (SELECT topic, "partition", max("offset") + 1 AS end_offset FROM topic_records GROUP BY 1, 2)
SELECT group_id, topic, CAST(sum(greatest(end_offset - committed, 0)) AS BIGINT) AS lag
FROM ends JOIN committed USING (topic, "partition") GROUP BY 1, 2""")
def q_consumer_lag(spark, sf_dir):
    r = _records(spark, sf_dir)
    return metrics.consumer_lag(r, _committed(r))


@query("replay_from_time", TR + COMMITTED_SQL + f""",
targets AS (
  SELECT topic, "partition", min("offset") AS new_offset FROM topic_records
  WHERE "timestamp" >= TIMESTAMP '{AS_OF}' - INTERVAL 6 HOUR GROUP BY 1, 2
)
SELECT group_id, topic, "partition", committed, new_offset FROM committed JOIN targets USING (topic, "partition")""")
def q_replay_from_time(spark, sf_dir):
    r = _records(spark, sf_dir)
    return dlq.replay_from_time(r, _committed(r), AS_OF, "6h")
