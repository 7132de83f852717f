"""Dead-letter inspection and replay over topic-shaped tables.

Input records have the Kafka source layout (key, value, topic, partition,
offset, timestamp, headers).  Listing, counting and peeking are aggregates or
per-group top-k; replays are projections that re-target the origin topic and
can be written with ``sources.topics.write_topic``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.columns import dlt_origin, is_dlt_topic


def dlt_topics(records: DataFrame) -> DataFrame:
    """Distinct dead-letter topic names, sorted."""
    return records.select("topic").where(is_dlt_topic("topic")).distinct().orderBy("topic")


def dlt_count(records: DataFrame, topics: DataFrame | None = None) -> DataFrame:
    """Records per DLT topic; topics asked for but absent count 0.

    ``topics`` (one column ``topic``) is a list of names; only DLT names are
    answered (non-DLT requests are rejected, i.e. left out)."""
    counts = records.where(is_dlt_topic("topic")).groupBy("topic").agg(F.count(F.lit(1)).alias("cnt"))
    if topics is None:
        return counts
    asked = topics.where(is_dlt_topic("topic")).distinct()
    return asked.join(counts, "topic", "left").select("topic", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt"))


def dlt_peek(records: DataFrame, n: int = 10, topic: str | None = None) -> DataFrame:
    """First ``n`` values per DLT topic in (partition, offset) order.

    ``row_number() <= n`` gets a window group limit before the shuffle, so at
    most ``n`` rows per topic leave each task even for a huge topic."""
    src = records.where(is_dlt_topic("topic"))
    if topic is not None:
        src = src.where(F.col("topic") == topic)
    w = Window.partitionBy("topic").orderBy("partition", "offset")
    return (src.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
            .select("topic", "partition", "offset", "rn", "key", "value"))


def dlt_replay(records: DataFrame, transform=None) -> DataFrame:
    """Every DLT record re-targeted to its origin topic (same key, value,
    headers, timestamp; partition left to the producer).  ``transform`` may map
    the value column (e.g. upgrade a payload schema) before re-publishing."""
    src = records.where(is_dlt_topic("topic"))
    value = transform(F.col("value")) if transform is not None else F.col("value")
    return src.select(
        dlt_origin("topic").alias("topic"), "key", value.alias("value"),
        F.lit(None).cast("int").alias("partition"), "timestamp",
        *(["headers"] if "headers" in records.columns else []),
        F.col("topic").alias("source_topic"), F.col("offset").alias("source_offset"),
    )


def dlt_replay_range(records: DataFrame, topic: str, from_offset: int, to_offset: int,
                     partition: int = 0) -> DataFrame:
    """Replay offsets ``from..to`` inclusive of one partition of one DLT topic."""
    src = records.where((F.col("topic") == topic) & (F.col("partition") == partition)
                        & F.col("offset").between(from_offset, to_offset))
    return dlt_replay(src)


def dlt_purge_count(records: DataFrame) -> DataFrame:
    """What a purge would remove: record count per DLT topic (nothing deleted)."""
    return dlt_count(records)


def header_text(headers_col: str, name: str):
    """Text of the first header called ``name`` (NULL if absent)."""
    hit = F.filter(F.col(headers_col), lambda h: h["key"] == F.lit(name))
    return F.try_element_at(hit, F.lit(1))["value"].cast("string")


def dlt_causes(records: DataFrame, header: str = codes.EXCEPTION_HEADER) -> DataFrame:
    """Dead letters grouped by the exception message header."""
    src = records.where(is_dlt_topic("topic"))
    return src.groupBy(header_text("headers", header).alias("cause")).agg(F.count(F.lit(1)).alias("cnt"))


def replay_from_time(records: DataFrame, committed: DataFrame, as_of, duration: str) -> DataFrame:
    """Rewind consumer groups to the first offset at or after ``as_of - duration``.

    Per (topic, partition) the target is ``min(offset)`` over records with
    timestamp >= cutoff (one partial aggregate).  Partitions without such a
    record keep their position; groups absent from ``committed`` get nothing.
    ``duration`` accepts ``30m``, ``1h``, ``PT5M`` (see ``parse_duration``).
    """
    secs = parse_duration(duration)
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(secs))
    targets = records.where(F.col("timestamp") >= cutoff).groupBy("topic", "partition").agg(
        F.min("offset").alias("new_offset"))
    return committed.join(targets, ["topic", "partition"], "inner").select(
        "group_id", "topic", "partition", "committed", "new_offset")


def parse_duration(text: str) -> int:
    """Seconds of ``30m`` / ``1h`` / ``45s`` / ``2d`` or ISO ``PT5M`` / ``PTPT5M``."""
    import re

    t = text.strip().upper()
    while t.startswith("PT"):
        t = t[2:]
    total = 0
    for n, u in re.findall(r"(\d+)([DHMS])", t):
        total += int(n) * {"D": 86400, "H": 3600, "M": 60, "S": 1}[u]
    if total == 0 and not re.fullmatch(r"(\d+[DHMS])+", t):
        raise ValueError(f"bad duration: {text}")
    return total
