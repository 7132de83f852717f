"""Topic I/O with the Kafka source layout.

On a cluster with the Kafka connector the functions read and write Kafka
directly (``format("kafka")``).  Without it (tests, this container) the same
record layout is kept in Parquet folders partitioned by topic, read with the
file source (batch or streaming) and written with the file sink.  Either way
the operators only see the columns ``key, value, topic, partition, offset,
timestamp[, headers]``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC_SCHEMA = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp, "
    "headers array<struct<key:string,value:binary>>"
)


def _kafka_frame(df: DataFrame) -> DataFrame:
    """Kafka source columns -> string key/value layout."""
    cols = [
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp",
    ]
    if "headers" in df.columns:
        cols.append("headers")
    return df.select(*cols)


def read_topic_batch(
    spark: SparkSession,
    topics: list[str],
    bootstrap: str | None = None,
    path: str | None = None,
    starting: str = "earliest",
    ending: str = "latest",
) -> DataFrame:
    """Bounded scan of topics from their beginning to the current end."""
    if bootstrap:
        df = (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", ",".join(topics)).option("startingOffsets", starting)
              .option("endingOffsets", ending).option("includeHeaders", "true").load())
        return _kafka_frame(df)
    df = spark.read.schema(TOPIC_SCHEMA).parquet(path)
    return df.where(F.col("topic").isin(*topics))


def read_topic_stream(
    spark: SparkSession,
    topics: list[str],
    bootstrap: str | None = None,
    path: str | None = None,
    max_per_trigger: int | None = None,
    from_timestamp_ms: int | None = None,
) -> DataFrame:
    """Continuous scan from the earliest offset (Kafka) or of a record folder.

    ``from_timestamp_ms`` starts every partition at its first offset with a
    record timestamp at or after that time (Kafka ``startingTimestamp``): the
    streaming form of ``replay_from_time``.  Partitions without such a record
    start at the end."""
    if bootstrap:
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
             .option("subscribe", ",".join(topics)).option("includeHeaders", "true"))
        if from_timestamp_ms is not None:
            r = r.option("startingTimestamp", str(int(from_timestamp_ms))).option(
                "startingOffsetsByTimestampStrategy", "latest")
        else:
            r = r.option("startingOffsets", "earliest")
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return _kafka_frame(r.load())
    r = spark.readStream.schema(TOPIC_SCHEMA)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    df = r.parquet(path).where(F.col("topic").isin(*topics))
    if from_timestamp_ms is not None:
        df = df.where(F.col("timestamp") >= F.timestamp_millis(F.lit(int(from_timestamp_ms))))
    return df


def to_records(df: DataFrame, topic, key: str = "key", value: str = "value") -> DataFrame:
    """Project rows to producer records; ``topic`` is a name or a column.

    Headers, partition, offset and timestamp go along where the rows have them
    (``write_topic`` gives Kafka those that a producer may set)."""
    t = F.lit(topic) if isinstance(topic, str) else topic
    cols = [F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"), t.alias("topic")]
    return df.select(*cols, *[c for c in ("headers", "partition", "offset", "timestamp") if c in df.columns])


def write_topic(df: DataFrame, bootstrap: str | None = None, path: str | None = None, mode: str = "append") -> None:
    """Produce keyed records; the target topic is chosen per record (``topic`` column).

    Kafka numbers and stamps the records itself; a record folder keeps the
    offset and time that the rows bring."""
    if bootstrap:
        df.drop("offset", "timestamp").write.format("kafka").option("kafka.bootstrap.servers", bootstrap).save()
        return
    df.write.mode(mode).partitionBy("topic").parquet(path)
