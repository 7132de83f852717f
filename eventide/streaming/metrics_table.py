"""Metrics of a stream as a table of counter samples.

Each micro-batch adds one row per series (metric and labels): what the counter
grew by and the batch's time (its greatest event time).  ``samples`` gives the
cumulative values, as a scrape would, ready for ``promql.counter_rate``; they
go on after a restart, since the increments are in the table, and a batch that
is run again adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .layers import PART, LayeredTable


class MetricsTable:
    def __init__(self, spark: SparkSession, path: str, labels: list[str], max_layers: int = 8):
        self.labels = labels
        held = ", ".join(f"{x} string" for x in labels)
        self.table = LayeredTable(spark, path, f"batch_id bigint, ts timestamp_ntz, metric string, {held}, n bigint", None, max_layers)

    def record(self, rows: DataFrame, batch_id: int, counters: dict[str, Column], ts: str = "timestamp") -> bool:
        """Adds how many of ``rows`` each counter's condition holds for, by labels; False if the batch was recorded before."""
        if self.table.has(batch_id):
            return False
        counts = rows.groupBy(*self.labels).agg(F.max(ts).alias("_ts"), *(F.count_if(c).alias(name) for name, c in counters.items()))
        counts = counts.withColumn("ts", F.max("_ts").over(Window.partitionBy()))  # one row per label set
        each = F.explode(F.array(*(F.struct(F.lit(name).alias("metric"), F.col(name).alias("n")) for name in counters)))
        grown = counts.select(F.lit(batch_id).cast("bigint").alias("batch_id"), F.col("ts").cast("timestamp_ntz").alias("ts"), *self.labels, each.alias("m"))
        grown = grown.select("batch_id", "ts", "m.metric", *self.labels, "m.n")
        return self.table.append(grown.withColumn(PART, F.date_format("ts", "'d'yyyyMMdd")), batch_id)

    def samples(self) -> DataFrame:
        """ts, metric, labels and the counter's value after each batch that touched it."""
        so_far = Window.partitionBy("metric", *self.labels).orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
        return self.table.read().select("ts", "metric", *self.labels, F.sum("n").over(so_far).cast("double").alias("value"))
