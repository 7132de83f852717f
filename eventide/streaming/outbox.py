"""The outbox change feed in runs: each run publishes what it has not published yet.

The high-water mark (greatest ``occurred_at`` seen) is committed with the ids
of the published rows.  A run reads the rows after the mark less an overlap
and leaves out the published ids of those days, so a row that its transaction
commits late, up to the overlap, is published by the run that first sees it,
and no row is published twice.  Records are written before the ids are
committed, to a folder of the run, so a run that is repeated after a crash
replaces its own records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import outbox_change_feed
from .layers import PART, LayeredTable
from .streams import interval_seconds

_MARK = "yyyy-MM-dd HH:mm:ss.SSSSSS"


class OutboxFeed:
    def __init__(self, spark: SparkSession, path: str, overlap: str = "6 hours", max_layers: int = 8):
        interval_seconds(overlap)
        self.spark, self.path, self.overlap = spark, path, overlap
        self.published = LayeredTable(spark, f"{path}/published", "id string", None, max_layers)

    def publish(self, outbox: DataFrame, run_id: int) -> bool:
        """Publishes the new rows of ``outbox`` as the records of a run; False if the run is committed."""
        if self.published.has(run_id):
            return False
        mark = self.published.state()["notes"].get("mark")
        day = F.date_format("occurred_at", "'d'yyyyMMdd")
        rows = outbox
        if mark is not None:
            since = F.lit(mark).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.overlap}")
            first = self.spark.range(1).select(F.date_format(since, "'d'yyyyMMdd")).first()[0]
            known = self.published.read(p for p in self.published.files() if p >= first)
            rows = outbox.where(F.col("occurred_at") > since).join(known.select("id"), "id", "left_anti")
        out = f"{self.path}/records/run_id={run_id}"
        outbox_change_feed(rows).write.mode("overwrite").parquet(out)
        records = self.spark.read.parquet(out)
        ids = records.select(F.filter("headers", lambda h: h["key"] == "id")[0]["value"].cast("string").alias("id"), F.col("timestamp").alias("occurred_at"))
        newest = ids.agg(F.date_format(F.max("occurred_at"), _MARK)).first()[0]
        marks = [m for m in (mark, newest) if m is not None]
        return self.published.append(ids.select("id", day.alias(PART)), run_id, {"mark": max(marks, default=None)})

    def records(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/records")
