"""The windowed counts as a stored table that micro-batches add to.

``WindowStore.add`` takes the records of one micro-batch: one partial
aggregate counts them per window size, window and status, and the counts are
added to the parts (size and day) they touch; reading sums the layers.  The
stream time (greatest event time of the batches before) is kept in the
manifest.  A record whose window began a day or more before the stream time
comes too late (the grace is 24 h less the window): it is not counted for that
size, but written to ``late`` and counted in the manifest.  A batch that is
run again adds nothing.

``fetch`` reads the days that the asked range touches and no others;
``expire`` lets go of days beyond the retention.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json_fields import payment_status
from .layers import PART, LayeredTable
from .streams import DAY_SECONDS, interval_seconds

SCHEMA = "size string, window_start timestamp_ntz, status string, cnt bigint"
SIZES = ("1 hour", "6 hours")


def _label(size: str) -> str:
    return size.replace(" ", "")


def _part(size: Column, start: Column) -> Column:
    return F.concat(F.replace(size, F.lit(" "), F.lit("")), F.lit("d"), F.date_format(start, "yyyyMMdd"))


def _sum_layers(rows: DataFrame) -> DataFrame:
    return rows.groupBy("size", "window_start", "status", PART).agg(F.sum("cnt").alias("cnt"))


class WindowStore:
    def __init__(self, spark: SparkSession, path: str, sizes: tuple[str, ...] = SIZES, max_layers: int = 8):
        self.spark, self.path, self.sizes = spark, path, sizes
        self.table = LayeredTable(spark, f"{path}/counts", SCHEMA, _sum_layers, max_layers)

    def _windows(self, records: DataFrame, ts: str, stream_time: int | None) -> DataFrame:
        """A row per record and size: its window, and whether it comes too late."""
        us = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {ts})")
        begin = lambda size: (us - F.pmod(us, F.lit(interval_seconds(size) * 1_000_000)))
        each = F.explode(F.array(*(F.struct(F.lit(s).alias("size"), begin(s).alias("us")) for s in self.sizes)))
        late = F.lit(False) if stream_time is None else F.col("w.us") + DAY_SECONDS * 1_000_000 <= F.lit(stream_time)
        start = F.expr("timestampadd(MICROSECOND, w.us, TIMESTAMP_NTZ '1970-01-01 00:00:00')")
        return records.withColumn("w", each).select("*", F.col("w.size").alias("size"), start.alias("window_start"), late.alias("is_late")).drop("w")

    def add(self, records: DataFrame, batch_id: int, ts: str = "timestamp", value: str = "value") -> bool:
        """Adds the records of a micro-batch; False if they were added before."""
        if self.table.has(batch_id):
            return False
        notes = self.table.state()["notes"]
        stream_time = notes.get("stream_time")
        records = records.persist()
        try:
            rows = self._windows(records.withColumn("status", payment_status(value)), ts, stream_time)
            late = rows.where("is_late").drop("is_late")
            late.write.mode("overwrite").parquet(f"{self.path}/late/batch_id={batch_id}")
            seen = records.agg(F.max(F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {ts})"))).first()[0]
            n_late = self.spark.read.parquet(f"{self.path}/late/batch_id={batch_id}").count()
            counts = rows.where(~F.col("is_late")).groupBy("size", "window_start", "status").agg(F.count("*").alias("cnt"))
            known = [t for t in (stream_time, seen) if t is not None]
            return self.table.append(counts.withColumn(PART, _part(F.col("size"), F.col("window_start"))), batch_id,
                                     {"stream_time": max(known, default=None), "late": notes.get("late", 0) + n_late})
        finally:
            records.unpersist()

    def counts(self) -> DataFrame:
        """size, window_start, window_end, status, cnt of every stored window."""
        return self._shown(self.table.read())

    def _shown(self, rows: DataFrame) -> DataFrame:
        end = F.coalesce(*(F.when(F.col("size") == s, F.col("window_start") + F.expr(f"INTERVAL {s}")) for s in self.sizes))
        return rows.select("size", "window_start", end.alias("window_end"), "status", "cnt")

    def fetch(self, status: str, size: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
        """Windows of a status that begin in [start, end]; reads the days of that range."""
        days = [start.date() + dt.timedelta(days=k) for k in range((end.date() - start.date()).days + 1)]
        found = self.table.read([f"{_label(size)}d{d:%Y%m%d}" for d in days])
        s, e = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
        return self._shown(found.where((F.col("status") == status) & F.col("window_start").between(s, e)))

    def late(self) -> DataFrame:
        """The records that came too late, by size, with their batch."""
        return self.spark.read.parquet(f"{self.path}/late")

    def expire(self, days: int) -> None:
        """Lets go of days that ended more than ``days`` before the stream time."""
        now = self.table.state()["notes"].get("stream_time")
        if now is not None:
            last = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=now) - dt.timedelta(days=days)
            self.table.drop_parts(p for p in self.table.files() if p[-8:] < f"{last:%Y%m%d}")
