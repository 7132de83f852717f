"""``foreachBatch`` sinks: quarantine split, idempotent upsert, metrics.

Each micro-batch is persisted once and written to two outputs (good rows,
dead letters); writes are keyed by the batch id so a retried batch
overwrites its own output instead of appending twice (exactly-once with the
checkpoint).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import EXCEPTION_HEADER
from ..operators.tables import upsert_table

HEADERS = "array<struct<key:string,value:binary>>"


def split_writer(good_path: str, dead_path: str, error_col: str = "error_reason"):
    """foreachBatch function: good rows and dead letters to two Parquet folders."""

    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            bad = F.col(error_col).isNotNull()
            b.where(~bad).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
                f"{good_path}/batch_id={batch_id}")
            dead = b.where(bad)
            if "topic" in dead.columns:
                dead = dead.withColumn("topic", F.concat(F.col("topic"), F.lit(".dlt")))
            # the cause goes along as a record header, where dlt_causes looks for it
            cause = F.array(F.struct(F.lit(EXCEPTION_HEADER).alias("key"), F.col(error_col).cast("binary").alias("value")))
            dead = dead.withColumn("headers", F.concat(F.coalesce("headers", F.array().cast(HEADERS)), cause) if "headers" in dead.columns else cause)
            dead.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
                f"{dead_path}/batch_id={batch_id}")
        finally:
            b.unpersist()

    return write


def upsert_writer(table_path: str, key: list[str], order: list[str]):
    """foreachBatch function: merge the batch into a snapshot table.

    The snapshot of a batch is written to ``<table>/v=<batch_id>``.  A version
    counts only once its writer has committed it (``_SUCCESS``), and a batch
    reads the newest committed version before its own, so a batch that is
    retried after a crash, during or after its write, gives the same snapshot.
    The first snapshot is reduced to one row per key like any other.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        current = latest_version(batch.sparkSession, table_path, before=batch_id)
        snap = upsert_table(batch.limit(0) if current is None else current, batch if current is None else batch.select(*current.columns), key, order)
        snap.write.mode("overwrite").parquet(f"{table_path}/v={batch_id:012d}")

    return write


def latest_version(spark, table_path: str, before: int | None = None):
    """The newest committed snapshot of an upserted table (of a batch below ``before``), or None."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(table_path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return None
    found = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{table_path}/{name}/_SUCCESS")):
            found.append(int(name[2:]))
    found = [v for v in found if before is None or v < before]
    return spark.read.parquet(f"{table_path}/v={max(found):012d}") if found else None
