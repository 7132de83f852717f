"""Table maintenance: upsert by primary key and the outbox change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_table(current: DataFrame, updates: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """``save(entity)`` semantics for a batch: the latest update per key (by
    ``order``) replaces the current row; other rows stay.

    The latest update is a ``max_by`` aggregate (map-side combined); the old
    rows survive through ``left_anti`` and the union is the new snapshot, to be
    written with overwrite (or as a new table version)."""
    cols = current.columns
    latest = updates.groupBy(*key).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols if c not in key]), F.struct(*[F.col(c) for c in order]))
        .alias("_r")).select(*key, "_r.*")
    kept = current.join(latest.select(*key), key, "left_anti")
    return kept.unionByName(latest.select(*cols))


def outbox_change_feed(outbox: DataFrame, routes: dict[str, str] | None = None) -> DataFrame:
    """Outbox rows -> topic records: key = aggregate id, value = payload, topic
    routed by event type (default ``OrderCreated -> order.created``), headers
    carry the outbox id and type; one record per outbox id."""
    routes = routes or {"OrderCreated": "order.created"}
    topic = None
    for t, dest in routes.items():
        topic = F.when(F.col("type") == t, F.lit(dest)) if topic is None else topic.when(F.col("type") == t, dest)
    topic = topic.otherwise(F.concat(F.lit("outbox."), F.col("type")))
    headers = F.array(
        F.struct(F.lit("id").alias("key"), F.col("id").cast("binary").alias("value")),
        F.struct(F.lit("eventType").alias("key"), F.col("type").cast("binary").alias("value")),
    )
    return outbox.dropDuplicates(["id"]).select(
        F.col("aggregate_id").cast("string").alias("key"), F.col("payload").alias("value"), topic.alias("topic"),
        F.col("occurred_at").alias("timestamp"), headers.alias("headers"))
