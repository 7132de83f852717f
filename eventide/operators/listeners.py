"""State updates driven by command/result messages (the consumers' effects).

Every ``apply_*`` is: de-duplicate by the listener's idempotency key, reduce
the messages to one per entity with aggregates (map-side combined), join the
current state on the key, and decide with ``CASE``.  Each returns the new
state table and the emitted result rows, so the caller can write both (an
upsert of the state and an append to the result topic), and then add
``processed_keys`` to the idempotency store that it passes as ``seen``: the
same messages again change nothing and emit nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.columns import order_is_terminal, valid_uuid
from ..functions.json_fields import blank, with_json
from .dedup import dedup_first_seen


def _result_json(order_id, ctype: str, success, service: str):
    return F.to_json(F.struct(
        order_id.alias("orderId"), F.lit(ctype).alias("compensationType"),
        success.alias("success"), F.lit(service).alias("service")))


def apply_status_updates(orders: DataFrame, msgs: DataFrame, seq: str = "offset") -> DataFrame:
    """``order.status.update`` messages (bare JSON ``{orderId,status,reason}``).

    Unconditional overwrite with the mapped status (unknown -> FAILED); the
    reason replaces ``review_reason`` only when non-empty; the last message
    per order wins; invalid JSON / missing fields / non-UUID ids are skipped.
    """
    from ..functions.columns import map_status_update

    x = with_json(msgs, "value", ["orderId", "status", "reason"], "_m")
    oid = F.when(F.col("_m_ok"), F.col("_m.orderId"))
    st = F.when(F.col("_m_ok"), F.col("_m.status"))
    rs = F.when(F.col("_m_ok"), F.col("_m.reason"))
    ok = oid.isNotNull() & st.isNotNull() & valid_uuid(oid)
    parsed = x.select(oid.alias("id"), map_status_update(st).alias("_st"), rs.alias("_rs"), F.col(seq).alias("_seq"),
                      ok.alias("_ok")).where("_ok")
    last = parsed.groupBy("id").agg(
        F.max_by("_st", "_seq").alias("_st"),
        F.max_by(F.struct(F.col("_rs").alias("r")), F.when((F.col("_rs").isNotNull()) & (F.col("_rs") != ""),
                                                          F.col("_seq")))["r"].alias("_rs"),
    )
    j = orders.join(last, "id", "left")
    return j.withColumn("status", F.coalesce("_st", "status")).withColumn(
        "review_reason", F.coalesce("_rs", "review_reason")).drop("_st", "_rs")


def processed_keys(msgs: DataFrame, scope: str) -> DataFrame:
    """The (scope, key) rows to add to the idempotency store once a listener's outputs are written."""
    return msgs.where(F.col("key").isNotNull()).select(F.lit(scope).alias("scope"), "key").distinct()


def _parse_command(msgs: DataFrame, scope: str, ref_field: str | None, seq: str, seen: DataFrame | None):
    """Dedup by ``scope:key`` (first record wins; keys in the store ``seen``
    (scope, key) are skipped) and parse the payload."""
    scoped = msgs.withColumn("scope", F.lit(scope))
    first = dedup_first_seen(scoped, ["key"], [seq], ["scope"], seen)
    fields = ["orderId", "reason"] + ([ref_field] if ref_field else [])
    x = with_json(first, "value", ["payload"], "_env")
    x = x.withColumn("_payload", F.when(F.col("_env_ok"), F.coalesce(F.col("_env.payload"), F.lit("{}"))))
    x = with_json(x, "_payload", fields, "_p")
    cols = [
        F.col("key"), F.col(seq).alias("_seq"),
        F.col("_p.orderId").alias("_oid"),
        F.coalesce(F.col("_p.reason"), F.lit("Saga compensation")).alias("_reason"),
        F.col("_p_ok").alias("_ok"),
    ]
    if ref_field:
        cols.append(F.col(f"_p.{ref_field}").alias("_ref"))
    return x.select(*cols)


def apply_cancellations(orders: DataFrame, msgs: DataFrame, seq: str = "offset", seen: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``order.cancel``: non-terminal orders become CANCELLED with
    ``Cancelled: <reason>``; results ``{orderId, ORDER_CANCEL, success, order-api}``.
    Invalid UUID or unparsable message -> success=false; blank id -> no result."""
    p = _parse_command(msgs, "order.cancel", None, seq, seen)
    p = p.where(~(F.col("_ok") & blank("_oid")))
    good = p.where(F.col("_ok") & valid_uuid("_oid"))
    # the first message of an order decides; a later one finds it cancelled
    cancel = good.groupBy(F.col("_oid").alias("id")).agg(F.min_by("_reason", "_seq").alias("_creason"))
    j = orders.join(cancel, "id", "left")
    hit = F.col("_creason").isNotNull() & ~order_is_terminal("status")
    new_orders = j.withColumn("review_reason", F.when(hit, F.concat(F.lit(codes.REASON_CANCEL_PREFIX),
                                                                       F.col("_creason"))).otherwise(
        F.col("review_reason"))).withColumn(
        "status", F.when(hit, F.lit("CANCELLED")).otherwise(F.col("status"))).drop("_creason")
    rid = F.when(F.col("_ok"), F.col("_oid")).otherwise(F.col("key"))
    success = F.col("_ok") & valid_uuid("_oid")
    results = p.select(rid.alias("order_id"), F.col("_seq").alias("seq"),
                       _result_json(rid, "ORDER_CANCEL", success, "order-api").alias("value"))
    return new_orders, results


def apply_refunds(payment_status: DataFrame, msgs: DataFrame, seq: str = "offset", seen: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``payment.refund`` against the current payment status per order:
    CHARGED -> REFUNDED; already REFUNDED / other / unknown -> unchanged;
    result success=true for every parsable message with an order id."""
    p = _parse_command(msgs, "payment.refund", "paymentId", seq, seen)
    p = p.where(~(F.col("_ok") & blank("_oid")))
    good = p.where("_ok").select(F.col("_oid").alias("order_id"), F.lit(True).alias("_refund"))
    j = payment_status.join(good.distinct(), "order_id", "left")
    new_status = j.withColumn("status", F.when(F.col("_refund") & (F.col("status") == codes.PAYMENT_OK),
                                               F.lit(codes.PAYMENT_REFUNDED)).otherwise(F.col("status"))).drop(
        "_refund")
    rid = F.when(F.col("_ok"), F.col("_oid")).otherwise(F.col("key"))
    results = p.select(rid.alias("order_id"), F.col("_seq").alias("seq"),
                       _result_json(rid, "PAYMENT_REFUND", F.col("_ok"), "payment-svc").alias("value"))
    return new_status, results


def apply_releases(reservations: DataFrame, msgs: DataFrame, seq: str = "offset",
                   seen: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``inventory.release``: the order's first message removes its reservation;
    a release is counted when it removed one or an id was given.
    Returns (remaining reservations, release rows, result rows)."""
    p = _parse_command(msgs, "inventory.release", "reservationId", seq, seen)
    p = p.where(~(F.col("_ok") & F.col("_oid").isNull()))
    good = p.where("_ok")
    known = reservations.select(F.col("order_id").alias("_oid"), F.col("reservation_id").alias("_held"))
    first = good.groupBy("_oid").agg(F.min("_seq").alias("_first"))
    g = good.join(first, "_oid").join(known, "_oid", "left")
    g = g.withColumn("_known", F.when(F.col("_seq") == F.col("_first"), F.col("_held")))
    released = g.select(F.col("_oid").alias("order_id"), F.col("_seq").alias("seq"),
                        (F.col("_known").isNotNull() | F.col("_ref").isNotNull()).alias("counted"),
                        F.coalesce("_ref", "_known").alias("reservation_id"))
    remaining = reservations.join(good.select(F.col("_oid").alias("order_id")).distinct(), "order_id", "left_anti")
    rid = F.when(F.col("_ok"), F.col("_oid")).otherwise(F.col("key"))
    results = p.select(rid.alias("order_id"), F.col("_seq").alias("seq"),
                       _result_json(rid, "INVENTORY_RELEASE", F.col("_ok"), "inventory-svc").alias("value"))
    return remaining, released, results


def compensation_counters(msgs: DataFrame, service: str, scope: str, applied: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """received / duplicate / applied of a compensation consumer, in one row.

    A message is a duplicate when its key came before (in ``msgs``, or in the
    store ``seen`` of (scope, key)); ``applied`` has one row per refund or
    release that took effect."""
    keys = msgs.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    if seen is not None:
        keys = keys.join(seen.where(F.col("scope") == scope).select("key").distinct().withColumn("_old", F.lit(1)), "key", "left")
    else:
        keys = keys.withColumn("_old", F.lit(None).cast("int"))
    again = F.when(F.col("key").isNull(), 0).otherwise(F.col("n") - F.when(F.col("_old").isNull(), 1).otherwise(0))
    counted = keys.agg(F.sum("n").alias("received"), F.sum(again).alias("duplicate")).withColumn("applied", F.lit(0).cast("bigint"))
    took = applied.agg(F.count(F.lit(1)).alias("applied")).select(
        F.lit(0).cast("bigint").alias("received"), F.lit(0).cast("bigint").alias("duplicate"), "applied")
    total = counted.unionByName(took).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("received", "duplicate", "applied")])
    return total.select(F.lit(service).alias("service"), "received", "duplicate", "applied")


def applied_refunds(payment_status: DataFrame, msgs: DataFrame, seq: str = "offset", seen: DataFrame | None = None) -> DataFrame:
    """Orders whose payment a refund message turns from CHARGED to REFUNDED: (order_id)."""
    p = _parse_command(msgs, "payment.refund", "paymentId", seq, seen)
    asked = p.where(F.col("_ok") & ~blank("_oid")).select(F.col("_oid").alias("order_id")).distinct()
    return payment_status.where(F.col("status") == codes.PAYMENT_OK).select("order_id").join(asked, "order_id", "left_semi")


def _result_fields(results: DataFrame, fields: list[str]) -> DataFrame:
    """Envelope and payload of result messages, each parsed once (``_b``)."""
    x = with_json(results, "value", ["payload"], "_env")
    x = x.withColumn("_body", F.when(F.col("_env_ok"), F.col("_env.payload")))
    return with_json(x, "_body", fields, "_b")


def payment_status_lookup(results: DataFrame, seq: str = "offset") -> DataFrame:
    """Current payment status per order: status of its latest payment result."""
    x = _result_fields(results, ["orderId", "status"])
    return (x.select(F.col("_b.orderId").alias("order_id"), F.col("_b.status").alias("_st"), F.col(seq).alias("_seq"))
            .where(F.col("order_id").isNotNull() & F.col("_st").isNotNull())
            .groupBy("order_id").agg(F.max_by("_st", "_seq").alias("status")))


def inventory_request_from_payment(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Choreography consumer: CHARGED -> inventory request (items default 1);
    anything else -> order compensation {reason PAYMENT_FAILED, originalStatus}."""
    x = _result_fields(results, ["orderId", "status", "items"])
    items = F.coalesce(F.col("_b.items").try_cast("int"), F.lit(1))
    parsed = x.select("key", F.col("_b.orderId").alias("order_id"), F.col("_b.status").alias("status"),
                      items.alias("items")).where(F.col("order_id").isNotNull())
    req = parsed.where(F.col("status") == codes.PAYMENT_OK).select(
        "order_id", F.to_json(F.struct(F.col("order_id").alias("orderId"), F.col("items").alias("items")))
        .alias("value"))
    comp = parsed.where(F.coalesce(F.col("status"), F.lit("")) != codes.PAYMENT_OK).select(
        "order_id", F.to_json(F.struct(F.col("order_id").alias("orderId"), F.lit("PAYMENT_FAILED").alias("reason"),
                                       F.col("status").alias("originalStatus")), {"ignoreNullFields": "false"})
        .alias("value"))
    return req, comp
