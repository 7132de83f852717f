"""Envelope parsing/building, result-message parsing, validation, quarantine.

All projections are built-in JSON expressions; a bad record never raises,
it gets an ``error_reason`` and is routed by ``split_quarantine``.  No
operator here shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.columns import valid_uuid
from ..functions.json_fields import blank, is_json, non_blank, with_json


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def parse_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """Add order_id, event_id, type, payload and ``error_reason``.

    Missing fields default to NULL (payload to ``{}``); an unparsable
    document is an error (``Envelope parse failed``), never an exception.
    The document is parsed once (``from_json`` into four string fields).
    """
    x = with_json(df, value, ["orderId", "eventId", "type", "payload"], "_env")
    ok = F.col("_env_ok")
    return x.select(
        *df.columns,
        F.when(ok, F.col("_env.orderId")).alias("order_id"),
        F.when(ok, F.col("_env.eventId")).alias("event_id"),
        F.when(ok, F.col("_env.type")).alias("type"),
        F.when(ok, F.coalesce(F.col("_env.payload"), F.lit("{}"))).alias("payload"),
        F.when(~ok, F.lit("Envelope parse failed")).alias("error_reason"),
    )


def build_envelope(
    df: DataFrame,
    order_id: str = "order_id",
    event_id: str = "event_id",
    type_: str = "type",
    payload: str = "payload",
    out: str = "envelope",
) -> DataFrame:
    """JSON envelope ``{orderId,eventId,type,payload}`` with payload as text.

    NULL or blank payload becomes ``{}``; a payload that is not JSON yields
    ``error_reason = 'Envelope build failed'`` and a NULL envelope.
    """
    p = _c(payload)
    p_fixed = F.when(blank(p), F.lit("{}")).otherwise(p)
    valid = blank(p) | is_json(p)
    env = F.to_json(
        F.struct(
            _c(order_id).alias("orderId"),
            _c(event_id).alias("eventId"),
            _c(type_).alias("type"),
            p_fixed.alias("payload"),
        ),
        {"ignoreNullFields": "false"},
    )
    return df.withColumn(out, F.when(valid, env)).withColumn(
        "error_reason", F.when(~valid, F.lit("Envelope build failed"))
    )


def split_quarantine(df: DataFrame, error_col: str = "error_reason") -> tuple[DataFrame, DataFrame]:
    """(good, quarantined) by the error column; both are lazy filters of one plan.

    Persist ``df`` (or write it once) before using both halves when the input
    is expensive; ``streaming.sinks.split_writer`` does that per micro-batch.
    """
    bad = F.col(error_col).isNotNull()
    return df.where(~bad), df.where(bad)


def parse_order_created(df: DataFrame, value: str = "value") -> DataFrame:
    """order.created: payload if present (text or object), else the message.

    orderId required (blank -> error), total -> 0.0, currency -> USD,
    customerId -> N/A, shippingAddress -> NULL.
    """
    x = _with_unwrapped(df, value, ["orderId", "total", "currency", "customerId", "shippingAddress"])
    oid = F.col("_b.orderId")
    return _drop_tmp(x.select(
        "*",
        oid.alias("order_id"),
        F.coalesce(F.col("_b.total").try_cast("double"), F.lit(0.0)).alias("total"),
        F.coalesce(F.col("_b.currency"), F.lit(codes.CURRENCY_DEFAULT)).alias("currency"),
        F.coalesce(F.col("_b.customerId"), F.lit(codes.CUSTOMER_DEFAULT)).alias("customer_id"),
        F.col("_b.shippingAddress").alias("shipping_address"),
        F.when(~F.col("_b_ok"), F.lit("Failed to parse order.created"))
        .when(blank(oid), F.lit("Missing orderId"))
        .alias("error_reason"),
    ))


def build_payment_request(df: DataFrame) -> DataFrame:
    """``{orderId, amount, currency}`` payload for payment.requested."""
    return df.withColumn(
        "payment_request",
        F.to_json(F.struct(F.col("order_id").alias("orderId"), F.col("total").alias("amount"),
                           F.col("currency").alias("currency"))),
    )


def _with_body(df: DataFrame, value: str, fields: list[str]) -> DataFrame:
    """Envelope parsed once, then its payload (text or object) parsed once:
    ``_env`` / ``_env_ok`` and ``_b`` / ``_b_ok``."""
    x = with_json(df, value, ["orderId", "payload"], "_env")
    x = x.withColumn("_body", F.when(F.col("_env_ok"), F.col("_env.payload")))
    return with_json(x, "_body", fields, "_b")


def _with_unwrapped(df: DataFrame, value: str, fields: list[str]) -> DataFrame:
    """The payload (text or object) if the message has one, else the message
    itself, parsed once: ``_b`` / ``_b_ok``."""
    x = with_json(df, value, ["payload"], "_env")
    x = x.withColumn("_body", F.when(F.col("_env_ok"), F.coalesce(F.col("_env.payload"), F.col(value))))
    return with_json(x, "_body", fields, "_b")


def _drop_tmp(x: DataFrame) -> DataFrame:
    return x.drop("_env", "_env_ok", "_body", "_b", "_b_ok")


def parse_payment_result(df: DataFrame, value: str = "value") -> DataFrame:
    """status (UNKNOWN default), order_id, payment_id, reason, success flag."""
    x = _with_body(df, value, ["orderId", "status", "paymentId", "reason"])
    status = F.coalesce(F.col("_b.status"), F.lit(codes.PAYMENT_UNKNOWN))
    oid = F.col("_b.orderId")
    return _drop_tmp(x.select(
        "*",
        oid.alias("order_id"),
        status.alias("status"),
        F.col("_b.paymentId").alias("payment_id"),
        F.coalesce(F.col("_b.reason"), F.lit(codes.REASON_PAYMENT_DECLINED)).alias("reason"),
        (F.upper(status) == codes.PAYMENT_OK).alias("success"),
        F.when(~F.col("_b_ok"), F.lit("Failed to parse payment.result"))
        .when(blank(oid), F.lit("Missing orderId")).alias("error_reason"),
    ))


def parse_inventory_result(df: DataFrame, value: str = "value") -> DataFrame:
    """RESERVED ok; OUT_OF_STOCK fail; anything else fails with its text."""
    x = _with_body(df, value, ["status", "reservationId"])
    env_oid = F.when(F.col("_env_ok"), F.col("_env.orderId"))
    status = F.coalesce(F.col("_b.status"), F.lit(""))
    return _drop_tmp(x.select(
        "*",
        env_oid.alias("order_id"),
        status.alias("status"),
        F.col("_b.reservationId").alias("reservation_id"),
        (status == "RESERVED").alias("success"),
        F.when(status == "RESERVED", F.lit(None).cast("string"))
        .when(status == "OUT_OF_STOCK", F.lit(codes.REASON_OUT_OF_STOCK))
        .otherwise(F.concat(F.lit(codes.REASON_UNKNOWN_INVENTORY), status)).alias("reason"),
        F.when(~F.col("_b_ok"), F.lit("Failed to parse inventory.result"))
        .when(blank(env_oid), F.lit("Missing orderId")).alias("error_reason"),
    ))


def parse_shipping_result(df: DataFrame, value: str = "value") -> DataFrame:
    """DELIVERED/SHIPPED ok; FAILED (reason default); anything else fails."""
    x = _with_body(df, value, ["status", "shippingId", "reason"])
    env_oid = F.when(F.col("_env_ok"), F.col("_env.orderId"))
    status = F.coalesce(F.col("_b.status"), F.lit(""))
    ok = status.isin("DELIVERED", "SHIPPED")
    return _drop_tmp(x.select(
        "*",
        env_oid.alias("order_id"),
        status.alias("status"),
        F.col("_b.shippingId").alias("shipping_id"),
        ok.alias("success"),
        F.when(ok, F.lit(None).cast("string"))
        .when(status == "FAILED", F.coalesce(F.col("_b.reason"), F.lit(codes.REASON_SHIPPING_FAILED)))
        .otherwise(F.concat(F.lit(codes.REASON_UNKNOWN_SHIPPING), status)).alias("reason"),
        F.when(~F.col("_b_ok"), F.lit("Failed to parse shipping.result"))
        .when(blank(env_oid), F.lit("Missing orderId")).alias("error_reason"),
    ))


def parse_status_update(df: DataFrame, value: str = "value") -> DataFrame:
    """Bare ``{orderId,status,reason}``; order id must be a UUID."""
    from ..functions.columns import map_status_update

    x = with_json(df, value, ["orderId", "status", "reason"], "_b")
    oid, st = F.col("_b.orderId"), F.col("_b.status")
    return x.select(
        *df.columns,
        oid.alias("order_id"),
        map_status_update(st).alias("new_status"),
        F.col("_b.reason").alias("reason"),
        F.when(~F.col("_b_ok"), F.lit("Invalid JSON"))
        .when(oid.isNull() | st.isNull(), F.lit("Invalid status update message"))
        .when(~valid_uuid(oid), F.lit("Invalid UUID format")).alias("error_reason"),
    )


def validate_inventory_request(df: DataFrame, value: str = "value") -> DataFrame:
    """items default 1 and must be > 0."""
    x = _with_unwrapped(df, value, ["orderId", "items"])
    items = F.coalesce(F.col("_b.items").try_cast("int"), F.lit(1))
    return _drop_tmp(x.select(
        "*", F.col("_b.orderId").alias("order_id"), items.alias("items"),
        F.when(~F.col("_b_ok"), F.lit("Invalid JSON"))
        .when(items <= 0, F.lit("Invalid items count")).alias("error_reason"),
    ))


def validate_shipping_request(df: DataFrame, value: str = "value") -> DataFrame:
    """address must be present, not blank and not ``UNKNOWN``."""
    x = _with_unwrapped(df, value, ["orderId", "address"])
    addr = F.col("_b.address")
    return _drop_tmp(x.select(
        "*", F.col("_b.orderId").alias("order_id"), addr.alias("address"),
        F.when(~F.col("_b_ok"), F.lit("Invalid JSON"))
        .when(blank(addr) | (addr == "UNKNOWN"), F.lit("Invalid address")).alias("error_reason"),
    ))


def validate_create_order(df: DataFrame) -> DataFrame:
    """customer_id and currency not blank; total >= 0.01.  All violations listed."""
    errs = F.array_compact(F.array(
        F.when(blank("customer_id"), F.lit("customerId must not be blank")),
        F.when(blank("currency"), F.lit("currency must not be blank")),
        F.when(F.col("total").isNull() | (F.col("total") < F.lit(0.01)), F.lit("total must be >= 0.01")),
    ))
    return df.withColumn("violations", errs).withColumn(
        "error_reason", F.when(F.size(errs) > 0, F.array_join(errs, "; "))
    )


def non_blank_order_id(df: DataFrame, col: str = "order_id") -> DataFrame:
    return df.where(non_blank(col))
