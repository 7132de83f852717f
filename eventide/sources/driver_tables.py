"""Stand-in inputs built from the driver's test tables.

The reference consumes Kafka topics and Postgres tables that do not exist
here.  These adapters only reshape rows of the driver tables into the schemas
the operators expect (topic records, orders, a saga event log, metric
samples).  They do none of an operator's work, and no operator relies on how
they are built: every operator is written against the schema alone.

Each adapter is a narrow projection (Catalyst prunes the scan to the columns
named here) and keeps one output row per input row unless stated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.columns import uuid_from

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _id(prefix: str, col) -> F.Column:
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def _jstr(name: str, col: F.Column) -> F.Column:
    """``"name":"<col>"`` JSON member (values here never need escaping)."""
    return F.concat(F.lit(f'"{name}":"'), col, F.lit('"'))


def payment_result_records(events: DataFrame) -> DataFrame:
    """``payment.result`` topic records, one per event.

    Envelope ``{orderId,eventId,type,payload}``; purchase -> CHARGED,
    error -> CHARGE_FAILED, other event types carry a payload without status.
    Even event ids send the payload as JSON text, odd ones as an object; ids
    with ``event_id % 50 == 7`` arrive truncated to half their length (the
    same fault ``inject_faults`` applies), i.e. as unparsable JSON.
    """
    status = (
        F.when(F.col("event_type") == "purchase", F.lit(codes.PAYMENT_OK))
        .when(F.col("event_type") == "error", F.lit(codes.PAYMENT_BAD))
    )
    payload = F.concat(
        F.lit("{"),
        _jstr("orderId", _id("ord-", "event_id")), F.lit(","),
        _jstr("paymentId", _id("pay-", "event_id")),
        F.coalesce(F.concat(F.lit(","), _jstr("status", status)), F.lit("")),
        F.lit(',"amount":'), F.col("value").cast("decimal(12,2)").cast("string"),
        F.lit("}"),
    )
    head = F.concat(
        F.lit("{"),
        _jstr("orderId", _id("ord-", "event_id")), F.lit(","),
        _jstr("eventId", _id("ev-", "event_id")), F.lit(","),
        _jstr("type", F.lit("PaymentResult")), F.lit(',"payload":'),
    )
    as_text = F.concat(head, F.lit('"'), F.replace(payload, F.lit('"'), F.lit('\\"')), F.lit('"}'))
    as_object = F.concat(head, payload, F.lit("}"))
    value = F.when(F.col("event_id") % 2 == 0, as_text).otherwise(as_object)
    value = F.when(
        F.col("event_id") % 50 == 7, value.substr(F.lit(1), F.floor(F.length(value) / 2).cast("int"))
    ).otherwise(value)
    return events.select(
        _id("ord-", "event_id").alias("key"),
        value.alias("value"),
        F.lit(codes.TOPIC_PAYMENT_RESULT).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(3)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def fraud_orders(events: DataFrame) -> DataFrame:
    """Orders to score: id, customer, created_at, total = value x 50 (decimal)."""
    return events.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("ts").alias("created_at"),
        (F.col("value").cast("decimal(12,2)") * F.lit(50)).cast("decimal(12,2)").alias("total"),
    )


def saga_events(events: DataFrame) -> DataFrame:
    """Typed saga event log; one saga per (user, day), id UUID-shaped.

    signup -> OrderCreated; click -> PaymentCompleted; view ->
    InventoryReserved / InventoryRequested (even / odd id); purchase ->
    ShippingCompleted / ShippingRequested (every fifth id CompensationCompleted); error -> Payment-, Inventory- or
    ShippingFailed by ``event_id % 3``.  ``seq`` is the event id.
    """
    et, eid = F.col("event_type"), F.col("event_id")
    even = eid % 2 == 0
    etype = (
        F.when(et == "signup", "OrderCreated")
        .when(et == "click", "PaymentCompleted")
        .when(et == "view", F.when(even, "InventoryReserved").otherwise("InventoryRequested"))
        .when(et == "purchase", F.when(even, "ShippingCompleted").when(eid % 5 == 1, "CompensationCompleted").otherwise("ShippingRequested"))
        .when(et == "error",
              F.when(eid % 3 == 0, "PaymentFailed")
              .when(eid % 3 == 1, "InventoryFailed")
              .otherwise("ShippingFailed"))
    )
    ref = (
        F.when(et == "click", _id("pay-", "event_id"))
        .when((et == "view") & even, _id("res-", "event_id"))
        .when((et == "purchase") & even, _id("shp-", "event_id"))
    )
    reason = F.when(et == "error", F.concat(F.lit("declined "), F.col("props")))
    address = F.when(
        (et == "signup") & (F.col("value") >= 5), F.concat(F.lit("Street "), F.col("user_id").cast("string"))
    )
    return events.select(
        uuid_from(F.concat(F.lit("ord-"), F.col("user_id").cast("string"), F.lit("-"),
                           F.date_format("ts", "yyyyMMdd"))).alias("order_id"),
        eid.alias("seq"),
        F.col("ts"),
        etype.alias("event_type"),
        ref.alias("ref_id"),
        reason.alias("reason"),
        address.alias("shipping_address"),
    )


# --- fixed mapping used only to shape topic records -----------------------
_TOPIC_BY_EVENT = [
    ("signup", "order.created"),
    ("click", "payment.requested"),
    ("view", "inventory.requested"),
    ("purchase", "payment.result"),
]
_DLT_TOPICS = ["order.created.dlt", "payment.requested-dlt", "inventory.requested.DLT", "shipping.requested-DLT"]


def topic_records(events: DataFrame) -> DataFrame:
    """Kafka-layout records over several topics, dead letters included.

    Error events land on one of four dead-letter topics (by ``event_id % 4``)
    with an ``x-exception-message`` header; the rest go to their main topic.
    """
    et, eid = F.col("event_type"), F.col("event_id")
    topic = None
    for e, t in _TOPIC_BY_EVENT:
        topic = F.when(et == e, t) if topic is None else topic.when(et == e, t)
    dlt = None
    for i, t in enumerate(_DLT_TOPICS):
        dlt = F.when(eid % 4 == i, t) if dlt is None else dlt.when(eid % 4 == i, t)
    topic = topic.otherwise(dlt)
    message = (
        F.when(F.col("value") < 50, "Envelope parse failed")
        .when(F.col("value") < 150, "Timeout waiting for response")
        .otherwise("Payment declined")
    )
    headers = F.when(
        et == "error",
        F.array(
            F.struct(F.lit("x-original-topic").alias("key"), F.lit("unknown").cast("binary").alias("value")),
            F.struct(F.lit("x-exception-message").alias("key"), message.cast("binary").alias("value")),
        ),
    ).otherwise(F.array().cast("array<struct<key:string,value:binary>>"))
    value = F.concat(
        F.lit("{"), _jstr("orderId", _id("ord-", "user_id")), F.lit(","),
        _jstr("eventId", _id("ev-", "event_id")), F.lit(","),
        _jstr("type", et), F.lit(',"payload":'), F.col("props"), F.lit("}"),
    )
    return events.select(
        _id("ord-", "user_id").alias("key"),
        value.alias("value"),
        topic.alias("topic"),
        F.pmod(F.col("user_id"), F.lit(3)).cast("int").alias("partition"),
        eid.alias("offset"),
        F.col("ts").alias("timestamp"),
        headers.alias("headers"),
    )


def latency_samples(lineitem: DataFrame) -> DataFrame:
    """Per-request latencies in ms: one row per line item, by return flag."""
    return lineitem.select(
        F.col("l_returnflag").alias("service"),
        F.col("l_linestatus").alias("channel"),
        (F.col("l_extendedprice") / F.lit(50.0)).alias("latency_ms"),
    )


def counter_samples(events: DataFrame) -> DataFrame:
    """Scraped counter samples: per (metric, app, minute) cumulative value.

    One series per event type and app (``user_id % 3``); the counter is
    cumulative within a day and restarts at midnight (a reset per day).  The
    per-minute aggregation comes first, so the running sum works on at most
    1 440 rows per series and day whatever the event volume.
    """
    per_min = (
        events.select(
            F.concat(F.lit("events_"), F.col("event_type"), F.lit("_total")).alias("metric"),
            F.concat(F.lit("app-"), F.pmod(F.col("user_id"), F.lit(3)).cast("string")).alias("app"),
            F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz").alias("ts"),
        )
        .groupBy("metric", "app", "ts")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    from pyspark.sql import Window as W

    w = W.partitionBy("metric", "app", F.to_date("ts")).orderBy("ts").rowsBetween(W.unboundedPreceding, 0)
    return per_min.select(
        "ts", "metric", "app",
        F.sum("n").over(w).cast("double").alias("value"),
    )


def order_table(orders: DataFrame) -> DataFrame:
    """The TPC-H ``orders`` table in the order-service layout."""
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("created_at"),
    )


def result_records(saga_events: DataFrame) -> DataFrame:
    """``inventory.result`` / ``shipping.result`` envelopes from the saga log.

    Inventory events give RESERVED (reserved), OUT_OF_STOCK (failed, even
    seq) or BACKORDER (failed, odd seq: an unknown status); shipping events
    give DELIVERED / SHIPPED (completed, by seq parity), FAILED (failed) or
    LOST.  Requested events are not results and are left out.
    """
    et, s = F.col("event_type"), F.col("seq")
    even = s % 2 == 0
    topic = F.when(et.startswith("Inventory"), F.lit("inventory.result")).when(
        et.startswith("Shipping"), F.lit("shipping.result"))
    status = (
        F.when(et == "InventoryReserved", "RESERVED")
        .when(et == "InventoryFailed", F.when(even, "OUT_OF_STOCK").otherwise("BACKORDER"))
        .when(et == "ShippingCompleted", F.when(even, "DELIVERED").otherwise("SHIPPED"))
        .when(et == "ShippingFailed", F.when(even, "FAILED").otherwise("LOST"))
    )
    ref_name = F.when(et.startswith("Inventory"), F.lit("reservationId")).otherwise(F.lit("shippingId"))
    payload = F.to_json(F.struct(
        F.col("order_id").alias("orderId"), status.alias("status"),
        F.col("ref_id").alias("ref"), F.col("reason").alias("reason")))
    payload = F.replace(payload, F.lit('"ref":'), F.concat(F.lit('"'), ref_name, F.lit('":')))
    value = F.to_json(F.struct(
        F.col("order_id").alias("orderId"), F.concat(F.lit("ev-"), s.cast("string")).alias("eventId"),
        et.alias("type"), payload.alias("payload")))
    return saga_events.where(status.isNotNull()).select(
        F.col("order_id").alias("key"), value.alias("value"), topic.alias("topic"),
        F.lit(0).alias("partition"), s.alias("offset"), F.col("ts").alias("timestamp"))


def mixed_messages(events: DataFrame) -> DataFrame:
    """One message per event (offset, value), many of them faulty in one way or another:
    ids that are no UUID, blank or missing; unknown or missing statuses; items, addresses,
    totals, currencies and customers missing or out of range (the good ones are the event's
    value, user and type); payloads as text, as an
    object, unparsable or absent; truncated documents."""
    n = F.col("event_id")

    def pick(by: int, *values: str | F.Column | None):
        """The value for ``event_id % by`` as JSON text (null where there is none)."""
        out = F.when(F.lit(False), F.lit(""))
        for k, v in enumerate(values):
            out = out.when(n % by == k, F.lit("null" if v is None else v) if not isinstance(v, F.Column) else v)
        return out.otherwise(F.lit("null"))

    uuid = F.concat(F.lit('"'), uuid_from("event_id"), F.lit('"'))
    oid = F.when(n % 16 == 1, F.lit('"not-a-uuid"')).when(n % 16 == 2, F.lit('" \\t"')).when(n % 16 == 3, F.lit("null")).otherwise(uuid)
    body = F.concat(
        F.lit('{"orderId":'), oid,
        F.lit(',"status":'), pick(10, '"RESERVED"', '"OUT_OF_STOCK"', '"BACKORDER"', '"DELIVERED"', '"FAILED"', '"COMPLETED"', '"PAYMENT_FAILED"', None, '"CHARGED"', '"charged"'),
        F.lit(',"paymentId":'), pick(4, F.concat(F.lit('"pay-'), F.col("user_id").cast("string"), F.lit('"')), None),
        F.lit(',"items":'), pick(5, "0", "3", "-1", '"x"', None),
        F.lit(',"address":'), pick(4, '"12 Main St"', '"UNKNOWN"', '"  "', None),
        F.lit(',"reason":'), pick(3, F.concat(F.lit('"'), F.col("event_type"), F.lit('"')), None),
        F.lit(',"total":'), pick(6, F.col("value").cast("decimal(12,2)").cast("string"), "0", '"abc"', "0.01", None, "-3"),
        F.lit(',"currency":'), pick(3, '"EUR"', '" "', None),
        F.lit(',"customerId":'), pick(3, F.concat(F.lit('"c-'), F.col("user_id").cast("string"), F.lit('"')), '""', None), F.lit("}"))
    text = F.replace(F.replace(body, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    value = (
        F.when(n % 13 == 4, F.substring(body, 1, 20))
        .when(n % 13 == 5, F.concat(F.lit('{"orderId":'), oid, F.lit(',"payload":"{oops"}')))
        .when(n % 13 < 8, body)
        .when(n % 13 < 10, F.concat(F.lit('{"orderId":'), oid, F.lit(',"payload":'), body, F.lit("}")))
        .otherwise(F.concat(F.lit('{"orderId":'), oid, F.lit(',"payload":"'), text, F.lit('"}'))))
    return events.select(n.alias("offset"), value.alias("value"))
