"""The order saga as keyed state with event-time timers.

State per order: current state, failure, ids, retries, time of the last
change, and the number of its last event.  Events move it as
``operators.saga`` does (no guard on the previous state; an order counts from
its first ``OrderCreated``).  A timer is set past the last change:

* after PENDING_MINUTES in a *_PENDING state the saga fails, like the matching
  failure event with the reason of a timeout;
* after RETRY_MINUTES in COMPENSATING the commands are sent again with the
  next retry number, and so on at every later firing.

Timers fire once a micro-batch, when the watermark has passed them, and take
the watermark as their time: a firing is the sweep of the batch operators as
of the watermark.  Finished sagas (COMPLETED, COMPENSATED) leave the state, so
it holds the running ones; later events of a finished order are ignored.

Rows that come out: kind ``state`` (the saga after the change), ``command``
and ``status`` (update for the order's service), numbered in order per order.

Spark makes a pandas column of every column of every order, whatever it holds,
which costs more than the moves.  So events go to ``_step`` as JSON, and the
rows of a call come back as one JSON array that Spark parses.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..operators.saga import EVENT_FAILED, EVENT_STATE, PENDING_TO_FAILED
from .stateful import watermarked_micros

PENDING_MINUTES, RETRY_MINUTES = 10, 5
FINISHED = ("COMPLETED", "COMPENSATED")
ID_EVENTS = {"PaymentCompleted": "payment_id", "InventoryReserved": "reservation_id", "ShippingCompleted": "shipping_id"}
OUT = ("order_id string, n bigint, kind string, at_us bigint, state string, failed_state string, payment_id string, reservation_id string, "
       "shipping_id string, failure_reason string, retry_count int, topic string, type string, ref_id string, status string")
_ROWS = "array<struct<%s>>" % OUT.replace(" ", ":").replace(",:", ",")
_CELL = pd.Index(["rows"])
_STATE, _FAILED, _TIMED_OUT = dict(EVENT_STATE), dict(EVENT_FAILED), dict(PENDING_TO_FAILED)


def commands(failed: str, saga: dict, reason: str) -> list[dict]:
    """Release, refund and cancel, as far as the failure and the known ids ask for them."""
    out = []
    if failed == "SHIPPING_FAILED" and saga["reservation_id"] is not None:
        out.append({"topic": codes.TOPIC_INVENTORY_RELEASE, "type": codes.COMPENSATION_RELEASE, "ref_id": saga["reservation_id"]})
    if failed in ("INVENTORY_FAILED", "SHIPPING_FAILED") and saga["payment_id"] is not None:
        out.append({"topic": codes.TOPIC_PAYMENT_REFUND, "type": codes.COMPENSATION_REFUND, "ref_id": saga["payment_id"]})
    out.append({"topic": codes.TOPIC_ORDER_CANCEL, "type": codes.COMPENSATION_CANCEL, "ref_id": None})
    return [{"kind": "command", "failure_reason": reason, **c} for c in out]


def _fail(saga: dict, failed: str, reason: str | None) -> list[dict]:
    saga.update(failed_state=failed, failure_reason=reason)
    return [{"kind": "status", "status": failed, "failure_reason": reason}, *commands(failed, saga, reason)]


def apply_event(saga: dict, event_type: str, ref_id: str | None, reason: str | None) -> list[dict]:
    """Moves the saga and returns what is sent."""
    sent = []
    if event_type in ID_EVENTS:
        saga[ID_EVENTS[event_type]] = ref_id
    if event_type in _FAILED:
        sent = _fail(saga, _FAILED[event_type], reason)
    elif event_type == "ShippingCompleted":
        sent = [{"kind": "status", "status": "COMPLETED"}]
    elif event_type == "CompensationCompleted":
        sent = [{"kind": "status", "status": "CANCELLED", "failure_reason": codes.REASON_COMPENSATED}]
    saga["state"] = _STATE[event_type]
    return sent


def fire_timer(saga: dict) -> list[dict]:
    """The timeout of a pending state, or the next retry of a compensation."""
    if saga["state"] in _TIMED_OUT:
        failed, reason = _TIMED_OUT[saga["state"]], codes.REASON_TIMEOUT % saga["state"]
        saga["state"] = "COMPENSATING"
        return _fail(saga, failed, reason)
    saga["retry_count"] += 1
    return commands("SHIPPING_FAILED", saga, codes.REASON_RETRY % saga["retry_count"])


def due(saga: dict) -> int | None:
    """When the timer fires (microseconds), if one is set."""
    minutes = PENDING_MINUTES if saga["state"] in _TIMED_OUT else RETRY_MINUTES if saga["state"] == "COMPENSATING" else None
    return None if minutes is None else saga["at_us"] + minutes * 60_000_000


def _step(key, frames: Iterator[pd.DataFrame], state):
    order_id = key[0]
    saga = json.loads(state.get[0]) if state.exists else None
    rows: list[dict] = []

    def emit(sent: list[dict]) -> None:
        fields = {k: saga[k] for k in ("state", "failed_state", "payment_id", "reservation_id", "shipping_id", "failure_reason", "retry_count")}
        for r in [*sent, {"kind": "state", **fields}]:
            saga["n"] += 1
            rows.append({"order_id": order_id, "n": saga["n"], "at_us": saga["at_us"], **r})

    if state.hasTimedOut:
        sent = fire_timer(saga)
        saga["at_us"] = state.getCurrentWatermarkMs() * 1000
        emit(sent)
    else:
        events = [json.loads(e) for f in frames for e in f["event"].tolist()]
        for e in sorted(events, key=lambda e: (e.get("seq") is None, e.get("seq"))):
            event_type, ref_id, reason = e["event_type"], e.get("ref_id"), e.get("reason")
            start = event_type == codes.SAGA_START_EVENT
            if saga is None and start:
                saga = {"state": None, "failed_state": None, "payment_id": None, "reservation_id": None, "shipping_id": None,
                        "failure_reason": None, "retry_count": 0, "n": 0, "at_us": 0}
            elif saga is None or start or saga["state"] in FINISHED:
                continue
            sent = apply_event(saga, event_type, ref_id if isinstance(ref_id, str) else None, reason if isinstance(reason, str) else None)
            saga["at_us"] = int(e["at_us"])
            emit(sent)
    if saga is None:
        return
    if saga["state"] in FINISHED:
        state.remove()
    else:
        state.update((json.dumps(saga),))
        at = due(saga)
        if at is not None:
            state.setTimeoutTimestamp(max(at // 1000 + 1, state.getCurrentWatermarkMs() + 1))
    if rows:
        yield pd.DataFrame(np.array([[json.dumps(rows)]], dtype=object), columns=_CELL, copy=False)


def saga_timers_stream(events: DataFrame, ts: str = "ts", delay: str = "1 minute") -> DataFrame:
    """Events (order_id, seq, ts, event_type, ref_id, reason) to the rows of all changes."""
    known = events.where(F.col("event_type").isin(*_STATE)).withColumn("event_time", F.col(ts).cast("timestamp"))
    event = F.to_json(F.struct("seq", F.unix_micros("event_time").alias("at_us"), "event_type", "ref_id", "reason"))
    keyed = watermarked_micros(known.select("order_id", event.alias("event"), "event_time"), "event_time", delay)
    rows = keyed.groupBy("order_id").applyInPandasWithState(_step, "rows string", "saga string", "Update", "EventTimeTimeout")
    return rows.select(F.inline(F.from_json("rows", _ROWS)))
