"""Scalar column helpers: status flags, saga attributes, money, topic names.

Pure built-in expressions (``CASE``/``isin``/``regexp``); nothing runs in
Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes
from .json_fields import blank

UUID_REGEX = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def case_map(col: Column | str, pairs, default=None) -> Column:
    """``CASE col WHEN k THEN v ... ELSE default END`` from (k, v) pairs."""
    c = _c(col)
    expr = None
    for k, v in pairs:
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(default) if not isinstance(default, Column) else default)


# ---- orders ---------------------------------------------------------------

def order_requires_review(status: Column | str) -> Column:
    return _c(status) == "PENDING_REVIEW"


def order_is_terminal(status: Column | str) -> Column:
    return _c(status).isin(*codes.ORDER_TERMINAL)


def order_can_pay(status: Column | str) -> Column:
    return _c(status).isin(*codes.ORDER_CAN_PAY)


def map_status_update(status: Column | str) -> Column:
    """Known status names pass, anything else becomes FAILED."""
    c = _c(status)
    return F.when(c.isin(*codes.STATUS_UPDATE_KNOWN), c).otherwise(F.lit("FAILED"))


# ---- saga states ----------------------------------------------------------

def saga_phase(state: Column | str) -> Column:
    return case_map(state, codes.SAGA_STATE_PHASE)


def saga_is_failure(state: Column | str) -> Column:
    return _c(state).isin(*codes.SAGA_FAILURE_STATES)


def saga_is_terminal(state: Column | str) -> Column:
    return saga_phase(state) == "TERMINAL"


def saga_is_compensating(state: Column | str) -> Column:
    return _c(state) == "COMPENSATING"


def saga_strategy(state: Column | str) -> Column:
    return case_map(state, codes.SAGA_STRATEGY, "NONE")


# ---- money ----------------------------------------------------------------

def money(col: Column | str, precision: int = 12) -> Column:
    """Scale 2, HALF_UP, in one rounding of the exact value (a double counts as its shortest decimal text)."""
    return F.round(_c(col).cast("decimal(38,18)"), 2).cast(f"decimal({precision},2)")


# ---- identifiers and topics -----------------------------------------------

def valid_uuid(col: Column | str) -> Column:
    c = _c(col)
    return c.isNotNull() & c.rlike(UUID_REGEX)


def is_dlt_topic(topic: Column | str) -> Column:
    t = _c(topic)
    return t.isNotNull() & t.rlike(codes.DLT_SUFFIX_REGEX)


def dlt_origin(topic: Column | str) -> Column:
    """Strip the 4-character DLT suffix; NULL for non-DLT topics."""
    t = _c(topic)
    return F.when(is_dlt_topic(t), t.substr(F.lit(1), F.length(t) - 4))


def result_key(order_id: Column | str, payload: Column | str) -> Column:
    """``orderId|md5(payload)`` outbound de-duplication key."""
    return F.concat_ws("|", _c(order_id), F.md5(_c(payload)))


def default_address(addr: Column | str) -> Column:
    c = _c(addr)
    return F.coalesce(F.when(~blank(c), c), F.lit(codes.DEFAULT_ADDRESS))


def unit_draw(key: Column | str, salt: str = "") -> Column:
    """Deterministic uniform draw in [0, 1) from the md5 of key (+ salt).

    The first 8 hex digits give 32 bits; same value in any SQL engine with md5.
    """
    k = _c(key).cast("string")
    if salt:
        k = F.concat(k, F.lit(salt))
    return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def ntz_as_utc(col: Column | str) -> Column:
    """TIMESTAMP_NTZ wall clock read as UTC -> TIMESTAMP, whatever the session zone."""
    c = _c(col)
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


def epoch_micros(df, col: str) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ columns.

    An NTZ wall-clock value is read as UTC whatever the session time zone.
    """
    dtype = dict(df.dtypes)[col]
    if dtype == "timestamp_ntz":
        return F.unix_micros(ntz_as_utc(col))
    return F.unix_micros(F.col(col))


def uuid_from(col: Column | str) -> Column:
    """Deterministic UUID-shaped id (8-4-4-4-12 hex) from the md5 of a value."""
    h = F.md5(_c(col).cast("string"))
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
        F.substring(h, 17, 4), F.substring(h, 21, 12),
    )
