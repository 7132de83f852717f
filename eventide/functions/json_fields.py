"""Column expressions over JSON text (schema-on-read with defaults).

All of these are built-in Catalyst expressions (``get_json_object``,
``try_parse_json``), so they stay inside whole-stage codegen and are pruned
per field: only the paths that a query asks for are extracted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def json_text(col: Column | str, field: str) -> Column:
    """Text of a top-level field; JSON ``null`` and a missing field give NULL."""
    return F.get_json_object(_c(col), f"$.{field}")


def is_json(col: Column | str) -> Column:
    """True when the text parses as one JSON document."""
    return F.try_parse_json(_c(col)).isNotNull()


def payment_status(value: Column | str) -> Column:
    """``payload.status`` of an envelope whose payload is JSON text or an object.

    Unparsable envelope, unparsable payload, missing or null status all give
    ``UNKNOWN``.  ``get_json_object`` returns the raw text of a string field,
    so a payload that is itself JSON text is parsed by the second call.
    """
    payload = F.get_json_object(_c(value), "$.payload")
    return F.coalesce(F.get_json_object(payload, "$.status"), F.lit(codes.PAYMENT_UNKNOWN))


def unwrap_payload(value: Column | str) -> Column:
    """``payload`` if the envelope has one (text or object), else the message."""
    return F.coalesce(F.get_json_object(_c(value), "$.payload"), _c(value))


def blank(col: Column | str) -> Column:
    """NULL or only whitespace (of any kind)."""
    c = _c(col)
    return c.isNull() | c.rlike(r"^\s*$")


def non_blank(col: Column | str) -> Column:
    return ~blank(col)


def json_struct(value: Column | str, fields: list[str]) -> Column:
    """Parse a JSON object once into a struct of string fields.

    Nested objects/arrays come back as their compact JSON text (the same text
    ``get_json_object`` returns); JSON ``null`` and missing fields are NULL.
    The extra ``_corrupt`` field holds the input when it is not valid JSON.
    """
    schema = ", ".join(f"`{f}` string" for f in fields) + ", `_corrupt` string"
    return F.from_json(_c(value), schema, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"})


def with_json(df, value: str, fields: list[str], out: str):
    """Add ``out`` (struct of ``fields``) and ``out_ok`` (valid JSON) with one parse.

    Downstream expressions read ``out.field``; because ``from_json`` is not a
    cheap expression, Catalyst keeps it in its own projection instead of
    re-evaluating it per consumer.
    """
    x = df.withColumn(out, json_struct(value, fields))
    ok = F.col(value).isNotNull() & F.col(f"{out}._corrupt").isNull() & F.col(out).isNotNull()
    return x.withColumn(f"{out}_ok", ok)
