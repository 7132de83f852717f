"""Registered batch queries (one per operator of SURVEY section 2)."""

from . import q_dlq, q_extra, q_fraud, q_hygiene, q_io, q_listeners, q_metrics, q_mixed, q_orders, q_outputs, q_saga, q_status, q_streams  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
