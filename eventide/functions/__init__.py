"""Column-level functions (built-in Catalyst expressions only)."""

from . import codes, columns, json_fields  # noqa: F401
