"""Column expressions: pure functions from Columns to Columns."""

from . import calendar, formatting, inventory, metrics, nulls  # noqa: F401
