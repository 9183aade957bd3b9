"""Readers: driver tables, the canonical sales view and file sets."""

from .tables import SALES_COLUMNS, events_as_sales, read_table, sales  # noqa: F401
