"""All named queries. Importing the family modules registers them."""

from tidemill.catalog import grouping, joining, rows, streams, timing, turns  # noqa: F401
from tidemill.catalog.base import QUERIES

__all__ = ["QUERIES"]
