"""Retail analytics operators and named pipelines for PySpark."""

from tallyroom.session import get_session
from tallyroom.sources.tables import CatalogTables, SampleTables

__all__ = ["get_session", "CatalogTables", "SampleTables"]
