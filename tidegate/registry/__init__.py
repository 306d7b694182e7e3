"""Runnable examples of every operator on the given tables, each with the SQL it must equal."""

from tidegate.registry import on_pages, on_tables, sinks
from tidegate.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "on_pages", "on_tables", "sinks"]
