"""Incremental landing of page documents."""

from tidegate.streaming.landing import land_new_pages, land_stream, new_page_files

__all__ = ["land_new_pages", "land_stream", "new_page_files"]
