"""Readers: page files and documents, landed runs, page statistics."""

from tidegate.sources.pages import (
    missing_pages,
    missing_ranges,
    page_audit,
    page_statistics,
    parse_documents,
    read_documents,
    read_page_files,
    require_complete,
)
from tidegate.sources.runs import (
    LandedRun,
    find_run,
    find_run_folder,
    landed_runs,
    newest_run,
    read_landed_documents,
    read_landed_in_scope,
    read_sidecar,
)

__all__ = [
    "LandedRun",
    "find_run",
    "find_run_folder",
    "landed_runs",
    "missing_pages",
    "missing_ranges",
    "newest_run",
    "page_audit",
    "page_statistics",
    "parse_documents",
    "read_documents",
    "read_landed_documents",
    "read_landed_in_scope",
    "read_page_files",
    "read_sidecar",
    "require_complete",
]
