"""Audit files as they arrive."""

from .audit import ingest_new_files, merged_summary  # noqa: F401
from .incremental import current_summary, update_summary, vacuum_summary  # noqa: F401
