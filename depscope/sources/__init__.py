"""Readers. Every reader has a fixed schema; none runs an inference pass.

Readers that feed first-wins or last-wins operators add ``pos``, the place of a record
in its source: file, block within the file, row.
"""

from .audit import (  # noqa: F401
    audit_file_count, audit_folders, audit_lines, date_range, flat_audit, lines,
)
from .catalog import (  # noqa: F401
    entities, hive_describe_lines, hive_listing, kudu_descriptions, kudu_tables,
    lineage_payloads, live_describe, live_hive_listing, search_results,
)
from .damage import damaged  # noqa: F401
from .history import cdsw, jhs_jobs, rm_apps, spark_apps  # noqa: F401
from .listing import jdbc_listing, listing_table, ls_listing  # noqa: F401
