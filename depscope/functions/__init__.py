"""Column builders: every scalar of the data model as a built-in Spark expression."""

from .access import (  # noqa: F401
    infer_op, infer_op_flat, job_to_app_id, normalize_result, object_type,
)
from .catalog import (  # noqa: F401
    describe_key, describe_value, json_trim, owner_name, pick_name, pick_owner,
    pick_qualified_name, project_extra, project_id, storage_format, storage_format_strict,
    type_to_service,
)
from .paths import basename, is_noise, parent_dir, truncate_path  # noqa: F401
from .text import (  # noqa: F401
    comma_to_semicolon, first_present, is_braced, joined_parts, or_empty, present,
    safe_str, sha1_or_empty, strip, strip_line,
)
from .times import (  # noqa: F401
    date_to_ms, day, dep_window, dep_window_start, epoch_number, epoch_seconds, epoch_to_iso,
    floor_minutes, history_ts, iso, ms_to_iso, number_seconds, parse_iso, safe_ts, yyyymmdd,
)
