from millrace.operators.checks import concat_strict, require_columns, require_same_schema
from millrace.operators.clean import (
    cast_time_columns,
    clean,
    deterministic_sort,
    drop_exact_duplicates,
    sort_columns,
    to_naive_utc,
)
from millrace.operators.latest import latest_by_key
from millrace.operators.states import aggregate, merge, partial
from millrace.operators.watermark import advance_watermark, newer_than, scan_since

__all__ = [
    "advance_watermark",
    "aggregate",
    "cast_time_columns",
    "clean",
    "concat_strict",
    "deterministic_sort",
    "drop_exact_duplicates",
    "latest_by_key",
    "merge",
    "newer_than",
    "partial",
    "require_columns",
    "require_same_schema",
    "scan_since",
    "sort_columns",
    "to_naive_utc",
]
