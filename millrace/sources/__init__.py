from millrace.sources.landing import land, land_files, landed, landed_schema, scan_landing, scan_new_files
from millrace.sources.layout import Layout, clean_name
from millrace.sources.progress import (
    read_progress,
    read_watermark,
    write_progress,
    write_watermark,
)
from millrace.sources.relation import (
    JdbcSink,
    JdbcSource,
    TableSpec,
    scan_full,
    scan_query,
    source_relation,
    write_jdbc,
)
from millrace.sources.versioned import (
    added_since,
    append_version,
    as_of,
    as_of_time,
    committed_versions,
    current_version,
    read_versions,
    versions,
    with_version,
)

__all__ = [
    "JdbcSink",
    "JdbcSource",
    "Layout",
    "TableSpec",
    "added_since",
    "append_version",
    "as_of",
    "as_of_time",
    "clean_name",
    "committed_versions",
    "current_version",
    "land",
    "land_files",
    "landed",
    "landed_schema",
    "read_progress",
    "read_versions",
    "read_watermark",
    "scan_full",
    "scan_landing",
    "scan_new_files",
    "scan_query",
    "source_relation",
    "versions",
    "with_version",
    "write_jdbc",
    "write_progress",
    "write_watermark",
]
