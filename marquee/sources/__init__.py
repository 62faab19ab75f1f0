"""Sources: raw TSV files and the versioned Parquet lake."""

from marquee.sources.lake import lake_project, read_lake, read_version
from marquee.sources.manifest import file_report, read_state
from marquee.sources.tsv import (
    can_delete,
    delete_path,
    path_exists,
    read_raw_inputs,
    read_tsv,
    read_tsv_path,
    resolve_raw_path,
)

__all__ = [
    "can_delete",
    "delete_path",
    "file_report",
    "lake_project",
    "path_exists",
    "read_lake",
    "read_raw_inputs",
    "read_state",
    "read_tsv",
    "read_tsv_path",
    "read_version",
    "resolve_raw_path",
]
