"""Plans: the ETL pipeline (raw -> lake) and the serving refresh (lake -> tables)."""

from marquee.plans.etl import (
    build_all,
    counts_frame,
    lake_path,
    run_etl,
    run_etl_from_dir,
)
from marquee.plans.serving import (
    conform,
    create_serving_tables,
    load_table,
    current_version,
    read_table,
    refresh_serving,
    repair_views,
    validate_counts,
)
from marquee.plans.versions import expire_versions, write_lake

__all__ = [
    "build_all",
    "conform",
    "counts_frame",
    "current_version",
    "expire_versions",
    "repair_views",
    "write_lake",
    "create_serving_tables",
    "lake_path",
    "load_table",
    "read_table",
    "refresh_serving",
    "run_etl",
    "run_etl_from_dir",
    "validate_counts",
]
