"""marquee — a Spark-native film/TV catalogue lake.

Raw tab-separated catalogue files are read tolerantly, cleaned with plain
``Column`` expressions, linked with left joins into five datasets (titles,
episodes, names, akas, principals), written as a partitioned Parquet lake,
refreshed into typed and sorted serving tables, and queried with ranking,
average, median and popularity reports.

Sub-packages:

- ``marquee.sources``   — raw TSV scan, lake scan with explicit schema
- ``marquee.functions`` — reusable ``Column -> Column`` helpers
- ``marquee.operators`` — dataset builders, joins, sinks, analytics reports
- ``marquee.plans``     — the ETL pipeline and the serving-table refresh
"""

from marquee import schemas
from marquee.session import build_session, scratch_path

__all__ = ["schemas", "build_session", "scratch_path"]
