"""Sources: driver tables, adapters onto the raw schemas, CSV and file scans."""

from towerlens.sources.adapters import cdrs_raw, customers_raw, raw_sources, towers_raw  # noqa: F401
from towerlens.sources.files import (  # noqa: F401
    file_fingerprints,
    malformed_fields,
    read_csv,
    read_mart_csv,
    require_sources,
    source_file_stats,
)
from towerlens.sources.tables import read_table  # noqa: F401
