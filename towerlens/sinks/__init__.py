"""Sinks: Parquet tables, CSV exports, JSON reports, declared warehouse tables."""

from towerlens.sinks.writers import (  # noqa: F401
    load_table,
    write_csv,
    write_json_report,
    write_mart,
    write_parquet,
)
