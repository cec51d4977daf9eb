"""Incremental ingestion of landed raw CDR files through the batch operators."""

from towerlens.streaming.ingest import (  # noqa: F401
    CdrIngest,
    landing_stream,
    latest_daily,
    start_cdr_ingest,
)
