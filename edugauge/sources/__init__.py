"""Readers, layer tables and report sinks."""

from edugauge.sources.readers import (
    INGEST_ORDER,
    read_csv,
    read_delimited,
    read_report,
    read_sharded,
    read_sheet,
    read_table,
    read_yearly,
    spread,
    union_aligned,
)
from edugauge.sources.writers import (
    shard_row_limit,
    stamp,
    stored_counts,
    write_report,
    write_sharded,
    write_table,
)

__all__ = [
    "INGEST_ORDER", "read_csv", "read_delimited", "read_report", "read_sharded", "read_sheet",
    "read_table", "read_yearly", "spread", "union_aligned",
    "shard_row_limit", "stamp", "stored_counts", "write_report", "write_sharded", "write_table",
]
