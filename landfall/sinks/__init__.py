"""Writers for partitioned Parquet tables: plain, with versions, with checks, in buckets."""

from landfall.sinks.buckets import bucketed_lookup, hot_keys, open_bucketed, write_bucketed
from landfall.sinks.checked import publish_checked, stored_checks
from landfall.sinks.merge import MergeReport, merge_table
from landfall.sinks.snapshots import (
    ConcurrentWrite,
    Snapshot,
    current_snapshot,
    drop_snapshots,
    publish_table,
    read_snapshot,
    snapshot_versions,
)
from landfall.sinks.tables import WriteReport, write_csv, write_table

__all__ = [
    "ConcurrentWrite",
    "MergeReport",
    "Snapshot",
    "WriteReport",
    "bucketed_lookup",
    "current_snapshot",
    "drop_snapshots",
    "hot_keys",
    "merge_table",
    "open_bucketed",
    "publish_checked",
    "publish_table",
    "read_snapshot",
    "snapshot_versions",
    "stored_checks",
    "write_bucketed",
    "write_csv",
    "write_table",
]
