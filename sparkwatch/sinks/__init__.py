from .accepted import dedup_across_runs
from .conformed import conformed, read_good, read_rejected, write_conformed
from .events import publish, to_events
from .layers import (
    append_table,
    bloom_options,
    cluster_by,
    clustered_files,
    insert_new,
    with_partition_col,
    write_layer,
)
from .metrics import write_metrics
from .snapshots import read_snapshot, snapshot_path, write_snapshot

__all__ = [
    "append_table",
    "bloom_options",
    "cluster_by",
    "clustered_files",
    "conformed",
    "dedup_across_runs",
    "insert_new",
    "publish",
    "read_good",
    "read_rejected",
    "read_snapshot",
    "snapshot_path",
    "to_events",
    "with_partition_col",
    "write_conformed",
    "write_layer",
    "write_metrics",
    "write_snapshot",
]
