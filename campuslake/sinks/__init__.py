"""Where tables go: overwritten folders, catalog entries, snapshots, and their upkeep."""

from .bins import compact_bins
from .catalog import list_tables, register_tables
from .clustering import cluster_by, cluster_zorder
from .layout import compact, table_detail
from .ordered import check_sorted, publish_sorted, read_sorted
from .publish import publish, publish_all
from .runs import complete_runs, read_run, repoint, retain_runs, run_as_of, run_folder, run_history
from .snapshots import publish_snapshot, read_snapshot, retain_snapshots, snapshot_history

__all__ = [
    "check_sorted",
    "cluster_by",
    "cluster_zorder",
    "compact",
    "compact_bins",
    "complete_runs",
    "list_tables",
    "publish",
    "publish_all",
    "publish_snapshot",
    "publish_sorted",
    "read_run",
    "read_snapshot",
    "read_sorted",
    "register_tables",
    "repoint",
    "retain_runs",
    "retain_snapshots",
    "run_as_of",
    "run_folder",
    "run_history",
    "snapshot_history",
    "table_detail",
]
