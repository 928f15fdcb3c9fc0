from tidemark.sources.files import (
    EmptyFileError,
    NoSnapshotError,
    latest_file,
    list_files,
    newest,
    read_json_file,
    read_latest_file,
    read_pages,
    read_parquet_file,
)
from tidemark.sources.snapshots import (
    has_runs,
    latest_snapshot,
    list_snapshots,
    manifest,
    read_raw,
    read_snapshot,
    snapshot_id,
    snapshot_path,
    table_path,
    write_parquet,
    write_raw,
)

__all__ = [
    "EmptyFileError",
    "NoSnapshotError",
    "has_runs",
    "latest_file",
    "latest_snapshot",
    "list_files",
    "list_snapshots",
    "manifest",
    "newest",
    "read_json_file",
    "read_latest_file",
    "read_pages",
    "read_parquet_file",
    "read_raw",
    "read_snapshot",
    "snapshot_id",
    "snapshot_path",
    "table_path",
    "write_parquet",
    "write_raw",
]
