"""Our own tables: ``<base>/<layer>/<name>/snapshot_ts=<stamp>/``, one folder per run.

Every attempt writes to a folder of its own in there. When it is done, a manifest
of its files, their sizes and the number of rows is published in one rename, the
first attempt's if there are several. Only files that a manifest names are read, so nothing that a failed or slower
attempt leaves behind is ever read or counted twice, and a run that died may be repeated.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files, schemas
from tidemark.sources.files import NoSnapshotError, check_format

BRONZE, SILVER = "bronze", "silver"

MANIFEST = "_MANIFEST"

#: Writer options of JSON Lines as gzip. This level writes an eighth more bytes than the default one, in a third of its time.
GZIP = {"compression": "gzip", "zlib.compress.level": "THREE"}

_PARTITION = "snapshot_ts="
_STAMP = "%Y%m%d_%H%M%S"


def snapshot_id(now: datetime | None = None) -> str:
    """The stamp of a run, ``yyyyMMdd_HHmmss`` in UTC. Take one and pass it to every write."""
    return (now or datetime.now(timezone.utc)).strftime(_STAMP)


def table_path(base: str, layer: str, name: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{name}"


def snapshot_path(table: str, snapshot_ts: str) -> str:
    return f"{table}/{_PARTITION}{snapshot_ts}"


def list_snapshots(spark: SparkSession, table: str) -> list[str]:
    """Stamps of the complete snapshots, oldest first (one listing, one entry per run)."""
    done = files.glob(spark, f"{files.literal(table)}/{_PARTITION}*/{MANIFEST}")
    return sorted(path.split("/")[-2].removeprefix(_PARTITION) for path in done)


def has_runs(spark: SparkSession, table: str) -> bool:
    """Whether any run wrote here, complete or not."""
    return bool(files.glob(spark, f"{files.literal(table)}/{_PARTITION}*"))


def latest_snapshot(spark: SparkSession, table: str) -> str:
    """Stamp of the newest complete snapshot."""
    stamps = list_snapshots(spark, table)
    if not stamps:
        raise NoSnapshotError(f"no snapshot in {table}")
    return stamps[-1]


def manifest(spark: SparkSession, table: str, snapshot_ts: str | None = None) -> dict:
    """What was published of a snapshot, the latest unless one is named: ``rows``, ``files`` (path in its folder, bytes), ``bytes``."""
    stamp = latest_snapshot(spark, table) if snapshot_ts is None else snapshot_ts
    path = f"{snapshot_path(table, stamp)}/{MANIFEST}"
    if not files.exists(spark, path):
        raise NoSnapshotError(f"no complete snapshot {stamp} in {table}")
    return {"snapshot_ts": stamp} | json.loads(files.read_text(spark, path))


def read_snapshot(
    spark: SparkSession,
    table: str,
    fmt: str,
    schema: T.StructType | None = None,
    snapshot_ts: str | None = None,
) -> DataFrame:
    """One complete snapshot, the latest unless ``snapshot_ts`` names one. JSON needs a schema."""
    if check_format(fmt) == "json" and schema is None:
        raise ValueError("reading JSON needs a schema")
    found = manifest(spark, table, snapshot_ts)
    folder = snapshot_path(table, found["snapshot_ts"])
    paths = [files.literal(f"{folder}/{name}") for name, _ in found["files"]]
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "json":
        return reader.option("mode", "FAILFAST").json(paths)
    return reader.parquet(*paths)


def read_raw(
    spark: SparkSession,
    table: str,
    record: T.StructType | None = None,
    key: str | None = None,
    snapshot_ts: str | None = None,
) -> DataFrame:
    """Raw records of a snapshot with their arrival order, and the parent's key as ``key`` if they have one.

    With the schema of a ``record`` its fields are columns; without, ``record`` is a VARIANT of all that was landed.
    """
    rows = read_snapshot(spark, table, "json", schemas.landed(record, key), snapshot_ts)
    if record is None:
        return rows
    fields = [F.col("record").getField(f).alias(f) for f in record.names if f != key]
    return rows.select(*schemas.ORDINAL_COLUMNS, *fields, *([key] if key else []))


def _attempt(df: DataFrame, folder: str, fmt: str, sized: bool, counts: dict[str, Column], **options: str) -> tuple[str, dict[str, int]]:
    """Write ``df`` to a new folder in ``folder``; returns that folder's name, and the counts."""
    counted, attempt = Observation(), f"attempt-{uuid.uuid4().hex}"
    # The counts are taken on the way into the write; no second pass.
    out = df.observe(counted, *[count.alias(name) for name, count in counts.items()])
    if sized:
        out = out.hint("rebalance")
    out.write.format(fmt).options(**options).save(f"{folder}/{attempt}")
    return attempt, counted.get


def _objects(df: DataFrame) -> DataFrame | None:
    """``df`` with VARIANT records as maps of their fields, NULL where a record is no object; None if it has no such records."""
    if "record" not in df.columns or not isinstance(df.schema["record"].dataType, T.VariantType):
        return None
    return df.withColumn("record", F.try_variant_get("record", "$", "map<string,variant>"))


def _write(df: DataFrame, table: str, snapshot_ts: str, fmt: str, sized: bool, **options: str) -> int:
    spark, folder = df.sparkSession, snapshot_path(table, snapshot_ts)
    if files.exists(spark, f"{folder}/{MANIFEST}"):
        raise FileExistsError(f"snapshot {snapshot_ts} of {table} is already complete")
    attempt, counts = None, {"rows": F.count(F.lit(1))}
    # Spark makes the text of each name in a VARIANT anew, at some cost; those of a map are written as they are, to the same JSON.
    objects = _objects(df) if fmt == "json" else None
    if objects is not None:
        attempt, counted = _attempt(objects, folder, fmt, sized, counts | {"others": F.count_if(F.col("record").isNull())}, **options)
        if counted["others"]:
            files.delete(spark, f"{folder}/{attempt}")
            attempt = None
    if attempt is None:
        attempt, counted = _attempt(df, folder, fmt, sized, counts, **options)
    written = [(f"{attempt}/{path.rsplit('/', 1)[1]}", size) for path, _, size in files.walk(spark, f"{folder}/{attempt}")]
    rows = counted["rows"]
    told = {"rows": rows, "bytes": sum(size for _, size in written), "files": sorted(written)}
    if not files.publish(spark, f"{folder}/{MANIFEST}", json.dumps(told)):
        raise FileExistsError(f"snapshot {snapshot_ts} of {table} was completed by another attempt")
    return rows


def write_raw(
    df: DataFrame, base: str, name: str, snapshot_ts: str, sized: bool = False, packed: bool = False
) -> int:
    """Land ``df`` as JSON Lines (UTF-8) under bronze; returns the row count.

    ``packed`` writes them as gzip, a tenth of the bytes; such a file is read by one task, so there are as many readers as writers.
    ``sized`` deals the rows anew before they are written, so that every file is of about the size the session advises
    for a partition (``settings_for(..., file_bytes)``): small tasks are merged and skewed ones split by adaptive execution.
    """
    options = GZIP if packed else {}
    return _write(df, table_path(base, BRONZE, name), snapshot_ts, "json", sized, encoding="UTF-8", **options)


def write_parquet(df: DataFrame, base: str, name: str, snapshot_ts: str, sized: bool = False) -> int:
    """Write ``df`` as snappy Parquet under silver; returns the row count. ``sized`` as in ``write_raw``."""
    return _write(df, table_path(base, SILVER, name), snapshot_ts, "parquet", sized, compression="snappy")
