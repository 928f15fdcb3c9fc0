"""Files others wrote: list them, take the newest, read it whole."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files, schemas
from tidemark.sources import compact, foreign
from tidemark.operators.shaping import JSON_SPACE, json_record, unwrap_json

FORMATS = ("json", "parquet")

# Column pandas adds to Parquet when a frame's index is not a plain range.
_PANDAS_INDEX = "__index_level_0__"


class NoSnapshotError(FileNotFoundError):
    """A folder holds nothing to read."""


class EmptyFileError(ValueError):
    """The newest file has no content, as after a write that broke off."""


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    return fmt


def list_files(spark: SparkSession, folder: str, fmt: str = "json") -> DataFrame:
    """``path, modificationTime, length`` of the ``.fmt`` files anywhere below ``folder``.

    Only the listing is read, no content. Empty files, which the scan passes over, are found by a
    streamed listing that keeps nothing else. As for all
    Spark sources, names starting with ``_`` or ``.`` are not listed.
    """
    check_format(fmt)
    try:
        listing = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", f"*.{fmt}")
            .load(files.literal(folder))
        )
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise NoSnapshotError(f"no {fmt} snapshot in {folder}") from e
        raise
    found = listing.select("path", "modificationTime", "length")
    empty = [
        (path, datetime.fromtimestamp(at / 1000, timezone.utc), 0)
        for path, at, _ in files.walk(spark, folder, lambda status: status.getLen() == 0)
        if path.endswith(f".{fmt}")
    ]
    return found.union(spark.createDataFrame(empty, found.schema)) if empty else found


def newest(listing: DataFrame) -> DataFrame:
    """The most recently modified row of a listing; the first path wins a tie."""
    return listing.orderBy(F.col("modificationTime").desc(), F.col("path")).limit(1)


def latest_file(spark: SparkSession, folder: str, fmt: str = "json") -> str:
    """Path of the newest ``.fmt`` file below ``folder``, of a streamed listing that holds one entry.

    The first path wins a tie, as in ``newest``.
    """
    check_format(fmt)
    best: tuple[int, str, int] | None = None
    if files.exists(spark, folder):
        for path, at, length in files.walk(spark, folder, lambda status: best is None or status.getModificationTime() >= best[0]):
            if path.endswith(f".{fmt}") and (best is None or at > best[0] or path < best[1]):
                best = at, path, length
    if best is None:
        raise NoSnapshotError(f"no {fmt} snapshot in {folder}")
    if best[2] == 0:
        raise EmptyFileError(f"the newest {fmt} file is empty: {best[1]}")
    return best[1]


def _layout(spark: SparkSession, path: str) -> tuple[str, str, str] | None:
    """What stands before the first record, between records and after the last one.

    None unless the file is an indented array with a line per brace, by itself or
    as the only value of ``{"items": ...}``.
    """
    head, tail = (part.decode("utf-8", "replace") for part in files.ends(spark, path, 64))
    opening = re.match(r'(?:\{(\r?\n)[ \t]+"items": )?\[(\r?\n)([ \t]+)\{\r?\n', head)
    if opening is None:
        return None
    newline, indent = opening[2], opening[3]
    closing = re.search(rf"{newline}{indent}\}}{newline}[ \t]*\]" + (rf"{newline}\}}" if opening[1] else "") + r"\s*$", tail)
    if closing is None:
        return None
    return opening[0], f"{newline}{indent}}},{newline}{indent}{{{newline}", closing[0].rstrip(JSON_SPACE)


def _read_indented_array(
    spark: SparkSession, path: str, record: T.StructType, layout: tuple[str, str, str]
) -> DataFrame:
    # A line break inside a JSON string is escaped, so what stands between two
    # records stands nowhere else, and the file splits there. Other elements
    # ({} or null) may stand beside a record in its piece.
    opening, between, closing = layout
    chunk = F.rtrim("value", F.lit(JSON_SPACE))
    chunk = F.when(chunk.startswith(opening), F.substr(chunk, F.lit(len(opening) + 1))).otherwise(chunk)
    chunk = F.when(
        chunk.endswith(closing), F.left(chunk, F.length(chunk) - len(closing))
    ).otherwise(chunk)
    lines = spark.read.text(files.literal(path), lineSep=between)
    # Arrival order: by split, then by piece in the split, then by place in the piece.
    pieces = lines.select(
        F.array("_metadata.file_block_start").alias("parent_ord"),
        F.monotonically_increasing_id().alias("page_offset"),
        F.concat(F.lit("[{"), chunk, F.lit("}]")).alias("text"),
    )
    return unwrap_json(pieces, "text", record, keep=["parent_ord", "page_offset"])


def _task_bytes(spark: SparkSession) -> int:
    """What one task reads of a file at most."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def read_json_file(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """The records of a JSON file others wrote, with their arrival order.

    An indented array of records, one line per brace and with line breaks of
    either kind, is split between records and read in parallel. Any other array of records, or
    object with one under ``items``, is scanned for the ends of records (``compact``) if it is more than one task reads. What is left is
    read whole, in one task, and must fit in one string (2 GB).
    """
    layout = _layout(spark, path)
    if layout is not None:
        return _read_indented_array(spark, path, record, layout)
    if files.status(spark, path)[1] > _task_bytes(spark):
        records = compact.read_compact(spark, path, record, files.part(spark, path, 0, compact.HEAD))
        if records is not None:
            return records
    records = unwrap_json(spark.read.text(files.literal(path), wholetext=True), "value", record)
    return records.select(
        F.array().cast("array<bigint>").alias("parent_ord"),
        F.lit(0).cast("bigint").alias("page_offset"),
        "*",
    )


def read_pages(
    spark: SparkSession, path: str, record: T.StructType | None = None, fmt: str = "json"
) -> DataFrame:
    """Response bodies as they were landed: JSON Lines with a page per line, or Parquet.

    Without ``record`` every field of an item is kept: JSON items are VARIANT values, Parquet ones what the files
    say. Merging reads pages twice, sizes first. From Parquet the first reading is
    one field; JSON is parsed in full, child pages of VARIANT items once (``merge_child_pages`` stages them).
    """
    if check_format(fmt) == "json":
        return spark.read.schema(schemas.page(record)).option("mode", "FAILFAST").json(path)
    return spark.read.parquet(path) if record is None else spark.read.schema(schemas.page(record)).parquet(path)


def read_parquet_file(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file, without the index column pandas may have left in it.

    Times in nanoseconds, which Spark has no type for, are read as whole numbers and floored to microseconds: to
    ``timestamp_ntz``, or to ``timestamp`` where the file says they are instants.
    """
    return foreign.read(spark, path).drop(_PANDAS_INDEX)


def read_latest_file(
    spark: SparkSession, folder: str, fmt: str = "json", record: T.StructType | None = None
) -> DataFrame:
    """The newest file below ``folder``: JSON needs the schema of its records, Parquet has its own."""
    if check_format(fmt) == "json" and record is None:
        raise ValueError("reading JSON needs the schema of its records")
    path = latest_file(spark, folder, fmt)
    if fmt == "json":
        return read_json_file(spark, path, record)
    return read_parquet_file(spark, path)
