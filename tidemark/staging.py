"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tidemark import files

#: Where a local session may stage that was started without a folder.
LOCAL_FOLDER = "file:///tmp/checkpoints"

_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)


def named_folder(spark: SparkSession) -> str | None:
    """The folder ``spark.checkpoint.dir`` names, or the one set on the context."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    return named.rstrip("/") if named else None


def named_or_local(spark: SparkSession) -> None:
    """Give a local session without a shared folder one; one process has no other machine to share with.

    For the callers that can't ask for a folder (registered queries, tests). On a
    cluster nothing is set, and staging without a named folder is an error.
    """
    master = spark.sparkContext.master
    if named_folder(spark) is None and (master == "local" or master.startswith("local[")):
        spark.sparkContext.setCheckpointDir(LOCAL_FOLDER)


def shared_folder(spark: SparkSession) -> str:
    """The named folder, which all executors share; there is no default."""
    named = named_folder(spark)
    if named is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path (not yet created) below the job's folder or else the shared one."""
    parent = _job_folder.get() or shared_folder(spark)
    return f"{parent}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """Stage below one new folder, and remove it when the job is done with its tables."""
    folder = new_folder(spark, "job")
    token = _job_folder.set(folder)
    try:
        yield folder
    finally:
        _job_folder.reset(token)
        files.delete(spark, folder)


def staged(df: DataFrame, packed: bool = False) -> DataFrame:
    """``df`` written once as Parquet and read back.

    The lineage ends here, so a lost executor costs no recomputation above this
    point, and the optimizer sees the table's size when it picks a join. The
    files are plain (no compression, no dictionary), so their size is that of
    the values, and a broadcast is bounded by it; ``packed`` ones are a third, for tables that grow with the input.
    """
    path = new_folder(df.sparkSession, "staged")
    options = {"compression": "zstd"} if packed else {"compression": "none", "parquet.enable.dictionary": "false"}
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
