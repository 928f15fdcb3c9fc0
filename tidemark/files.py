"""File system calls through Spark's own Hadoop configuration (any URI Spark can read)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _path(spark: SparkSession, name: str) -> tuple:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def literal(name: str) -> str:
    """A path as a pattern that matches only itself, for readers that take globs."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", name)


def status(spark: SparkSession, name: str) -> tuple[datetime, int]:
    """Modification time (UTC) and length of a file."""
    fs, path = _path(spark, name)
    found = fs.getFileStatus(path)
    return datetime.fromtimestamp(found.getModificationTime() / 1000, timezone.utc), found.getLen()


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching ``pattern``."""
    fs, path = _path(spark, pattern)
    return [status.getPath().toString() for status in (fs.globStatus(path) or [])]


def total_size(spark: SparkSession, pattern: str) -> int:
    """Bytes of all files at and below the paths matching ``pattern``."""
    fs, path = _path(spark, pattern)
    return sum(fs.getContentSummary(status.getPath()).getLength() for status in (fs.globStatus(path) or []))


def ends(spark: SparkSession, file: str, n: int) -> tuple[bytes, bytes]:
    """The first and last ``n`` bytes of a file (all of it, if it is shorter)."""
    fs, path = _path(spark, file)
    size = fs.getFileStatus(path).getLen()
    n = min(n, size)
    read = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray
    stream = fs.open(path)
    try:
        head = bytes(read(stream, n))
        stream.seek(size - n)
        return head, bytes(read(stream, n))
    finally:
        stream.close()


def part(spark: SparkSession, file: str, offset: int, n: int) -> bytes:
    """Up to ``n`` bytes of a file from ``offset`` on."""
    fs, path = _path(spark, file)
    n = max(0, min(n, fs.getFileStatus(path).getLen() - offset))
    stream = fs.open(path)
    try:
        stream.seek(offset)
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n))
    finally:
        stream.close()


def walk(
    spark: SparkSession, folder: str, wanted: Callable[[JavaObject], bool] = lambda status: True
) -> Iterator[tuple[str, int, int]]:
    """Path, modification time (ms) and length of every file below a folder, one at a time.

    As for all Spark sources, what starts with ``_`` or ``.`` is passed over, folders with all below them. Of a
    file whose status isn't ``wanted`` nothing more is asked.
    """
    fs, path = _path(spark, folder)
    root = fs.makeQualified(path).toString().rstrip("/")
    found = fs.listFiles(path, True)
    while found.hasNext():
        status = found.next()
        if not wanted(status):
            continue
        name = status.getPath().toString()
        inner = name[len(root) + 1 :].split("/") if name.startswith(f"{root}/") else [name.rsplit("/", 1)[-1]]
        if not any(part.startswith(("_", ".")) for part in inner):
            yield name, status.getModificationTime(), status.getLen()


def exists(spark: SparkSession, name: str) -> bool:
    fs, path = _path(spark, name)
    return fs.exists(path)


def read_text(spark: SparkSession, file: str) -> str:
    fs, path = _path(spark, file)
    return part(spark, file, 0, fs.getFileStatus(path).getLen()).decode()


def publish(spark: SparkSession, file: str, text: str) -> bool:
    """Write a file under another name and give it its own in one rename; False if there is one already."""
    fs, path = _path(spark, file)
    _, draft = _path(spark, f"{path.getParent().toString()}/_{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        done = not fs.exists(path) and fs.rename(draft, path)
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)
    return done


def delete(spark: SparkSession, folder: str) -> None:
    fs, path = _path(spark, folder)
    fs.delete(path, True)
