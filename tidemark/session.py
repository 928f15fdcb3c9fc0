"""Session settings. Jobs change none of them, so jobs that share a session don't meet."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Report hot shuffle blocks exactly: beyond 2000 partitions only averages are
    # kept, and a hot partition would go unseen.
    "spark.shuffle.accurateBlockSkewedFactor": "5",
    # Join by hash instead of sorting page bodies where every build side is this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.parquet.compression.codec": "snappy",
}

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
SCAN_TASKS = "spark.sql.files.maxPartitionNum"
ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARALLELISM_FIRST = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


def build_session(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def settings_for(
    input_bytes: int,
    at_least: int = 200,
    bytes_per_partition: int = 512 << 20,
    max_partitions: int = 50_000,
    max_scan_tasks: int = 100_000,
    file_bytes: int | None = None,
) -> dict[str, str]:
    """Settings for a session whose jobs read ``input_bytes`` of files; adaptive execution merges what turns out small.

    A shuffle has scan tasks times partitions blocks. Both are bounded so that
    these stay in hand; past the bounds (25 TB by default) tasks grow instead,
    and spill. A large input is merged into partitions of the advisory size
    rather than into one per core, for files of a good size. ``file_bytes`` is what the partitions of a sized write
    should hold, as rows on their way (compressed); files come out near that.
    """
    wanted = -(-input_bytes // bytes_per_partition)
    settings = {
        SHUFFLE_PARTITIONS: str(max(at_least, min(wanted, max_partitions))),
        SCAN_TASKS: str(max_scan_tasks),
    }
    if input_bytes > bytes_per_partition or file_bytes:
        settings[PARALLELISM_FIRST] = "false"
    if file_bytes:
        settings[ADVISED] = str(file_bytes)
    return settings
