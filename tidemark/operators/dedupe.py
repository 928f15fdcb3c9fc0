"""Duplicate removal that keeps the first arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.shaping import quoted

_RANK = "__arrival_rank"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``. NULL keys are one key.

    ``order`` should be unique within a key; then the result does not depend on
    partitioning or retries, unlike ``dropDuplicates``. The rank filter becomes
    a partial WindowGroupLimit before the shuffle, so each map task sends at
    most one row per key and a hot key costs its reducer one row per map task.
    """
    arrival = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*[quoted(o) for o in order])
    return df.withColumn(_RANK, F.row_number().over(arrival)).where(F.col(_RANK) == 1).drop(_RANK)
