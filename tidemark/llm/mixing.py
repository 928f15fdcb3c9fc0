"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions.

The sources share a number of words by their weights. A source is clamped at
``MAX_EPOCHS`` times its size; what it leaves is shared again by weight, until
none is above. Sources are ranked, summed and clamped in tables; only a few sums
of a round reach the driver.

A target of 2.3 epochs takes every document twice and a seeded sample of three
tenths of the words once more. The sample is the documents first in the order of
a seeded hash, up to the words asked for: words are summed by ``BUCKETS`` parts of
the hash, and only the part in which the sum is reached is put in order. So no
task orders a whole source, and the words taken differ from the target by half a
document at most.

Defined results: null texts have no words, whatever they are repeated. Null sources are one source, the last. A source
without words has target 0. Documents of equal hashes go in the order of their
key, and rows equal in all are exchangeable, so reruns agree. Rows without a key are told apart by a hash of their
text, in the draw and in ``mix``. Rows that share key, source and text are taken equally often. Further columns are carried in
one struct and may have any name. Texts of any length are read whole.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, written

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 20_240
BUCKETS = 4096
#: A source counts as clamped from this near its cap on (relative), so rounds end.
TOLERANCE = 1e-12


def _mark(column: str) -> Column:
    """What tells texts of one key, or of none, apart."""
    return F.xxhash64(F.col(column)).alias("mark")


def sizes(docs: DataFrame, key: str = "doc_id", source: str = "source", column: str = "text", seed: int = SEED) -> DataFrame:
    """``key, source, mark, size, draw, bucket`` per row: hash of the text, words, seeded hash, part of the hash."""
    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("source", docs.schema[source].dataType),
            T.StructField("mark", T.LongType()),
            T.StructField("size", T.LongType()),
        ]
    )

    def each(batch: pa.RecordBatch) -> dict:
        found = pc.count_substring_regex(batch.column("text"), r"[^\x20\x09-\x0D]+")
        same = {c: batch.column(c) for c in ("key", "source", "mark")}
        return same | {"size": pc.fill_null(found, 0).cast(pa.int64())}

    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), _mark(column), F.col(column).alias("text"))
    draw = F.xxhash64(F.lit(seed), F.col("key"), F.when(F.col("key").isNull(), F.col("mark")))
    return arrow_map(rows, each, schema).withColumn("draw", draw).withColumn("bucket", F.pmod("draw", F.lit(BUCKETS)))


def ranked_sources(sized: DataFrame) -> DataFrame:
    """``source, size, place``: sources by code point, null last, numbered from 0 without one task seeing all."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    slices = written(
        totals.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("slice", F.spark_partition_id()),
        "sources",
    )
    before, offsets = 0, {}
    for row in slices.groupBy("slice").count().orderBy("slice").collect():
        offsets[row["slice"]] = before
        before += row["count"]
    inside = F.row_number().over(Window.partitionBy("slice").orderBy(F.col("source").asc_nulls_last())) - 1
    start = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])[F.col("slice")] if offsets else F.lit(0)
    return slices.select("source", "source_size", (inside + start).alias("place"))


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS, total: int | None = None) -> DataFrame:
    """``source, source_size, target`` by water-filling ``total`` words (default: all there are)."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = written(ranked_sources(sized).withColumn("weight", weight), "weighted-sources")
    cap = F.col("source_size") * float(max_epochs)
    if total is None:
        total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, clamped = 0.0, F.lit(False)
    while True:
        row = sources.agg(
            F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(clamped, 1)),
        ).first()
        if row[1] == 0:
            break
        level = max(0.0, (total - row[0]) / row[1])
        now = cap <= F.lit(level) * F.col("weight") * (1 + TOLERANCE)
        if sources.where(now).count() == row[2]:
            break
        clamped = now
    share = F.when(clamped, cap).otherwise(F.lit(level) * F.col("weight"))
    return sources.select("source", "source_size", F.least(cap, share).alias("target"))


def plan(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: ``whole`` repetitions, the words ``rest`` to sample, the bucket that ends the sample, words before it."""
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(epochs + 1e-9)
    rest = F.greatest(F.lit(0.0), F.col("target") - whole * F.col("source_size"))
    goals = goals.withColumn("whole", whole).withColumn("rest", rest)
    filled = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    summed = filled.withColumn("before", F.coalesce(F.sum("words").over(order), F.lit(0)))
    last = summed.join(goals.select("source", "rest").withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    last = last.where("before <= rest").groupBy("source").agg(F.max_by(F.struct("bucket", "before"), "bucket").alias("last"))
    last = last.select(F.col("source").alias("__source"), F.col("last.bucket").alias("last_bucket"), "last.before")
    return goals.join(last, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")


def repetitions(docs: DataFrame, key: str = "doc_id", source: str = "source", column: str = "text", seed: int = SEED) -> DataFrame:
    """Per row ``key, source, mark, size, source_size, target, times``: how often the mix takes the document."""
    sized = written(sizes(docs, key, source, column, seed), "sizes")
    planned = written(plan(sized, targets(sized)), "mix-plan").withColumnRenamed("source", "__source")
    rows = sized.join(planned, F.col("source").eqNullSafe(F.col("__source")))
    # extra: whether the document is in the sample
    inside = rows.where(F.col("bucket") != F.col("last_bucket"))
    inside = inside.withColumn("extra", F.col("bucket") < F.col("last_bucket"))
    order = Window.partitionBy("source").orderBy("draw", "key", "mark").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where(F.col("bucket") == F.col("last_bucket"))
    reached = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("size") / 2
    edge = edge.withColumn("extra", reached <= F.col("rest"))
    times = F.col("whole") + (F.col("extra") & (F.col("rest") > 0)).cast("int")
    return inside.unionByName(edge).select("key", "source", "mark", "size", "source_size", "target", times.cast("int").alias("times"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", column: str = "text", seed: int = SEED) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; rows that share key, source and text are taken equally often."""
    found = repetitions(docs, key, source, column, seed)
    times = found.groupBy("key", "source", "mark").agg(F.max("times").alias("times")).where("times > 0")
    times = times.select(*[F.col(c).alias(f"its_{c}") for c in times.columns])
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("key"), F.col(source).alias("source"), _mark(column))
    same = [F.col(c).eqNullSafe(F.col(f"its_{c}")) for c in ("key", "source", "mark")]
    taken = rows.join(times, same[0] & same[1] & same[2]).select("row", F.explode(F.sequence(F.lit(1), F.col("its_times"))))
    return taken.select("row.*")
