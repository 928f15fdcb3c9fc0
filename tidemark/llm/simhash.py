"""SimHash near-duplicates by multi-index hashing.

A fingerprint has a bit where more than half of the shingles' hashes have it.
Two fingerprints that differ in at most 3 bits differ in at most 1 bit in one of
their halves of 32 bits. So the small Hamming ball (the half itself, and the half
with one bit changed) of one of them holds the half of the other:

* the table lists every distinct fingerprint by its halves, the queries are the
  balls around them. Of two halves that differ in one bit, the one with the bit
  off asks for the other, so each pair is met once, not twice;
* what a ball leaves for the other half (3 bits, or 2 after a changed bit) spares
  one of 4 (3) parts of it, so that part goes into the key: a half that many
  fingerprints share does not bring them all together;
* the whole distance is verified in the join.

Only distinct fingerprints are joined; copies of a document are met by their
fingerprint and never paired. Links give connected components.

Defined results: a null or empty text has fingerprint 0 and is linked like any
other. Repeated rows each get a row. NULL keys are members; a component without
any key has the id NULL. Texts of any length are read whole. Only key and text are read; ``keep_one`` carries the
other columns, of any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, lower_words, utf8, written
from tidemark.llm.components import components

#: Shingles whose bits are added up at once.
BLOCK = 1 << 14
SEED = 42
BITS = 64


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The fingerprint as a signed 64-bit number."""
    import xxhash

    listed = lower_words(text)
    if not listed:
        return 0
    width = min(shingle, len(listed))
    shingles = map(b" ".join, zip(*(listed[i:] for i in range(width))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(listed) - width + 1)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``key, mark, fp`` per row; ``mark`` is a hash of the text."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *(T.StructField(c, T.LongType()) for c in ("mark", "fp"))])

    def each(batch: pa.RecordBatch) -> dict:
        same = {c: batch.column(c) for c in ("key", "mark")}
        return same | {"fp": [fingerprint(t, shingle) for t in utf8(batch.column("text"))]}

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(column).alias("mark"), F.col(column).alias("text"))
    return arrow_map(rows, each, schema)


def links(fps: DataFrame, max_distance: int = 3) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints (column ``fp``) at most ``max_distance`` (0 to 3) bits apart.

    A pair may come more than once, from each key that its two sides share.
    """
    if not 0 <= max_distance <= 3:
        raise ValueError("balls of one bit in two halves find distances up to 3")
    halves = """inline(array(
        named_struct('half', 0L, 'own', shiftrightunsigned(fp, 32), 'other', fp & 4294967295L),
        named_struct('half', 1L, 'own', fp & 4294967295L, 'other', shiftrightunsigned(fp, 32))))"""
    # parts 0 to 3 are bytes of the other half, 4 to 6 are its thirds
    part = "IF(part < 4, shiftright(other, CAST(8 * part AS INT)) & 255, shiftright(other, CAST(11 * (part - 4) AS INT)) & 2047)"
    key = f"(half * 7 + part) * 8796093022208L + {{}} * 2048L + {part}"
    table = (
        fps.selectExpr("fp", halves)
        .selectExpr("*", "explode(sequence(0L, 6L)) AS part")
        .selectExpr("fp AS b", f"{key.format('own')} AS key")
    )
    ball = (
        fps.selectExpr("fp", halves)
        .selectExpr("*", "explode(sequence(-1, 31)) AS bit")
        .where("bit = -1 OR getbit(own, greatest(bit, 0)) = 0")
        .selectExpr("*", "explode(IF(bit = -1, sequence(0L, 3L), sequence(4L, 6L))) AS part")
        .selectExpr("fp AS a", f"{key.format('IF(bit = -1, own, own | shiftleft(1L, bit))')} AS key", "bit = -1 AS same")
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    once = ~F.col("same") | (F.col("a") < F.col("b"))
    # Both sides are many rows per fingerprint, which the planner's estimate of a table leaves out.
    return ball.hint("merge").join(table, (ball["key"] == table["key"]) & near & once & (F.col("a") != F.col("b"))).select("a", "b")


def members(docs: DataFrame, shingle: int = 3, max_distance: int = 3, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``key, mark, fp, component, component_id`` per row: its component, and the smallest key in that."""
    marked = written(fingerprints(docs, shingle, key, column), "fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min("key").alias("least")), "fingerprint-classes")
    linked = components(links(classes.select("fp"), max_distance), "a", "b")
    labelled = classes.join(linked, classes["fp"] == linked["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    labelled = written(labelled, "fingerprint-components")
    ids = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    return marked.join(labelled.join(ids, "component").select("fp", "component", "component_id"), "fp")


def groups(docs: DataFrame, shingle: int = 3, max_distance: int = 3, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``key, fp, component_id`` per row: the smallest key that links lead to, its own included."""
    return members(docs, shingle, max_distance, key, column).select(F.col("key").alias(key), "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_distance: int = 3, key: str = "doc_id", column: str = "text") -> DataFrame:
    """One document of each component: the one with the smallest key, without keys the one with the smallest hash of its text.

    Of rows that share key and text the first by a hash of the whole row stays. Columns may have any name.
    """
    found = members(docs, shingle, max_distance, key, column)
    place = F.struct(F.col("key").isNull().alias("none"), F.col("key"), F.col("mark"))
    first = found.groupBy("component").agg(F.min(place).alias("first")).select("first.key", "first.mark")
    # how many rows share the place of a first one; only those are put in order
    shared = found.groupBy("key", "mark").agg(F.count("*").alias("n"))
    same = lambda a, b: a["key"].eqNullSafe(b["key"]) & (a["mark"] == b["mark"])
    first = written(first.alias("f").join(shared.alias("s"), F.expr("f.key <=> s.key AND f.mark = s.mark")).select("f.*", "n"), "first-of-group")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("key"), F.xxhash64(column).alias("mark"))
    once, more = first.where("n = 1"), first.where("n > 1")
    alone = rows.join(once, same(rows, once), "left_semi")
    order = Window.partitionBy("key", "mark").orderBy(F.xxhash64("row"))
    several = rows.join(more, same(rows, more), "left_semi").withColumn("place", F.row_number().over(order)).where("place = 1")
    return alone.select("row.*").unionByName(several.select("row.*"))
