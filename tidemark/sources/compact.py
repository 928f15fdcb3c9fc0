"""Compact JSON in parallel: a structural scan finds the ends of records, and the document is cut there.

A document without line breaks does not split by lines, so it is read in pieces
that end at ``}``, which any task can find. Whether such a brace ends a record
depends on all that stands before it: on being inside a string, and on depth.
Both are sums, so they are scanned in parallel:

1. Every block of the file (what one task reads) gives its bytes, whether it has an odd
   number of quotes, and how it changes the depth if it begins outside or inside a
   string. That is one row for each block; their prefix sums are the states in which blocks begin.
2. With these every piece knows its own state, hence which braces end a record,
   and where the array of records closes. Blocks give their numbers of records.
3. Pieces are put together by the number of their record, also across blocks, and each
   record is parsed for itself.

No record is read by one task only because it stands in one line with others; a single record must
fit in one string (2 GB).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files
from tidemark.operators.shaping import JSON_SPACE, unwrap_json

#: Bytes at the start of a document in which its array of records has to begin.
HEAD = 1 << 16
#: Bytes that may stand between the last brace of the records and the end of their array.
LAST_PIECE = 1 << 26
#: Bytes that may follow the array of records in a document that wraps it.
TAIL = 1 << 20


class Scan:
    """A plain scan of a few bytes: depth and string state at each place."""

    def __init__(self, depth: int = 0, in_string: bool = False) -> None:
        self.depth, self.in_string, self.escaped = depth, in_string, False

    def step(self, byte: int) -> None:
        if self.escaped:
            self.escaped = False
        elif self.in_string:
            self.escaped, self.in_string = byte == 0x5C, byte != 0x22
        elif byte == 0x22:
            self.in_string = True
        elif byte in b"[{":
            self.depth += 1
        elif byte in b"]}":
            self.depth -= 1


def array_start(head: bytes) -> tuple[int, int] | None:
    """Where the first record may begin, and at what depth: after ``[``, or after ``[`` of the outermost key ``items``."""
    body = head.lstrip(JSON_SPACE.encode())
    if body.startswith(b"["):
        return len(head) - len(body) + 1, 1
    if not body.startswith(b"{"):
        return None
    scan, opened = Scan(), None
    key = None  # the last string at depth 1, if a colon follows it
    for at, byte in enumerate(head):
        before = scan.in_string
        scan.step(byte)
        if scan.depth == 1 and scan.in_string and not before:
            opened = at
        elif scan.depth == 1 and before and not scan.in_string:
            key = head[opened : at + 1]
        elif scan.depth == 2 and byte == 0x5B and not scan.in_string and key == b'"items"':
            return at + 1, 2
        elif scan.depth == 1 and not scan.in_string and byte not in b": \t\r\n":
            key = None
    return None


def _count(text: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kept}]", ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``block, id, value``, and what a piece outside (0) or inside (1) a string changes."""
    lines = spark.read.text(files.literal(path), lineSep="}")
    pieces = lines.select(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    return pieces.withColumn("bytes", F.octet_length("value") + 1)


def _quoted_parts(text: str) -> Column:
    """The text between quotes, without what a backslash escapes."""
    return F.split(F.regexp_replace(text, r"\\[\s\S]", ""), '"', -1)


def _every_other(parts: Column | str, first: int) -> Column:
    return F.array_join(F.filter(parts, lambda _, i: i % 2 == first), "")


def _shaped(pieces: DataFrame) -> DataFrame:
    shaped = pieces.withColumn("parts", _quoted_parts("value")).withColumn("odd", (F.size("parts") - 1) % 2)
    for state in (0, 1):
        shaped = shaped.withColumn(f"outside{state}", _every_other("parts", state))
        # the brace that ends the piece counts if it is outside a string
        change = _count(F.col(f"outside{state}"), r"\[{") - _count(F.col(f"outside{state}"), r"\]") - (F.col("odd") == state).cast("int")
        shaped = shaped.withColumn(f"change{state}", change)
    return shaped.drop("parts")


def _before(value: Column | str) -> Column:
    in_order = Window.partitionBy("block").orderBy("id")
    return F.coalesce(F.sum(value).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _entries(spark: SparkSession, path: str) -> list[tuple[int, int, int, int]]:
    """Each block with the offset, string state and depth in which its first piece begins."""
    shaped = _shaped(_pieces(spark, path)).select("block", "id", "bytes", "odd", "change0", "change1")
    placed = shaped.withColumn("before", _before("odd") % 2)
    same = F.col("before") == 0
    totals = placed.groupBy("block").agg(
        F.sum("bytes").alias("bytes"),
        (F.sum("odd") % 2).alias("odd"),
        F.sum(F.when(same, F.col("change0")).otherwise(F.col("change1"))).alias("change0"),
        F.sum(F.when(same, F.col("change1")).otherwise(F.col("change0"))).alias("change1"),
    )
    out, offset, state, depth = [], 0, 0, 0
    for row in totals.orderBy("block").collect():  # one row for each block
        out.append((row["block"], offset, state, depth))
        depth += row[f"change{state}"]
        offset += row["bytes"]
        state ^= row["odd"]
    return out


def _placed(spark: SparkSession, path: str, entries: list[tuple[int, int, int, int]], start: int, base: int, head: bytes) -> DataFrame:
    """Pieces from the one that holds ``start`` on: offset, depth, whether one ends a record, or the array closes in it."""
    first = head.rfind(b"}", 0, start) + 1
    skipped = len(head[first:start].decode())
    known = spark.createDataFrame(entries, "block long, entry_offset long, entry_state int, entry_depth int")
    shaped = _shaped(_pieces(spark, path)).join(F.broadcast(known), "block")
    state = (F.col("entry_state") + _before("odd")) % 2
    placed = shaped.withColumn("offset", F.col("entry_offset") + _before("bytes")).withColumn("state", state)
    change = F.when(F.col("state") == 0, F.col("change0")).otherwise(F.col("change1"))
    placed = placed.withColumn("depth", F.col("entry_depth") + _before(change)).withColumn("after", F.col("depth") + change)
    placed = placed.where(F.col("offset") >= first)
    is_first = F.col("offset") == first
    # what stands before the records in the first piece holds no brackets but those counted in the base
    text = F.when(is_first, F.substr("value", F.lit(skipped + 1))).otherwise(F.col("value"))
    cut = placed.withColumn("text", text)
    outside = F.when(is_first, _every_other(_quoted_parts("text"), 0)).when(F.col("state") == 0, F.col("outside0")).otherwise(F.col("outside1"))
    depth = F.when(is_first, F.lit(base)).otherwise(F.col("depth"))
    cut = cut.withColumn("seen", outside).withColumn("depth", depth).withColumn("state", F.when(is_first, 0).otherwise(F.col("state")))
    turn = F.split(F.regexp_replace("seen", r"[^\[\]{]", ""), "")

    def lower(held: Column, char: Column) -> Column:
        now = held["now"] + F.when(char == "]", -1).when(char == "", 0).otherwise(1)
        return F.struct(now.alias("now"), F.least(held["low"], now).alias("low"))

    zero = F.lit(0)
    lowest = F.aggregate(turn, F.struct(zero.alias("now"), zero.alias("low")), lower)["low"]
    closes = F.when(F.col("depth") - _count(F.col("seen"), r"\]") < base, F.col("depth") + lowest < base).otherwise(False)
    odd = F.when(is_first, (F.size(_quoted_parts("text")) - 1) % 2).otherwise(F.col("odd"))
    ends = (F.col("after") == base) & ((F.col("state") + odd) % 2 == 0)
    return cut.select("block", "id", "offset", "depth", "state", "text", ends.alias("ends"), closes.alias("closes"))


def read_compact(spark: SparkSession, path: str, record: T.StructType, head: bytes) -> DataFrame | None:
    """The records of a document, read in pieces; None if no array of records begins in ``head``.

    Raises for what is no JSON array, text after the document included.
    """
    found = array_start(head)
    if found is None:
        return None
    start, base = found
    entries = _entries(spark, path)
    placed = _placed(spark, path, entries, start, base, head)
    slim = placed.select("block", "id", "offset", "depth", "state", "ends", "closes").withColumn("number", _before(F.col("ends").cast("int")))
    closing = F.struct("offset", "depth", "state", "number")
    blocks = slim.groupBy("block").agg(
        F.sum(F.col("ends").cast("int")).alias("records"), F.min(F.when(F.col("closes"), closing)).alias("closing")
    )
    numbers, total, end = [], 0, None
    for row in blocks.orderBy("block").collect():  # one row for each block
        numbers.append((row["block"], total))
        if row["closing"] is not None:
            end = row["closing"]
            last = total + end["number"]
            break
        total += row["records"]
    if end is None:
        raise ValueError(f"MALFORMED JSON document: its array does not end: {path}")
    left, rest = _closing(spark, path, max(end["offset"], start), end["depth"], bool(end["state"]), base)
    try:
        json.loads(head[: start - 1] + b"[]" + rest)
    except ValueError as e:
        raise ValueError(f"MALFORMED JSON document: {path}") from e
    known = spark.createDataFrame(numbers, "block long, records_before long")
    numbered = placed.where(F.col("offset") < end["offset"]).join(F.broadcast(known), "block")
    number = F.col("records_before") + _before(F.col("ends").cast("int"))
    pieces = numbered.select(number.alias("number"), "offset", F.concat("text", F.lit("}")).alias("text"))
    if left.strip(JSON_SPACE):
        pieces = pieces.unionByName(spark.createDataFrame([(last, end["offset"], left)], "number long, offset long, text string"))
    joined = pieces.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("offset", "text"))).alias("pieces"))
    both = joined.select("number", F.array_join("pieces.text", "").alias("text"))
    trimmed = F.ltrim("text", F.lit(JSON_SPACE))
    refused = F.raise_error(F.lit("MALFORMED JSON document: no comma between records"))
    body = F.when(F.col("number") == 0, trimmed).when(trimmed.startswith(","), F.substr(trimmed, F.lit(2))).otherwise(refused)
    records = both.select(
        F.array().cast("array<bigint>").alias("parent_ord"),
        F.col("number").alias("page_offset"),
        F.concat(F.lit("["), body, F.lit("]")).alias("text"),
    )
    return unwrap_json(records, "text", record, keep=["parent_ord", "page_offset"])


def _closing(spark: SparkSession, path: str, offset: int, depth: int, in_string: bool, base: int) -> tuple[str, bytes]:
    """What stands between ``offset`` and the end of the array, and after it."""
    scan = Scan(depth, in_string)
    piece = files.part(spark, path, offset, LAST_PIECE + TAIL)
    for at, byte in enumerate(piece):
        scan.step(byte)
        if scan.depth < base:
            rest = piece[at + 1 :]
            if len(rest) > TAIL:
                raise ValueError(f"more than {TAIL} bytes after the array of records: {path}")
            return piece[:at].decode(), rest
    raise ValueError(f"MALFORMED JSON document: its array does not end: {path}")
