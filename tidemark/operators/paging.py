"""Merge the pages of an entity into rows, keeping parent keys and arrival order.

A source is read page by page until a page is empty or short, so a page counts
only if no earlier page of its parent is short. Written as a window over a
parent's pages, that rule sends every body of a parent to one task. Here the
page sizes decide first, and the bodies move only if they must:

1. One pass over page sizes makes a state for each parent and run of ``RUN_PAGES``
   pages: first and last offset, first short page, and if wholeness is asked for the pages
   that are there. States merge, so map tasks send one row for each run, and a parent with a
   third of all pages is spread over its runs. Only keys, offsets and
   sizes are read (column pruning reaches into ``items``). The states are staged as a table; a parent's stop, and
   whether all pages up to it are there, are aggregates of that table.
2. The outcome is staged as a table when the frame is built, so Catalyst knows its size: it is broadcast if it is under
   ``spark.sql.autoBroadcastJoinThreshold``, and bodies are not shuffled at all;
   otherwise the join is by (parent, run), which splits a hot parent. Before that join a bitmap of the wanted
   parents (at most ``MOST_BLOCKS`` blocks of 4 KB) holds back most bodies that no parent wants.

So pages are read twice: their sizes once, their bodies once. Of VARIANT items no leaf can be read by itself: both
readings would parse all of them. Child pages with such items are read once, into a staged table of every page's size
and the items of the pages that the bitmap lets pass (``sized_pages``); both steps are of that table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.shaping import explode_items, quoted, record_field
from tidemark.schemas import ORDINAL_COLUMNS
from tidemark.staging import staged

RUN_PAGES = 4096

# Bits in a block and most blocks: 16 MB. Up to ``FEW_WANTED`` parents are not worth a bitmap.
BLOCK_BITS, MOST_BLOCKS, FEW_WANTED = 32768, 4096, 100_000

# So many runs past their parents' first are few: what is known of their parents is broadcast.
FEW_RUNS = 50_000

# Page sizes of the two requests, and the album groups asked for.
ALBUM_PAGE_LIMIT = 10
TRACK_PAGE_LIMIT = 50
ALBUM_GROUPS = ("album", "single")


def source_filter(
    records: DataFrame,
    column: str = "album_group",
    values: Iterable[str] = ALBUM_GROUPS,
    required: bool = False,
    within: str | None = None,
) -> DataFrame:
    """Keep the records whose ``column`` (or that field of the column ``within``) is one of ``values``; if ``required``, a NULL there raises."""
    value = F.col(quoted(column)) if within is None else record_field(records, column, within)
    values = tuple(values)
    refused = F.raise_error(F.lit(f"record without {column}"))
    if required and values:
        # The value stands here once: a filter reads a field of a VARIANT as often as it stands in it.
        return records.where(F.coalesce(value, refused).isin(*values))
    kept = value.isin(*values)
    return records.where(F.when(value.isNull(), refused).otherwise(kept) if required else kept)


def _page_size(pages: DataFrame, items: str) -> Column:
    """Number of items; reads one leaf of the items where there is a leaf to read."""
    array = F.col(quoted(items))
    element = pages.schema[items].dataType.elementType
    if isinstance(element, T.StructType):
        flat = [f.name for f in element if not isinstance(f.dataType, (T.StructType, T.ArrayType))]
        if flat:
            array = array.getField(flat[0])
    return F.coalesce(F.array_size(array), F.lit(0))


def _run(limit: int) -> Column:
    return F.expr(f"CAST(offset AS BIGINT) DIV {limit * RUN_PAGES}")


def page_states(pages: DataFrame, limit: int, whole: bool = False, size: str | None = None) -> DataFrame:
    """Per parent and run of pages: ``parent_id, run, first_offset, last_offset, short_offset``; ``size`` is a column that holds page sizes.

    Offsets advance by ``limit``, so a run is ``RUN_PAGES`` pages; ``short_offset`` is that of its
    first short page. With ``whole`` also ``n``, how many of the run's pages up to its first short one (or its last) are there, copies
    counted once, and ``between``, whether an offset is no multiple of ``limit``.
    """
    offset = F.col("offset")
    n_items = F.col(size) if size else _page_size(pages, "items")
    sizes = pages.select("parent_id", offset.cast("bigint").alias("offset"), n_items.alias("size"))
    state = {
        "first_offset": F.min(offset),
        "last_offset": F.max(offset),
        "short_offset": F.min(F.when(F.col("size") < limit, offset)),
    }
    if whole:
        state |= {"held": F.collect_set(offset), "between": F.max(offset % limit != 0)}
    runs = sizes.groupBy("parent_id", _run(limit).alias("run")).agg(*[v.alias(k) for k, v in state.items()])
    if not whole:
        return runs
    upto = F.coalesce("short_offset", "last_offset")
    return runs.withColumn("n", F.size(F.filter("held", lambda page: page <= upto)).cast("bigint")).drop("held")


def with_stop(states: DataFrame) -> DataFrame:
    """``states`` with ``stop_offset``, that of the parent's first short page; NULL if none of its pages is short."""
    stops = states.groupBy("parent_id").agg(F.min("short_offset").alias("stop_offset"))
    stops = stops.where("stop_offset IS NOT NULL").withColumnRenamed("parent_id", "stopped_id")
    return states.join(stops, F.col("parent_id").eqNullSafe(F.col("stopped_id")), "left").drop("stopped_id")


def check_whole(stopped: DataFrame, limit: int) -> None:
    """Raise if a parent lacks a page before its first short page (or its last), or has offsets between pages.

    ``stopped`` is ``with_stop`` of states that count pages. Pages past the stop may be missing. A parent's only run
    (where ``alone`` says so) is judged by itself; of these only what lacks a page is summed with the others.
    """
    upto = F.coalesce("short_offset", "last_offset")
    lacks = (F.col("n") * limit <= F.col("upto")) | F.col("between")
    needed = stopped.where(F.col("stop_offset").isNull() | (F.col("first_offset") <= F.col("stop_offset"))).withColumn("upto", upto)
    if "alone" in stopped.columns:
        needed = needed.where(~F.col("alone") | lacks)
    summed = needed.groupBy("parent_id").agg(F.max("upto").alias("upto"), F.sum("n").alias("n"), F.max("between").alias("between"))
    lacking = summed.where(lacks).select("parent_id").first()
    if lacking is not None:
        raise ValueError(f"a page of parent {lacking['parent_id']} is missing, or not at a multiple of {limit}")


def _with_few_stops(states: DataFrame) -> DataFrame:
    """``with_stop`` where few parents have a run but the first: their stops are broadcast, any other's is in its only row, ``alone``."""
    later = states.where("NOT run <=> 0").select(F.col("parent_id").alias("later_id")).distinct()
    stops = (
        states.join(F.broadcast(later), F.col("parent_id").eqNullSafe(F.col("later_id")))
        .groupBy(F.col("parent_id").alias("stopped_id"))
        .agg(F.min("short_offset").alias("later_stop"), F.lit(False).alias("is_alone"))
    )
    joined = states.join(F.broadcast(stops), F.col("parent_id").eqNullSafe(F.col("stopped_id")), "left")
    alone = F.coalesce("is_alone", F.lit(True))
    stop = F.when(alone, F.col("short_offset")).otherwise(F.col("later_stop"))
    return joined.select(*states.columns, stop.alias("stop_offset"), alone.alias("alone"))


def _stopped(pages: DataFrame, limit: int, whole: bool, size: str | None = None) -> DataFrame:
    """The one pass over page sizes, staged, and its stops; raises if ``whole`` and a page is missing."""
    states = staged(page_states(pages, limit, whole, size))
    few = states.where("NOT run <=> 0").count() <= FEW_RUNS
    stopped = _with_few_stops(states) if few else with_stop(states)
    if whole:
        check_whole(stopped, limit)
    return stopped


def _looked_up(pages: DataFrame, wanted: DataFrame, n: int) -> tuple[DataFrame, Column]:
    """``pages`` joined to a bitmap of the parents of ``wanted``, which has ``n`` rows, and whether a page's parent is in it.

    One bit for each parent, eight bits a parent as long as the blocks last; past these it holds back less. A block is an array of words.
    """
    blocks = max(1, min(MOST_BLOCKS, -(-8 * n // BLOCK_BITS)))
    bit = F.pmod(F.xxhash64("parent_id"), F.lit(blocks * BLOCK_BITS))
    set_bits = wanted.select(bit.alias("bit")).selectExpr("bit DIV 64 AS word", "shiftleft(1L, CAST(bit % 64 AS INT)) AS bits")
    no_bits = wanted.sparkSession.range(blocks * BLOCK_BITS // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = set_bits.union(no_bits).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"]
    bits = words.groupBy(F.expr(f"word * 64 DIV {BLOCK_BITS}").alias("block")).agg(in_order.alias("bits"))
    placed = pages.select("*", bit.alias("bit")).withColumn("block", F.expr(f"bit DIV {BLOCK_BITS}"))
    is_set = F.expr(f"getbit(get(bits, CAST(bit % {BLOCK_BITS} DIV 64 AS INT)), CAST(bit % 64 AS INT)) = 1")
    return placed.join(F.broadcast(bits), "block"), is_set


def held_back(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """``pages`` without most of those whose ``parent_id`` is not in ``wanted``; all others stay."""
    n = wanted.count()
    if n <= FEW_WANTED:
        return pages
    joined, is_set = _looked_up(pages, wanted, n)
    return joined.where(is_set).select(*[F.col(quoted(c)) for c in pages.columns])


def sized_pages(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """``pages`` read once, staged: ``parent_id, offset, n_items`` of each, and ``items``, NULL for most that no ``parent_id`` of ``wanted`` has."""
    sized = pages.select("parent_id", "offset", _page_size(pages, "items").alias("n_items"), "items")
    joined, is_set = _looked_up(sized, wanted, wanted.count())
    return staged(joined.select("parent_id", "offset", "n_items", F.when(is_set, F.col("items")).alias("items")), packed=True)


def require_whole(pages: DataFrame, limit: int) -> None:
    """Raise if a page is missing before its parent's stop; ``merge_pages(..., whole=True)`` does so in its own pass."""
    _stopped(_of_one_source(pages), limit, True)


def attach_parent_key(pages: DataFrame, attach_as: str | None = None) -> DataFrame:
    """One row per item with its arrival order, and the parent's key as ``attach_as``.

    ``pages`` has ``parent_id, parent_ord, offset, items``. A parent without
    items gives no rows. An item field named ``attach_as`` is overwritten.
    """
    fields = [f for f in pages.schema["items"].dataType.elementType.names if f != attach_as]
    key = [F.col("parent_id").alias(attach_as)] if attach_as else []
    return explode_items(pages, F.col("parent_id")).select(
        *ORDINAL_COLUMNS, *[F.col("item").getField(f).alias(f) for f in fields], *key
    )


def attach_whole(pages: DataFrame, attach_as: str | None = None) -> DataFrame:
    """``attach_parent_key`` with items as they are, in one column ``record``: a struct or a VARIANT with all fields."""
    key = [F.col("parent_id").alias(attach_as)] if attach_as else []
    return explode_items(pages, F.col("parent_id")).select(*ORDINAL_COLUMNS, *key, F.col("item").alias("record"))


def _of_one_source(pages: DataFrame) -> DataFrame:
    """Pages that name no parent are those of one source."""
    defaults = {"parent_id": F.lit(None).cast("string"), "parent_ord": F.lit(0).cast("bigint")}
    return pages.withColumns({c: v for c, v in defaults.items() if c not in pages.columns})


def page_cut(pages: DataFrame, limit: int, whole: bool = False) -> DataFrame:
    """Runs with pages past their parent's stop, staged: none, for a source that was read to its end and no further."""
    return staged(
        _stopped(_of_one_source(pages), limit, whole)
        .where(F.col("last_offset") > F.col("stop_offset"))
        .select(F.col("parent_id").alias("cut_id"), F.col("run").alias("cut_run"), "stop_offset")
    )


def merge_pages(
    pages: DataFrame,
    limit: int,
    attach_as: str | None = None,
    whole: bool = False,
    records: bool = False,
    cut: DataFrame | None = None,
) -> DataFrame:
    """The items of every parent's pages, up to its first empty or short page.

    ``pages`` has ``offset`` and ``items``, and unless it is of one source
    ``parent_id`` and ``parent_ord``, the parent's place among the sources.
    ``whole`` raises if a page before that is missing; ``records`` gives items as ``attach_whole`` does.
    ``cut`` is the ``page_cut`` of these pages, if it is at hand.
    """
    if cut is None:
        cut = page_cut(pages, limit, whole)
    pages = _of_one_source(pages)
    same_run = F.col("parent_id").eqNullSafe(F.col("cut_id")) & (_run(limit) == F.col("cut_run"))
    kept = (
        pages.join(cut, same_run, "left")
        .where(F.col("stop_offset").isNull() | (F.col("offset") <= F.col("stop_offset")))
        .withColumn("parent_ord", F.array(F.col("parent_ord").cast("bigint")))
    )
    return (attach_whole if records else attach_parent_key)(kept, attach_as)


def merge_child_pages(
    parents: DataFrame,
    pages: DataFrame,
    limit: int,
    attach_as: str | None = None,
    whole: bool = False,
    records: bool = False,
) -> DataFrame:
    """``merge_pages`` for every parent record: each parent expanded into its children.

    ``parents`` has ``id`` and the ordinal columns; ``pages`` has ``parent_id``,
    ``offset`` and ``items``. A parent listed more than once is expanded at each
    of its places; pages of parents not listed are not read out.
    """
    listed = parents.select(
        F.col("id").alias("parent_id"),
        F.concat("parent_ord", F.array("page_offset", "pos")).alias("parent_ord"),
    )
    size = None
    if isinstance(pages.schema["items"].dataType.elementType, T.VariantType):
        pages, size = sized_pages(pages, listed.select("parent_id")), "n_items"
    wanted = staged(
        _stopped(pages, limit, whole, size)
        .where(F.col("stop_offset").isNull() | (F.col("first_offset") <= F.col("stop_offset")))
        .join(listed, "parent_id")
        .select("parent_id", "run", "stop_offset", "parent_ord")
    )
    bodies = pages.select("parent_id", "offset", "items", _run(limit).alias("run"))
    kept = (
        (bodies if size else held_back(bodies, wanted))
        .join(wanted, ["parent_id", "run"])
        .where(F.col("stop_offset").isNull() | (F.col("offset") <= F.col("stop_offset")))
    )
    return (attach_whole if records else attach_parent_key)(kept, attach_as)
