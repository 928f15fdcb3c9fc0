"""Pages and records made from the driver tables, row by row.

``orders`` are pages of albums of their customer, ``lineitem`` rows are pages
of tracks of their order. A page holds up to ``LIMIT`` items; some are short or
empty. Album ``collection-<customer>`` recurs on all pages of a customer and has
a page of tracks of its own. About a third of all tracks share one name. The
``album_id`` of an item on a page is wrong: only the page knows its parent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import files
from tidemark.sources.snapshots import GZIP
from tidemark.staging import new_folder

LIMIT = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables up to this size are dealt over the cores; larger ones have row groups for many tasks.
FEW_BYTES = 16 << 20


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table dealt over the cores if it is small; then it is one row group, hence one task to scan."""
    rows = table(spark, sf_dir, name)
    if files.total_size(spark, f"{files.literal(sf_dir)}/{name}.parquet") > FEW_BYTES:
        return rows
    return rows.repartition(spark.sparkContext.defaultParallelism)


RELEASE_DATE = """
    CASE WHEN o_orderstatus = 'F' THEN date_format(o_orderdate, 'yyyy')
         WHEN o_orderstatus = 'O' THEN date_format(o_orderdate, 'yyyy-MM')
         WHEN o_orderpriority = '1-URGENT' THEN 'n/a'
         ELSE date_format(o_orderdate, 'yyyy-MM-dd') END"""


def _album_items(more: str = "") -> str:
    """The items of a page of albums; ``more`` are further fields, last in each."""
    return f"""
    slice(array(
        named_struct(
            'id', cast(o_orderkey AS string),
            'name', concat('Album ', o_orderkey),
            'total_tracks', cast(floor(o_totalprice / 10000) AS bigint),
            'release_date', {RELEASE_DATE},
            'album_group', CASE o_orderpriority WHEN '2-HIGH' THEN 'single'
                WHEN '4-NOT SPECIFIED' THEN 'compilation' WHEN '5-LOW' THEN 'appears_on'
                ELSE 'album' END,
            'images', slice(transform(array(640L, 300L, 64L), side -> named_struct(
                'url', concat('cover-', o_orderkey, '-', side), 'height', side, 'width', side)),
                1, cast(o_custkey % 4 AS int)),
            'external_urls', named_struct('spotify', concat('album/', o_orderkey)){more}),
        named_struct(
            'id', concat('collection-', o_custkey),
            'name', concat('Collection ', o_orderkey),
            'total_tracks', 1L,
            'release_date', date_format(o_orderdate, 'yyyy'),
            'album_group', 'single',
            'images', cast(NULL AS array<struct<url:string,height:bigint,width:bigint>>),
            'external_urls', named_struct('spotify', concat('collection/', o_orderkey)){more})),
        1, CASE WHEN dayofmonth(o_orderdate) = 31 THEN 0
                WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 1 ELSE {LIMIT} END)"""


ALBUM_ITEMS = _album_items()

TRACK_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

TRACK_ITEMS = f"""
    slice(array(
        named_struct(
            'id', {TRACK_ID},
            'name', CASE WHEN l_returnflag = 'R' THEN 'Intro'
                WHEN l_quantity <> 7 THEN concat('Track ', l_partkey) END,
            'track_number', cast(l_linenumber AS bigint),
            'is_playable', l_linestatus = 'O',
            'duration_ms', cast(round(l_extendedprice * 100) AS bigint),
            'explicit', l_discount > 0.05D,
            'external_urls', named_struct('spotify', concat('track/', l_partkey)),
            'album_id', concat('not ', l_orderkey)),
        named_struct(
            'id', concat({TRACK_ID}, '-b'),
            'name', concat('Interlude ', l_suppkey),
            'track_number', cast(l_linenumber AS bigint),
            'is_playable', l_linestatus = 'F',
            'duration_ms', cast(l_quantity * 1000 AS bigint),
            'explicit', false,
            'external_urls', named_struct('spotify', concat('interlude/', l_suppkey)),
            'album_id', concat('not ', l_orderkey))),
        1, CASE WHEN l_quantity = 50 THEN 0 WHEN l_quantity <= 5 THEN 1 ELSE {LIMIT} END)"""


# One track of each collection, an album that recurs.
COLLECTION_ITEMS = """
    array(named_struct(
        'id', concat('collected-', c_custkey),
        'name', concat('Collected ', c_custkey),
        'track_number', 1L,
        'is_playable', true,
        'duration_ms', cast(round(abs(c_acctbal) * 100) AS bigint),
        'explicit', false,
        'external_urls', named_struct('spotify', concat('collected/', c_custkey)),
        'album_id', concat('not ', c_custkey)))"""


def album_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey AS string) AS parent_id",
        "o_custkey AS parent_ord",
        "o_orderkey AS offset",
        f"{ALBUM_ITEMS} AS items",
    )


def track_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey AS string) AS parent_id",
        "l_orderkey AS parent_ord",
        "cast(l_linenumber AS bigint) AS offset",
        f"{TRACK_ITEMS} AS items",
    )
    collected = table(spark, sf_dir, "customer").selectExpr(
        "concat('collection-', c_custkey) AS parent_id",
        "c_custkey AS parent_ord",
        "0L AS offset",
        f"{COLLECTION_ITEMS} AS items",
    )
    return pages.union(collected)


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON document per line item: an array, a wrapped array, or one record."""
    first = "named_struct('id', cast(l_partkey AS string), 'n', cast(l_quantity AS bigint))"
    second = "named_struct('id', concat('s', l_suppkey), 'n', cast(l_linenumber AS bigint))"
    return spread(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"""CASE l_returnflag
              WHEN 'A' THEN to_json(array({first}, {second}))
              WHEN 'N' THEN to_json(named_struct('limit', 50, 'items', array({first}, {second})))
              ELSE to_json({first}) END AS document""",
    )


def mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{RELEASE_DATE} AS release_date")


def _numbered(rows: DataFrame, parent: str, *order: str) -> DataFrame:
    """Rows with the ``offset`` a paging loop gives their page: 0, ``LIMIT``, and so on for each parent."""
    place = F.row_number().over(Window.partitionBy(parent).orderBy(*order)) - 1
    return rows.withColumn("offset", (place * LIMIT).cast("bigint"))


_found: dict[tuple[str, str, str], str] = {}


def _written(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The folder that ``write`` filled, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _found:
        path = new_folder(spark, name)
        write(path)
        _found[key] = path
    return _found[key]


def json_pages(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Folders of album and track pages as JSON Lines, with true offsets and a field of albums that no schema names."""
    # The rows are numbered, then made into pages: only columns of the table move.
    priority = ", 'priority', named_struct('rank', cast(substr(o_orderpriority, 1, 1) AS bigint))"
    albums = _numbered(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey").selectExpr(
        "cast(o_custkey AS string) AS parent_id", "o_custkey AS parent_ord", "offset", f"{_album_items(priority)} AS items"
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    tracks = _numbered(table(spark, sf_dir, "lineitem"), "l_orderkey", *order).selectExpr(
        "cast(l_orderkey AS string) AS parent_id", "l_orderkey AS parent_ord", "offset", f"{TRACK_ITEMS} AS items"
    )
    collected = table(spark, sf_dir, "customer").selectExpr(
        "concat('collection-', c_custkey) AS parent_id", "c_custkey AS parent_ord", f"{COLLECTION_ITEMS} AS items", "0L AS offset"
    )
    tracks = tracks.unionByName(collected)
    return (
        _written(spark, sf_dir, "album-json", lambda path: albums.write.options(**GZIP).json(path)),
        _written(spark, sf_dir, "track-json", lambda path: tracks.write.options(**GZIP).json(path)),
    )


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of one event, two to a page, of their user; an event keeps its props, and fields of its own."""
    events = spread(spark, sf_dir, "events")
    item = F.struct(
        "event_id", "value", F.parse_json("props").alias("props"), F.struct(F.col("user_id").alias("by"), F.col("event_type").alias("as")).alias("seen")
    )
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    placed = events.select("user_id", place.alias("place"), F.to_variant_object(item).alias("item"))
    by = F.floor(F.col("place") / LIMIT) * LIMIT
    listed = placed.groupBy("user_id", by.cast("bigint").alias("offset")).agg(F.collect_list(F.struct("place", F.to_json("item").alias("item"))).alias("found"))
    items = F.transform(F.sort_array("found"), lambda x: F.parse_json(x["item"]))
    return listed.select(F.col("user_id").cast("string").alias("parent_id"), F.col("user_id").alias("parent_ord"), "offset", items.alias("items"))


#: Files a task may have open when it writes by day; with 0, Spark's default, all rows of a task are sorted first.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _many_open_files(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, "64")
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)


def event_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the events in files by day, month and year, in folders of several depths and two formats.

    A day is one file, hence one task; its rows stream into the file, none are sorted.
    """
    events = table(spark, sf_dir, "events")

    def write(path: str) -> None:
        for unit, fmt, folder in (("yyyyMMdd", "json", "events/a/deep"), ("yyyyMM", "json", "events/flat"), ("yyyy", "parquet", "events/other"), ("yyyy", "json", "events-old")):
            dated = events.withColumn("day", F.date_format("ts", unit)).repartition(16, "day")
            with _many_open_files(spark):
                dated.write.partitionBy("day").format(fmt).save(f"{path}/{folder}")

    return _written(spark, sf_dir, "listing", write)


def event_documents(spark: SparkSession, sf_dir: str, n: int = 4) -> list[str]:
    """``n`` files, each one line with an array of a null and a share of the events, written row by row."""
    item = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.col("props")))
    part = (F.col("event_id") % n).cast("int")
    events = table(spark, sf_dir, "events").select(part.alias("part"), F.lit(1).alias("place"), F.concat(F.lit(","), item).alias("value"))
    ends = spark.range(n).select(F.col("id").cast("int").alias("part"), F.explode(F.array(F.struct(F.lit(0).alias("place"), F.lit("[null").alias("value")), F.struct(F.lit(2).alias("place"), F.lit("]").alias("value")))).alias("end"))
    rows = events.unionByName(ends.select("part", "end.*")).repartition(n, "part").sortWithinPartitions("part", "place")

    def write(path: str) -> None:
        rows.drop("place").write.partitionBy("part").option("lineSep", " ").text(path)

    folder = _written(spark, sf_dir, "event-documents", write)
    return sorted(name for name, _, _ in files.walk(spark, folder))
