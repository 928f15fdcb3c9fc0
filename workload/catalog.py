"""Queries over the driver tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files, schemas
from tidemark.functions import format_mm_ss, parse_mixed_date, pick_nth_field
from tidemark.operators import (
    attach_parent_key,
    flatten,
    keep_first,
    merge_child_pages,
    merge_pages,
    rename,
    select_columns,
    source_filter,
    unwrap_items,
    unwrap_json,
)
from tidemark.plans import ALBUMS, TRACKS, land, run, silver_albums, silver_tracks
from tidemark.sources import (
    list_files,
    manifest,
    newest,
    read_pages,
    read_raw,
    read_snapshot,
    snapshot_id,
    snapshot_path,
    table_path,
    write_parquet,
    write_raw,
)
from tidemark.sources.compact import HEAD, read_compact
from tidemark.staging import new_folder
from workload import derive
from workload.derive import LIMIT, table

Query = Callable[[SparkSession, str], DataFrame]

OLDER, NEWER = "20240101_000000", "20240102_000000"


def shown(column: str) -> F.Column:
    """A timestamp without zone as text, so that both engines return the same type."""
    return F.col(column).cast("timestamp_ntz").cast("string").alias(column)


def _ordinal(*path: str) -> list[F.Column]:
    """The ordinal columns with ``parent_ord`` spread over one column per level."""
    spread = [F.get("parent_ord", F.lit(i)).alias(name) for i, name in enumerate(path)]
    return [*spread, F.col("page_offset"), F.col("pos")]


# Paging


def merge_pages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merge_pages(derive.album_pages(spark, sf_dir), LIMIT)
    return rows.select(*_ordinal("custkey"), "id", "name", "release_date")


def merge_child_pages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = source_filter(unwrap_items(derive.album_pages(spark, sf_dir)))
    rows = merge_child_pages(parents, derive.track_pages(spark, sf_dir), LIMIT, "album_id")
    return rows.select(
        *_ordinal("custkey", "album_offset", "album_pos"), "id", "name", "album_id"
    )


def attach_parent_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derive.track_pages(spark, sf_dir)
    return attach_parent_key(pages, "album_id").select("album_id", "page_offset", "pos", "id")


def source_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return source_filter(events, "event_type", ("click", "view"))


# Shaping


def unwrap_items_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])
    documents = derive.json_documents(spark, sf_dir)
    return unwrap_json(documents, "document", record, keep=["l_orderkey", "l_linenumber"])


def flatten_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", "k bigint", {"mode": "FAILFAST"}).alias("props"),
        F.struct("user_id", F.struct("event_type", "value").alias("last")).alias("user"),
    )
    names = {
        "props.k": "k",
        "user.user_id": "user_id",
        "user.last.event_type": "event_type",
        "user.last.value": "value",
    }
    return rename(flatten(events), names)


def rename_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {
        "c_custkey": "id",
        "c_name": "nome",
        "c_mktsegment": "segmento do cliente",
        "absent": "ignored",
    }
    customers = rename(table(spark, sf_dir, "customer"), names)
    return select_columns(customers, ["segmento do cliente", "nome", "id"])


# Scalar functions


def pick_nth_field_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("url")))
    documents = table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines"))
    return documents.select(
        "doc_id", *[pick_nth_field("lines", i, "url").alias(f"line_{i}") for i in range(3)]
    )


def parse_mixed_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = derive.mixed_dates(spark, sf_dir)
    parsed = dates.withColumn("released", parse_mixed_date("release_date"))
    return parsed.select("o_orderkey", "release_date", shown("released"))


def format_mm_ss_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ms.alias("ms"))
    return items.withColumn("mm_ss", format_mm_ss("ms"))


# Keep first


def keep_first_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    return keep_first(items, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


def keep_first_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_name", "p_partkey", "p_brand", "p_retailprice")
    return keep_first(parts, ["p_name"], ["p_partkey"])


def keep_first_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five keys over all events."""
    events = table(spark, sf_dir, "events")
    return keep_first(events, ["event_type"], ["ts", "event_id"]).select(
        "event_type", "event_id", "user_id", "value", "props"
    )


# Sources and sinks


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_folder(spark, "row-count")
    counts = [
        (name, write_parquet(table(spark, sf_dir, name), base, name, NEWER))
        for name in ("orders", "lineitem")
    ]
    return spark.createDataFrame(counts, "dataset string, n bigint")


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned snapshots: the newer stamp is read, though the older is written last."""
    base = new_folder(spark, "roundtrip")
    orders = table(spark, sf_dir, "orders")
    write_parquet(orders, base, "orders", snapshot_id())
    write_parquet(orders.withColumn("o_totalprice", F.lit(0.0)), base, "orders", OLDER)
    latest = read_snapshot(spark, table_path(base, "silver", "orders"), "parquet")
    return latest.select("o_orderkey", "o_custkey", "o_totalprice", shown("o_orderdate"))


def raw_snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw snapshots of whole documents, non-ASCII text included."""
    base = new_folder(spark, "roundtrip")
    documents = table(spark, sf_dir, "documents")
    write_raw(documents, base, "documents", OLDER)
    path = table_path(base, "bronze", "documents")
    return read_snapshot(spark, path, "json", documents.schema)


def leftover_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot beside files of attempts that were never published, with the rows its manifest counts."""
    base = new_folder(spark, "attempts")
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    path = table_path(base, "silver", "orders")
    for stamp in (NEWER, "20240103_000000"):
        orders.write.parquet(f"{snapshot_path(path, stamp)}/attempt-broken")
    write_parquet(orders, base, "orders", NEWER)
    return read_snapshot(spark, path, "parquet").withColumn("n", F.lit(manifest(spark, path)["rows"]).cast("bigint"))


def raw_every_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of events with fields that no schema names, landed and read again as VARIANT."""
    pages = derive.event_pages(spark, sf_dir)
    base = new_folder(spark, "every-field")
    write_raw(merge_pages(pages, LIMIT, whole=True, records=True), base, "events", NEWER)
    rows = read_raw(spark, table_path(base, "bronze", "events"))
    fields = {"event_id": "bigint", "props.k": "bigint", "seen.by": "bigint", "seen.as": "string", "value": "double"}
    found = [F.variant_get("record", f"$.{path}", kind).alias(path.split(".")[-1]) for path, kind in fields.items()]
    return rows.select(F.get("parent_ord", F.lit(0)).alias("user_id"), "page_offset", "pos", *found)


def compact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four one-line documents of all events, each cut into records by many tasks."""
    record = T.StructType([T.StructField(n, t) for n, t in (("id", T.LongType()), ("kind", T.StringType()), ("props", T.StringType()))])
    parts = []
    for path in derive.event_documents(spark, sf_dir):
        rows = read_compact(spark, path, record, files.part(spark, path, 0, HEAD))
        parts.append(rows.where("id IS NOT NULL").select("id", "kind", "props"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_folder(spark, "latest")
    events = table(spark, sf_dir, "events").drop("ts")
    write_raw(events, base, "events", NEWER)
    write_raw(events.withColumn("value", F.lit(0.0)), base, "events", OLDER)
    return read_snapshot(spark, table_path(base, "bronze", "events"), "json", events.schema)


def latest_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest entry of a listing with one entry per event, times cut to the hour to make ties."""
    listing = table(spark, sf_dir, "events").select(
        F.concat_ws("/", "event_type", "user_id", "event_id").alias("path"),
        F.date_trunc("hour", "ts").alias("modificationTime"),
    )
    return newest(listing).select("path", shown("modificationTime"))


def list_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files by folder: at two depths, beside Parquet files and a folder whose name goes on."""
    parent = derive.event_files(spark, sf_dir)
    found = F.regexp_extract("path", "/([a-z]+)/day=", 1), F.regexp_extract("path", "/day=([0-9]+)/", 1)
    listing = list_files(spark, f"{parent}/events", "json")
    return listing.groupBy(found[0].alias("folder"), found[1].alias("day")).agg(F.count("*").alias("n_files"))


# Jobs


def silver_albums_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_albums(derive.album_pages(spark, sf_dir)).withColumn(
        "data_lançamento", shown("data_lançamento")
    )


def silver_tracks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_tracks(attach_parent_key(derive.track_pages(spark, sf_dir), "album_id"))


def _landed(spark: SparkSession, sf_dir: str) -> str:
    base = new_folder(spark, "jobs")
    pages = derive.album_pages(spark, sf_dir), derive.track_pages(spark, sf_dir)
    # offsets are keys of the driver tables here, with others between them
    land(*pages, base, NEWER, album_limit=LIMIT, track_limit=LIMIT, whole=False)
    return base


def bronze_albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_path(_landed(spark, sf_dir), "bronze", ALBUMS)
    rows = read_raw(spark, path, schemas.ALBUM)
    return rows.select(
        *_ordinal("custkey"),
        "id",
        "name",
        "total_tracks",
        "release_date",
        "album_group",
        F.coalesce(F.array_size("images"), F.lit(0)).cast("bigint").alias("n_images"),
        F.col("external_urls.spotify").alias("url"),
    )


def bronze_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_path(_landed(spark, sf_dir), "bronze", TRACKS)
    rows = read_raw(spark, path, schemas.TRACK, "album_id")
    return rows.select(
        *_ordinal("custkey", "album_offset", "album_pos"),
        "id",
        "name",
        "track_number",
        "is_playable",
        "duration_ms",
        "explicit",
        F.col("external_urls.spotify").alias("url"),
        "album_id",
    )


def _landed_whole(spark: SparkSession, sf_dir: str) -> str:
    """The job as it is run by default: pages found as JSON Lines, no page missing, every field kept."""
    base = new_folder(spark, "jobs")
    found = [read_pages(spark, path) for path in derive.json_pages(spark, sf_dir)]
    land(*found, base, NEWER, album_limit=LIMIT, track_limit=LIMIT)
    return base


def landed_albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_raw(spark, table_path(_landed_whole(spark, sf_dir), "bronze", ALBUMS))
    kinds = {"id": "string", "name": "string", "release_date": "string", "total_tracks": "bigint", "priority.rank": "bigint"}
    found = [F.variant_get("record", f"$.{path}", kind).alias(path.split(".")[-1]) for path, kind in kinds.items()]
    return rows.select(*_ordinal("custkey"), *found)


def landed_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_path(_landed_whole(spark, sf_dir), "bronze", TRACKS)
    rows = read_raw(spark, path, schemas.TRACK, "album_id")
    return rows.select(*_ordinal("custkey", "album_offset", "album_pos"), "id", "name", "duration_ms", "album_id")


def _cleaned(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base = _landed(spark, sf_dir)
    run(spark, base, NEWER)
    return read_snapshot(spark, table_path(base, "silver", name), "parquet")


def run_albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir, ALBUMS).withColumn("data_lançamento", shown("data_lançamento"))


def run_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir, TRACKS)


QUERIES: dict[str, Query] = {
    "merge_pages": merge_pages_query,
    "merge_child_pages": merge_child_pages_query,
    "attach_parent_key": attach_parent_key_query,
    "source_filter": source_filter_query,
    "unwrap_items": unwrap_items_query,
    "flatten_props": flatten_props,
    "rename_select": rename_select,
    "pick_nth_field": pick_nth_field_query,
    "parse_mixed_date": parse_mixed_date_query,
    "format_mm_ss": format_mm_ss_query,
    "keep_first_id": keep_first_id,
    "keep_first_name": keep_first_name,
    "keep_first_hot_key": keep_first_hot_key,
    "row_count": row_count,
    "snapshot_roundtrip": snapshot_roundtrip,
    "raw_snapshot_roundtrip": raw_snapshot_roundtrip,
    "leftover_attempts": leftover_attempts,
    "raw_every_field": raw_every_field,
    "compact_documents": compact_documents,
    "latest_snapshot": latest_snapshot,
    "latest_listed": latest_listed,
    "list_files": list_files_query,
    "silver_albums": silver_albums_query,
    "silver_tracks": silver_tracks_query,
    "bronze_albums": bronze_albums,
    "bronze_tracks": bronze_tracks,
    "landed_albums": landed_albums,
    "landed_tracks": landed_tracks,
    "run_albums": run_albums,
    "run_tracks": run_tracks,
}
