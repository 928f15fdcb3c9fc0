"""The jobs: land raw snapshots, clean them, run both datasets end to end."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemark import files, schemas
from tidemark.functions import format_mm_ss, parse_mixed_date, pick_nth_field
from tidemark.operators import (
    flatten,
    item_fields,
    keep_first,
    merge_child_pages,
    merge_pages,
    rename,
    record_field,
    require_values,
    select_columns,
    source_filter,
    unwrap_items,
)
from tidemark.operators.paging import ALBUM_GROUPS, ALBUM_PAGE_LIMIT, TRACK_PAGE_LIMIT, page_cut
from tidemark.sources import (
    has_runs,
    latest_file,
    manifest,
    read_json_file,
    read_raw,
    table_path,
    write_parquet,
    write_raw,
)
from tidemark.plans.datasets import side_by_side
from tidemark.sources.snapshots import BRONZE
from tidemark.staging import job_folder, staged

ALBUMS, TRACKS = "albums", "tracks"

#: Records of a dataset, and the parent's key beside them.
RECORDS = {ALBUMS: (schemas.ALBUM, None), TRACKS: (schemas.TRACK, "album_id")}

# Source field -> column of the cleaned table, and the columns
# of the cleaned tables in order.
ALBUM_NAMES = {
    "id": "id_album",
    "total_tracks": "qtd_faixas",
    "name": "nome_album",
    "release_date": "data_lançamento",
    "images": "capa_album",
    "external_urls.spotify": "urls_externos",
}
ALBUM_COVERS = ["capa_album_640", "capa_album_300", "capa_album_64"]
ALBUM_COLUMNS = ["id_album", "qtd_faixas", "nome_album", "data_lançamento", *ALBUM_COVERS]

TRACK_NAMES = {
    "id": "id_musica",
    "name": "nome_musica",
    "track_number": "numero_no_album",
    "is_playable": "Reproduzivel",
    "duration_ms": "duracao_ms",
    "explicit": "conteudo_explicito",
    "external_urls.spotify": "url_da_musica",
    "album_id": "id_album",
}
TRACK_COLUMNS = [
    "id_musica",
    "nome_musica",
    "duracao_min_seg",
    "numero_no_album",
    "Reproduzivel",
    "conteudo_explicito",
    "duracao_ms",
    "url_da_musica",
    "id_album",
]


def silver_albums(raw: DataFrame, extra_formats: Sequence[str] = ()) -> DataFrame:
    """Clean album records: one row per album id, the first to arrive.

    ``raw`` holds album records with the ordinal columns, or pages of them
    under ``items``. ``extra_formats`` are further date formats.
    """
    albums = rename(flatten(unwrap_items(raw)), ALBUM_NAMES)
    covers = {
        name: pick_nth_field("capa_album", i, "url") for i, name in enumerate(ALBUM_COVERS)
    }
    albums = select_columns(
        albums.withColumns(covers), [*ALBUM_COLUMNS, *schemas.ORDINAL_COLUMNS]
    )
    albums = keep_first(albums, ["id_album"], [*schemas.ORDINAL_COLUMNS, "nome_album"])
    albums = albums.withColumn("data_lançamento", parse_mixed_date("data_lançamento", extra_formats))
    return select_columns(albums, ALBUM_COLUMNS)


def silver_tracks(raw: DataFrame) -> DataFrame:
    """Clean track records: one row per track **name** over all albums, the first to arrive.

    ``raw`` holds track records with the ordinal columns, or pages of them
    under ``items``.
    """
    tracks = rename(flatten(unwrap_items(raw)), TRACK_NAMES)
    tracks = keep_first(tracks, ["nome_musica"], [*schemas.ORDINAL_COLUMNS, "id_musica"])
    tracks = tracks.withColumn("duracao_min_seg", format_mm_ss("duracao_ms"))
    return select_columns(tracks, TRACK_COLUMNS)


def land(
    album_pages: DataFrame,
    track_pages: DataFrame,
    base: str,
    snapshot_ts: str,
    album_limit: int = ALBUM_PAGE_LIMIT,
    track_limit: int = TRACK_PAGE_LIMIT,
    album_groups: Iterable[str] | None = ALBUM_GROUPS,
    whole: bool = True,
    sized: bool = False,
    packed: bool = True,
) -> dict[str, int]:
    """Merge the pages of both datasets and land them raw, every field of a record; returns rows per dataset.

    Only albums of ``album_groups`` are landed, and one without a group raises;
    None lands them all, for pages that were asked for by group. ``whole`` makes
    sure that no page of any parent is missing before its stop; without it, offsets need
    not advance by the limit.

    Tracks are read out for those albums, each with its album's key and in
    its album's arrival order. Both datasets are written side by side: one that
    fails leaves the other complete, and raises in the end. ``sized`` writes files of an advised size,
    ``packed`` gzip files (``write_raw``).
    """
    spark = album_pages.sparkSession
    with job_folder(spark):
        wanted = tuple(album_groups) if album_groups is not None else None
        # Sizes of pages, and what the tracks need of an album, are of one small table: the items are read for it once.
        columns = [c for c in ("parent_id", "parent_ord", "offset", "items") if c in album_pages.columns]
        narrow = staged(item_fields(album_pages.select(columns), ["id"] if wanted is None else ["id", "album_group"]), packed=True)
        cut = page_cut(narrow, album_limit, whole)

        def merged_albums(pages: DataFrame) -> DataFrame:
            merged = merge_pages(pages, album_limit, records=True, cut=cut)
            return merged if wanted is None else source_filter(merged, "album_group", wanted, required=True, within="record")

        albums = merged_albums(album_pages)
        keys = merged_albums(narrow)
        parents = staged(keys.select(*schemas.ORDINAL_COLUMNS, record_field(keys, "id").alias("id")), packed=True)

        def tracks() -> int:
            merged = merge_child_pages(parents, track_pages, track_limit, "album_id", whole, records=True)
            return write_raw(merged, base, TRACKS, snapshot_ts, sized, packed)

        return side_by_side(spark, {ALBUMS: lambda: write_raw(albums, base, ALBUMS, snapshot_ts, sized, packed), TRACKS: tracks})


def read_bronze(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The latest raw records of a dataset.

    The newest complete snapshot. Only where no run of ours ever wrote, the newest
    whole-document JSON file under the dataset's folder.
    """
    record, key = RECORDS[name]
    table = table_path(base, BRONZE, name)
    if has_runs(spark, table):
        return read_raw(spark, table, record, key)
    return read_json_file(spark, latest_file(spark, table), record)


def bronze_bytes(spark: SparkSession, base: str) -> int:
    """Size of the raw records that ``run`` reads."""
    total = 0
    for name in (ALBUMS, TRACKS):
        table = table_path(base, BRONZE, name)
        if has_runs(spark, table):
            total += manifest(spark, table)["bytes"]
        else:
            total += files.status(spark, latest_file(spark, table))[1]
    return total


#: JSON bytes in a byte of gzip, of records with the fields of ours (measured: 9 to 11).
GZIP_RATIO = 10


def bronze_text_bytes(spark: SparkSession, base: str) -> int:
    """About the size of the raw records that ``run`` reads, unpacked: what to choose settings by."""
    total = bronze_bytes(spark, base)
    for name in (ALBUMS, TRACKS):
        table = table_path(base, BRONZE, name)
        if has_runs(spark, table):
            total += sum((GZIP_RATIO - 1) * size for path, size in manifest(spark, table)["files"] if path.endswith(".gz"))
    return total


def _selected(names: Mapping[str, str], columns: Iterable[str]) -> list[str]:
    """The source fields that end up in a cleaned table."""
    return [field for field, name in names.items() if any(c.startswith(name) for c in columns)]


def run(
    spark: SparkSession,
    base: str,
    snapshot_ts: str,
    strict: bool = False,
    extra_formats: Sequence[str] = (),
    sized: bool = False,
) -> dict[str, int]:
    """Clean the latest raw snapshot of both datasets, side by side; returns rows per cleaned table.

    One that fails leaves the other complete, and raises in the end. ``strict`` first makes sure every field that ends up in a cleaned table has
    a value in at least one record. ``extra_formats`` are further date formats, ``sized`` as in ``land``.
    """
    wanted = {ALBUMS: _selected(ALBUM_NAMES, ALBUM_COLUMNS), TRACKS: _selected(TRACK_NAMES, TRACK_COLUMNS)}
    cleaned = {ALBUMS: lambda raw: silver_albums(raw, extra_formats), TRACKS: silver_tracks}

    def clean(name: str) -> int:
        raw = read_bronze(spark, base, name)
        if strict:
            require_values(flatten(raw), wanted[name])
        return write_parquet(cleaned[name](raw), base, name, snapshot_ts, sized)

    return side_by_side(spark, {name: partial(clean, name) for name in (ALBUMS, TRACKS)})
