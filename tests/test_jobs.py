import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import item_fields
from tidemark.plans import bronze_bytes, bronze_text_bytes, land, run, silver_albums, silver_tracks
from tidemark.plans.datasets import side_by_side
from tidemark.plans.jobs import ALBUM_COLUMNS, TRACK_COLUMNS
from tidemark.session import PARALLELISM_FIRST, SHUFFLE_PARTITIONS, settings_for
from tidemark.sources import NoSnapshotError, manifest, read_pages, read_raw, read_snapshot, table_path, write_raw


def album(i, name="n", group="album", date="1998-05-12", images=3):
    return {
        "id": i,
        "name": name,
        "total_tracks": 10,
        "release_date": date,
        "album_group": group,
        "images": [{"url": f"{i}-{k}", "height": 1, "width": 1} for k in range(images)],
        "external_urls": {"spotify": f"u-{i}"},
    }


def track(i, name, ms=61000):
    return {
        "id": i,
        "name": name,
        "track_number": 1,
        "is_playable": True,
        "duration_ms": ms,
        "explicit": False,
        "external_urls": {"spotify": f"u-{i}"},
    }


def pages(spark, record, bodies, limit):
    rows = [
        {"parent_id": p, "parent_ord": 0, "offset": o, "limit": limit, "total": None, "items": items}
        for p, o, items in bodies
    ]
    return spark.createDataFrame(rows, schemas.page(record))


def bodies(tag):
    albums = [
        ("artist", 0, [album("a1", f"A1 {tag}"), album("a2", group="compilation")]),
        ("artist", 2, [album("a3", date="1999", images=1), album("a1", "again")]),
        ("artist", 4, [album("a4", group="single", date="0000", images=0)]),
        ("artist", 6, [album("a5")]),
    ]
    tracks = [
        ("a4", 0, [track("t6", "one"), track("t7", "six", None)]),
        ("a4", 2, []),
        ("a3", 0, [track("t4", "two", 3661000)]),
        ("a3", 2, [track("t5", "late")]),
        ("a1", 0, [track("t1", "one"), track("t2", "two")]),
        ("a1", 2, [track("t3", "three")]),
        ("a2", 0, [track("tx", "other")]),
    ]
    return albums, tracks


def land_bodies(spark, base, ts, tag="x"):
    albums, tracks = bodies(tag)
    return land(
        pages(spark, schemas.ALBUM, albums, 2), pages(spark, schemas.TRACK, tracks, 2), base, ts, 2, 2
    )


def read(spark, base, name):
    return read_snapshot(spark, table_path(base, "silver", name), "parquet")


def test_land_and_run_twice(spark, base):
    assert land_bodies(spark, base, "20240101_000000", "old") == {"albums": 4, "tracks": 9}
    assert run(spark, base, "20240101_000100", strict=True) == {"albums": 3, "tracks": 4}
    land_bodies(spark, base, "20240102_000000", "new")
    assert run(spark, base, "20240102_000100") == {"albums": 3, "tracks": 4}

    albums = read(spark, base, "albums")
    assert albums.columns == ALBUM_COLUMNS
    assert dict(albums.dtypes)["data_lançamento"] == "timestamp_ntz"
    assert sorted(map(tuple, albums.collect())) == [
        ("a1", 10, "A1 new", datetime(1998, 5, 12), "a1-0", "a1-1", "a1-2"),
        ("a3", 10, "n", datetime(1999, 1, 1), "a3-0", None, None),
        ("a4", 10, "n", None, None, None, None),
    ]
    tracks = read(spark, base, "tracks")
    assert tracks.columns == TRACK_COLUMNS
    assert sorted(map(tuple, tracks.collect())) == [
        ("t1", "one", "01:01", 1, True, False, 61000, "u-t1", "a1"),
        ("t2", "two", "01:01", 1, True, False, 61000, "u-t2", "a1"),
        ("t3", "three", "01:01", 1, True, False, 61000, "u-t3", "a1"),
        ("t7", "six", None, 1, True, False, None, "u-t7", "a4"),
    ]


def test_a_broken_snapshot_is_never_cleaned(spark, base, tmp_path):
    land_bodies(spark, base, "20240101_000000")
    (tmp_path / "bronze/tracks/snapshot_ts=20240101_000000/_MANIFEST").unlink()
    with pytest.raises(NoSnapshotError):
        run(spark, base, "20240101_000100")
    # nor is a foreign file read beside it
    (tmp_path / "bronze/tracks/other.json").write_text(json.dumps([{"id": "x"}]))
    with pytest.raises(NoSnapshotError) as caught:
        run(spark, base, "20240101_000200")
    assert caught.value.datasets == {"albums": 3} and "albums: 3 rows; tracks: failed" in caught.value.__notes__[0]
    assert read(spark, base, "albums").count() == 3
    with pytest.raises(NoSnapshotError):
        read(spark, base, "tracks")


def test_one_failing_dataset_leaves_the_other_complete(spark, base):
    albums, tracks = bodies("x")
    given = pages(spark, schemas.ALBUM, albums, 2), pages(spark, schemas.TRACK, tracks, 2).withColumn("items", F.expr("IF(offset > 0, raise_error('torn'), items)"))
    with pytest.raises(Exception, match="torn") as caught:
        land(*given, base, "20240101_000000", 2, 2, whole=False)
    assert caught.value.datasets == {"albums": 4}
    assert read_raw(spark, table_path(base, "bronze", "albums"), schemas.ALBUM).count() == 4


def test_datasets_run_at_the_same_time_in_pools_of_their_own(spark):
    import threading

    meet, pools = threading.Barrier(2, timeout=60), {}

    def job(name):
        meet.wait()
        pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        return spark.range(5).count()

    assert side_by_side(spark, {n: lambda n=n: job(n) for n in ("a", "b")}) == {"a": 5, "b": 5}
    assert pools == {"a": "a", "b": "b"} and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_pages_are_read_twice(spark, base, monkeypatch):
    """Sizes once, with the check for missing pages, and bodies once."""
    from tidemark.operators import paging

    albums, _ = bodies("x")
    pages(spark, schemas.ALBUM, albums, 2).write.parquet(f"{base}/pages")
    plans, staged = [], paging.staged
    monkeypatch.setattr(paging, "staged", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or staged(df))
    rows = paging.merge_pages(spark.read.parquet(f"{base}/pages"), 2, whole=True, records=True)
    plans.append(rows._jdf.queryExecution().executedPlan().toString())
    scans = [plan.count("items:array<") for plan in plans]
    assert scans == [1, 0, 1] and "items:array<struct<id:string>>" in plans[0]


def test_landed_records_keep_every_field(spark, base, tmp_path):
    albums, tracks = bodies("x")
    for name, given in (("albums", albums), ("tracks", tracks)):
        lines = [json.dumps({"parent_id": p, "parent_ord": 0, "offset": o, "items": [{**i, "extra": {"of": i["id"]}} for i in items]}) for p, o, items in given]
        os.makedirs(tmp_path / "in", exist_ok=True)
        (tmp_path / "in" / f"{name}.json").write_text("\n".join(lines))
    found = [read_pages(spark, f"{base}/in/{n}.json") for n in ("albums", "tracks")]
    assert land(*found, base, "1", 2, 2) == {"albums": 4, "tracks": 9}
    for name in ("albums", "tracks"):
        rows = read_raw(spark, table_path(base, "bronze", name))
        assert rows.selectExpr("variant_get(record, '$.extra.of', 'string') = variant_get(record, '$.id', 'string') AS same").where("NOT same OR same IS NULL").count() == 0
    assert run(spark, base, "2", strict=True) == {"albums": 3, "tracks": 4}


def test_albums_without_a_group(spark, base):
    albums = [("artist", 0, [{**album("a1"), "album_group": None}])]
    tracks = [("a1", 0, [track("t1", "one")])]

    def landed(**options):
        given = pages(spark, schemas.ALBUM, albums, 2), pages(spark, schemas.TRACK, tracks, 2)
        return land(*given, base, "20240101_000000", 2, 2, **options)

    with pytest.raises(Exception, match="record without album_group"):
        landed()
    assert landed(album_groups=None) == {"albums": 1, "tracks": 1}


def test_extra_formats_and_strict(spark, base):
    albums = [("artist", 0, [{**album("a1", date="1998/05/12"), "external_urls": None}])]
    tracks = [("a1", 0, [track("t1", "one")])]
    land(pages(spark, schemas.ALBUM, albums, 2), pages(spark, schemas.TRACK, tracks, 2), base, "20240101_000000", 2, 2)
    run(spark, base, "20240101_000100", strict=True, extra_formats=["yyyy/MM/dd"])
    assert read(spark, base, "albums").first()["data_lançamento"] == datetime(1998, 5, 12)


def test_run_on_whole_document_files(spark, base, tmp_path):
    files = {"albums": {"items": [album("b"), album("a"), album("b", "again")]}, "tracks": []}
    files["tracks"] = [{**track(f"t{i}", n), "album_id": "b"} for i, n in enumerate("xyx")]
    for name, data in files.items():
        for stamp, content in (("20240101_000000", []), ("20240102_000000", data)):
            folder = tmp_path / "bronze" / name
            os.makedirs(folder, exist_ok=True)
            path = folder / f"{name}_{stamp}.json"
            path.write_text(json.dumps(content, ensure_ascii=False, indent=4), encoding="utf-8")
            os.utime(path, (int(stamp[:8]), int(stamp[:8])))
    assert run(spark, base, "20240103_000000") == {"albums": 2, "tracks": 2}
    assert sorted(r.id_musica for r in read(spark, base, "tracks").collect()) == ["t0", "t1"]
    assert [r.nome_album for r in read(spark, base, "albums").collect()] == ["n", "n"]
    assert read(spark, base, "albums").columns == ALBUM_COLUMNS


def test_run_without_bronze(spark, base):
    with pytest.raises(NoSnapshotError):
        run(spark, base, "20240101_000000")


def test_strict_run_wants_every_field(spark, base):
    albums, tracks = bodies("x")
    for _, _, items in tracks:
        for t in items:
            del t["is_playable"]
    land(pages(spark, schemas.ALBUM, albums, 2), pages(spark, schemas.TRACK, tracks, 2), base, "1", 2, 2)
    with pytest.raises(ValueError, match="is_playable"):
        run(spark, base, "2", strict=True)
    run(spark, base, "3")


def test_wrapped_frames(spark):
    albums, _ = bodies("x")
    got = silver_albums(pages(spark, schemas.ALBUM, albums, 2))
    assert sorted(r.id_album for r in got.collect()) == ["a1", "a2", "a3", "a4", "a5"]
    wrapped = pages(spark, schemas.TRACK, [("a", 0, [track("1", None), track("2", None)])], 2)
    assert [r.id_musica for r in silver_tracks(wrapped).collect()] == ["1"]


def test_empty_input_has_columns(spark):
    assert silver_albums(spark.createDataFrame([], schemas.raw(schemas.ALBUM))).columns == ALBUM_COLUMNS
    assert silver_tracks(spark.createDataFrame([], schemas.raw(schemas.TRACK))).columns == TRACK_COLUMNS


def test_only_needed_fields_are_read(spark, base):
    spark.createDataFrame([], schemas.raw(schemas.TRACK)).write.json(f"{base}/t")
    df = silver_albums(spark.read.schema(schemas.raw(schemas.ALBUM)).json(f"{base}/t"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "album_group" not in plan and "external_urls" not in plan


def test_one_shuffle_per_cleaned_table(spark, base):
    spark.createDataFrame([], schemas.raw(schemas.TRACK)).write.json(f"{base}/t")
    for clean, record in ((silver_albums, schemas.ALBUM), (silver_tracks, schemas.TRACK)):
        raw = spark.read.schema(schemas.raw(record)).json(f"{base}/t")
        plan = clean(raw)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "Python" not in plan


def test_settings_follow_the_input():
    small, large, huge = (settings_for(n << 20) for n in (10, 1 << 20, 100 << 20))
    assert [s[SHUFFLE_PARTITIONS] for s in (small, large, huge)] == ["200", "2048", "50000"]
    assert PARALLELISM_FIRST not in small and large[PARALLELISM_FIRST] == "false"
    assert settings_for(100 << 40, max_partitions=300_000)[SHUFFLE_PARTITIONS] == "204800"


def test_jobs_leave_the_session_as_it_is(spark, base):
    before = spark.conf.getAll
    land_bodies(spark, base, "20240101_000000")
    run(spark, base, "20240101_000100")
    assert spark.conf.getAll == before


def test_size_of_the_raw_records(spark, base, tmp_path):
    for stamp in ("20240101_000000", "20240102_000000"):
        land_bodies(spark, base, stamp)
    parts = [p for n in ("albums", "tracks") for p in (tmp_path / f"bronze/{n}/snapshot_ts=20240102_000000").glob("attempt-*/part-*")]
    assert bronze_bytes(spark, base) == sum(p.stat().st_size for p in parts) > 0
    assert manifest(spark, table_path(base, "bronze", "albums"))["rows"] == 4


def test_a_missing_page_is_not_landed_over(spark, base):
    albums, tracks = bodies("x")
    cases = ((albums[1:], tracks, "artist"), (albums, [b for b in tracks if b[:2] != ("a1", 0)], "a1"))
    for i, (a, t, lost) in enumerate(cases):
        given = pages(spark, schemas.ALBUM, a, 2), pages(spark, schemas.TRACK, t, 2)
        with pytest.raises(ValueError, match=f"page of parent {lost} is missing"):
            land(*given, base, f"2024010{i + 1}_000000", 2, 2)
    assert land(*given, base, "20240103_000000", 2, 2, whole=False)["albums"] == 4


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_command_line(spark, base, capsys, fmt):
    from tidemark.__main__ import main

    albums, tracks = bodies("x")
    pages(spark, schemas.ALBUM, albums, 2).write.format(fmt).save(f"{base}/pages/albums")
    pages(spark, schemas.TRACK, tracks, 2).write.format(fmt).save(f"{base}/pages/tracks")
    main(
        f"land --album-pages {base}/pages/albums --track-pages {base}/pages/tracks --base {base} "
        f"--pages-format {fmt} --album-limit 2 --track-limit 2 --snapshot-ts 20240101_000000".split()
    )
    main(f"run --base {base} --strict".split())
    out = capsys.readouterr().out
    assert "albums: 4 rows in snapshot 20240101_000000" in out and "tracks: 4 rows" in out
    assert read(spark, base, "albums").count() == 3


def test_raw_records_are_landed_packed(spark, base, tmp_path):
    albums, tracks = bodies("x")
    for stamp, packed in (("20240101_000000", False), ("20240102_000000", True)):
        land(pages(spark, schemas.ALBUM, albums, 2), pages(spark, schemas.TRACK, tracks, 2), base, stamp, 2, 2, packed=packed)
    land_bodies(spark, base, "20240103_000000")
    found = {}
    for stamp in ("20240101_000000", "20240102_000000", "20240103_000000"):
        table = table_path(base, "bronze", "tracks")
        found[stamp] = {name.endswith(".json.gz") for name, _ in manifest(spark, table, stamp)["files"]}
        rows = sorted(map(str, read_raw(spark, table, schemas.TRACK, "album_id", stamp).collect()))
        assert stamp != "20240102_000000" or rows == before
        before = rows
    assert list(found.values()) == [{False}, {True}, {True}]
    assert bronze_text_bytes(spark, base) == 10 * bronze_bytes(spark, base)


def test_keys_of_albums_move_without_their_bodies(spark, base):
    """What the tracks need of an album is two strings, of structs as of VARIANT items."""
    albums, _ = bodies("x")
    given = pages(spark, schemas.ALBUM, albums, 2)
    given.write.json(f"{base}/pages")
    for found in (given, read_pages(spark, f"{base}/pages")):
        narrow = item_fields(found, ["id", "album_group"])
        assert narrow.schema["items"].dataType.elementType.names == ["id", "album_group"]
        want = [[(x["id"], x["album_group"]) for x in r["items"]] for r in given.orderBy("parent_id", "offset").collect()]
        assert [[tuple(x) for x in r["items"]] for r in narrow.orderBy("parent_id", "offset").collect()] == want


def test_found_pages_are_parsed_no_more_than_needed(spark, base, monkeypatch):
    """Pages of albums for their sizes and keys, and for their records; pages of tracks once."""
    from tidemark.operators import paging
    from tidemark.plans import jobs

    albums, tracks = bodies("x")
    pages(spark, schemas.ALBUM, albums, 2).write.json(f"{base}/in/albums")
    pages(spark, schemas.TRACK, tracks, 2).write.json(f"{base}/in/tracks")
    scans = []

    def seen(write):
        def call(df, *args, **options):
            scans.extend({name for name in ("albums", "tracks") for file in df.inputFiles() if f"/in/{name}/" in file})
            return write(df, *args, **options)

        return call

    for module, name in ((paging, "staged"), (jobs, "staged"), (jobs, "write_raw")):
        monkeypatch.setattr(module, name, seen(getattr(module, name)))
    assert land(*[read_pages(spark, f"{base}/in/{n}") for n in ("albums", "tracks")], base, "1", 2, 2) == {"albums": 4, "tracks": 9}
    assert sorted(scans) == ["albums", "albums", "tracks"]


def test_raw_records_are_packed_lightly(spark, base):
    """The default level of gzip takes three times the time for an eighth less."""
    import glob
    import gzip

    rows = spark.range(0, 20000, 1, 1).selectExpr("array(id) AS parent_ord", "0L AS page_offset", "0L AS pos", "named_struct('id', concat('t', hash(id)), 'name', concat('n ', id % 99)) AS record")
    write_raw(rows, base, "tracks", "1", packed=True)
    (name,) = glob.glob(f"{base.removeprefix('file://')}/bronze/tracks/*/*/part-*.json.gz")
    packed = open(name, "rb").read()
    plain = gzip.decompress(packed)
    assert len(gzip.compress(plain, 6)) * 1.02 < len(packed) < len(gzip.compress(plain, 1)) * 1.02 < len(plain) / 3


ODD = ['{"b":1,"a":null,"é\\n\\"":{"z":[1,null,"x\\u0001"],"y":{}},"c":1.10,"d":12345678901234567890123,"f":"ü/"}', "{}", '{"a":{"a":"q"}}']


@pytest.mark.parametrize("other", [None, "null", '"text"', "[1,{}]", "5"])
def test_objects_are_written_as_maps_to_the_same_json(spark, base, monkeypatch, other):
    """Names of fields aren't made anew for each record; a record that is no object is landed as it is."""
    from pyspark.sql import types as T
    from pyspark.sql.readwriter import DataFrameWriter

    rows = spark.createDataFrame([(t,) for t in [*ODD, *([other] if other else [])]], "t string").select(
        F.array(F.lit(1).cast("bigint")).alias("parent_ord"), F.lit(0).cast("bigint").alias("page_offset"), F.lit(0).cast("bigint").alias("pos"), F.parse_json("t").alias("record")
    )
    kinds, save = [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, path: kinds.append(type(self._df.schema["record"].dataType)) or save(self, path))
    assert write_raw(rows, base, "tracks", "1") == rows.count()
    monkeypatch.undo()
    assert kinds == [T.MapType] + [T.VariantType] * (other is not None)
    folder = f"{base.removeprefix('file://')}/bronze/tracks/snapshot_ts=1"
    assert len([name for name in os.listdir(folder) if name.startswith("attempt-")]) == 1
    rows.write.json(f"{base}/plain")
    names = [f"file://{folder}/{name}" for name, _ in manifest(spark, table_path(base, "bronze", "tracks"))["files"]]
    landed, plain = (sorted(r.value for r in spark.read.text(paths).collect()) for paths in (names, f"{base}/plain"))
    assert landed == plain and len(landed) == rows.count()
    assert read_raw(spark, table_path(base, "bronze", "tracks")).count() == rows.count()
