import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark import staging
from tidemark.operators import merge_child_pages, merge_pages, page_states, paging, require_whole, source_filter, with_stop
from tidemark.sources import read_pages

PAGES = "parent_id string, parent_ord bigint, offset bigint, items array<struct<id:string,album_id:string>>"


def make(spark, sizes_by_parent, limit):
    rows = [
        (parent, o, i * limit, [(f"{parent}-{i}-{j}", "?") for j in range(n)])
        for o, (parent, sizes) in enumerate(sizes_by_parent.items())
        for i, n in enumerate(sizes)
    ]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, PAGES).repartition(3)


def expected(sizes_by_parent, limit):
    """Read page after page, as a sequential reader would."""
    out = []
    for parent, sizes in sizes_by_parent.items():
        for i, n in enumerate(sizes):
            out += [f"{parent}-{i}-{j}" for j in range(n)]
            if n < limit:
                break
    return out


def ids(df):
    return [r.id for r in df.orderBy("parent_ord", "page_offset", "pos").collect()]


CASES = {"p": [2, 1, 2], "q": [2, 0, 2], "r": [0, 2], "s": [2, 2], "t": [1]}


def test_merge_pages(spark):
    got = merge_pages(make(spark, CASES, 2), 2)
    assert got.columns == ["parent_ord", "page_offset", "pos", "id", "album_id"]
    assert ids(got) == expected(CASES, 2)


@pytest.mark.parametrize("seed", range(3))
def test_merge_pages_over_many_runs(spark, monkeypatch, seed):
    # Short runs, so that parents span several; one parent holds a third of the pages.
    monkeypatch.setattr(paging, "RUN_PAGES", 3)
    rng = random.Random(seed)
    sizes = {f"p{k}": [rng.choice([3, 3, 3, 3, 3, 2, 0]) for _ in range(rng.randrange(1, 30))] for k in range(20)}
    sizes["hot"] = [3] * 120 + [1] + [3] * 30
    assert ids(merge_pages(make(spark, sizes, 3), 3)) == expected(sizes, 3)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(paging, "RUN_PAGES", 2)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        got = merge_pages(make(spark, CASES, 2), 2)
        assert "Broadcast" not in got._jdf.queryExecution().sparkPlan().toString()
        assert ids(got) == expected(CASES, 2)
    finally:
        spark.conf.set(key, before)


def test_small_outcome_is_broadcast(spark):
    plan = merge_pages(make(spark, CASES, 2), 2)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_sizes_read_one_leaf_of_the_items(spark, base):
    make(spark, CASES, 2).write.parquet(f"{base}/pages")
    plan = page_states(spark.read.parquet(f"{base}/pages"), 2, True)._jdf.queryExecution().executedPlan().toString()
    assert "items:array<struct<id:string>>" in plan and "album_id" not in plan


def test_null_items_count_as_empty(spark):
    df = spark.createDataFrame([("p", 0, 0, [("a", "")] * 2), ("p", 0, 2, None), ("p", 0, 4, [("b", "")])], PAGES)
    assert ids(merge_pages(df, 2)) == ["a", "a"]


def test_pages_of_one_source(spark):
    df = make(spark, {"p": CASES["p"]}, 2).drop("parent_id", "parent_ord")
    assert ids(merge_pages(df, 2)) == expected({"p": CASES["p"]}, 2)


def test_parents_are_joined_without_another_shuffle(spark, base):
    make(spark, CASES, 2).write.parquet(f"{base}/pages")
    pages = spark.read.parquet(f"{base}/pages")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    plans = []
    staged = paging.staged
    paging.staged = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or staged(df)
    spark.conf.set(key, "-1")
    try:
        merge_child_pages(parents(spark, [("p", [0], 0, 0)]), pages, 2)
    finally:
        spark.conf.set(key, before)
        paging.staged = staged
    # One for the page sizes, whose states are staged; from those on only small tables move.
    assert plans[0].count("Exchange ") == 1 and "items:array<struct<id:string>>" in plans[0]
    assert f"{base}/pages" not in plans[1]


def test_a_hot_parent_sends_a_row_for_each_run_and_task(spark, base, monkeypatch):
    """Page states are merged map-side."""
    sizes = {"hot": [3] * 400 + [1], "p": [3, 2]}
    make(spark, sizes, 3).repartition(4).write.parquet(f"{base}/pages")
    states = page_states(spark.read.parquet(f"{base}/pages"), 3, True)
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "partial_collect_set" in plan and "Window" not in plan
    assert {r.parent_id: (r.n, r.short_offset) for r in states.collect()} == {"hot": (401, 1200), "p": (2, 3)}
    stopped = with_stop(states)
    assert {r.parent_id: r.stop_offset for r in stopped.collect()} == {"hot": 1200, "p": 3}
    assert "Window" not in stopped._jdf.queryExecution().executedPlan().toString()


def test_missing_pages_are_found(spark, monkeypatch):
    monkeypatch.setattr(paging, "RUN_PAGES", 3)
    sizes = {"p": [2] * 7 + [1] + [2] * 3, "q": [0], "r": [2, 2], "s": [2] * 5}
    df = make(spark, sizes, 2)
    require_whole(df.union(df), 2)  # copies are no more pages
    for lost in range(11):
        left = df.where(f"NOT (parent_id = 'p' AND offset = {2 * lost})")
        if lost > 7:  # past the short page
            require_whole(left, 2)
        else:
            with pytest.raises(ValueError, match="parent p"):
                require_whole(left, 2)
    with pytest.raises(ValueError, match="parent s"):
        require_whole(df.where("parent_id <> 's' OR offset >= 6"), 2)
    with pytest.raises(ValueError, match="parent q"):
        require_whole(df.withColumn("offset", F.expr("IF(parent_id = 'q', 1, offset)")), 2)
    require_whole(df.where("parent_id = 'p'").drop("parent_id", "parent_ord"), 2)
    require_whole(df.limit(0), 2)


def test_bodies_are_joined_by_hash(spark, base):
    """Beyond a broadcast the staged side is built into a map, and no body is sorted."""
    make(spark, CASES, 2).write.parquet(f"{base}/pages")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        got = merge_child_pages(parents(spark, [("p", [0], 0, 0)]), spark.read.parquet(f"{base}/pages"), 2)
        assert len(got.collect()) == 3
        final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set(key, before)
    assert "ShuffledHashJoin" in final and "Sort" not in final


def parents(spark, rows):
    return spark.createDataFrame(rows, "id string, parent_ord array<bigint>, page_offset bigint, pos bigint")


def test_merge_child_pages(spark):
    albums = parents(
        spark,
        [("t", [0], 0, 0), ("p", [0], 0, 1), ("q", [0], 10, 0), ("p", [0], 10, 1), ("none", [0], 10, 2)],
    )
    got = merge_child_pages(albums, make(spark, CASES, 2), 2, attach_as="album_id")
    assert got.columns == ["parent_ord", "page_offset", "pos", "id", "album_id"]
    order = {k: CASES[k] for k in ("t", "p", "q")}
    assert ids(got) == expected(order, 2) + expected({"p": CASES["p"]}, 2)
    assert {(r.id[0], r.album_id) for r in got.collect()} == {(k, k) for k in order}
    assert sorted(r.parent_ord for r in got.where("id = 'p-1-0'").collect()) == [[0, 0, 1], [0, 10, 1]]


def test_more_children_than_one_page(spark):
    albums = parents(spark, [("a", [0], 0, 0)])
    got = merge_child_pages(albums, make(spark, {"a": [50, 1]}, 50), 50, attach_as="album_id")
    assert got.count() == 51


def test_child_pages_over_many_runs(spark, monkeypatch):
    monkeypatch.setattr(paging, "RUN_PAGES", 3)
    rng = random.Random(11)
    sizes = {f"p{k:02}": [rng.choice([3, 3, 3, 3, 1]) for _ in range(rng.randrange(1, 20))] for k in range(15)}
    albums = parents(spark, [(k, [0], i // 10 * 10, i % 10) for i, k in enumerate(sizes)])
    got = merge_child_pages(albums, make(spark, sizes, 3), 3, attach_as="album_id")
    assert ids(got) == expected(sizes, 3)


def test_source_filter(spark):
    df = spark.createDataFrame([("album",), ("single",), ("compilation",), (None,)], "album_group string")
    assert sorted(r[0] for r in source_filter(df).collect()) == ["album", "single"]


def test_shared_folder_is_needed_on_a_cluster():
    class Fake:
        def __init__(self, master):
            self.sparkContext = self
            self.master = master

        def getConf(self):
            return self

        def get(self, key):
            return None

        def getCheckpointDir(self):
            return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Fake("yarn"))
    staging.named_or_local(Fake("yarn"))  # sets nothing
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Fake("local[2]"))


def test_job_folder_is_removed(spark):
    import os

    with pytest.raises(KeyError), staging.job_folder(spark) as folder:
        assert staging.staged(spark.range(3)).count() == 3
        local = folder.removeprefix("file://")
        assert len(os.listdir(local)) == 1
        raise KeyError
    assert not os.path.exists(local)
    assert "/job-" not in staging.new_folder(spark, "x")


def test_shared_folder_is_the_sessions(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert staging.new_folder(spark, "x").startswith(named + "/x-")


def test_hot_parent_is_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(paging, "RUN_PAGES", 3)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    sizes = {"hot": [3] * 120 + [1, 3, 3], "p": [3, 1, 3], "q": [3]}
    albums = parents(spark, [("hot", [0], 0, 0), ("p", [0], 0, 1)])
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        got = merge_child_pages(albums, make(spark, sizes, 3), 3, attach_as="album_id")
        hot = got.where("album_id = 'hot'").groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(hot) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(r["count"] for r in hot) == 361


def test_copies_of_one_page_are_split(spark):
    """A third of all pages are copies of one page: the join by run is split, and no row is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    pages = spark.range(0, 30000, 1, 12).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('p', id) END AS parent_id",
        "0L AS parent_ord",
        "CASE WHEN id % 3 = 0 THEN 4L ELSE 0L END AS offset",
        "array(named_struct('id', uuid(), 'album_id', '?')) AS items",
    )
    pages = staging.staged(pages)
    albums = staging.staged(
        pages.select("parent_id").distinct().selectExpr(
            "parent_id AS id", "array(0L) AS parent_ord", "xxhash64(parent_id) AS page_offset", "0L AS pos"
        )
    )
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        got = merge_child_pages(albums, pages, 1, attach_as="album_id")
        query = got.select("id", "album_id")
        ids = [r.id for r in query.collect()]
        plan = query._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    assert "skewed" in plan
    assert len(ids) == 30000 == len(set(ids))


def test_bodies_no_parent_wants_are_held_back(spark, monkeypatch):
    """The bitmap loses no page of a wanted parent, and most others don't reach the join."""
    pages = spark.range(4000).selectExpr(
        "CASE WHEN id % 5 > 0 THEN concat('p', id) END AS parent_id", "0L AS parent_ord", "0L AS offset", "array(named_struct('id', string(id))) AS items"
    )
    wanted = pages.where("parent_id LIKE '%7'").select("parent_id")
    wanted = wanted.union(wanted.limit(1))
    assert paging.held_back(pages, wanted).count() == 4000
    monkeypatch.setattr(paging, "FEW_WANTED", 0)
    for blocks in (4096, 1):
        monkeypatch.setattr(paging, "MOST_BLOCKS", blocks)
        got = paging.held_back(pages, wanted)
        assert got.columns == pages.columns and 400 <= got.count() < 600
        assert got.where("parent_id LIKE '%7'").count() == 400
    listed = wanted.distinct().selectExpr("parent_id AS id", "array(0L) AS parent_ord", "0L AS page_offset", "0L AS pos")
    assert merge_child_pages(listed, pages, 1).count() == 400


def variant_pages(spark, tmp_path, sizes_by_parent, limit):
    """The pages of ``make`` as they are found: JSON Lines, items VARIANT; the last item of a page is a bare string."""
    lines = [
        {"parent_id": parent, "parent_ord": o, "offset": i * limit, "items": [f"{parent}-{i}-{j}" if j == n - 1 else {"id": f"{parent}-{i}-{j}"} for j in range(n)]}
        for o, (parent, sizes) in enumerate(sizes_by_parent.items())
        for i, n in enumerate(sizes)
    ]
    lines += [{"parent_id": None, "offset": 0, "items": [{"id": "of no parent"}]}, {"parent_id": "u", "offset": 0}]
    random.Random(5).shuffle(lines)
    (tmp_path / "pages.json").write_text("\n".join(map(json.dumps, lines)))
    return read_pages(spark, f"file://{tmp_path}/pages.json")


def records(df):
    rows = df.selectExpr("parent_ord", "page_offset", "pos", "album_id", "to_json(record) AS record").collect()
    return sorted(map(tuple, rows))


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_variant_child_pages_are_read_once(spark, tmp_path, monkeypatch, broadcast):
    """Sizes and bodies are of one staged table, which holds the items of wanted parents."""
    sizes = CASES | {f"x{k}": [2] * (k % 4) + [1] for k in range(200)}
    pages = variant_pages(spark, tmp_path, sizes, 2)
    albums = parents(spark, [("p", [0], 0, 0), ("x7", [0], 0, 1), ("p", [0], 2, 0), ("u", [0], 2, 1), ("none", [0], 4, 0), (None, [0], 4, 1)])
    plans, staged, before = [], paging.staged, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def seen(df, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, **options)

    monkeypatch.setattr(paging, "staged", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = merge_child_pages(albums, pages, 2, "album_id", whole=True, records=True)
        found = records(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert [plan.count("FileScan json") for plan in plans] == [1, 0, 0, 0]
    plain = make(spark, sizes, 2)
    monkeypatch.setattr(paging, "staged", staged)
    want = merge_child_pages(albums, plain, 2, "album_id", whole=True).selectExpr("parent_ord", "page_offset", "pos", "album_id", "id")
    short = [(*r[:4], (json.loads(r[4])["id"] if r[4].startswith("{") else json.loads(r[4]))) for r in found]
    assert short == sorted(map(tuple, want.collect())) and len(short) == 3 + 3 + 7
    kept = paging.sized_pages(pages, albums.selectExpr("id AS parent_id"))
    assert kept.count() == pages.count() and kept.where("n_items > 0 AND items IS NOT NULL").count() < 20
    assert kept.agg(F.sum("n_items")).first()[0] == sum(map(sum, sizes.values())) + 1


def test_variant_child_pages_that_are_missing(spark, tmp_path):
    """Wholeness is of every parent's pages, wanted or not, and of what was found, not of the items kept."""
    pages = variant_pages(spark, tmp_path, CASES | {"v": [2, 2, 1]}, 2)
    albums = parents(spark, [("p", [0], 0, 0)])
    with pytest.raises(ValueError, match="parent v"):
        merge_child_pages(albums, pages.where("NOT (parent_id = 'v' AND offset = 2)"), 2, whole=True)
    assert merge_child_pages(albums, pages.where("NOT (parent_id = 'v' AND offset = 2)"), 2, records=True).count() == 3


@pytest.mark.parametrize("seed", range(2))
def test_stops_of_few_long_parents_are_broadcast(spark, monkeypatch, seed):
    """Stops and missing pages are the same as where all parents are long; parents of one run are not joined with others."""
    monkeypatch.setattr(paging, "RUN_PAGES", 3)
    rng = random.Random(seed)
    sizes = {f"p{k:02}": [rng.choice([2, 2, 2, 2, 1]) for _ in range(rng.randrange(1, 12))] for k in range(30)}
    whole = make(spark, sizes, 2).union(make(spark, {"n": [2, 2, 1, 2]}, 2).withColumn("parent_id", F.lit(None).cast("string"))).cache()
    states = staging.staged(page_states(whole, 2, True))
    columns = ["parent_id", "run", "stop_offset"]
    assert sorted(map(str, paging._with_few_stops(states).select(columns).collect())) == sorted(map(str, with_stop(states).select(columns).collect()))
    left = [whole, whole.where("offset <> 0"), whole.where("offset <> 6 OR parent_id IS NULL")]
    left += [whole.where(f"NOT (parent_id = '{p}' AND offset = {o})") for p, o in (("p03", 0), ("p07", 2))]
    said = []
    for few in (50_000, -1):
        monkeypatch.setattr(paging, "FEW_RUNS", few)
        said.append([])
        for pages in left:
            try:
                require_whole(pages, 2)
                said[-1].append(True)
            except ValueError:
                said[-1].append(False)
    assert said[0] == said[1] and said[0][:2] == [True, False]


def test_a_required_field_is_read_once(spark):
    """A filter does not share what it computes: a VARIANT's field was read for the check and for the filter."""
    df = spark.createDataFrame([('{"g": "a"}',), ('{"g": "b"}',)], "t string").select(F.parse_json("t").alias("record"))
    kept = source_filter(df, "g", ("a",), required=True, within="record")
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("variant_get") == 1 and kept.count() == 1
    for text, values in (('{"g": null}', ("a",)), ("{}", ("a", "b")), ("{}", ())):
        lacking = df.union(spark.createDataFrame([(text,)], "t string").select(F.parse_json("t")))
        with pytest.raises(Exception, match="record without g"):
            source_filter(lacking, "g", values, required=True, within="record").collect()
