import glob
import os

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from workload import derive


def tables(spark, base, **frames):
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{base}/{name}.parquet")
    return base


def test_files_by_day_are_written_without_a_sort(spark, base, tmp_path, monkeypatch):
    """A year is one file, so one task's sort would hold all its rows."""
    days = spark.range(3000).select(
        F.col("id").alias("event_id"), F.lit("x").alias("props"), F.expr("timestamp '2023-11-01' + make_interval(0, 0, 0, cast(id % 90 AS int))").alias("ts")
    )
    before, during, save = spark.conf.get(derive.OPEN_FILES), [], DataFrameWriter.save
    folder = tables(spark, base, events=days)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, path: during.append(int(spark.conf.get(derive.OPEN_FILES))) or save(self, path))
    found = derive.event_files(spark, folder)
    assert during == [64] * 4 and spark.conf.get(derive.OPEN_FILES) == before
    root = found.removeprefix("file://")
    assert len(glob.glob(f"{root}/events/a/deep/day=*/*.json")) == 90
    assert len(glob.glob(f"{root}/events/other/day=*/*.parquet")) == len(os.listdir(f"{root}/events/other")) - 2 == 2
    for name, fmt in (("events/a/deep", "json"), ("events/flat", "json"), ("events/other", "parquet"), ("events-old", "json")):
        assert spark.read.format(fmt).load(f"{found}/{name}").count() == 3000


def test_found_pages_are_packed_and_numbered(spark, base):
    """Orders of a customer get the offsets 0, 2, ...; the pages are gzip files."""
    at = F.expr("timestamp '2024-02-03'").alias("o_orderdate")
    orders = spark.range(30).selectExpr(
        "id AS o_orderkey", "id % 3 AS o_custkey", "'F' AS o_orderstatus", "1.0D AS o_totalprice", "'1-URGENT' AS o_orderpriority"
    ).select("*", at)
    lines = spark.range(40).selectExpr(
        "id % 8 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "cast(id DIV 8 AS int) AS l_linenumber", "7.0D AS l_quantity",
        "2.5D AS l_extendedprice", "0.1D AS l_discount", "'R' AS l_returnflag", "'O' AS l_linestatus",
    )
    customers = spark.range(3).selectExpr("id AS c_custkey", "1.5D AS c_acctbal")
    folders = derive.json_pages(spark, tables(spark, base, orders=orders, lineitem=lines, customer=customers))
    for folder, parents, each in zip(folders, (3, 8), (10, 5)):
        names = glob.glob(f"{folder.removeprefix('file://')}/part-*")
        assert names and all(name.endswith(".json.gz") for name in names)
        found = spark.read.json(folder).where("parent_id NOT LIKE 'collection%'").groupBy("parent_id").agg(F.sort_array(F.collect_list("offset")).alias("o"))
        assert [r.o for r in found.collect()] == [list(range(0, 2 * each, 2))] * parents


def test_pages_of_a_table_are_derived_not_written(spark, base, tmp_path):
    """Pages over a driver table are an expression: what reads them leaves no copy in the shared folder."""
    orders = spark.range(4).selectExpr("id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus", "1.0D AS o_totalprice", "'1-URGENT' AS o_orderpriority", "timestamp '2024-02-03' AS o_orderdate")
    got = derive.album_pages(spark, tables(spark, base, orders=orders))
    assert got.count() == 4 and all("orders.parquet" in name for name in got.inputFiles())
