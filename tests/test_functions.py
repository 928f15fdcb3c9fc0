from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import format_mm_ss, parse_mixed_date, pick_nth_field


def values(spark, schema, inputs, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {schema}")
    return [r.out for r in df.select("i", column.alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_format_mm_ss(spark, zone):
    cases = {
        0: "00:00",
        59999: "00:59",
        60000: "01:00",
        3599999: "59:59",
        3600000: "00:00",
        3661000: "01:01",
        7265432: "01:05",
        None: None,
        -1: "59:59",
        -1000: "59:59",
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert values(spark, "bigint", cases, format_mm_ss("v")) == list(cases.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_parse_mixed_date(spark):
    cases = {
        "1998": datetime(1998, 1, 1),
        "1998-05": datetime(1998, 5, 1),
        "1998-05-12": datetime(1998, 5, 12),
        "1998-05-12T10:00:00": datetime(1998, 5, 12, 10),
        "1998-05-12 10:00": datetime(1998, 5, 12, 10),
        "1998-05-12T10:00:00.25": datetime(1998, 5, 12, 10, 0, 0, 250000),
        "1998-05-12T25:00:00": None,
        "0000": None,
        "0000-01-01": None,
        "": None,
        None: None,
        "garbage": None,
        "1998-13-01": None,
        "1998-02-30": None,
        "12345": None,
        "12/05/1998": None,
        "May 1998": None,
    }
    assert values(spark, "string", cases, parse_mixed_date("v")) == list(cases.values())


def test_parse_mixed_date_extra_formats(spark):
    cases = {
        "12/05/1998": datetime(1998, 12, 5),
        "May 1998": datetime(1998, 5, 1),
        "1998-05": datetime(1998, 5, 1),
        "garbage": None,
    }
    column = parse_mixed_date("v", extra_formats=["MM/dd/yyyy", "MMM yyyy"])
    assert values(spark, "string", cases, column) == list(cases.values())


def test_parse_mixed_date_has_no_zone(spark):
    df = spark.createDataFrame([("1998",)], "v string").select(parse_mixed_date("v").alias("d"))
    assert dict(df.dtypes) == {"d": "timestamp_ntz"}


def test_pick_nth_field(spark):
    images = [None, [], [("a",)], [("a",), ("b",)], [("a",), ("b",), ("c",)], [None, ("b",)]]
    expected = [
        [None, None, "a", "a", "a", None],
        [None, None, None, "b", "b", "b"],
        [None, None, None, None, "c", None],
    ]
    for i, want in enumerate(expected):
        got = values(spark, "array<struct<url:string>>", images, pick_nth_field(F.col("v"), i, "url"))
        assert got == want
