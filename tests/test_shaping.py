import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import (
    flatten,
    rename,
    require_values,
    select_columns,
    unwrap_items,
    unwrap_json,
)

RECORD = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def unwrapped(spark, text):
    df = spark.createDataFrame([(text,)], "value string")
    return [tuple(r) for r in unwrap_json(df, "value", RECORD).orderBy("pos").collect()]


@pytest.mark.parametrize(
    "text, rows",
    [
        ('[{"id":"a"},{"id":"b","n":1}]', [(0, "a", None), (1, "b", 1)]),
        (' \r\n\t[{"id":"a"}]', [(0, "a", None)]),
        ('\n{"items":[{"id":"a"}]}', [(0, "a", None)]),
        ('{"id":"a","more":{"items":[]}}', [(0, "a", None)]),
        ('{"items":[{"id":"a"},{"id":"b"}],"limit":50}', [(0, "a", None), (1, "b", None)]),
        ('{"limit":50,"items":[{"id":"ação"}]}', [(0, "ação", None)]),
        ('{"items":[]}', []),
        ('{"id":"z"}', [(0, "z", None)]),
        ("[]", []),
    ],
)
def test_unwrap_json(spark, text, rows):
    assert unwrapped(spark, text) == rows


@pytest.mark.parametrize(
    "text",
    [
        '{oops',
        'nonsense',
        '[] x',
        '[{"id":"a"}]]',
        '[{"id":"a"}],[{"id":"b"}]',
        '{"id":"a"}\n{"id":"b"}',
        '{"items":[]}]',
        'null',
        '5',
        '{"id":"a"} x',
        '[{"id":"a"},',
        '{"items":[{"id"]}',
        '{"items":null}',
        '',
        '  ',
    ],
)
def test_unwrap_json_refuses(spark, text):
    with pytest.raises(Exception) as e:
        unwrapped(spark, text)
    assert "MALFORMED" in str(e.value) or "JSON document" in str(e.value)


def test_unwrap_json_empty_has_columns(spark):
    df = spark.createDataFrame([("[]",)], "value string")
    assert unwrap_json(df, "value", RECORD).columns == ["pos", "id", "n"]


def test_unwrap_items_of_pages(spark):
    df = spark.createDataFrame(
        [(1, 0, [("a",), ("b",)]), (1, 2, [("c",)]), (2, 0, [])],
        "parent_ord bigint, offset bigint, items array<struct<id:string>>",
    )
    rows = unwrap_items(df).orderBy("parent_ord", "page_offset", "pos").collect()
    assert [tuple(r) for r in rows] == [([1], 0, 0, "a"), ([1], 0, 1, "b"), ([1], 2, 0, "c")]


def test_unwrap_items_leaves_records_alone(spark):
    df = spark.createDataFrame([("a",)], "id string")
    assert unwrap_items(df) is df


def test_flatten(spark):
    df = spark.createDataFrame(
        [(((1,), None), [(1,)], "x")],
        "a struct<b:struct<c:int>,`d.e`:string>, l array<struct<u:int>>, s string",
    )
    flat = flatten(df)
    assert flat.columns == ["a.b.c", "a.d.e", "l", "s"]
    assert flat.first()["a.b.c"] == 1
    assert flat.schema["l"].dataType == df.schema["l"].dataType


def test_flatten_missing_branch(spark):
    df = spark.createDataFrame([(None,)], "a struct<b:struct<c:int>>")
    assert flatten(df).collect() == [(None,)]


def test_rename_and_select(spark):
    df = flatten(spark.createDataFrame([((1,), 2)], "a struct<b:int>, c int"))
    renamed = rename(df, {"a.b": "x", "absent": "y", "c": "z.w"})
    assert renamed.columns == ["x", "z.w"]
    assert select_columns(renamed, ["z.w", "x"]).collect() == [(2, 1)]
    with pytest.raises(AnalysisException):
        select_columns(renamed, ["x", "y"])


def test_require_values(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "`a.b` int, c int")
    assert require_values(df, ["a.b"]) is df
    with pytest.raises(ValueError, match="c"):
        require_values(df, ["a.b", "c"])
    with pytest.raises(ValueError):
        require_values(df.where(F.lit(False)), ["a.b"])
