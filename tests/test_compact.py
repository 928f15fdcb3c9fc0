"""Documents without line breaks: cut into pieces of any size they give what the whole parse gives."""

import json
import random

import pytest
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.sources import compact, read_json_file

RECORD = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])

TRICKY = [
    {"id": "plain", "n": 0},
    {"id": 'a},{"b":[', "n": 1},
    {"id": 'q"\\"}\\\\', "n": 2, "more": [{"x": {}}, {"y": [{"z": 1}, [2, [3]]]}], "e": []},
    {},
    {"id": "ação }\n{", "deep": {"id": "no", "n": 9, "items": [{"id": "x"}]}, "n": 4},
    {"id": "\\", "n": 5},
    {"id": None},
]


@pytest.fixture
def split(spark):
    keys = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": None}
    before = {k: spark.conf.get(k) for k in keys}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    for key, value in before.items():
        spark.conf.set(key, value)


def put(tmp_path, text):
    (tmp_path / "x.json").write_text(text, encoding="utf-8", newline="")
    return f"file://{tmp_path}/x.json"


def rows(df):
    return [(r.id, r.n) for r in df.orderBy(*schemas.ORDINAL_COLUMNS).collect()]


def wanted(records):
    return [((r or {}).get("id"), (r or {}).get("n")) for r in records]


@pytest.mark.parametrize("size", [7, 16, 61, 200])
@pytest.mark.parametrize("shape", ["array", "items", "late items", "spaced"])
def test_pieces_agree_with_the_whole_parse(spark, tmp_path, split, size, shape):
    rng = random.Random(size)
    records = [rng.choice([*TRICKY, None]) for _ in range(60)]
    document = {
        "array": records,
        "spaced": records,
        "items": {"items": records, "total": 3, "next": {"a": [{"b": 1}]}, "list": [{"id": "no"}]},
        "late items": {"meta": [{"id": "no"}, "}", {"items": [{"id": "no"}]}], "kind": "items", "items": records},
    }[shape]
    text = json.dumps(document, ensure_ascii=shape == "items", separators=None if shape == "spaced" else (",", ":"))
    path = put(tmp_path, f" {text}\n" if shape == "spaced" else text)
    split(size)
    found = compact.read_compact(spark, path, RECORD, text.encode()[:4000] if shape != "spaced" else f" {text}".encode()[:4000])
    assert found.columns == [*schemas.ORDINAL_COLUMNS, "id", "n"]
    assert rows(found) == wanted(records)


@pytest.mark.parametrize("records", [[], [{}], [None], [None, {"id": "a"}, None, None], [{"id": "}"}], [{"id": "a"}] * 3])
def test_small_documents(spark, tmp_path, split, records):
    split(3)
    for document in (records, {"items": records}, {"items": records, "x": {"y": []}}):
        text = json.dumps(document)
        assert rows(compact.read_compact(spark, put(tmp_path, text), RECORD, text.encode())) == wanted(records)


def test_one_line_is_read_by_many_tasks(spark, tmp_path, split):
    records = [{"id": f"r{i}", "n": i, "text": "x{" * 20} for i in range(2000)]
    path = put(tmp_path, json.dumps({"items": records}, separators=(",", ":")))
    split(10_000)
    pieces = compact._pieces(spark, path)
    assert pieces.rdd.getNumPartitions() > 8 and pieces.groupBy("block").count().count() > 8
    assert rows(read_json_file(spark, path, RECORD)) == wanted(records)


@pytest.mark.parametrize(
    "text",
    [
        '[{"id":"a"}{"id":"b"}]',
        '[{"id":"a"},{"id":"b"}',
        '[{"id":"a"},{"id":"b"',
        '[{"id":"a"},{"id":"b"}]]',
        '[{"id":"a"},{"id":"b"}] x',
        '[{"id":"a"},{"id":"b"}][]',
        '{"items":[{"id":"a"},{"id":"b"}]',
        '{"items":[{"id":"a"},{"id":"b"}],}',
        '[{"id":"a"},{"id" "b"}]',
        '[,{"id":"a"},{"id":"b"}]',
        '[{"id":"a"},{"id":"b"},x]',
    ],
)
def test_corrupt_documents_raise(spark, tmp_path, split, text):
    split(9)
    path = put(tmp_path, text)
    with pytest.raises(Exception, match="MALFORMED|JSON document"):
        read_json_file(spark, path, RECORD).collect()


def test_where_records_begin():
    assert compact.array_start(b' [{"a":1}]') == (2, 1)
    assert compact.array_start(b'{"items" : [1]}') == (12, 2)
    assert compact.array_start(b'{"a":"items","b":[1],"items":[') == (30, 2)
    assert compact.array_start(b'{"a":{"items":[1]}}') is None
    assert compact.array_start(b'{"id":"a"}') is None and compact.array_start(b"") is None
