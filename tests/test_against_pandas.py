"""Operators on random input against what the same pandas call gives."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import format_mm_ss, parse_mixed_date
from tidemark.operators import flatten, keep_first, rename, unwrap_json

pd = pytest.importorskip("pandas")


def test_format_mm_ss(spark):
    rng = random.Random(1)
    ms = [rng.randrange(-10**7, 10**8) for _ in range(2000)] + list(range(-1001, 1002))
    want = pd.to_datetime(pd.Series(ms), unit="ms").dt.strftime("%M:%S")
    df = spark.createDataFrame([(m,) for m in set(ms)], "ms bigint")
    got = {r.ms: r.out for r in df.select("ms", format_mm_ss("ms").alias("out")).collect()}
    assert got == dict(zip(ms, want))


def test_parse_mixed_date(spark):
    rng = random.Random(2)
    texts = set()
    for _ in range(1500):
        y, m, d = rng.randrange(1700, 2200), rng.randrange(0, 14), rng.randrange(0, 33)
        h, mi, s = rng.randrange(0, 26), rng.randrange(0, 62), rng.randrange(0, 62)
        texts.add(
            rng.choice(
                [
                    f"{y}",
                    f"{y}-{m:02}",
                    f"{y}-{m:02}-{d:02}",
                    f"{y}-{m:02}-{d:02}T{h:02}:{mi:02}:{s:02}",
                ]
            )
        )
    texts = sorted(texts)
    want = {t: pd.to_datetime(pd.Series([t]), format="mixed", errors="coerce")[0] for t in texts}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.out for r in df.select("t", parse_mixed_date("t").alias("out")).collect()}
    assert {t: None if pd.isna(v) else v.to_pydatetime() for t, v in want.items()} == got


@pytest.mark.parametrize("seed", range(3))
def test_keep_first(spark, seed):
    rng = random.Random(seed)
    keys = [rng.choice([None, "hot", "hot", *(f"k{i}" for i in range(30)), "K1"]) for _ in range(500)]
    frame = pd.DataFrame({"k": pd.Series(keys, dtype=object), "i": range(500)})
    want = frame.drop_duplicates(subset="k")["i"].tolist()
    rows = list(zip(keys, range(500)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i int").repartition(5)
    assert sorted(r.i for r in keep_first(df, ["k"], ["i"]).collect()) == want


def test_unwrap_flatten_rename(spark):
    rng = random.Random(3)
    record = T.StructType.fromDDL(
        "id string, n bigint, a struct<x:string,b:struct<y:bigint,z:string>>, l array<struct<u:string>>"
    )

    def some(value):
        return rng.choice([value, value, None])

    records = [
        {
            "id": f"r{i}",
            "n": some(i),
            "a": {"x": some("ção"), "b": {"y": some(i), "z": some("z")}},
            "l": [{"u": "1"}] * rng.randrange(3),
        }
        for i in range(200)
    ]
    want = pd.json_normalize(records).rename(columns={"a.b.y": "deep", "absent": "x"})
    for document in (records, {"items": records, "limit": 50}):
        text = json.dumps(document, ensure_ascii=False, indent=4)
        df = spark.createDataFrame([(text,)], "value string")
        got = rename(flatten(unwrap_json(df, "value", record)), {"a.b.y": "deep", "absent": "x"})
        assert set(got.columns) - {"pos"} == set(want.columns)
        rows = got.orderBy("pos").select(*[F.col(f"`{c}`") for c in want.columns]).collect()
        plain = [[[{"u": u.u} for u in v] if isinstance(v, list) else v for v in r] for r in rows]
        assert plain == want.astype(object).where(want.notna(), None).values.tolist()
