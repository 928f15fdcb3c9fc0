import random

from tidemark.operators import keep_first


def test_first_arrival_wins(spark):
    keys = ["a", "b", "a", None, None, "A"]
    rows = [(k, i) for i, k in enumerate(keys)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i int").repartition(3)
    kept = keep_first(df, ["k"], ["i"])
    assert kept.columns == ["k", "i"]
    assert sorted(r.i for r in kept.collect()) == [0, 1, 3, 5]


def test_order_over_several_columns(spark):
    df = spark.createDataFrame(
        [("k", [1, 9], 0, 5), ("k", [1, 10], 0, 0), ("k", [1, 9], 0, 3), ("k", [2], 0, 0)],
        "k string, o array<bigint>, f bigint, p bigint",
    )
    assert [tuple(r) for r in keep_first(df, ["k"], ["o", "f", "p"]).collect()] == [("k", [1, 9], 0, 3)]


def test_against_plain_python(spark):
    rng = random.Random(7)
    # One key holds a third of the rows.
    rows = [("hot" if rng.random() < 0.33 else f"k{rng.randrange(40)}", i) for i in range(3000)]
    want = {}
    for k, i in rows:
        want.setdefault(k, i)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "`k.k` string, i int").repartition(7)
    assert {r[0]: r.i for r in keep_first(df, ["k.k"], ["i"]).collect()} == want


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as i")
    plan = keep_first(df, ["k"], ["i"])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
