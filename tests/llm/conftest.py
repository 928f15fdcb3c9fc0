import random

import pytest
from pyspark.sql import types as T

SYLLABLES = ["the", "ing", "er", "an", "re", "on", "at", "en", "ti", "es", "öß", "ç", "日本"]


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def corpus():
    """Rows (doc_id, text, lang, source): ordinary texts, copies, near copies, and every odd case."""
    rng = random.Random(3)
    rows = []
    for i in range(40):
        lines = [" ".join(words(rng, rng.randint(1, 30))) for _ in range(rng.randint(1, 4))]
        rows.append((i, "\n".join(lines), "en" if i % 3 else "fr", f"s{i % 5}"))
    long = " ".join(words(rng, 4000))
    near = rows[7][1].split(" ")
    near[len(near) // 2] = "changed"
    rows += [
        (40, rows[3][1], "en", "s0"),
        (41, rows[3][1], "en", "s1"),
        (41, rows[3][1], "en", "s1"),  # a repeated row
        (42, " ".join(near), None, "s2"),
        (43, None, "en", None),
        (44, "", None, None),
        (45, " \t\n \n", "en", "s3"),
        (46, "123 !! 456", "en", "s3"),
        (47, long, "en", "s4"),
        (48, long + "\n" + "x" * 5000, "fr", "s4"),
        (49, "the the the\nThe THE the\nthe the the the the\n\nthe", "en", "s4"),
        (50, "don't we'll <|endoftext|> it's we're ''s 'S\r\n\x85 é́ \U0001f642", "en", "s4"),
        (None, "a row without a key", "en", "s0"),
        (None, rows[5][1], "en", "s0"),
    ]
    return rows


DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

#: Columns that operators and stages use for themselves.
CLASHING = ["__place", "__copy", "__source", "__times", "mark", "n", "place", "row", "its_key", "component", "n_tokens", "score", "ids", "size", "key", "line", "doc", "fp", "__doc", "__key", "times", "n_lines", "held_out"]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture
def docs(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS)
    return df.repartition(3).withColumns({c: F.lit(c) for c in CLASHING})


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def sf_dir(spark, rows, tmp_path_factory):
    """The same rows as a documents table."""
    from pyspark.sql import functions as F

    folder = f"file://{tmp_path_factory.mktemp('tables')}"
    df = spark.createDataFrame(rows, DOCS).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    df.write.parquet(f"{folder}/documents.parquet")
    return folder
