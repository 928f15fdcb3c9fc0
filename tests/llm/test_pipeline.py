"""The pipeline, stage by stage, against what each stage's operator should do to its own input."""

import hashlib

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from tidemark.llm import language_id, mixing, queries  # noqa: E402


def test_every_operator_is_registered():
    import __spark_entry__ as driver

    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(driver.queries())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, sf_dir)
        path = f"{sf_dir}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        kept[name] = sorted(r.doc_id for r in docs.where("doc_id IS NOT NULL").select("doc_id").distinct().collect())
        if name == "source_mix":
            times = {r.key: r.times for r in mixing.repetitions(before).collect() if r.key is not None}
            found = {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect() if r.doc_id is not None}
            assert found == {k: n for k, n in times.items() if n}
    assert not {43, 44, 45, 46} & set(kept["language_id"]) and {*range(40), 40, 41, 42, 47, 48, 49, 50} <= set(kept["language_id"])
    assert not {40, 41} & set(kept["line_dedup"]) and {3, 7} <= set(kept["line_dedup"])
    lengths = spark.read.parquet(f"{sf_dir}/line_dedup").select("n_chars", "text").collect()
    assert all(r.n_chars == len(r.text) for r in lengths)


def test_short_texts_go_by_their_letters_alone(spark):
    common = "the river walked slowly to the green house and then the people went home again " * 20
    junk = "".join(chr(0x4E00 + i) for i in range(2000))
    rows = [(i, common) for i in range(50)] + [(100, "Buzz Kuzak, Jazz Qubik"), (101, junk), (102, "12 + 3"), (103, None)]
    docs = spark.createDataFrame([(i, t, "en" if i < 100 else None) for i, t in rows], "doc_id long, text string, lang string")
    scores = {r.doc_id: r.score for r in language_id.predict(docs, language_id.learn(docs)).collect()}
    assert scores[100] < corpus_pipeline.MIN_LANGUAGE_SCORE and scores[101] < corpus_pipeline.MIN_LANGUAGE_SCORE
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {*range(50), 100}


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = out.collect()
    assert rows
    for r in rows:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()


def test_empty_tables(spark, tmp_path):
    folder = f"file://{tmp_path}"
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet"
    )
    assert corpus_pipeline.run(spark, folder).count() == 0
