"""Documents to token ids: language, line dedup, near-dedup, mixing, encoding.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the docs of
the next one. All but the last return the columns of documents, with whatever
further columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import files
from tidemark.llm import language_id, line_dedup, mixing, simhash
from tidemark.llm.queries import bpe_round_trip
from tidemark.staging import job_folder, named_or_local, new_folder

#: A text with a whole ranking of n-grams is of no known language below this score (1 -
#: out-of-place distance). Shorter texts are not judged by it: few of their n-grams may be
#: in any profile, most of all in scripts of thousands of letters.
MIN_LANGUAGE_SCORE = 0.2

#: What stays of a line dedup is judged by its words.
_HAS_WORD = r"[^\x20\x09-\x0D]"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language can't be told go: null, without letters, or long enough to rank and like none of the languages."""
    named_or_local(spark)
    profiles = language_id.learn(docs)
    found = language_id.predict(docs.select(F.struct("*").alias("__doc"), "text"), profiles, keep=["__doc"], counted="__grams")
    like = (F.col("score") >= MIN_LANGUAGE_SCORE) | (F.col("__grams") < language_id.PROFILE)
    known = (F.col("lang_pred") != language_id.UNDETERMINED) & like
    return found.where(known).select("__doc.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier one go, and documents of which no word is left; ``n_chars`` follows the text."""
    named_or_local(spark)
    others = [c for c in docs.columns if c != "text"]
    found = line_dedup.dedup(docs.select("doc_id", "text", F.struct(*others).alias("__doc")))
    left = found.where((F.col("n_removed") == 0) | F.col("text").rlike(_HAS_WORD))
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return left.select(*[new.get(c, F.col("__doc").getField(c)).alias(c) for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked one stays: the one with the smallest doc_id."""
    named_or_local(spark)
    return simhash.keep_one(docs, shingle=3, max_distance=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share asks for, copies as rows."""
    named_or_local(spark)
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of the ids and of what they decode to."""
    named_or_local(spark)
    return bpe_round_trip(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash", dedup_near),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

#: Out-of-place distances, fingerprints and merges have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the table that the one before wrote.

    What a stage stages for itself is removed when it has written, and so is the table before; only the
    last stage's table stays.
    """
    named_or_local(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_folder(spark, name)
        with job_folder(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            files.delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
