"""The operators as registered queries: whole tables, production parameters, digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, bpe, language_id, lexical, licenses, line_dedup, lm_score, mixing, prefix_trie, quality, simhash, token_counts, vector_dedup
from tidemark.llm.common import documents, is_remainder


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def pre_token_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return lm_score.score(docs, is_remainder(7, 2), tokenizer_file("piece_bpe_32k.model"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(documents(spark, sf_dir, "doc_id", "text"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.repetitions(documents(spark, sf_dir, "doc_id", "source", "text"))
    taken = F.col("size") * F.col("times")
    return mixed.select(F.col("key").alias("doc_id"), "size", "source_size", "target", taken.cast("long").alias("taken"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    return quality.judge(docs, quality.learn(docs))


def bpe_round_trip(docs: DataFrame) -> DataFrame:
    """Encode every text, decode the ids again: ``doc_id, ids, n_tokens, ids_sha256, decoded_sha256``."""
    path, pattern = tokenizer_file("byte_bpe_multi_50k.tiktoken"), pre_token_pattern()
    decoded = bpe.round_trip(docs, path, pattern, keep=["doc_id"])
    ids = F.col("ids")
    return decoded.select(
        "doc_id",
        "ids",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(documents(spark, sf_dir, "doc_id", "text")).drop("ids")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir, "doc_id", "text"))
    base = F.array_distinct(F.col("places.label"))
    both = F.array_union(base, F.col("blocks.label"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))).alias("score"),
        F.size("blocks").cast("long").alias("n_blocks"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(documents(spark, sf_dir, "doc_id", "text"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir, "doc_id", "text"), tokenizer_file("byte_bpe_50k.json"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = is_remainder(3, 1)
    docs = documents(spark, sf_dir, "doc_id", "text", "lang").withColumn("held_out", held_out)
    return language_id.identify(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    return prefix_trie.trie(*prefix_trie.rebuilt(turns))


#: The CRC of a conversation's id is worked out bit by bit, over the bytes of its decimal digits.
PREFIX_TRIE_SQL = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
    SELECT conv_id, count(*) AS n, xor(4294967295, list_reduce(
               list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
               lambda crc, byte: list_reduce(
                   list_prepend(xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                   lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 9 AS h
    FROM turns GROUP BY conv_id
), convs AS (
    SELECT c.conv_id, c.h, c.conv_id - c.conv_id % 5 AS base, least(c.h, coalesce(b.n, 0)) AS given
    FROM sizes c LEFT JOIN sizes b ON b.conv_id = c.conv_id - c.conv_id % 5
), paths AS (
    SELECT conv_id, pos + 1 AS depth, role, text FROM convs c JOIN (SELECT conv_id AS base, pos, role, text FROM turns) t USING (base) WHERE pos < h
    UNION ALL
    SELECT conv_id, given + pos - h + 1, role, text FROM convs JOIN turns USING (conv_id) WHERE pos >= h
), members AS (
    SELECT conv_id, depth, octet_length(encode(text)) AS size,
           string_agg(md5(concat(length(role), ':', role, text)), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path,
           depth = max(depth) OVER (PARTITION BY conv_id) AS ended
    FROM paths
    UNION ALL
    SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM paths) FROM convs
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
    FROM members GROUP BY path, depth
), children AS (
    SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)
), subtrees AS (
    SELECT left(path, CAST(32 * d AS BIGINT)) AS path, sum(saved) AS saved_tokens, sum(CAST(n_children = 0 AS INTEGER)) AS n_leaves
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN subtrees s USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, length(n.path) - 32)
"""


def op12_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_dedup.links(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", kept.alias("kept"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return lexical.search(documents(spark, sf_dir, "doc_id", "text"), items)


RANKED_SEARCH_SQL = r"""
WITH terms AS (
    SELECT rowid_ AS row, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS listed
    FROM (SELECT doc_id, text, row_number() OVER () AS rowid_ FROM documents)
), docs AS (
    SELECT row, doc_id, listed, CAST(len(listed) AS BIGINT) AS n FROM terms WHERE len(listed) > 0
), corpus AS (
    SELECT count(*) AS docs_n, CAST(sum(n) AS BIGINT) AS docs_l FROM docs
), counts AS (
    SELECT row, doc_id, n, term, count(*) AS tf
    FROM (SELECT row, doc_id, n, unnest(listed) AS term FROM docs) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM counts, corpus GROUP BY term, docs_n
), items AS (
    SELECT DISTINCT item, item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
    FROM (SELECT item_id, text, row_number() OVER () AS item FROM benchmark)
), scored AS (
    SELECT item, item_id, row, doc_id,
        CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs_n) // docs_l)))) AS BIGINT) AS score
    FROM items JOIN counts USING (term) JOIN weights USING (term), corpus
    GROUP BY item, item_id, row, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_score,
        op2_simhash,
        op3_nearest_neighbours,
        op4_source_mix,
        op5_quality_rules,
        op6_byte_bpe,
        op7_license_scan,
        op8_line_dedup,
        op9_token_counts,
        op10_language_id,
        op11_prefix_trie,
        op12_vector_dedup,
        op13_ranked_search,
    )
}
ORACLE: dict[str, str] = {"op11_prefix_trie": PREFIX_TRIE_SQL, "op13_ranked_search": RANKED_SEARCH_SQL}
