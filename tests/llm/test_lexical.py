"""Ranked search against a plain loop, the treap against its grid, the query against its SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from tidemark.llm import lexical, queries  # noqa: E402

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """docs: (key, text), items: (key, text); rows (item, rank, key, score)."""
    listed = [(key, Counter(terms(t))) for key, t in docs if terms(t)]
    n_docs, total = len(listed), sum(c.total() for _, c in listed)
    df = Counter(t for _, c in listed for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, counts in listed:
            norm = 10 + 90 * counts.total() * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * norm))
                for t in set(terms(text))
                if t in counts
            )
            if score > 0:
                scored.append((-score, key is None, key or 0))
        out += [(item, r, None if none else key, -s) for r, (s, none, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("seed", range(4))
def test_treap_finds_the_best_columns(seed):
    rng = np.random.default_rng(seed)
    rows_n, columns_n = [(1, 1), (3, 900), (300, 5), (70, 700)][seed]
    cells = rng.choice(rows_n * columns_n, size=max(1, rows_n * columns_n // 5), replace=False)
    rows, columns = (cells // columns_n).astype(np.int32), (cells % columns_n).astype(np.int32)
    values = rng.integers(1, 50, len(cells))
    grid = np.zeros((rows_n, columns_n), np.int64)
    grid[rows, columns] = values
    treap = lexical.Treap(rows, columns, values)
    for _ in range(20):
        asked = rng.choice(rows_n, size=rng.integers(1, min(rows_n, 12) + 1), replace=False).astype(np.int32)
        weights = rng.integers(0, 9, len(asked))
        scores = (grid[asked] * weights[:, None]).sum(axis=0)
        at, found = treap.best(asked, weights, 0, 10)
        order = sorted(zip(-found, at))[:10]
        assert order == [(-s, c) for s, c in sorted(zip(-scores, range(columns_n)))[:10] for s in [-s] if s > 0]


def test_search(spark, docs, rows):
    items = [(1, rows[3][1]), (2, rows[47][1]), (3, None), (4, ""), (5, "?! unheard-of"), (6, "the THE the"), (6, "the"), (None, "日本 x")]
    frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS number", "2 AS score", "3 AS rank", "4 AS doc_id")
    got = lexical.search(docs, frame).collect()
    assert sorted(repr((r.item_id, r["rank"], r.doc_id, r.score)) for r in got) == brute([(r[0], r[1]) for r in rows], items)


def test_ranges_blocks_and_ties(spark, monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choices("a b c d e f g".split(), k=rng.randint(0, 12))) for _ in range(300)] + ["a b c d"] * 100
    rng.shuffle(texts)
    docs = [(i // 2, t) for i, t in enumerate(texts)]
    items = [(i, " ".join(rng.choices("a b c d e f g h".split(), k=rng.randint(1, 6)))) for i in range(30)]
    monkeypatch.setattr(lexical, "RANGE_DOCS", 37)
    monkeypatch.setattr(lexical, "RANGE_CELLS", 64)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(lexical, "WIDTH", 3)
    monkeypatch.setattr(lexical, "PIECE", 5)
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(repr(tuple(r)) for r in lexical.search(*frames).collect()) == brute(docs, items)


def test_empty_tables(spark, no_docs, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert lexical.search(no_docs, one).count() == lexical.search(docs, none).count() == lexical.search(no_docs, none).count() == 0


def test_long_text_in_pieces():
    text = ("Word, " * 400_000 + "x" * 3_000_000 + " end").encode()
    counts = Counter()
    for listed in lexical.pieces(text):
        counts.update(listed)
    assert counts == {b"word": 400_000, b"x" * 3_000_000: 1, b"end": 1}


def test_query_equals_its_sql(spark, tmp_path, rows):
    folder = f"file://{tmp_path}"
    items = [(i, t) for i, t, *_ in rows[:30]]
    spark.createDataFrame([(r[0], r[1]) for r in rows if r[0] != 41], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    with duckdb.connect() as con:
        for name in ("documents", "benchmark"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
        want = con.execute(queries.ORACLE["op13_ranked_search"]).fetchall()
    got = queries.op13_ranked_search(spark, folder).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
