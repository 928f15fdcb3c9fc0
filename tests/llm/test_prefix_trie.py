"""The trie of conversation prefixes against a plain dictionary of prefixes; the parentheses against a stack."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from tidemark.llm import prefix_trie, queries  # noqa: E402

ROWS = "conv_id long, turn long, role string, text string"


def base_of(conv, period=5):
    return conv - (abs(conv) % period) * (1 if conv >= 0 else -1)


def brute(rows, rebuild=True):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(role, text) for _, _, role, text in sorted(turns)] for c, turns in said.items()}
    paths = own
    if rebuild:
        heads = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
        paths = {c: own.get(base_of(c), [])[: heads[c]] + own[c][heads[c] :] for c in own}
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, inside in members.items():
        own_saved = (len(inside) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own_saved
            leaves[node[:d]] += not kids[node]
    out = []
    for node, inside in members.items():
        ends = ",".join(str(c) for c in sorted(inside) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(inside), len(node), parent, len(inside), len(kids[node]), leaves[node], saved[node], digest))
    return sorted(map(repr, out))


def talk(rng, convs, turns, words, ids=None):
    rows = []
    for c in range(convs):
        conv = ids[c] if ids else c
        rows += [(conv, t, rng.choice(["user", "assistant", None, ""]), rng.choice(words)) for t in range(rng.randint(1, turns))]
    return rows


def odd_rows():
    rng = random.Random(5)
    ids = [*range(40), *range(-23, 0), 2**63 - 1, -(2**63), 1000, 1003]
    rows = talk(rng, len(ids), 11, ["", None, "a", "öß", "日本", "a:b"], ids)
    rows += [(None, 0, "user", "nobody's"), (7, None, "user", "first"), (7, None, "user", "a"), (7, 3, "user", "tie"), (7, 3, "assistant", "tie"), (7, 3, "user", "tie")]
    rows += [(2000, 0, "a:", "b"), (2001, 0, "a", ":b"), (2002, None, None, None), (2002, None, None, None)]
    return rows + rows[:5]


@pytest.mark.parametrize("seed", range(6))
def test_findclose_and_leaf_ranks(seed):
    rng = random.Random(seed)
    opens, depth = [], 0
    for _ in range(rng.choice([2, 50, 3000])):
        up = depth == 0 or rng.random() < rng.choice([0.3, 0.5, 0.9])
        opens.append(up)
        depth += 1 if up else -1
    opens += [False] * depth
    stack, close = [], {}
    for i, up in enumerate(opens):
        if up:
            stack.append(i)
        else:
            close[stack.pop()] = i
    parens = prefix_trie.Parens(np.array(opens))
    at = np.flatnonzero(opens)
    assert parens.findclose(at).tolist() == [close[i] for i in at]
    leaves = [i for i in at if close[i] == i + 1]
    assert parens.leaves_before.tolist() == [sum(leaf < i for leaf in leaves) for i in range(len(opens) + 1)]


def result(frame, rebuild):
    turns = prefix_trie.numbered(frame)
    if rebuild:
        found = prefix_trie.trie(*prefix_trie.rebuilt(turns))
    else:
        paths = turns.selectExpr("conv_id", "pos + 1 AS depth", "digest", "size")
        found = prefix_trie.trie(paths, paths.select("conv_id").distinct())
    return sorted(repr(tuple(r)) for r in found.collect())


@pytest.mark.parametrize("paths,turns", [(1 << 16, 1 << 19), (3, 1 << 19), (50, 7)])
def test_odd_rows_and_small_shards(spark, monkeypatch, paths, turns):
    monkeypatch.setattr(prefix_trie, "SHARD_PATHS", paths)
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", turns)
    rows = odd_rows()
    frame = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 AS pos", "2 AS depth", "3 AS digest", "4 AS size").repartition(5)
    assert result(frame, True) == brute(rows)


@pytest.mark.parametrize("span", [1, 3, 4])
def test_long_paths_in_spans(spark, monkeypatch, span):
    """Deep shared prefixes, copies of a long conversation, ends at a span's last turn."""
    monkeypatch.setattr(prefix_trie, "SPAN", span)
    monkeypatch.setattr(prefix_trie, "SHARD_PATHS", 5)
    rng = random.Random(span)
    long = [(t, "user", rng.choice("abc")) for t in range(23)]
    rows = [(c, *turn) for c in range(9) for turn in long[: [23, 23, 12, 8, 3, 1, 6, 22, 4][c]]]
    rows += [(20 + c, *turn) for c in range(6) for turn in [*long[: 3 * c], *((50 + t, "x", rng.choice("pq")) for t in range(rng.randint(0, 9)))]]
    rows += talk(rng, 15, 10, ["a", "b"], list(range(40, 55)))
    frame = spark.createDataFrame(rows, ROWS).repartition(4)
    assert result(frame, False) == brute(rows, False)


def test_one_conversation_over_many_ranges(spark):
    """A conversation with most of all rows is numbered by many tasks."""
    rows = [(3, t, "user", f"turn {t}") for t in range(700)] + [(c, t, "user", "x") for c in (1, 2, 4, 5) for t in range(3)]
    frame = spark.createDataFrame(rows, ROWS).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = prefix_trie.numbered(frame)
        assert found.where("conv_id = 3").selectExpr("count(DISTINCT pos) AS n", "min(pos) AS a", "max(pos) AS b").first() == (700, 0, 699)
        assert result(frame, True) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_query(spark, tmp_path):
    rows = odd_rows()
    spark.createDataFrame(rows, ROWS).write.parquet(f"file://{tmp_path}/conversations.parquet")
    got = queries.op11_prefix_trie(spark, f"file://{tmp_path}")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got.columns == names and [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    got = sorted(repr(tuple(r)) for r in got.collect())
    assert got == brute(rows)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
        assert sorted(map(repr, con.execute(queries.ORACLE["op11_prefix_trie"]).fetchall())) == got


def test_empty_tables(spark):
    for rows in ([], [(None, 1, "user", "x")], [(4, 0, None, None)]):
        assert result(spark.createDataFrame(rows, ROWS), True) == brute(rows)
