"""Near-duplicate vectors against all pairs: odd rows, groups beyond the window and the tile, pairs at the threshold."""

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from tidemark.llm import queries, vector_dedup  # noqa: E402

ROWS = "vec_id long, embedding array<double>, node long, size long, component long, k1 long"


def unit(vector):
    scaled = np.array(vector) / np.abs(vector).max()
    return scaled / np.linalg.norm(scaled)


def brute(rows, threshold=0.9):
    """Sorted (id, n_links, component) by all pairs of the vectors that take part."""
    vectors = [None if v is None or not any(v) or not all(x is not None and np.isfinite(x) for x in v) else unit(v) for _, v in rows]
    near = [[b for b, y in enumerate(vectors) if x is not None and y is not None and len(x) == len(y) and x @ y >= threshold and a != b] for a, x in enumerate(vectors)]
    out, component = [], {}
    for a in range(len(rows)):
        if a not in component:
            members, pending = {a}, [a]
            while pending:
                for b in near[pending.pop()]:
                    if b not in members:
                        members.add(b)
                        pending.append(b)
            ids = [rows[m][0] for m in members if rows[m][0] is not None]
            component.update(dict.fromkeys(members, min(ids) if ids else None))
        out.append((rows[a][0], len(near[a]), component[a]))
    return sorted(map(repr, out))


def found(spark, rows, parts=4):
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], ROWS).repartition(parts)
    return sorted(repr((r.id, r.n_links, r.component_id)) for r in vector_dedup.links(df).collect())


def group(rng, size, dim, noise):
    centre = rng.standard_normal(dim)
    return (centre + noise * np.linalg.norm(centre) / np.sqrt(dim) * rng.standard_normal((size, dim))).tolist()


def odd_rows(rng, dim=16):
    nan, inf = float("nan"), float("inf")
    vectors = [v for n in (2, 3, 9) for v in group(rng, n, dim, 0.1)] + rng.standard_normal((40, dim)).tolist()
    vectors += [vectors[0], vectors[0], [2 * x for x in vectors[0]], [1e200 * x for x in vectors[30]], vectors[30], [-x for x in vectors[1]]]
    rows = list(enumerate(vectors))
    rows += [(500, None), (501, []), (502, [0.0] * dim), (503, [nan] * dim), (504, [inf, *[1.0] * (dim - 1)]), (505, [None, *[1.0] * (dim - 1)])]
    rows += [(None, vectors[3]), (None, rng.standard_normal(dim).tolist()), (None, None), (7, vectors[8]), (7, vectors[7])]
    rows += [(600, [1.0, 2.0]), (601, [1.0, 2.1]), (602, [-1.0]), (603, [-3.0]), (604, [0.0, -1.0]), (605, [-0.0, -1.0])]
    return rows


def test_odd_rows(spark):
    rows = odd_rows(np.random.default_rng(0))
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("noise", [0.1, 0.38])
def test_groups_beyond_window_and_tile(spark, monkeypatch, noise):
    """Tight groups lie round their centroid; wide ones are compared block by block."""
    monkeypatch.setattr(vector_dedup, "WINDOW", 4)
    monkeypatch.setattr(vector_dedup, "TILE", 16)
    rng = np.random.default_rng(1)
    vectors = [v for n in (150, 40, 17, 16, 5) for v in group(rng, n, 24, noise)] + rng.standard_normal((200, 24)).tolist()
    vectors += [vectors[0]] * 60 + [vectors[-1]] * 30
    rows = list(zip(rng.permutation(len(vectors)).tolist(), vectors))
    assert found(spark, rows, 7) == brute(rows)


def test_pairs_at_the_threshold_are_found(spark):
    """Pairs of a cosine from 0.90 to 0.93 among many strangers: at least nine of ten, and no other link."""
    rng = np.random.default_rng(2)
    ones = rng.standard_normal((6000, 48))
    cosines = rng.uniform(0.901, 0.93, 300)
    units = ones[:300] / np.linalg.norm(ones[:300], axis=1, keepdims=True)
    side = rng.standard_normal((300, 48))
    side -= (side * units).sum(axis=1, keepdims=True) * units
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    others = cosines[:, None] * units + np.sqrt(1 - cosines**2)[:, None] * side
    rows = list(enumerate([*ones.tolist(), *others.tolist()]))
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], ROWS)
    got = {r.id: r for r in vector_dedup.links(df).collect()}
    caught = [i for i in range(300) if got[6000 + i].component_id == i and got[i].n_links == 1]
    assert len(caught) >= 270
    assert sum(r.n_links for r in got.values()) == 2 * len(caught)


def test_a_pass_sends_one_row_for_each_of_many_near_copies(spark):
    vectors = group(np.random.default_rng(3), 3000, 16, 0.05)
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    _, nodes = vector_dedup.classes(df, "vec_id", "embedding")
    one = vector_dedup.sorted_pass(vector_dedup.hashed(nodes, 1, 3), 0, 0.9)
    assert one.where("b IS NOT NULL").count() < 3000


def test_query(spark, tmp_path):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in odd_rows(np.random.default_rng(4)) if v is None or len(v) != 16 or abs(v[0] or 0) < 1e38]
    folder = f"file://{tmp_path}"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    got = queries.op12_vector_dedup(spark, folder)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = got.collect()
    assert sorted(repr((r.vec_id, r.n_links, r.component_id)) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, [1.0])]):
        assert found(spark, rows) == brute(rows)
