"""Near-duplicate vectors by sorted projection passes.

A hash of a vector is the number and sign of the largest of ``COLUMNS`` random
projections; vectors at a small angle often share it. A pass concatenates a few
such hashes, orders all vectors by them lexicographically (a range shuffle) and
compares every vector with the ``WINDOW`` before it. Pairs verified by their
cosine are united across passes:

* equal vectors are one class; passes see each class once;
* a task takes one range of a pass and hands over its first and last rows, so that windows across the
  ends of ranges are compared afterwards, by groups of two windows' rows;
* of a task's pairs those go on that join two sets not yet joined there, so a
  pass gives about one row for each class, however many are alike;
* components of these pairs are found by star rounds.

A window is bounded, a group of near copies is not. So links are counted exactly inside each component:
up to ``TILE`` classes in one block; beyond that, members within half the
threshold's angle of the component's centroid are all linked to one another, which takes one
comparison each, and only the others are compared with every member, block by
block. Rows grow with the input unless a component of more than ``TILE`` classes is a chain spread
wider than that angle.

The number of passes follows from the number of classes: enough to bring a pair that is just at the
threshold together with probability ``RECALL``, by the hashes that a window's neighbours share.

Defined results: a vector that is null, zero, or holds a null or a non-finite
component links with nothing. Vectors of different lengths are not compared. Every row is a vector, also
where ids repeat; a row without an id takes part, and is nobody's component id. A component
of such rows alone has none, and all of it stays. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, ship, written
from tidemark.llm.components import components

COLUMNS = 64
WINDOW = 32
TILE = 1024
RECALL = 0.98
SEED = 11


def units(column: pa.Array | list) -> np.ndarray:
    """Vectors of one length, scaled to length 1 in double precision."""
    if isinstance(column, pa.Array):
        rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    else:
        rows = np.array(list(column), np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


@lru_cache(maxsize=4096)
def directions(dim: int, number: int) -> np.ndarray:
    return np.random.default_rng((SEED, dim, number)).standard_normal((dim, COLUMNS))


def largest(projected: np.ndarray) -> np.ndarray:
    """The hash: twice the place of the largest projection, and its sign."""
    at = np.abs(projected).argmax(axis=1)
    return (2 * at + (np.take_along_axis(projected, at[:, None], 1)[:, 0] < 0)).astype(np.uint8)


@lru_cache(maxsize=64)
def agreement(cosine: float) -> float:
    """How often two vectors at that cosine share a hash, from 20,000 drawn pairs."""
    rng = np.random.default_rng(SEED)
    one, other = rng.standard_normal((2, 20_000, COLUMNS))
    return float((largest(one) == largest(cosine * one + math.sqrt(1 - cosine * cosine) * other)).mean())


def plan(classes: int, threshold: float) -> tuple[int, int]:
    """How many passes, and hashes in each, for so many vectors."""
    shared = max(1.0, math.log(max(classes / WINDOW, 2)) / math.log(COLUMNS))
    chance = min(agreement(threshold) ** shared, 0.9)
    return max(4, math.ceil(math.log(1 - RECALL) / math.log(1 - chance))), math.ceil(shared) + 2


def classes(df: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame]:
    """``id, k1, k2`` of every row (no k1 where it takes no part), and the classes ``node, k1, k2, least, size, vector``."""
    x = F.col("vector")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    kind = "array<float>" if df.schema[column].dataType == T.ArrayType(T.FloatType()) else "array<double>"
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(column).cast(kind).alias("vector"))
    rows = rows.withColumn("vector", F.when(F.coalesce(usable, F.lit(False)), F.transform(x, lambda v: v + F.lit(0).cast(kind[6:-1]))))
    hashed = [F.when(x.isNotNull(), F.xxhash64(F.lit(n), x)).alias(f"k{n}") for n in (1, 2)]
    rows = rows.select("id", "vector", *hashed)
    grouped = rows.where(x.isNotNull()).groupBy("k1", "k2").agg(F.min("id").alias("least"), F.count("*").alias("size"), F.first("vector").alias("vector"))
    return rows.drop("vector"), written(grouped.select(F.monotonically_increasing_id().alias("node"), "*"), "vector-classes")


def _by_length(column: pa.Array) -> Iterator[np.ndarray]:
    lengths = np.diff(column.offsets.to_numpy())
    for length in np.unique(lengths):
        yield np.flatnonzero(lengths == length)


def hashed(nodes: DataFrame, passes: int, hashes: int) -> DataFrame:
    """``node, vector, length, keys``: the concatenated hashes of each pass."""
    schema = T.StructType([*nodes.select("node", "vector").schema.fields, T.StructField("length", T.IntegerType()), T.StructField("keys", T.ArrayType(T.BinaryType()))])

    def each(batch: pa.RecordBatch) -> dict:
        column = batch.column("vector")
        keys: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
        for at in _by_length(column):
            rows = units(column.take(pa.array(at)))
            for p in range(passes):
                own = np.stack([largest(rows @ directions(rows.shape[1], p * hashes + h)) for h in range(hashes)], axis=1)
                for i, key in zip(at, own):
                    keys[i].append(key.tobytes())
        return {"node": batch.column("node"), "vector": column, "length": np.diff(column.offsets.to_numpy()).tolist(), "keys": keys}

    return written(arrow_map(nodes.select("node", "vector"), each, schema), "vector-keys")


def joined(size: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Of pairs of places below ``size``, those that join two sets which the ones before them haven't joined."""
    root = list(range(size))
    out = []
    for a, b in pairs.tolist():
        x, y = a, b
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[x] = y
            out.append((a, b))
    return out


def neighbours(rows: np.ndarray, window: int, threshold: float) -> np.ndarray:
    """Pairs of places (later, earlier), at most ``window`` apart, with that cosine."""
    out = []
    for at in range(0, len(rows), window):
        block, low = rows[at : at + window], max(0, at - window)
        near = block @ rows[low : at + len(block)].T >= threshold
        later, earlier = np.nonzero(near)
        later, earlier = later + at, earlier + low
        keep = (earlier < later) & (later - earlier <= window)
        out.append(np.stack([later[keep], earlier[keep]], axis=1))
    pairs = np.concatenate(out) if out else np.empty((0, 2), np.int64)
    return pairs[np.argsort(pairs[:, 0] - pairs[:, 1], kind="stable")]


def sorted_pass(keyed: DataFrame, number: int, threshold: float) -> DataFrame:
    """One pass: pairs ``a, b`` found in each range, and each range's first and last rows with their places."""
    ship(keyed.sparkSession)
    rows = keyed.select("length", F.col("keys")[number].alias("key"), "node", "vector")
    ordered = rows.repartitionByRange("length", "key", "node").sortWithinPartitions("length", "key", "node")
    fields = [T.StructField(n, T.LongType()) for n in ("a", "b", "pid", "place", "rows", "length")]
    schema = T.StructType([*fields, T.StructField("vector", keyed.schema["vector"].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        pid = TaskContext.get().partitionId()

        def out(**columns: object) -> pa.RecordBatch:
            size = len(next(iter(columns.values())))
            arrays = [pa.nulls(size, f.type) if f.name not in columns else pa.array(columns[f.name], f.type) for f in arrow]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        def ends(part: pa.Table, first: int) -> pa.RecordBatch:
            n = part.num_rows
            return out(
                a=part.column("node").to_pylist(),
                pid=[pid] * n,
                place=list(range(first, first + n)),
                length=part.column("length").to_pylist(),
                vector=part.column("vector").to_pylist(),
            )

        done, held = 0, None  # rows before this batch; the last WINDOW of them
        for batch in batches:
            part = pa.Table.from_batches([batch])
            if done < WINDOW:
                yield ends(part.slice(0, WINDOW - done), done)
            part = part if held is None else pa.concat_tables([held, part])
            done += batch.num_rows
            lengths = part.column("length").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), len(lengths)]
            for low, high in zip(cuts, cuts[1:]):
                here = part.slice(low, high - low).combine_chunks()
                pairs = joined(high - low, neighbours(units(here.column("vector").chunk(0)), WINDOW, threshold))
                if pairs:
                    nodes = here.column("node").to_numpy()
                    a, b = nodes[np.array(pairs).T]
                    yield out(a=a, b=b)
            held = part.slice(max(0, part.num_rows - WINDOW))
        if held is not None:
            fresh = max(WINDOW, done - held.num_rows)  # the first WINDOW have been given already
            if done > fresh:
                yield ends(held.slice(held.num_rows - (done - fresh)), fresh)
            yield out(pid=[pid], rows=[done])

    return ordered.mapInArrow(run, schema)


def across_ranges(found: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: pairs that a range's end parts, of all passes; groups hold the rows within a window of one end."""
    spark = found.sparkSession
    starts: dict[int, np.ndarray] = {}
    pids: dict[int, list[int]] = {}
    for r in found.where("rows IS NOT NULL").select("pass", "pid", "rows").orderBy("pass", "pid").toLocalIterator():
        starts.setdefault(r["pass"], [0]).append(starts[r["pass"]][-1] + r["rows"])
        pids.setdefault(r["pass"], []).append(r["pid"])
    known = spark.sparkContext.broadcast({p: (np.array(s), {pid: i for i, pid in enumerate(pids[p])}) for p, s in starts.items()})
    rows = found.where("place IS NOT NULL").select("pass", "pid", "place", "length", F.col("a").alias("node"), "vector")
    schema = T.StructType(
        [*(T.StructField(n, T.LongType()) for n in ("pass", "end", "place", "length", "node")), T.StructField("vector", found.schema["vector"].dataType)]
    )

    def near_ends(batch: pa.RecordBatch) -> dict:
        took, ends, places = [], [], []
        for i, (p, pid, place) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("pass", "pid", "place")))):
            start, number = known.value[p]
            at = int(start[number[pid]]) + place
            inner = start[1:-1]
            for end in inner[np.searchsorted(inner, at - WINDOW, "right") : np.searchsorted(inner, at + WINDOW, "right")].tolist():
                took.append(i)
                ends.append(end)
                places.append(at)
        taken = {c: batch.column(c).take(pa.array(took, pa.int64())) for c in ("pass", "length", "node", "vector")}
        return taken | {"end": ends, "place": places}

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, same in group.sort_values("place").groupby("length"):
            places, nodes = same["place"].to_numpy(), same["node"].to_numpy()
            later, earlier = np.nonzero(np.tril(units(same["vector"]) @ units(same["vector"]).T >= threshold, -1))
            end = same["end"].iloc[0]
            keep = (places[later] - places[earlier] <= WINDOW) & (places[later] >= end) & (places[earlier] < end)
            pairs = np.stack([later[keep], earlier[keep]], axis=1)
            out += [(int(nodes[a]), int(nodes[b])) for a, b in joined(len(same), pairs)]
        return pd.DataFrame(out, columns=["a", "b"])

    return arrow_map(rows, near_ends, schema).groupBy("pass", "end").applyInPandas(compare, "a long, b long")


COUNTED = T.StructType([T.StructField("node", T.LongType()), T.StructField("links", T.LongType())])


def linked_weight(rows: np.ndarray, others: np.ndarray, sizes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row the summed sizes of the others linked to it, and which pairs are linked."""
    near = rows @ others.T >= threshold
    return near.astype(np.int64) @ sizes, near


def small_components(members: DataFrame, threshold: float) -> DataFrame:
    """``node, links``: the summed sizes of all classes linked to each, its own included; ``TILE`` members a component at most."""
    ship(members.sparkSession)
    ordered = members.select("component", "node", "size", "vector").repartition("component").sortWithinPartitions("component")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(part: pa.Table) -> pa.RecordBatch:
            nodes, sizes = part.column("node").to_numpy(), part.column("size").to_numpy()
            rows = units(part.column("vector").chunk(0))
            weights, near = linked_weight(rows, rows, sizes, threshold)
            weights += np.where(near.diagonal(), 0, sizes)  # rounding aside, a vector is at cosine 1 of itself
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(weights)], names=["node", "links"])

        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held, part])
            owner = part.column("component").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist()]
            for low, high in zip(cuts, cuts[1:]):
                yield counted(part.slice(low, high - low).combine_chunks())
            held = part.slice(cuts[-1])
        if held is not None:
            yield counted(held.combine_chunks())

    return ordered.mapInArrow(run, COUNTED)


def large_components(members: DataFrame, threshold: float) -> DataFrame:
    """The same beyond ``TILE`` members: those near the centroid by their number, the others block by block."""
    half = math.cos(math.acos(threshold) / 2) + 1e-9
    sums = T.StructType([T.StructField("component", T.LongType()), T.StructField("sum", T.ArrayType(T.DoubleType()))])

    def add(batch: pa.RecordBatch) -> dict:
        owner = batch.column("component").to_numpy()
        out = {}
        for c in np.unique(owner):
            out[int(c)] = units(batch.column("vector").take(pa.array(np.flatnonzero(owner == c)))).sum(axis=0).tolist()
        return {"component": list(out), "sum": list(out.values())}

    added = arrow_map(members.select("component", "vector"), add, sums).select("component", F.posexplode("sum"))
    each = added.groupBy("component", "pos").agg(F.sum("col").alias("total"))
    centroids = each.groupBy("component").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "total"))), lambda x: x["total"]).alias("centroid"))
    sized = T.StructType([*(T.StructField(n, T.LongType()) for n in ("component", "node", "size")), members.schema["vector"], T.StructField("core", T.BooleanType())])

    def inside(batch: pa.RecordBatch) -> dict:
        core = []
        for vector, centroid in zip(batch.column("vector").to_pylist(), batch.column("centroid").to_pylist()):
            core.append(bool(any(centroid)) and float((units([vector]) @ units([centroid]).T)[0, 0]) >= half)
        return {c: batch.column(c) for c in ("component", "node", "size", "vector")} | {"core": core}

    near = written(arrow_map(members.join(centroids, "component").select("component", "node", "size", "vector", "centroid"), inside, sized), "vector-cores")
    totals = near.groupBy("component").agg(
        F.sum(F.when(F.col("core"), F.col("size")).otherwise(0)).alias("core_size"),
        F.ceil(F.count("*") / TILE).cast("int").alias("blocks"),
        F.ceil(F.sum(F.when(F.col("core"), 0).otherwise(1)) / TILE).cast("int").alias("slices"),
    )
    known = near.join(totals, "component")
    block, slice_ = (F.pmod(F.xxhash64(F.lit(n), "node"), F.col(c)).cast("int") for n, c in ((1, "blocks"), (2, "slices")))
    outer = known.where(~F.col("core")).withColumn("slice", slice_).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = known.where("slices > 0").withColumn("block", block).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    columns = ["component", "block", "slice", "node", "size", "vector", "core"]

    def tile(outers: pd.DataFrame, inner: pd.DataFrame) -> pd.DataFrame:
        if not len(outers) or not len(inner):
            return pd.DataFrame({"node": [], "links": []}, dtype=np.int64)
        weights, linked = linked_weight(units(outers["vector"]), units(inner["vector"]), inner["size"].to_numpy(), threshold)
        core = inner["core"].to_numpy(bool)
        back = linked[:, core].T.astype(np.int64) @ outers["size"].to_numpy()
        return pd.DataFrame({"node": np.r_[outers["node"], inner["node"][core]], "links": np.r_[weights, back]})

    by = ["component", "block", "slice"]
    renewed = every.select(*[F.col(c).alias(c) for c in columns])  # other attributes than those of the outer side
    tiles = outer.select(*columns).groupBy(*by).cogroup(renewed.groupBy(*by)).applyInPandas(tile, COUNTED)
    alike = known.where("core").select("node", F.col("core_size").alias("links"))
    return alike.unionByName(tiles).groupBy("node").agg(F.sum("links").alias("links"))


def links(df: DataFrame, threshold: float = 0.9, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``id, n_links, component_id`` of every row: the vectors linked to it, and the smallest id that links lead to."""
    if not 0 < threshold < 1:
        raise ValueError("the threshold is a cosine between 0 and 1")
    rows, nodes = classes(df, key, column)
    passes, hashes = plan(nodes.count(), threshold)
    keyed = hashed(nodes, passes, hashes)
    found = None
    for number in range(passes):
        one = written(sorted_pass(keyed, number, threshold), f"vector-pass-{number}").withColumn("pass", F.lit(number).cast("long"))
        found = one if found is None else found.unionByName(one)
    edges = found.where("b IS NOT NULL").select("a", "b").unionByName(across_ranges(found, threshold)).distinct()
    owners = written(components(edges, "a", "b"), "vector-components")
    members = owners.join(owners.groupBy("component").count(), "component")
    members = written(members.join(nodes.select("node", "size", "vector"), "node"), "vector-members")
    small, large = members.where(F.col("count") <= TILE), members.where(F.col("count") > TILE)
    counted = small_components(small, threshold)
    if not large.isEmpty():
        counted = counted.unionByName(large_components(large, threshold))
    least = members.select("node", "component").join(nodes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    linked = owners.join(counted, "node").join(least, "component").select("node", "links", "component_id")
    known = nodes.join(linked, "node", "left").select(
        "k1",
        "k2",
        (F.coalesce("links", "size") - 1).alias("n_links"),
        F.when(F.col("links").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
    )
    named = rows.where("k1 IS NOT NULL").join(known, ["k1", "k2"]).select("id", "n_links", "component_id")
    alone = rows.where("k1 IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return named.unionByName(alone)
