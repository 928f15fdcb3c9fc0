"""The trie of conversation prefixes, in balanced parentheses per shard.

A node is a distinct sequence of first turns, its members the conversations
that start with it. A turn is known by 128 bits of the SHA-256 of its role and text;
no text is shuffled.

* Turns are numbered by one range shuffle on (conversation, turn); a task counts
  its own, and a conversation that runs over several ranges starts each of them at the sum of those before
  (one number for each task).
* Paths (turn digests in one value) are ordered lexicographically by another. A shard is
  a run of at most ``SHARD_PATHS`` of them or ``SHARD_TURNS`` turns. Its trie is written as
  balanced parentheses in one walk over the paths. Blocks of the running excess with their minima, and a
  tree of these minima, give ``findclose`` for all nodes at once; a close delimits the subtree. The
  number of leaf pairs ``()`` before a place gives leaves, cumulative arrays over nodes in preorder give savings,
  and the rows on which a parenthesis opens and closes give members.
* As paths are in order, only a shard's first and last path can pass nodes of
  other shards. These spines are merged by key: members and partial sums add up, and what a node counts once goes to it and the
  nodes above it. All other nodes are final in their shard.
* Conversations that end at a node come in order of their ids, so a spine's ids are
  hashed from sorted chunks in a stream.

A path longer than ``SPAN`` turns goes on in a further span, which starts at the node where the one before ended and
is known by a polynomial hash of all digests before (running sums of one number for each span). Spans that start
with several members make a layer of tries, worked off from the deepest, each handing the sums of its roots to the layer above; a span with a single
member is a chain and needs no trie. So nothing holds a whole conversation, and rounds grow with the depth that
conversations share.

Defined results: turns are ordered by turn (null first), equal ones by role, the
first 64 characters of the text, and digest; repeated rows are turns of their own. Null role or text counts as empty.
Rows without a conv_id belong to no conversation and are left out. Without conversations there is no node, not even the root.
Other columns aren't read. Texts of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, ship, written

SHARD_PATHS = 1 << 16
SHARD_TURNS = 1 << 19
SPAN = 256
DIGEST = 16
BLOCK = 64
NO_ENDS = hashlib.sha256().hexdigest()
#: A Mersenne prime and two bases of the hash that names the start of a span.
PRIME = (1 << 61) - 1
BASES = (0x1B873593CC9E2D51 % PRIME, 0x27D4EB2F165667C5 % PRIME)


# Turns


def numbered(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, pos, digest, size`` of every turn: its place from 0, its digest, the bytes of its text."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    whole = F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said)
    turns = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        by.alias("role"),
        F.substring(said, 1, 64).alias("head"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, DIGEST).alias("digest"),
        F.octet_length(said).cast("long").alias("size"),
    )
    order = ["conv_id", "turn", "role", "head", "digest"]
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "size")
    schema = T.StructType([T.StructField("pid", T.LongType()), T.StructField("local", T.LongType()), *ordered.schema.fields])
    ship(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, owner, before = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            if not len(ids):
                continue
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            local = np.arange(len(ids)) - np.repeat(starts, np.diff(np.r_[starts, len(ids)]))
            if ids[0] == owner:
                local[: starts[1] if len(starts) > 1 else len(ids)] += before
            owner, before = ids[-1], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), pid)), pa.array(local), *batch.columns], names=["pid", "local", *batch.schema.names]
            )

    found = written(ordered.mapInArrow(count, schema), "turns")
    ends = found.groupBy("pid").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "local")).alias("last"))
    offsets, owner, before = [], None, 0
    for r in ends.orderBy("pid").toLocalIterator():
        if r["first"] == owner:
            offsets.append((r["pid"], owner, before))
        before = r["last"]["local"] + 1 + (before if r["first"] == owner == r["last"]["conv_id"] else 0)
        owner = r["last"]["conv_id"]
    if not offsets:
        return found.select("conv_id", F.col("local").alias("pos"), "digest", "size")
    carried = df.sparkSession.createDataFrame(offsets, "pid long, conv_id long, before long")  # a row for each task at most
    joined = found.join(F.broadcast(carried), ["pid", "conv_id"], "left")
    return joined.select("conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "size")


# Balanced parentheses


class Parens:
    """A balanced sequence with range min-max blocks over its excess and ranks of its leaf pairs."""

    def __init__(self, opens: np.ndarray) -> None:
        self.opens = opens
        excess = np.cumsum(np.where(opens, 1, -1))
        top = np.iinfo(np.int64).max
        padded = np.full(-(-len(opens) // BLOCK) * BLOCK, top)
        padded[: len(opens)] = excess
        self.blocks = padded.reshape(-1, BLOCK)
        self.levels = [self.blocks.min(axis=1)]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            if len(low) % 2:
                low = self.levels[-1] = np.r_[low, top]
            self.levels.append(low.reshape(-1, 2).min(axis=1))
        leaf = np.zeros(len(opens) + 1, np.int64)
        leaf[1:-1] = opens[:-1] & ~opens[1:]
        self.leaves_before = np.cumsum(leaf)  # pairs that open before a place

    def _first(self, block: np.ndarray, want: np.ndarray, after: np.ndarray) -> np.ndarray:
        """In each block the first place beyond ``after`` whose excess is not above ``want``; -1 if none is."""
        hit = (self.blocks[block] <= want[:, None]) & (np.arange(BLOCK) > after[:, None])
        return np.where(hit.any(axis=1), block * BLOCK + hit.argmax(axis=1), -1)

    def findclose(self, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), np.int64)
        for low in range(0, len(at), 1 << 14):
            out[low : low + (1 << 14)] = self._findclose(at[low : low + (1 << 14)])
        return out

    def _findclose(self, at: np.ndarray) -> np.ndarray:
        want = self.blocks.ravel()[at] - 1
        out = self._first(at // BLOCK, want, at % BLOCK)
        rest = np.flatnonzero(out < 0)
        want, node = want[rest], at[rest] // BLOCK
        level = np.full(len(rest), -1)
        for height, minima in enumerate(self.levels[:-1]):  # up, until a right neighbour goes low enough
            right = (level < 0) & (node % 2 == 0)
            right[right] = minima[node[right] + 1] <= want[right]
            node[right] += 1
            level[right] = height
            node[level < 0] >>= 1
        for height in range(len(self.levels) - 1, 0, -1):  # and down to the first such block
            down = level == height
            child = 2 * node[down]
            node[down] = child + (self.levels[height - 1][child] > want[down])
            level[down] -= 1
        out[rest] = self._first(node, want, np.full(len(rest), -1))
        return out


def shared_turns(one: bytes, other: bytes) -> int:
    most = min(len(one), len(other))
    if one[:most] == other[:most]:
        return most // DIGEST
    return next(d for d in range(0, most, DIGEST) if one[d : d + DIGEST] != other[d : d + DIGEST]) // DIGEST


NODES = T.StructType(
    [
        T.StructField("kind", T.StringType()),  # node, spine, or ends
        *(T.StructField(n, T.BinaryType()) for n in ("key", "parent_key")),
        T.StructField("above", T.ArrayType(T.BinaryType())),
        *(
            T.StructField(n, T.LongType())
            for n in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "bytes")
        ),
        *(T.StructField(n, T.LongType()) for n in ("below_children", "below_leaves", "below_saved")),
        T.StructField("ends_sha256", T.StringType()),
        T.StructField("chunk", T.BinaryType()),
    ]
)


def shard(rows: dict[str, list], above: int) -> list[dict]:
    """The nodes of a run of paths in order, their starts at depth ``above``; see ``layer_nodes`` for the columns."""
    opens: list[bool] = []
    on_row: list[int] = []
    depth: list[int] = []
    parent: list[int] = []
    size: list[int] = []
    first_row: list[int] = []
    stack: list[int] = []
    end_node: list[int] = []
    start, path = None, b""

    def close(keep: int, row: int) -> None:
        n = len(stack) - keep
        opens.extend([False] * n)
        on_row.extend([row] * n)
        del stack[keep:]

    def open_(at_depth: int, bytes_: int, row: int) -> None:
        parent.append(stack[-1] if stack else -1)
        stack.append(len(depth))
        depth.append(at_depth)
        size.append(bytes_)
        first_row.append(row)
        opens.append(True)
        on_row.append(row)

    for row, (own_start, own, sizes) in enumerate(zip(rows["start"], rows["path"], rows["sizes"])):
        if own_start != start:
            close(0, row)
            open_(0, 0, row)
            shared = 0
        else:
            shared = shared_turns(path, own)
            close(shared + 1, row)
        for d in range(shared, len(own) // DIGEST):
            open_(d + 1, sizes[d], row)
        start, path = own_start, own
        end_node.append(stack[-1])
    spine = np.zeros(len(depth), bool)
    spine[stack] = True
    close(0, len(end_node))
    first = end_node[0]
    while first >= 0:
        spine[first] = True
        first = parent[first]

    parens = Parens(np.array(opens))
    at = np.flatnonzero(parens.opens)
    shut = parens.findclose(at)
    closed = np.array(on_row)[shut]
    depth_, parent_, size_ = np.array(depth), np.array(parent), np.array(size, np.int64)
    opened = np.array(first_row)
    members = closed - opened
    convs = np.append(np.array(rows["conv_id"], np.int64), 0)
    least = np.minimum.reduceat(convs, np.stack([opened, closed], axis=1).ravel())[::2]
    until = np.arange(len(at)) + (shut - at + 1) // 2  # the subtree in preorder

    below = np.zeros((len(at), 3), np.int64)
    next_key: dict[int, bytes] = {}
    goes_on = set()
    ends: dict[int, list[int]] = {}
    for row, node in enumerate(end_node):
        if rows["next"][row] is not None:
            next_key[node] = rows["next"][row]
        if rows["last"][row]:
            ends.setdefault(node, []).append(rows["conv_id"][row])
        else:
            goes_on.add(node)
            below[node] = rows["below_children"][row], rows["below_leaves"][row], rows["below_saved"][row]

    def over_subtree(weights: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(weights)]
        return total[until] - total[:-1]

    is_leaf = parens.leaves_before[at + 1] > parens.leaves_before[at]
    replaced = np.where(spine, 0, np.where(below[:, 0] > 0, below[:, 1], 1)) - 1
    leaves = parens.leaves_before[shut] - parens.leaves_before[at] + over_subtree(np.where(is_leaf, replaced, 0))
    saved = over_subtree(size_ * members - np.where(spine, 0, size_ - below[:, 2]))
    inner = (parent_ >= 0) & ~spine
    children = np.bincount(parent_[inner], minlength=len(at)) + np.where(spine, 0, below[:, 0])

    def key(node: int) -> bytes:
        row = first_row[node]
        if depth[node] == 0:
            return rows["start"][row]
        if node in next_key:
            return next_key[node]
        prefix = rows["path"][row][: depth[node] * DIGEST]
        return hashlib.blake2b(rows["start"][row] + prefix, digest_size=DIGEST).digest()

    spine_keys = {n: key(n) for n in np.flatnonzero(spine).tolist()}
    out = []
    for node in range(len(at)):
        up = parent[node]
        in_spine = node in spine_keys
        row = {
            "kind": "spine" if in_spine else "node",
            "depth": above + depth[node],
            "conv_id": int(least[node]),
            "n_convs": int(members[node]),
            "n_children": int(children[node]),
            "n_leaves": int(leaves[node]),
            "saved_tokens": int(saved[node]),
        }
        if in_spine or node in goes_on or depth[node] == 0:
            row["key"] = spine_keys[node] if in_spine else key(node)
        if up >= 0:
            if up in spine_keys or (above and depth[node] == 1):
                row["parent_key"] = spine_keys[up] if up in spine_keys else key(up)
            else:
                row["parent_conv_id"] = int(least[up])
        if in_spine:
            line = [node]
            while parent[line[-1]] >= 0:
                line.append(parent[line[-1]])
            row["above"] = [spine_keys[n] for n in line]
            row["bytes"] = size[node]
            row["below_children"], row["below_leaves"], row["below_saved"] = below[node].tolist()
        else:
            row["ends_sha256"] = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest() if node in ends else NO_ENDS
        out.append(row)
    for node, ids in ends.items():
        if node in spine_keys:
            out.append({"kind": "ends", "key": spine_keys[node], "conv_id": ids[0], "chunk": ",".join(map(str, ids)).encode()})
    return out


def hashed_ends(chunks: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of sorted chunks of ids, one chunk in memory at a time."""
    ordered = chunks.select("key", "conv_id", "chunk").repartition("key").sortWithinPartitions("key", "conv_id").select("key", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

        key, state = None, None
        for batch in batches:
            for own, chunk in zip(batch.column("key"), batch.column("chunk")):
                if own.as_py() != key:
                    if state is not None:
                        yield done()
                    key, state = own.as_py(), hashlib.sha256(chunk.as_py())
                else:
                    state.update(b"," + chunk.as_py())
        if state is not None:
            yield done()

    return ordered.mapInArrow(run, "key binary, ends_sha256 string")


def layer_nodes(spans: DataFrame, layer: int) -> DataFrame:
    """The nodes that paths pass between one span's start and its end.

    ``spans``: start, path, sizes, conv_id, next (the key at a full span's end), last, below_* (what the root of the next span
    hands over). ``key`` is given where others may refer to a node. Either ``parent_conv_id`` or ``parent_key`` names the parent.
    """
    ship(spans.sparkSession)
    columns = ["start", "path", "sizes", "conv_id", "next", "last", "below_children", "below_leaves", "below_saved"]
    order = ["start", "path", "conv_id"]
    ordered = spans.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(NODES)
        held: dict[str, list] = {c: [] for c in columns}
        turns = 0

        def flush() -> Iterator[pa.RecordBatch]:
            found = shard(held, layer * SPAN)
            for low in range(0, len(found), 1 << 14):
                yield pa.RecordBatch.from_pylist(found[low : low + (1 << 14)], schema=arrow)

        for batch in batches:
            listed = batch.to_pydict()
            low = 0
            for i, path in enumerate(listed["path"]):
                turns += len(path) // DIGEST
                if len(held["path"]) + i + 1 - low >= SHARD_PATHS or turns >= SHARD_TURNS:
                    for c in columns:
                        held[c] += listed[c][low : i + 1]
                    yield from flush()
                    held, low, turns = {c: [] for c in columns}, i + 1, 0
            for c in columns:
                held[c] += listed[c][low:]
        if held["path"]:
            yield from flush()

    found = written(ordered.mapInArrow(run, NODES), f"trie-layer-{layer}")
    return found.where("kind = 'node'").drop("kind", "above", "bytes", "chunk").unionByName(merged_spines(found))


def merged_spines(found: DataFrame) -> DataFrame:
    """The nodes of spines, each once."""
    spine = found.where("kind = 'spine'")
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    highest = ["depth", "parent_key", "bytes", "below_children", "below_leaves", "below_saved"]
    once = spine.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("above").alias("above"),
        *(F.sum(c).alias(c) for c in sums),
        *(F.max(c).alias(c) for c in highest),
    )
    once = written(once, "trie-spines")
    kids = once.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("kids"))
    known = once.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)) + F.col("below_children"))
    own_leaves = F.when(F.col("below_children") > 0, F.col("below_leaves")).otherwise(F.when(F.col("n_children") == 0, 1).otherwise(0))
    own = known.select(
        F.explode("above").alias("key"), own_leaves.alias("own_leaves"), (F.col("below_saved") - F.col("bytes")).alias("own_saved")
    )
    handed = own.groupBy("key").agg(F.sum("own_leaves").alias("own_leaves"), F.sum("own_saved").alias("own_saved"))
    ends = hashed_ends(found.where("kind = 'ends'"))
    whole = known.join(handed, "key").join(ends, "key", "left")
    new = {
        "n_leaves": F.col("n_leaves") + F.col("own_leaves"),
        "saved_tokens": F.col("saved_tokens") + F.col("own_saved"),
        "ends_sha256": F.coalesce("ends_sha256", F.lit(NO_ENDS)),
        "parent_conv_id": F.lit(None).cast("long"),
    }
    left_out = {"kind", "above", "bytes", "chunk"}
    return whole.select(*[new.get(c, F.col(c)).alias(c) for c in NODES.fieldNames() if c not in left_out])


# Spans


def _named_spans(spans: DataFrame) -> DataFrame:
    """``start`` and ``next`` of spans by the running polynomial hash of their conversation."""
    kept = spans.columns
    both = T.StructType([*spans.schema.fields, T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])

    def each(batch: pa.RecordBatch) -> dict:
        sums: list[list[int]] = [[], []]
        for span, path in zip(batch.column("span").to_pylist(), batch.column("path").to_pylist()):
            digests = [int.from_bytes(path[d : d + DIGEST]) % PRIME for d in range(0, len(path), DIGEST)]
            for base, out in zip(BASES, sums):
                total = 0
                for digest in reversed(digests):
                    total = (total * base + digest) % PRIME
                out.append(total * pow(base, span * SPAN + 1, PRIME) % PRIME)
        return {c: batch.column(c) for c in kept} | {"h1": sums[0], "h2": sums[1]}

    until = Window.partitionBy("conv_id").orderBy("span")

    def name(before: bool) -> Column:
        parts = []
        for h in ("h1", "h2"):
            running = F.sum(F.col(h).cast("decimal(38,0)")).over(until) - (F.col(h) if before else F.lit(0))
            parts.append(F.lpad(F.hex(F.pmod(running, F.lit(PRIME).cast("decimal(38,0)")).cast("long")), 16, "0"))
        return F.unhex(F.concat(*parts))

    named = arrow_map(spans, each, both)
    # names are given where paths are left out, so the window holds one small row for each span
    names = named.select(
        "conv_id", "span", name(True).alias("start"), name(False).alias("next"), F.lead("span").over(until).isNull().alias("last")
    )
    full = F.size("sizes") == SPAN
    joined = spans.join(names, ["conv_id", "span"])
    return written(joined.withColumn("next", F.when(full, F.col("next"))), "trie-spans")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of paths ``conv_id, depth (from 1), digest, size``; every row of ``convs`` (distinct conv_id) has a path, maybe empty.

    Returns conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    turn = F.struct("depth", "digest", "size")
    empty = convs.select("conv_id", F.lit(0).cast("long").alias("span"), F.lit(None).cast(turns.select(turn.alias("t")).schema["t"].dataType).alias("turn"))
    spread = turns.select("conv_id", F.expr(f"(depth - 1) DIV {SPAN}").alias("span"), turn.alias("turn"))
    listed = spread.unionByName(empty).groupBy("conv_id", "span").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    spans = written(listed.select("conv_id", "span", path.alias("path"), F.col("turns.size").alias("sizes")), "trie-paths")
    deepest = spans.agg(F.max("span")).first()[0]
    none = F.lit(0).cast("long")
    if not deepest:
        single = spans.select(
            F.lit(b"\0" * DIGEST).alias("start"), "path", "sizes", "conv_id", F.lit(None).cast("binary").alias("next"), F.lit(True).alias("last"),
            none.alias("below_children"), none.alias("below_leaves"), none.alias("below_saved"),
        )
        nodes = layer_nodes(single, 0)
    else:
        nodes = _layered(_named_spans(spans))
    named = nodes.where("key IS NOT NULL").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("named"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    asked = nodes.where("parent_key IS NOT NULL").drop("parent_conv_id").join(named, "parent_key", "left")
    return nodes.where("parent_key IS NULL").select(*columns).unionByName(asked.withColumnRenamed("named", "parent_conv_id").select(*columns))


def _layered(spans: DataFrame) -> DataFrame:
    """Nodes of paths of several spans, layer by layer from the deepest that conversations share."""
    starts = spans.where("span > 0").groupBy("span", "start").agg(F.count("*").alias("n"))
    starts = written(starts, "trie-starts")
    shared = starts.where("n > 1")
    deepest = shared.agg(F.max("span")).first()[0] or 0
    single = spans.join(starts.where("n = 1").select("span", "start"), ["span", "start"])
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    final = F.col("last") & (F.col("at") == F.size("sizes") - 1)
    ended = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    chain = single.select("*", F.posexplode("sizes").alias("at", "bytes")).select(
        F.when(F.col("at") == SPAN - 1, F.col("next")).alias("key"),
        F.when(F.col("at") == 0, F.col("start")).alias("parent_key"),
        (F.col("span") * SPAN + F.col("at") + 1).alias("depth"),
        "conv_id",
        F.when(F.col("at") > 0, F.col("conv_id")).alias("parent_conv_id"),
        one.alias("n_convs"),
        F.when(final, none).otherwise(one).alias("n_children"),
        one.alias("n_leaves"),
        none.alias("saved_tokens"),
        F.when(final, ended).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    nodes, roots = [chain], None
    for layer in range(deepest, -1, -1):
        mine = spans.where(F.col("span") == layer)
        if layer:
            mine = mine.join(shared.where(F.col("span") == layer).select("start"), "start", "left_semi")
        alone = starts.where((F.col("span") == layer + 1) & (F.col("n") == 1))
        handed = alone.select(F.col("start").alias("next"), one.alias("below_children"), one.alias("below_leaves"), none.alias("below_saved"))
        if roots is not None:
            handed = handed.unionByName(
                roots.select(
                    F.col("key").alias("next"),
                    F.col("n_children").alias("below_children"),
                    F.col("n_leaves").alias("below_leaves"),
                    F.col("saved_tokens").alias("below_saved"),
                )
            )
        filled = mine.join(handed, "next", "left").fillna(0, ["below_children", "below_leaves", "below_saved"])
        found = written(layer_nodes(filled, layer), f"trie-nodes-{layer}")
        roots = found.where(F.col("depth") == layer * SPAN) if layer else None
        nodes.append(found.where(F.col("depth") > layer * SPAN) if layer else found)
    columns = chain.columns
    out = nodes[0]
    for part in nodes[1:]:
        out = out.unionByName(part.select(*columns))
    return out


def rebuilt(turns: DataFrame, period: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that open like the first of their group of ``period`` ids: ``conv_id, depth, digest, size``, and all ids.

    The first h turns are those of conversation c - c % period, h = crc32(c) % most; its own follow after its first h.
    ``turns`` is the outcome of ``numbered``.
    """
    base = F.col("conv_id") - F.col("conv_id") % period
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = turns.groupBy("conv_id").agg(F.least(F.count("*"), F.lit(most - 1)).alias("n"))
    convs = written(convs.select("conv_id", "n", head.alias("h"), base.alias("base")), "conversations")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    known = written(convs.join(bases, "base", "left").select("conv_id", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("given")), "openings")
    own = turns.join(known, "conv_id").where("pos >= h").select("conv_id", (F.col("given") + F.col("pos") - F.col("h") + 1).alias("depth"), "digest", "size")
    step = F.explode(F.sequence(F.lit(-(period - 1)).cast("long"), F.lit(period - 1).cast("long")))
    lent = turns.where((F.col("pos") < most - 1) & (F.col("conv_id") % period == 0)).select(F.col("conv_id").alias("from"), "pos", "digest", "size", step.alias("step"))
    lent = lent.withColumn("conv_id", F.expr("try_add(from, step)")).where(base == F.col("from"))
    given = lent.join(known, "conv_id").where("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "digest", "size")
    return own.unionByName(given), known.select("conv_id")
