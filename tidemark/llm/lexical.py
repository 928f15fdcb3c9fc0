"""Ranked lexical search over a K2-treap of the term-document grid.

A cell of the grid holds the impact of a term (row) in a document (column): an
integer that grows with the term's count and falls with the document's length.
A document's score for an item is the sum over the item's terms, once each, of
the term's weight times the cell.

* Terms of the items are numbered; one pass over whole texts keeps, of each
  document, its number of terms and the counts of numbered ones (a table). The
  corpus figures (documents, terms, documents of each term) are counted from it.
* A task cuts its documents into ranges of ``RANGE_DOCS`` documents or ``RANGE_CELLS``
  cells, ordered by length, so that neighbours have like impacts. Each range
  becomes a K2-treap: the grid's quadtree, an empty quadrant being one 0 bit,
  children found by rank over the bits, every cell with the largest impact below it.
* An item descends by all its rows at once: a state is a range of documents with
  one cell for each row, bounded by the weighted sum of the cells' maxima. The states with
  the highest bounds are split first (``WIDTH`` at a time, as arrays) until no bound reaches
  the k-th best score, which a task carries from range to range.
* Tasks give their k best for each item; a window takes the k best of all.

Items are read in blocks of at most ``BLOCK_ITEMS`` items and about ``BLOCK_TERMS`` terms, each
searched in all documents, so what is broadcast doesn't grow with any table. One item's own distinct
terms must fit into a task.

Defined results: terms are maximal runs of ASCII letters, digits and characters
beyond ASCII, A-Z in lower case. A null or empty text has no term; it isn't counted and isn't found. Every
row is a document, rows that share a key too; equal scores go by ascending key, a null key last.
Every row of items is searched for itself, one without a known term finds nothing. Only the named columns are read, so others may have any name.
Texts of any length are read whole, ``PIECE`` bytes at a time.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, ship, utf8, written

RANGE_DOCS = 1 << 13
RANGE_CELLS = 1 << 20
BLOCK_ITEMS = 4096
BLOCK_TERMS = 1 << 20
#: States that are split together.
WIDTH = 128
PIECE = 1 << 20

#: Every byte outside terms becomes a space; bytes of characters beyond ASCII belong to terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

ITEM_TERMS = T.StructType(
    [T.StructField("number", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("terms", T.ArrayType(T.BinaryType()))]
)
FOUND = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.LongType()),
    ]
)


def pieces(text: bytes | None, size: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of those of about ``size`` bytes."""
    folded = (text or b"").translate(_FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + size)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(counts: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    norm = 100 - 90 + (90 * lengths * documents) // total
    return (1_000_000_000 * counts) // (1000 * counts + 8 * norm)


class Treap:
    """Quadtree of a grid in level order, as bits with ranks, and the maximum of every cell."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> None:
        side = int(max(rows.max(initial=0), columns.max(initial=0))) + 1
        self.height = max(1, (side - 1).bit_length())
        code = np.zeros(len(rows), np.int64)
        for bit in range(self.height):
            code |= ((columns >> bit & 1) | (rows >> bit & 1) << 1).astype(np.int64) << 2 * bit
        order = np.argsort(code, kind="stable")
        code, value = code[order], values[order]
        bits, maxima = [], []
        while True:  # from the leaves up
            maxima.append(value)
            if len(code) == 1 and len(maxima) > self.height:
                break
            above = code >> 2
            starts = np.flatnonzero(np.r_[True, above[1:] != above[:-1]])
            level = np.zeros((len(starts), 4), bool)
            level[np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(code)])), code & 3] = True
            bits.append(level.ravel())
            code, value = above[starts], np.maximum.reduceat(value, starts)
        # the root is cell 0; the cell of the r-th set bit is r
        self.bits = np.concatenate(bits[::-1])
        self.rank = np.cumsum(self.bits, dtype=np.int32)
        self.maxima = np.concatenate(maxima[::-1])

    def children(self, cells: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The cells in a quadrant of other cells; -1 where one is empty."""
        at = 4 * cells + quadrant
        return np.where((cells >= 0) & self.bits[at], self.rank[at], -1)

    def best(self, rows: np.ndarray, weights: np.ndarray, least: int, k: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores that are above 0 and not below ``least`` nor the k-th best here; more than k only on ties."""
        bound = np.array([int((weights * self.maxima[0]).sum())])
        depth, prefix, cells = np.zeros(1, np.int32), np.zeros(1, np.int32), np.zeros((1, len(rows)), np.int32)
        found_at, found = np.empty(0, np.int32), np.empty(0, np.int64)
        least = max(least, 1)
        while len(bound):
            if len(bound) > width:
                first = np.argpartition(-bound, width)
                now, later = first[:width], first[width:]
            else:
                now, later = np.arange(len(bound)), np.empty(0, np.int64)
            row_bit = (rows[None, :] >> (self.height - 1 - depth[now])[:, None] & 1) << 1
            split = [self.children(cells[now], row_bit + side) for side in (0, 1)]
            new_cells = np.concatenate(split)
            new_bound = (np.where(new_cells >= 0, self.maxima[new_cells], 0) * weights).sum(axis=1)
            new_prefix = np.concatenate([prefix[now] * 2, prefix[now] * 2 + 1])
            new_depth = np.tile(depth[now] + 1, 2)
            leaf = (new_depth == self.height) & (new_bound >= least)
            if leaf.any():
                found_at, found = np.r_[found_at, new_prefix[leaf]], np.r_[found, new_bound[leaf]]
                if len(found) >= k:
                    least = max(least, int(np.partition(found, len(found) - k)[len(found) - k]))
                    found_at, found = found_at[found >= least], found[found >= least]
            on = (new_depth < self.height) & (new_bound >= least)
            still = later[bound[later] >= least]
            bound, depth, prefix = (np.r_[a[still], b[on]] for a, b in ((bound, new_bound), (depth, new_depth), (prefix, new_prefix)))
            cells = np.concatenate([cells[still], new_cells[on]])
        return found_at, found


def item_terms(items: DataFrame, key: str = "item_id", column: str = "text") -> DataFrame:
    """``number, item_id, terms``: the distinct terms of each item, rows told apart by a number."""
    schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("terms", T.ArrayType(T.BinaryType()))])

    def each(batch: pa.RecordBatch) -> dict:
        terms = [sorted(set().union(*pieces(t, PIECE))) for t in utf8(batch.column("text"))]
        return {"item_id": batch.column("item_id"), "terms": terms}

    rows = items.select(F.col(key).cast("long").alias("item_id"), F.col(column).alias("text"))
    found = arrow_map(rows, each, schema).where(F.size("terms") > 0)
    return written(found.select(F.monotonically_increasing_id().alias("number"), "item_id", "terms"), "item-terms")


def postings(docs: DataFrame, numbers: dict[bytes, int], key: str = "doc_id", column: str = "text") -> DataFrame:
    """``doc_id, n, terms, counts`` of every document with a term: its number of terms, and its numbered ones."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
        ]
    )
    known = docs.sparkSession.sparkContext.broadcast(numbers)

    def each(batch: pa.RecordBatch) -> dict:
        lengths, terms, counts = [], [], []
        for text in utf8(batch.column("text")):
            n, here = 0, Counter()
            for listed in pieces(text, PIECE):
                n += len(listed)
                here.update(map(known.value.get, listed))
            here.pop(None, None)
            lengths.append(n)
            terms.append(list(here))
            counts.append(list(here.values()))
        return {"doc_id": batch.column("doc_id"), "n": lengths, "terms": terms, "counts": counts}

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("text"))
    return written(arrow_map(rows, each, schema).where("n > 0"), "postings")


def _ranges(batches: Iterator[pa.RecordBatch], most_docs: int, most_cells: int) -> Iterator[pa.Table]:
    """The rows of a task, in tables of so many rows, or so many cells and one row more."""
    held, docs, cells = [], 0, 0
    for batch in batches:
        sizes = np.diff(batch.column("terms").offsets.to_numpy())
        at = 0
        while at < batch.num_rows:
            room = int(np.searchsorted(np.cumsum(sizes[at:]), most_cells - cells)) + 1
            take = min(most_docs - docs, room, batch.num_rows - at)
            held.append(batch.slice(at, take))
            docs, cells, at = docs + take, cells + int(sizes[at : at + take].sum()), at + take
            if docs >= most_docs or cells >= most_cells:
                yield pa.Table.from_batches(held).combine_chunks()
                held, docs, cells = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _best_of(table: DataFrame, asked: list[tuple], weights: np.ndarray, documents: int, total: int, k: int) -> DataFrame:
    """The k best documents of every task for each item of ``asked`` (number, item_id, term numbers)."""
    ship(table.sparkSession)
    given = table.sparkSession.sparkContext.broadcast((asked, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        asked, weights = given.value
        best: list[list[tuple]] = [[] for _ in asked]  # (-score, key is null, key)
        for part in _ranges(batches, RANGE_DOCS, RANGE_CELLS):
            part = part.take(np.argsort(part.column("n").to_numpy(), kind="stable"))
            terms, keys = part.column("terms").combine_chunks(), part.column("doc_id").to_pylist()
            columns = np.repeat(np.arange(len(keys), dtype=np.int32), np.diff(terms.offsets.to_numpy()))
            rows = terms.flatten().to_numpy()
            if not len(rows):
                continue
            counts = part.column("counts").combine_chunks().flatten().to_numpy()
            treap = Treap(rows, columns, impacts(counts, part.column("n").to_numpy()[columns], documents, total))
            held = np.bincount(rows, minlength=len(weights)) > 0
            for i, (_, _, wanted) in enumerate(asked):
                wanted = wanted[held[wanted]]
                if len(wanted):
                    at, scores = treap.best(wanted, weights[wanted], -best[i][-1][0] if len(best[i]) == k else 0, k, WIDTH)
                    new = [(-s, keys[c] is None, keys[c] or 0) for c, s in zip(at.tolist(), scores.tolist())]
                    best[i] = sorted(best[i] + new)[:k]
        out = [(n, key, None if none else doc, -s) for (n, key, _), top in zip(asked, best) for s, none, doc in top]
        arrow = to_arrow_schema(FOUND)
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return table.mapInArrow(run, FOUND)


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", item_key: str = "item_id", column: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents with the highest scores above 0 for each row of ``items``."""
    spark = docs.sparkSession
    listed = item_terms(items, item_key, column)
    n_items, n_terms = listed.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    n_blocks = max(math.ceil(n_items / BLOCK_ITEMS), math.ceil(n_terms / BLOCK_TERMS))
    parts = []
    for block in range(n_blocks):
        mine = listed.where(F.pmod(F.xxhash64("number"), F.lit(n_blocks)) == block).collect()
        numbers: dict[bytes, int] = {}
        asked = [(r.number, r.item_id, np.array([numbers.setdefault(bytes(t), len(numbers)) for t in r.terms], np.int32)) for r in mine]
        table = postings(docs, numbers, key, column)
        documents, total = table.agg(F.count("*"), F.sum("n")).first()
        if documents:
            held = table.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
            weights = np.zeros(len(numbers), np.int64)
            for r in held:
                weights[r.term] = weight(documents, r["count"])
            parts.append(written(_best_of(table, asked, weights, documents, total, k), "ranked"))
    found = spark.createDataFrame([], FOUND)
    for part in parts:
        found = found.unionByName(part)
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
