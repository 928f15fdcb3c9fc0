"""Line dedup by an exact set-similarity join over all lines of all documents.

A line is its words, A-Z lowered, repeats numbered (so "a a" is not "a"). A line
goes if any line before it has a Jaccard similarity of ``THRESHOLD`` or more with
it. Lines are ordered by document key, then by place. Lines without words stay.

* Equal lines are met by their 128-bit hash. One table holds each distinct line, at the
  first of its places (tasks leave out their own copies, so a line on a third of all rows is a
  row for each ``SENT_BYTES``), and the places of copies. All further steps read the former, so copies never meet.
* Words are ordered by rarity among distinct lines. Their counts are kept in counters, a sketch
  that grows with the number of words up to ``MOST_COUNTERS``; words that share a counter rank by
  their own hash. Any order that all lines share gives exact results.
* A line of more than ``SPLIT`` words is dealt to parts by a hash of its words. If two lines are similar, two of their
  parts are (not all parts can differ by more than the whole does), so parts meet in place of lines, and no filter has to
  grow with a line. A line that others with more parts may match is dealt that way, too.
* Prefix filter: similar lines share one of their ``n - ceil(t n) + 1`` rarest
  words, so lines meet by those (but not by words that occur once). Length and
  positional filters follow, and a bit parity of the words bounds how many differ; long lines
  carry a wider one, as the bound has to grow with the line.
* The lines that share a word are read in their order, each held against those
  before it, up to the first that looks very near. A line sends on ``LIKELIEST`` candidates for
  each of its words at most. So rows grow with the lines, however many are alike.
* Candidates are verified on their words, the likeliest first. A line that none of them matches although others may is open. Open lines meet once
  more, by parities wide enough (``WIDE`` bits a word) to leave hardly any false candidate; what is open even then is verified against
  all of its candidates.
* A task holds ``HELD`` lines of one word at most. The lines of a word that has
  more are dealt to blocks, and each two blocks meet as a list of their own.

Words are hashed to 32 bits until they are verified; words that fall together
can only bring more candidates, never lose one. A line is no candidate of its own.

Defined results: null texts stay null. Rows that repeat a key and a text are one
document, and get the same result; other rows of one key go in the order of a
hash of their text. Rows without a key come last, ordered by such a hash. A document none of whose lines
stays has an empty text. Lines are parted by "\\n" only, and are kept as they are. Columns other than key and text are carried
in one struct, so they may have any name but ``n_lines`` and ``n_removed``, which are replaced.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SLICE_ROWS, arrow_map, ship, utf8, written

#: Similarity from which a line matches, as a fraction.
THRESHOLD = (4, 5)
LEAST_COUNTERS, MOST_COUNTERS = 1 << 16, 1 << 24
#: Counters that travel together.
BLOCK = 1 << 16
#: Lines that share a word and are held by one task at most.
HELD = 1 << 20
#: Candidates that a line sends on for one word.
LIKELIEST = 16
#: Keys of a semi join (two longs) that are broadcast at most, some 64 MB.
BROADCAST_ROWS = 1 << 20
#: Rows whose lists are worked off together.
MET_ROWS = 1 << 18
#: Pairs that are looked at together, once fewer lines than that go on.
STEP_PAIRS = 1 << 15
#: A line's number and the hash of its text share a long.
LINE_BITS, TEXT_BITS = 28, 35
#: A prefix word, the length of its line and its place share a long; longer lines are not filtered.
SIZE_BITS = 16
LONGEST = (1 << SIZE_BITS) - 1
#: Steps of length from a number of words to its double, and how far similar lines are apart at most.
LENGTHS, SIMILAR_LENGTHS = 16, 6

#: The parity of a line's words has two longs. A word turns one of ``PARITY_BITS`` bits,
#: which tell long lines apart, and up to three of the 16 bits above them: one word put in
#: the place of another seldom leaves all of these as they were, however short the line.
PARITY_BITS = 112
SINGLE = 48
#: Words of a line that meets as it is.
SPLIT = 512
#: Wide parities: (lines of more words, bits a word at least, bits at most), of first and second meeting.
NARROW_LINES = (160, 1.5, 1 << 10)
WIDE = (0, 8, 1 << 15)
#: Bytes of text that are parted into lines at once (or one text).
TEXT_BYTES = 1 << 20
#: Bytes of lines that are sent on (and received) together, and buckets they are dealt to.
SENT_BYTES = 1 << 24
LINE_BUCKETS = 1 << 11
#: Bytes of a word whose hash is looked up; longer words are hashed one by one.
WORD_BYTES = 24
#: Rows of a bucket of prefix words, on the average, and buckets at least and at most.
BUCKET_ROWS = 1 << 16
BUCKETS = 1 << 9, 1 << 14

_MIX = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def _doc(key: str) -> Column:
    """The key, with NULL as the last."""
    return F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1))


def _text_hash(column: str) -> Column:
    """What tells texts of one key apart."""
    return F.xxhash64(column).bitwiseAND(F.lit((1 << TEXT_BITS) - 1))


def keyed(docs: DataFrame, key: str, column: str) -> DataFrame:
    return docs.select(_doc(key).alias("doc"), _text_hash(column).alias("text_hash"), F.col(column).alias("text"))


def lines_of(docs: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.BinaryArray]:
    """Document, identity (text hash and line number), number of words and words (a space apart) of every line that has words."""
    texts = [text or b"" for text in utf8(docs.column("text"))]
    text = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    gap = _IS_SPACE[text]
    begins = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
    ends = np.flatnonzero(gap & np.r_[False, ~gap[:-1]])
    breaks = np.flatnonzero(text == ord("\n"))
    line = np.searchsorted(breaks, begins)
    first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]]) if len(line) else np.empty(0, np.int64)
    # of each run of white space inside a line one byte stays
    keep = ~gap
    keep[np.delete(ends, first - 1)] = True
    stay = text[keep]
    stay[gap[keep]] = ord(" ")
    n = np.diff(np.r_[first, len(line)])
    size = np.add.reduceat(ends - begins, first) + n - 1 if len(first) else n
    offsets = np.r_[0, np.cumsum(size)].astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(stay)])
    at = np.cumsum([0, *map(len, texts)])[:-1] + np.arange(len(texts))
    head = np.searchsorted(breaks, at)
    doc = np.searchsorted(head, line[first], "right") - 1
    identity = docs.column("text_hash").to_numpy()[doc] << LINE_BITS | line[first] - head[doc]
    return docs.column("doc").to_numpy()[doc], identity, n, words


def slices(docs: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of up to ``TEXT_BYTES`` of text, or one row."""
    size = docs.column("text").cast(pa.binary())
    ends = np.cumsum([len(text or b"") for text in size.to_pylist()])
    at = 0
    while at < docs.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT_BYTES, "right")))
        yield docs.slice(at, end - at)
        at = end


#: A CRC is linear: what each byte adds is looked up by how far it is from its word's end, what the length adds by the length.
_NULLS = np.array([zlib.crc32(bytes(k)) for k in range(WORD_BYTES + 1)], np.uint32)
_ADDS = np.array([[zlib.crc32(bytes([b, *bytes(k)])) for b in range(256)] for k in range(WORD_BYTES)], np.uint32) ^ _NULLS[1:, None]


def hashed(lines: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of the words of lines (a space apart), as ``hashes`` gives them, and the number of words of each."""
    if not len(lines):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset : lines.offset + len(lines) + 1].astype(np.int64)
    text = np.frombuffer(lines.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    gap = np.zeros(len(text) + 1, bool)
    gap[:-1] = text == ord(" ")
    begin = np.r_[False, gap[:-1]]
    begin[offsets[:-1]] = True
    gap[offsets[1:]] = True
    begins, ends = np.flatnonzero(begin), np.flatnonzero(gap)
    length = ends - begins
    short = np.minimum(length, WORD_BYTES).astype(np.uint8)
    order = np.argsort(short, kind="stable")[::-1]
    last = ends[order] - 1
    found = _NULLS[short[order]]
    counts = len(order) - np.cumsum(np.bincount(short, minlength=WORD_BYTES + 1))
    for k in range(WORD_BYTES):
        some = int(counts[k])
        if not some:
            break
        found[:some] ^= _ADDS[k].take(text.take(last[:some] - k))
    out = np.empty(len(order), np.int64)
    out[order] = found
    for at in np.flatnonzero(length > WORD_BYTES).tolist():
        out[at] = zlib.crc32(text[begins[at] : ends[at]])
    return out, np.diff(np.searchsorted(begins, offsets))


def hashes(words: list[list[bytes]]) -> np.ndarray:
    flat = chain.from_iterable(words)
    return np.fromiter(map(zlib.crc32, flat), np.int64, sum(map(len, words)))


# Counts of all words


def gathered(
    df: DataFrame,
    places: Callable[[pa.RecordBatch], np.ndarray],
    size: int,
    finish: Callable[[np.ndarray], np.ndarray],
) -> np.ndarray:
    """How often ``places`` names each of ``size`` entries, over all rows, through ``finish`` (to a byte each).

    A task counts in one array and hands it on by blocks; blocks are added up by
    tasks, so the driver gets what ``finish`` makes of each.
    """
    ship(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS * 16):
                np.add.at(counts, places(batch.slice(at, SLICE_ROWS * 16)), np.uint32(1))
        for block in range(0, size, BLOCK):
            part = counts[block : block + BLOCK]
            held = np.flatnonzero(part)
            if len(held):
                packed = held.astype(np.uint16).tobytes() + part[held].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([block // BLOCK], pa.int64()), pa.array([packed], pa.binary())], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                n = len(part) // 6
                if block not in held:
                    held[block] = np.zeros(BLOCK, np.uint64)
                held[block][np.frombuffer(part, np.uint16, n)] += np.frombuffer(part, np.uint32, n, 2 * n)
        for block, counts in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([finish(counts).tobytes()], pa.binary())],
                names=["block", "counts"],
            )

    schema = "block long, counts binary"
    blocks = df.mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect()
    out = np.zeros(size, np.uint8)
    for row in blocks:
        out[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["counts"], np.uint8)
    return out


def rarity_class(counts: np.ndarray) -> np.ndarray:
    """A byte that grows with the count: 0 for none, 1 for one, 7 for two."""
    counts = np.asarray(counts, np.float64)
    classes = np.minimum(255, 1 + np.floor(6 * np.log2(np.maximum(counts, 1))))
    return np.where(counts > 0, classes, 0).astype(np.uint8)


ONCE = 1


def rarity(lines: DataFrame) -> np.ndarray:
    """The rarity class of each counter: words are counted by hash over all distinct lines."""
    words = lines.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    size = min(max(LEAST_COUNTERS, 1 << max(words // 4, 1).bit_length()), MOST_COUNTERS)

    def places(batch: pa.RecordBatch) -> np.ndarray:
        return hashed(batch.column(0))[0] & (size - 1)

    return gathered(lines.select("words"), places, size, rarity_class)


# The join


def ordered(words: list[list[bytes]], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes and repeat numbers of lines, each line's rarest first, and where each line begins."""
    return by_rarity(hashes(words), np.fromiter(map(len, words), np.int64, len(words)), classes)


def by_rarity(raw: np.ndarray, lengths: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``ordered`` of hashes and the number of words of each line."""
    keys = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths) << 40
    keys |= classes[raw & (len(classes) - 1)].astype(np.int64) << 32
    keys |= raw
    keys.sort()
    places = np.arange(len(keys))
    first = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.empty(0, bool)
    repeats = places - np.maximum.accumulate(np.where(first, places, 0))
    return keys & 0xFFFFFFFF, repeats, np.concatenate(([0], np.cumsum(lengths)))


def prefix_length(n: np.ndarray) -> np.ndarray:
    top, bottom = THRESHOLD
    return n - -(-top * n // bottom) + 1


LINE = T.StructType([T.StructField("doc", T.LongType()), T.StructField("line", T.LongType())])
PLACED = T.StructType([*LINE.fields, T.StructField("n", T.LongType()), T.StructField("words", T.BinaryType())])
#: Lines on their way: those of one bucket of line hashes (hash, place, number of words and bytes by row, and the words), and copies known as such.
SENT = T.StructType([T.StructField("bucket", T.LongType()), *(T.StructField(c, T.BinaryType()) for c in ("rows", "words", "copies"))])
PREFIX = T.StructType(
    [
        T.StructField("pack", T.LongType()),
        *LINE.fields,
        T.StructField("parity_a", T.LongType()),
        T.StructField("parity_b", T.LongType()),
        T.StructField("wide", T.BinaryType()),
    ]
)


class Lines:
    """Some lines: rows of (hash, hash, doc, line, n), and their words."""

    def __init__(self, rows: list[np.ndarray], words: list[pa.BinaryArray]) -> None:
        self.rows, self.words = np.concatenate(rows), pa.concat_arrays(words)

    def parted(self) -> tuple[np.ndarray, np.ndarray]:
        """The rows with the first place of each line, and the rows with its other places."""
        hash_a, hash_b, doc, line, _ = self.rows.T
        order = np.lexsort((line, doc, hash_b, hash_a))
        rows = self.rows[order]
        new = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        first = np.r_[True, new][: len(rows)]
        # a repeated row of the input has its lines at the same places
        other = ~first & np.r_[False, (rows[1:, 2:4] != rows[:-1, 2:4]).any(axis=1)][: len(rows)]
        return order[first], order[other]


def placed_lines(docs: DataFrame) -> DataFrame:
    """``doc, line, n, words`` of each distinct line, at its first place, and ``doc, line`` (no ``n``) of its other places, from ``doc, text_hash, text``.

    A task finds what is a copy among its own lines, so a line on a third of all rows is a row for each ``SENT_BYTES`` of text.
    """
    ship(docs.sparkSession)

    def send(held: list[tuple[np.ndarray, pa.BinaryArray]]) -> Iterator[pa.RecordBatch]:
        lines = Lines(*zip(*held))
        first, other = lines.parted()
        if not len(first):
            return
        bucket = lines.rows[first, 0] & (LINE_BUCKETS - 1)
        order = np.argsort(bucket.astype(np.uint16), kind="stable")
        sent, starts = np.unique(bucket[order], return_index=True)
        words = lines.words.take(pa.array(first[order]))
        ends = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1]
        text = memoryview(words.buffers()[2] or b"")
        rows = np.column_stack([lines.rows[first[order]], np.diff(ends)])
        parts = list(zip(starts.tolist(), [*starts.tolist()[1:], len(order)]))
        arrays = [
            pa.array(sent, pa.int64()),
            pa.array([rows[a:b].tobytes() for a, b in parts], pa.binary()),
            pa.array([bytes(text[ends[a] : ends[b]]) for a, b in parts], pa.binary()),
            pa.array([lines.rows[some, 2:4].tobytes() for some in np.array_split(other, len(parts))], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=SENT.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        held, size = [], 0
        for batch in batches:
            for part in slices(batch):
                doc, line, n, words = lines_of(part)
                pairs = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words.to_pylist())), np.int64).reshape(-1, 2)
                held.append((np.column_stack([pairs, doc, line, n]), words))
                size += len(words) and words.buffers()[2].size
                if size >= SENT_BYTES:
                    yield from send(held)
                    held, size = [], 0
        if held:
            yield from send(held)

    def work_off(held: list[tuple[bytes, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate([np.frombuffer(h[0], np.int64).reshape(-1, 6) for h in held])
        offsets = pa.py_buffer(np.r_[0, np.cumsum(rows[:, 5])])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, offsets, pa.py_buffer(b"".join(h[1] for h in held))])
        lines = Lines([rows[:, :5]], [words])
        first, other = lines.parted()
        known = np.concatenate([np.frombuffer(h[2], np.int64).reshape(-1, 2) for h in held])
        doc, line, n = lines.rows[first, 2:].T
        columns = [pa.array(np.ascontiguousarray(c)) for c in (doc, line, n)]
        yield pa.RecordBatch.from_arrays([*columns, words.take(pa.array(first)).cast(pa.binary())], names=PLACED.fieldNames())
        copies = np.concatenate([lines.rows[other, 2:4], known])
        columns = [pa.array(np.ascontiguousarray(c)) for c in copies.T]
        yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(copies), pa.int64()), pa.nulls(len(copies), pa.binary())], names=PLACED.fieldNames())

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = chain.from_iterable(zip(*(b.column(c).to_pylist() for c in SENT.fieldNames())) for b in batches)
        held, size, bucket = [], 0, None
        for at, *blob in blobs:
            if bucket != at and size >= SENT_BYTES:
                yield from work_off(held)
                held, size = [], 0
            bucket = at
            held.append(blob)
            size += sum(map(len, blob))
        if held:
            yield from work_off(held)

    sent = docs.mapInArrow(run, SENT).repartition("bucket").sortWithinPartitions("bucket")
    return written(sent.mapInArrow(meet, PLACED), "placed-lines")


def distinct_lines(docs: DataFrame) -> DataFrame:
    """``doc, line, n, words`` of each distinct line, at its first place, from ``doc, text_hash, text``."""
    return placed_lines(docs).where("n IS NOT NULL")


def wide_parity(mixed: np.ndarray, starts: np.ndarray, sizes: tuple[int, float, int]) -> list[bytes | None]:
    """For each line of more words than given (that is filtered) a parity of 256 bits or more, a power of two."""
    beyond, each, most = sizes
    n = np.diff(starts)
    out: list[bytes | None] = [None] * len(n)
    bits = np.minimum(most, 1 << np.ceil(np.log2(np.maximum(256, n * each))).astype(np.int64))
    carries = (n > beyond) & (n < LONGEST)
    for width in np.unique(bits[carries]).tolist():
        lines = np.flatnonzero(carries & (bits == width))
        step = max(1, (1 << 24) // width)
        for low in range(0, len(lines), step):
            some = lines[low : low + step]
            at = np.repeat(starts[some] - np.r_[0, np.cumsum(n[some])[:-1]], n[some]) + np.arange(n[some].sum())
            bit = (mixed[at] >> np.uint64(20)).astype(np.int64) & (width - 1)
            turned = np.bincount(np.repeat(np.arange(len(some)), n[some]) * width + bit, minlength=len(some) * width) & 1
            packed = np.packbits(turned.astype(np.uint8).reshape(-1, width), axis=1, bitorder="little")
            for line, row in zip(some.tolist(), packed):
                out[line] = row.tobytes()
    return out


def parts_of(n: int) -> int:
    """Into how many parts a line of so many words is dealt, a power of two."""
    return 1 << max(0, -(-n // SPLIT) - 1).bit_length()


def dealt(mixed: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Long lines in parts: the places of words by part, each part's line and number of parts, and where each part begins.

    ``starts`` are those of lines. A line is dealt by its own number of words and by the most that a similar line may have.
    """
    top, bottom = THRESHOLD
    n = np.diff(starts)
    most = bottom * n // top
    short = np.flatnonzero(most <= SPLIT)
    took = [np.repeat(starts[short] - np.r_[0, np.cumsum(n[short])[:-1]], n[short]) + np.arange(n[short].sum())] if len(short) else []
    owner, parts, sizes = [short], [np.ones(len(short), np.int64)], [n[short]]
    for line in np.flatnonzero(most > SPLIT).tolist():
        places = np.arange(starts[line], starts[line + 1])
        spread = ((mixed[places] ^ (mixed[places] >> np.uint64(29))) * _MIX >> np.uint64(24)).astype(np.int64)
        for count in {parts_of(int(n[line])), parts_of(int(most[line]))}:
            part = spread & (count - 1)
            held = np.bincount(part, minlength=count)
            took.append(places[np.argsort(part, kind="stable")])
            owner.append(np.full((held > 0).sum(), line))
            parts.append(np.full((held > 0).sum(), count))
            sizes.append(held[held > 0])
    begin = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    return np.concatenate(took) if took else np.empty(0, np.int64), np.concatenate(owner), np.concatenate(parts), begin


def prefix(lines: pa.RecordBatch, classes: np.ndarray, sizes: tuple[int, float, int], only: tuple[np.ndarray, np.ndarray] | None = None) -> dict:
    """Of the rarest words of every line, or of every part of a long one, the columns of ``PREFIX``, ``wide`` by line (or part), those as ``part`` and the words' own hashes.

    ``only``: these words (sorted; of a row, and by bits of their own hashes whether there are any) and no others. Rows then have no parity.
    """
    raw, lengths = hashed(lines.column("words"))
    if only is not None:
        has = only[1][raw & (len(only[1]) - 1)]
        some = np.flatnonzero(np.add.reduceat(has, np.cumsum(lengths) - lengths, dtype=np.int64)) if len(lengths) else lengths
        some_words = np.zeros(len(lengths), bool)
        some_words[some] = True
        raw, lengths, lines = raw[np.repeat(some_words, lengths)], lengths[some], lines.take(pa.array(some))
    raw, repeats, starts = by_rarity(raw, lengths, classes)
    mixed = ((raw.astype(np.uint64) | repeats.astype(np.uint64) << np.uint64(32)) + np.uint64(1)) * _MIX
    took, owner, parts, starts = dealt(mixed, starts)
    raw, mixed = raw[took], mixed[took]
    n = np.diff(starts)
    size = np.minimum(n, LONGEST) << SIZE_BITS
    length = prefix_length(n)
    line = np.repeat(np.arange(len(n)), length)
    place = np.arange(len(line)) - np.repeat(np.cumsum(length) - length, length)
    at = place + starts[:-1][line]
    met = classes[raw[at] & (len(classes) - 1)] > ONCE
    line, place, at = line[met], place[met], at[met]
    # parts of lines dealt alike meet, and no others
    salted = mixed[at] ^ ((parts[line] - 1).astype(np.uint64) * _MIX)
    word = (salted >> np.uint64(33)).astype(np.int64)
    out = {"doc": lines.column("doc").to_numpy()[owner], "line": lines.column("line").to_numpy()[owner]}
    if only is not None:
        some = np.flatnonzero(np.isin(word, only[0]))
        line, place, word, at = line[some], place[some], word[some], at[some]
    else:
        bit = (mixed >> np.uint64(32)) % np.uint64(PARITY_BITS)
        one = np.uint64(1) << (bit & np.uint64(63))
        low, high = np.where(bit < 64, one, np.uint64(0)), np.where(bit < 64, np.uint64(0), one)
        for shift in (52, 56, 60):
            high ^= np.uint64(1) << ((mixed >> np.uint64(shift) & np.uint64(15)) + np.uint64(SINGLE))
        out["parity_a"], out["parity_b"] = (
            np.bitwise_xor.reduceat(bits, starts[:-1]).view(np.int64) if len(n) else np.empty(0, np.int64) for bits in (low, high)
        )
    out = {name: values[line] for name, values in out.items()}
    out["pack"] = word << 2 * SIZE_BITS | size[line] | np.minimum(place, LONGEST)
    return out | {"wide": wide_parity(mixed, starts, sizes) if only is None else [], "part": line, "own": raw[at]}


def prefix_rows(lines: DataFrame, classes: np.ndarray, sizes: tuple[int, float, int], words: np.ndarray | None = None) -> DataFrame:
    """``pack, doc, line, parity_a, parity_b, wide``: the rarest words of every line, or of every part of a long one (``words`` only)."""
    shared = lines.sparkSession.sparkContext.broadcast(classes)

    def each(batch: pa.RecordBatch) -> dict:
        out = prefix(batch, shared.value, sizes)
        met = np.arange(len(out["pack"])) if only is None else np.flatnonzero(np.isin(out["pack"] >> 2 * SIZE_BITS, only.value))
        wide = pa.array(out["wide"], pa.binary()).take(pa.array(out["part"][met]))
        return {"wide": wide} | {name: pa.array(out[name][met]) for name in FIXED}

    only = None if words is None else lines.sparkSession.sparkContext.broadcast(words)
    return arrow_map(lines.select("doc", "line", "words"), each, PREFIX, rows=1 << 12)


#: Rows of prefix words on their way: those of one bucket of words, by column and byte (so that equal bytes stand together), and their wide parities.
PACKED = T.StructType(
    [
        T.StructField("bucket", T.LongType()),
        T.StructField("rows", T.BinaryType()),
        T.StructField("wide", T.BinaryType()),
    ]
)
FIXED = ("pack", "doc", "line", "parity_a", "parity_b")


def packed_rows(lines: DataFrame, classes: np.ndarray, sizes: tuple[int, float, int]) -> DataFrame:
    """``prefix_rows`` in buckets: a row for each bucket of words and batch of lines. Buckets grow in number with the words."""
    words = lines.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least, most = BUCKETS
    buckets = min(max(least, 1 << (words // 4 // BUCKET_ROWS).bit_length()), most)
    shared = lines.sparkSession.sparkContext.broadcast(classes)

    def each(batch: pa.RecordBatch) -> dict:
        out = prefix(batch, shared.value, sizes)
        bucket = (out["pack"] >> 2 * SIZE_BITS) & (buckets - 1)
        order = np.argsort(bucket.astype(np.uint16), kind="stable")
        sent, starts = np.unique(bucket[order], return_index=True)
        fixed = np.stack([out[c][order] for c in FIXED], axis=1)
        wide, part = out["wide"], out["part"][order]
        carries = np.array([w is not None for w in wide], bool)[part]
        width = np.zeros(len(part), np.int64)
        width[carries] = [len(wide[i]) for i in part[carries].tolist()]
        rows, wides = [], []
        for a, b in zip(starts.tolist(), [*starts.tolist()[1:], len(order)]):
            both = np.concatenate([fixed[a:b], width[a:b, None]], axis=1)
            rows.append(both.view(np.uint8).T.tobytes())
            wides.append(b"".join([wide[i] for i in part[a:b][carries[a:b]].tolist()]))
        return {"bucket": sent, "rows": rows, "wide": wides}

    return arrow_map(lines.select("doc", "line", "words"), each, PACKED, rows=1 << 14)


def open_words(lines: DataFrame, classes: np.ndarray) -> DataFrame:
    """``word, own``: the prefix words of these lines, and their own hashes."""
    shared = lines.sparkSession.sparkContext.broadcast(classes)

    def each(batch: pa.RecordBatch) -> dict:
        out = prefix(batch, shared.value, (LONGEST, 1, 256))
        return {"word": out["pack"] >> 2 * SIZE_BITS, "own": out["own"]}

    schema = T.StructType([T.StructField("word", T.LongType()), T.StructField("own", T.LongType())])
    return arrow_map(lines.select("doc", "line", "words"), each, schema, rows=1 << 12).distinct()


def lines_with(lines: DataFrame, classes: np.ndarray, words: np.ndarray, own: np.ndarray) -> DataFrame:
    """``doc, line`` of the lines that have one of these prefix words. Lines without a word of such a hash of its own aren't ordered."""
    bits = np.zeros(1 << 24, bool)
    bits[own & (len(bits) - 1)] = True
    shared, wanted = (lines.sparkSession.sparkContext.broadcast(x) for x in (classes, (words, np.packbits(bits))))

    def each(batch: pa.RecordBatch) -> dict:
        words, bits = wanted.value
        if "bits" not in unpacked:
            unpacked["bits"] = np.unpackbits(bits).view(bool)
        out = prefix(batch, shared.value, (LONGEST, 1, 256), (words, unpacked["bits"]))
        pairs = np.unique(np.stack([out["doc"], out["line"]], axis=1), axis=0)
        return {"doc": pairs[:, 0], "line": pairs[:, 1]}

    unpacked: dict[str, np.ndarray] = {}
    return arrow_map(lines.select("doc", "line", "words"), each, LINE, rows=1 << 12)


class Met:
    """The lines of some lists, by row: what the filters need of them."""

    def __init__(self, fixed: dict[str, np.ndarray], wide_at: np.ndarray, wide_size: np.ndarray, wide: np.ndarray) -> None:
        pack = fixed["pack"]
        self.size = (pack >> SIZE_BITS & LONGEST).astype(np.int32)
        self.place = (pack & LONGEST).astype(np.int32)
        self.parity = np.stack([fixed["parity_a"], fixed["parity_b"]], axis=1).view(np.uint64)
        self.doc, self.line = fixed["doc"], fixed["line"]
        # what is too long to be filtered looks like any other
        lengths = np.floor(LENGTHS * np.log2(np.maximum(self.size, 1)))
        self.lengths = (np.zeros(len(pack)) if (self.size == LONGEST).any() else lengths).astype(np.int16)
        self.wide_at, self.wide_size, self.wide = wide_at, wide_size, wide

    @classmethod
    def of_rows(cls, part: pa.Table) -> Met:
        wide = part.column("wide").combine_chunks()
        offsets = wide.buffers()[1]
        ends = np.frombuffer(offsets, np.int32)[wide.offset : wide.offset + len(wide) + 1].astype(np.int64)
        fixed = {c: part.column(c).to_numpy() for c in FIXED}
        return cls(fixed, ends[:-1], np.diff(ends), np.frombuffer(wide.buffers()[2] or b"", np.uint8))

    def wide_differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many bits wide parities differ at least; the wider of two is folded. Rows without one differ in none."""
        out = np.zeros(len(a), np.int64)
        width = self.wide_size[a], self.wide_size[b]
        both = np.flatnonzero((width[0] > 0) & (width[1] > 0))
        for wide_a, wide_b in np.unique(np.stack([w[both] for w in width], axis=1), axis=0).tolist():
            pick = both[(width[0][both] == wide_a) & (width[1][both] == wide_b)]
            step = max(1, (1 << 24) // max(wide_a, wide_b))
            for low in range(0, len(pick), step):
                some = pick[low : low + step]
                bits = [
                    np.bitwise_xor.reduce(self.wide[self.wide_at[x[some], None] + np.arange(w)].reshape(len(some), -1, min(wide_a, wide_b)), axis=1)
                    for x, w in ((a, wide_a), (b, wide_b))
                ]
                out[some] = np.bitwise_count(bits[0] ^ bits[1]).sum(axis=1)
        return out

    def through(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the pairs of rows may be similar; how many words look different in them, and how many may be."""
        top, bottom = THRESHOLD
        size_a, size_b = self.size[a], self.size[b]
        long = (size_a == LONGEST) | (size_b == LONGEST)
        keep = np.flatnonzero((bottom * np.minimum(size_a, size_b) >= top * np.maximum(size_a, size_b)) | long)
        # words of one line that fall together, and repeated rows, bring a line to itself
        keep = keep[(self.line[a[keep]] != self.line[b[keep]]) | (self.doc[a[keep]] != self.doc[b[keep]])]
        size_a, size_b, long = size_a[keep], size_b[keep], long[keep]
        total = (size_a + size_b).astype(np.int64)
        needed = -(-top * total // (top + bottom))
        place_a, place_b = self.place[a[keep]], self.place[b[keep]]
        fits = (np.minimum(place_a, place_b) + np.minimum(size_a - place_a, size_b - place_b) >= needed) | long
        keep, long, most = keep[fits], long[fits], (total - 2 * needed)[fits]
        apart = self.parity[a[keep]] ^ self.parity[b[keep]]
        triple = np.bitwise_count(apart[:, 1] >> np.uint64(SINGLE)).astype(np.int64)
        apart[:, 1] &= np.uint64((1 << SINGLE) - 1)
        differ = np.bitwise_count(apart).sum(axis=1, dtype=np.int64)
        fits = ((differ <= most) & (triple <= 3 * most)) | long
        keep, long, most, differ = keep[fits], long[fits], most[fits], differ[fits]
        differ = np.maximum(differ, self.wide_differ(a[keep], b[keep]))
        fits = (differ <= most) | long
        return keep[fits], differ[fits], np.where(long, -1, most)[fits]


class Held:
    """Packed rows a task holds: of buckets that are whole, and of the one that is read.

    A word of more than ``most`` rows is given up, and the words of most rows are if a bucket has more than four times as many.
    """

    def __init__(self, most: int | None) -> None:
        self.most, self.limit = most, None if most is None else max(4 * most, MET_ROWS)
        self.rows, self.whole = 0, []
        self.given: list[int] = []
        self._begin()

    def _begin(self) -> None:
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.new_rows, self.gone = 0, np.empty(0, np.int64)

    def add(self, rows: bytes, wide: bytes) -> None:
        width = 8 * (len(FIXED) + 1)
        fixed = np.ascontiguousarray(np.frombuffer(rows, np.uint8).reshape(width, -1).T).view(np.int64)
        self.new.append((fixed, np.frombuffer(wide, np.uint8)))
        self.new_rows += len(fixed)
        if self.limit is not None and self.new_rows > self.limit:
            self._give_up(self.limit // 2)

    def _give_up(self, limit: int) -> None:
        """Leave out the rows of words that have too many, and of others while there are more than ``limit`` rows."""
        fixed, wide = (np.concatenate(x) for x in zip(*self.new))
        word = fixed[:, 0] >> 2 * SIZE_BITS
        words, counts = np.unique(word, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        left = len(word) - np.r_[0, np.cumsum(counts[order])[:-1]]
        known = np.isin(words[order], self.gone)
        self.gone = np.union1d(self.gone, words[order][known | (counts[order] > self.most) | (left > limit)])
        stay = ~np.isin(word, self.gone)
        if not stay.all():
            bytes_stay = np.repeat(stay, fixed[:, -1])
            fixed, wide = fixed[stay], wide[bytes_stay]
        self.new, self.new_rows = [(fixed, wide)], len(fixed)

    def settle(self) -> None:
        """The bucket that is read is whole."""
        if self.new and self.most is not None and (len(self.gone) or self.new_rows > self.most):
            self._give_up(self.limit)
        self.whole += self.new
        self.rows += self.new_rows
        self.given += self.gone.tolist()
        self._begin()

    def work_off(self, pairs: Callable) -> Iterator[pa.RecordBatch]:
        if self.rows:
            fixed, wide = (np.concatenate(x) for x in zip(*self.whole))
            self.whole, self.rows = [], 0
            width = fixed[:, -1]
            wide_at = np.cumsum(width) - width
            word = fixed[:, 0] >> 2 * SIZE_BITS
            order = np.lexsort((fixed[:, 2], fixed[:, 1], word))
            word, fixed = word[order], np.ascontiguousarray(fixed[order].T)
            met = Met(dict(zip(FIXED, fixed)), wide_at[order], fixed[-1], wide)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            yield pa.RecordBatch.from_arrays(pairs(met, starts, None), names=PAIR.fieldNames())
        if self.given:
            n = len(self.given)
            row = [pa.nulls(n, pa.int64())] * 5 + [pa.nulls(n, pa.bool_()), pa.array(self.given, pa.int64())]
            self.given = []
            yield pa.RecordBatch.from_arrays(row, names=PAIR.fieldNames())


PAIR = T.StructType(
    [
        *(T.StructField(c, T.LongType()) for c in ("doc", "line", "differ", "a_doc", "a_line")),
        T.StructField("more", T.BooleanType()),
        T.StructField("full", T.LongType()),
    ]
)
ENDS = ("doc", "line", "a_doc", "a_line")


def near_pairs(rows: DataFrame, every: bool = False, held_lines: int | None = None) -> DataFrame:
    """``doc, line, differ, a_doc, a_line, more, full``: of the lines before a line that share a word and may match, the likeliest.

    A line goes on to the first that looks very near (half the words allowed to differ do), and takes the ``LIKELIEST`` with the
    fewest different words; ``more`` says that others may match as well. With ``every``
    all that may match are returned. A list is the rows of one word, and of one ``tile`` if there is such a column. A row with ``full`` names a word of more than
    ``held_lines`` (None: any number) rows, which has no pairs here. With a column ``open`` only such lines are held against others.
    """
    asking, tiled = "open" in rows.columns, "tile" in rows.columns

    def pairs(met: Met, starts: np.ndarray, asks: np.ndarray | None) -> list[pa.Array]:
        size = len(met.size)
        place = np.arange(size) - np.repeat(starts, np.diff(np.append(starts, size)))
        # lines by their place in a list, the last first: those that go on are always at the front
        b = np.flatnonzero(place if asks is None else (place > 0) & asks)
        b = b[np.argsort(-place[b], kind="stable")]
        left, first = -place[b], b - place[b]
        lengths = met.lengths[b]
        going = np.ones(len(b), bool)
        stopped = np.zeros(size, bool)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        step = done = 0
        while number := int(np.searchsorted(left, -step)):
            # as many steps at once as make some work for an array
            many = max(1, min(STEP_PAIRS // number, int(-left[0]) - step))
            a = first[:number, None] + np.arange(step, step + many)
            fits = going[:number, None] & (a < b[:number, None])
            fits &= np.abs(met.lengths[np.minimum(a, size - 1)] - lengths[:number, None]) <= SIMILAR_LENGTHS
            at, k = np.nonzero(fits)
            step += many
            if not len(at):
                continue
            some, differ, most = met.through(a[at, k], b[at])
            at, k = at[some], k[some]
            near = np.flatnonzero(2 * differ <= most)
            if not every and len(near):
                nearest = np.full(number, many)
                np.minimum.at(nearest, at[near], k[near])
                before = k <= nearest[at]
                at, k, differ = at[before], k[before], differ[before]
                ended = np.flatnonzero(nearest < many)
                stopped[b[ended[nearest[ended] + step - many + 1 < -left[ended]]]] = True
                going[ended] = False
                done += len(ended)
            found.append((b[at], a[at, k], differ))
            if done * 8 > number:
                b, left, first, lengths = (x[:number][going[:number]] for x in (b, left, first, lengths))
                going, done = np.ones(len(b), bool), 0
        b, a, differ = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
        more = np.zeros(len(b), bool)
        if not every and len(b):
            order = np.lexsort((a, differ, b))
            b, a, differ = b[order], a[order], differ[order]
            first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
            rank = np.arange(len(b)) - np.repeat(first, np.diff(np.r_[first, len(b)]))
            stopped[b[rank >= LIKELIEST]] = True
            keep = rank < LIKELIEST
            b, a, differ = b[keep], a[keep], differ[keep]
            more = stopped[b]
        columns = [met.doc[b], met.line[b], differ, met.doc[a], met.line[a], more]
        return [*map(pa.array, columns), pa.nulls(len(b), pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        full: int | None = None
        new = 0
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                new += batch.num_rows
            if not held or (batch is not None and new < MET_ROWS):
                continue
            new = 0
            part = pa.Table.from_batches(held).combine_chunks()
            word = part.column("pack").to_numpy() >> 2 * SIZE_BITS
            tile = part.column("tile").to_numpy() if tiled else np.zeros(len(word), np.int64)
            if full is not None:  # the rest of a word that was given up
                rest = int(np.searchsorted(word, full, "right"))
                part, word, tile = part.slice(rest), word[rest:], tile[rest:]
            starts = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (tile[1:] != tile[:-1])]) if len(word) else np.empty(0, np.int64)
            # the last list may go on in the next batch
            cut = int(starts[-1]) if batch is not None and len(starts) else len(word)
            if cut:
                some = part.slice(0, cut).combine_chunks()
                asks = some.column("open").to_numpy(zero_copy_only=False) if asking else None
                yield pa.RecordBatch.from_arrays(pairs(Met.of_rows(some), starts[starts < cut], asks), names=PAIR.fieldNames())
            part, word = part.slice(cut), word[cut:]
            if held_lines is not None and len(word) > held_lines:
                full = int(word[0])
                row = [pa.nulls(1, pa.int64())] * 5 + [pa.nulls(1, pa.bool_()), pa.array([full])]
                yield pa.RecordBatch.from_arrays(row, names=PAIR.fieldNames())
                part = part.slice(part.num_rows)
            held = part.to_batches() if part.num_rows else []

    def run_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = chain.from_iterable(zip(*(b.column(c).to_pylist() for c in PACKED.fieldNames())) for b in batches)
        held, bucket = Held(held_lines), None
        for at, rows, wide in blobs:
            if bucket != at:
                held.settle()
                if held.rows >= MET_ROWS:
                    yield from held.work_off(pairs)
            bucket = at
            held.add(rows, wide)
        held.settle()
        yield from held.work_off(pairs)

    if "bucket" in rows.columns:
        return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run_packed, PAIR)
    by = [_word(), *(["tile"] if tiled else [])]
    return rows.repartition(*by).sortWithinPartitions(*by, "doc", "line").mapInArrow(run, PAIR)


def _word() -> Column:
    return F.shiftright("pack", 2 * SIZE_BITS)


def tiles(rows: DataFrame, full: DataFrame) -> DataFrame:
    """The rows of the words ``full`` in blocks of about ``HELD``, each two blocks (and each with itself) a tile."""
    mine = rows.withColumn("word", _word()).join(full.select(F.col("full").alias("word")), "word", "left_semi")
    blocks = mine.groupBy("word").agg(F.ceil(F.count("*") / HELD).alias("blocks"))
    block, other = F.pmod(F.xxhash64("doc", "line"), F.col("blocks")), F.col("other")
    spread = mine.join(blocks, "word").select("*", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    tile = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    return spread.withColumn("tile", tile).drop("word", "blocks", "block", "other")


def candidates(rows: Callable[[], DataFrame], every: bool = False, packed: DataFrame | None = None) -> DataFrame:
    """All that ``near_pairs`` gives, words of more than ``HELD`` lines included. ``packed`` are the same rows in buckets."""
    met = written(near_pairs(rows() if packed is None else packed, every, HELD), "met")
    found, full = met.where("full IS NULL").drop("full"), met.where("full IS NOT NULL")
    if not full.isEmpty():
        # of a word that was given up some pairs may have come before
        found = found.unionByName(written(near_pairs(tiles(rows(), full), every), "met-tiles").drop("full"))
    return found


def similar(a: list[bytes], b: list[bytes]) -> bool:
    top, bottom = THRESHOLD
    shared = sum((Counter(a) & Counter(b)).values())
    return bottom * shared >= top * (len(a) + len(b) - shared)


def pick(lines: DataFrame, some: DataFrame, by: list[str]) -> DataFrame:
    """The rows of ``lines`` that a written table names; up to ``BROADCAST_ROWS`` names go to every task, and no line is shuffled."""
    return lines.join(F.broadcast(some) if some.count() <= BROADCAST_ROWS else some, by, "left_semi")


def really(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """``doc, line`` of the later lines of the pairs (``doc, line, a_doc, a_line``, distinct) that are similar by their words."""
    pairs = written(pairs, "candidates")
    ends = pairs.select("doc", "line").union(pairs.select("a_doc", "a_line")).distinct()
    asked = written(pick(lines, written(ends, "candidate-ends"), ["doc", "line"]).select("doc", "line", "words"), "candidate-lines")
    earlier = asked.select(*[F.col(c).alias(f"a_{c}") for c in ("doc", "line", "words")])

    def check(batch: pa.RecordBatch) -> dict:
        names = ("doc", "line", "words", "a_words")
        rows = zip(*(batch.column(c).to_pylist() for c in names))
        hits = [(doc, line) for doc, line, b, a in rows if similar(a.split(), b.split())]
        return {"doc": [h[0] for h in hits], "line": [h[1] for h in hits]}

    both = pairs.join(asked, ["doc", "line"]).join(earlier, ["a_doc", "a_line"])
    return written(arrow_map(both.select("doc", "line", "words", "a_words"), check, LINE).distinct(), "matches")


def matched(lines: DataFrame, met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The later lines that match one of their candidates, and those that don't although there are more."""
    grouped = met.groupBy("doc", "line").agg(F.min(F.struct("differ", "a_doc", "a_line")).alias("best"), F.max("more").alias("more"))
    best = written(grouped.select("doc", "line", "best.a_doc", "best.a_line", "more"), "likeliest")
    gone = really(lines, best.select(*ENDS))  # most lines that match at all match the likeliest
    missed = best.join(gone, ["doc", "line"], "left_anti")
    others = met.select(*ENDS).join(missed.select("doc", "line"), ["doc", "line"], "left_semi").distinct()
    gone = gone.unionByName(really(lines, others.join(missed.select(*ENDS), list(ENDS), "left_anti")))
    still = missed.where("more").select("doc", "line").join(gone, ["doc", "line"], "left_anti")
    return gone, written(still, "open-lines")


def gone_lines(docs: DataFrame) -> DataFrame:
    """``doc, line`` of the lines that go, from ``doc, text_hash, text``."""
    placed = placed_lines(docs)
    lines, copies = placed.where("n IS NOT NULL"), placed.where("n IS NULL").select("doc", "line")
    classes = rarity(lines)
    gone, still = matched(lines, candidates(lambda: prefix_rows(lines, classes, NARROW_LINES), packed=packed_rows(lines, classes, NARROW_LINES)))
    if not still.isEmpty():
        rows = again(lines, classes, still)
        new, still = matched(lines, candidates(lambda: _marked(rows, still)))
        gone = gone.unionByName(new)
        if not still.isEmpty():
            last = candidates(lambda: _marked(rows, still), True).select(*ENDS).distinct()
            gone = gone.unionByName(really(lines, last))
    return gone.unionByName(copies)


def again(lines: DataFrame, classes: np.ndarray, still: DataFrame) -> DataFrame:
    """The rows of the words of open lines, with wide parities."""
    asked = pick(lines, still, ["doc", "line"])
    words = written(open_words(asked, classes), "open-words")
    # lines are picked by narrow rows, so that wide ones are made of few lines only
    few = words.count() <= BROADCAST_ROWS
    if few:
        found = words.toArrow()
        only, own = (np.unique(found.column(c).to_numpy()) for c in ("word", "own"))
        narrow = lines_with(lines, classes, only, own)
    else:
        narrow = pick(prefix_rows(lines, classes, (LONGEST, 1, 256)).select("doc", "line", _word().alias("word")), words, ["word"])
    picked = written(narrow.select("doc", "line").distinct(), "open-met")
    some = written(pick(lines, picked, ["doc", "line"]), "open-met-lines")
    if few:
        return written(prefix_rows(some, classes, WIDE, only), "open-rows")
    wide = prefix_rows(some, classes, WIDE).withColumn("word", _word())
    return written(pick(wide, words, ["word"]).drop("word"), "open-rows")


def _marked(rows: DataFrame, still: DataFrame) -> DataFrame:
    marked = rows.join(still.withColumn("open", F.lit(True)), ["doc", "line"], "left")
    return marked.withColumn("open", F.coalesce("open", F.lit(False)))


STAYED = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])


def dedup(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``docs`` with ``column`` less its later matches, and ``n_lines`` (with words) and ``n_removed`` in place of such columns."""
    gone = gone_lines(keyed(docs, key, column))
    low = (1 << LINE_BITS) - 1
    marks = gone.groupBy("doc", F.shiftrightunsigned("line", LINE_BITS).alias("text_hash")).agg(
        F.collect_set(F.col("line").bitwiseAND(F.lit(low))).alias("gone")
    )
    names = [c for c in docs.columns if c not in STAYED.fieldNames()]
    rows = docs.select(F.struct(*names).alias("row"), _doc(key).alias("doc"), _text_hash(column).alias("text_hash"))
    joined = rows.join(marks, ["doc", "text_hash"], "left").select("row", "gone")
    schema = T.StructType([*(docs.schema[c] for c in names), *STAYED.fields])

    def each(batch: pa.RecordBatch) -> dict:
        texts, found, removed = [], [], []
        row = dict(zip(names, batch.column("row").flatten()))
        for text, gone in zip(utf8(row[column]), batch.column("gone").to_pylist()):
            lines = text.split(b"\n") if text else []
            found.append(sum(bool(line.strip(b" \t\n\r\x0b\x0c")) for line in lines))
            removed.append(len(gone or ()))
            if gone:
                gone = set(gone)
                text = b"\n".join([line for i, line in enumerate(lines) if i not in gone])
            texts.append(text)
        return row | {column: pa.array(texts, pa.binary()).cast(pa.string()), "n_lines": found, "n_removed": removed}

    return arrow_map(joined, each, schema)
