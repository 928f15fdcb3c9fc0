"""Quality by distribution: Jensen-Shannon distance to references of each language.

A reference is learned from all documents of a language: how its characters
fall into classes, and how its words fall on its ``COMMON`` most frequent ones
(and the rest). A document is held against every reference; its distance is the
smallest over the languages of the larger of the two, each divided by its limit.
Above 1 it is rejected. The guards: a histogram of fewer than ``MIN_CHARS``
characters or ``MIN_WORDS`` words is not judged, as its distance is mostly noise.

A language has a reference if it has enough text, however small its share: at least
``MIN_REFERENCE_WORDS`` words. A document with more than ``MAX_DOCUMENT_SHARE`` of its language's words is left out of
the reference (one long document of junk would make one that rejects the rest), and judged by it like any other. A document of a language without one is not judged by the
references of others. More than ``MAX_LANGUAGES`` references are refused with an
error, as every task holds them.

Defined results: null texts have no words and fail the base rules. Words of
equal counts rank by their bytes. Repeated rows count as often as they occur.
Documents without a language are held against every reference. Only key, text and language are read, so other
columns may have any name. Texts of any length are read whole; a task needs some fifteen times the longest for its words.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, lower_words, utf8, written

COMMON = 64
MIN_REFERENCE_WORDS = 10_000
MAX_DOCUMENT_SHARE = 1 / 16
MAX_LANGUAGES = 8192
MIN_CHARS = 200
#: Bytes of a text whose characters are told apart at once.
BLOCK = 1 << 20
MIN_WORDS = 100
#: Limits of the two distances.
MAX_CLASS_DISTANCE = 0.21
MAX_WORD_DISTANCE = 0.38

# The symbols and rules of the contract.
SYMBOLS = b"#*$%&|<>"
BASE_MIN_WORDS = 50
BASE_MAX_REPEATED = 50  # per cent of the words

CLASSES = ("Ll", "Lu", "L", "N", "P", "S", "space", "other")
_WHITE = (9, 10, 11, 12, 13, 32)
_CONTINUATION = bytes(range(128, 192))  # of UTF-8
_class_of: np.ndarray | None = None


def _classes() -> np.ndarray:
    """The class of each code point, by its general category."""
    global _class_of
    if _class_of is None:
        index = {"Ll": 0, "Lu": 1}
        first = {"L": 2, "N": 3, "P": 4, "S": 5, "Z": 6}

        def of(point: int) -> int:
            category = unicodedata.category(chr(point))
            return index.get(category, first.get(category[0], 7))

        _class_of = np.fromiter(map(of, range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
        _class_of[list(_WHITE)] = 6
    return _class_of


def class_counts(text: bytes, block: int = BLOCK) -> np.ndarray:
    """How many characters fall into each class, ``block`` bytes at a time."""
    counts, at = np.zeros(len(CLASSES), np.int64), 0
    while at < len(text):
        end = min(at + block, len(text))
        while end < len(text) and text[end] & 0xC0 == 0x80:  # inside a character
            end += 1
        points = np.frombuffer(text[at:end].decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        counts += np.bincount(_classes()[points], minlength=len(CLASSES))
        at = end
    return counts


def repeated_words(listed: list[bytes]) -> int:
    """Words that lie in a window of three that occurs twice or more."""
    if len(listed) < 3:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in listed), np.int64, len(listed))
    _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, windows, counts = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[windows] > 1
    covered = np.zeros(len(listed), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, repeated words."""
    if not text:
        return 0, 0, 0, 0, 0
    listed = text.split()
    joined = b"".join(listed)
    chars = len(joined.translate(None, _CONTINUATION))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(listed), chars, symbols, len(lines) - len(set(lines)), repeated_words(listed)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of ``p`` to each row of ``q``."""
    mean = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / mean), 0.0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / mean), 0.0).sum(axis=-1)
    return np.sqrt(np.clip((left + right) / 2, 0.0, 1.0))


class References:
    def __init__(self, classes: dict[str, np.ndarray], words: dict[str, list[tuple[bytes, int]]], totals: dict[str, int]) -> None:
        self.langs = sorted(lang for lang in classes if totals.get(lang))
        self.known = set(self.langs)
        self.classes = np.array([classes[lang] / classes[lang].sum() for lang in self.langs])
        self.slots: dict[bytes, list[tuple[int, int]]] = {}
        self.words = np.zeros((len(self.langs), COMMON + 1))
        for i, lang in enumerate(self.langs):
            for slot, (w, n) in enumerate(words[lang]):
                self.slots.setdefault(w, []).append((i, slot))
                self.words[i, slot] = n
            self.words[i, -1] = totals[lang] - self.words[i].sum()
            self.words[i] /= totals[lang]

    def distances(self, text: bytes | None, lang: str | None = None) -> tuple[float | None, float | None, bool]:
        """Distances to the nearest reference (None: not judged), and whether they are within the limits."""
        if not text or not self.langs or (lang is not None and lang not in self.known):
            return None, None, True
        counts = class_counts(text)
        listed = lower_words(text)
        by_class = js_distance(counts / counts.sum(), self.classes) if counts.sum() >= MIN_CHARS else None
        by_word = None
        if len(listed) >= MIN_WORDS:
            mine = np.zeros(self.words.shape)
            for w, n in Counter(listed).items():
                for at in self.slots.get(w, ()):
                    mine[at] = n
            mine[:, -1] = len(listed) - mine.sum(axis=1)
            by_word = js_distance(mine / len(listed), self.words)
        zeros = np.zeros(len(self.langs))
        a, b = (zeros if d is None else d for d in (by_class, by_word))
        worst = np.maximum(a / MAX_CLASS_DISTANCE, b / MAX_WORD_DISTANCE)
        best = int(np.argmin(worst))
        return (
            None if by_class is None else float(by_class[best]),
            None if by_word is None else float(by_word[best]),
            bool(worst[best] <= 1),
        )


def _longest(known: DataFrame) -> dict[str, float]:
    """For each language the most words a document of its reference may have, from all documents' sizes."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("n", T.LongType())])

    def each(batch: pa.RecordBatch) -> dict:
        found = pc.count_substring_regex(batch.column("text"), r"[^\x20\x09-\x0D]+")
        return {"lang": batch.column("lang"), "n": pc.fill_null(found, 0).cast(pa.int64())}

    totals = arrow_map(known, each, schema).groupBy("lang").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_REFERENCE_WORDS)
    rows = totals.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r["lang"]: r["n"] * MAX_DOCUMENT_SHARE for r in rows}


def _counts(known: DataFrame, longest: dict[str, float]) -> DataFrame:
    """``lang, class, word, n``: a language's words (``class`` is NULL) and classes of characters, of texts that aren't too long for it."""
    schema = T.StructType(
        [
            T.StructField("lang", T.StringType()),
            T.StructField("class", T.IntegerType()),
            T.StructField("word", T.BinaryType()),
            T.StructField("n", T.LongType()),
        ]
    )
    shared = known.sparkSession.sparkContext.broadcast(longest)

    def each(batch: pa.RecordBatch) -> dict:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}
        for code, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text"))):
            if text and code in shared.value:
                listed = lower_words(text)
                if len(listed) <= shared.value[code]:
                    words.setdefault(code, Counter()).update(listed)
                    classes[code] = classes.get(code, 0) + class_counts(text)
        rows = [(code, None, w, n) for code, held in words.items() for w, n in held.items()]
        rows += [(code, i, None, int(n)) for code, held in classes.items() for i, n in enumerate(held)]
        return dict(zip(schema.fieldNames(), map(list, zip(*rows)))) if rows else {c: [] for c in schema.fieldNames()}

    return arrow_map(known, each, schema).groupBy("lang", "class", "word").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, lang: str = "lang", column: str = "text") -> References:
    """References of the languages that have enough text."""
    known = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(column).alias("text"))
    counts = written(_counts(known, _longest(known)), "quality-counts")
    held = counts.where(F.col("class").isNull()).groupBy("lang").agg(F.sum("n").alias("n"))
    totals = {r["lang"]: r["n"] for r in held.where(F.col("n") >= MIN_REFERENCE_WORDS).collect()}
    langs = list(totals)
    counts = counts.where(F.col("lang").isin(langs))
    of_words = counts.where(F.col("class").isNull())
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    top = of_words.withColumn("place", F.row_number().over(order)).where(F.col("place") <= COMMON)
    words: dict[str, list[tuple[bytes, int]]] = {code: [] for code in langs}
    for r in top.select("lang", "word", "n").collect():
        words[r["lang"]].append((bytes(r["word"]), r["n"]))
    classes = {code: np.zeros(len(CLASSES)) for code in langs}
    for r in counts.where(F.col("class").isNotNull()).collect():
        classes[r["lang"]][r["class"]] = r["n"]
    return References(classes, words, totals)


def judge(docs: DataFrame, references: References, key: str = "doc_id", column: str = "text", lang: str = "lang") -> DataFrame:
    """Per row the base counts, both distances, and the two verdicts."""
    long, double, boolean = T.LongType(), T.DoubleType(), T.BooleanType()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = T.StructType(
        [
            docs.schema[key],
            *(T.StructField(n, long) for n in names),
            T.StructField("base_failed", boolean),
            T.StructField("kept", boolean),
            T.StructField("class_distance", double),
            T.StructField("word_distance", double),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(references)

    def each(batch: pa.RecordBatch) -> dict:
        texts = utf8(batch.column("__text"))
        counts = [base_counts(t) for t in texts]
        found = [shared.value.distances(t, code) for t, code in zip(texts, batch.column("__lang").to_pylist())]
        failed = [c[0] < BASE_MIN_WORDS or 100 * c[4] > BASE_MAX_REPEATED * c[0] for c in counts]
        return (
            {key: batch.column(key), "base_failed": failed, "kept": [not b and f[2] for b, f in zip(failed, found)]}
            | {n: [c[i] for c in counts] for i, n in enumerate(names)}
            | {"class_distance": [f[0] for f in found], "word_distance": [f[1] for f in found]}
        )

    return arrow_map(docs.select(key, F.col(column).alias("__text"), F.col(lang).alias("__lang")), each, schema)
