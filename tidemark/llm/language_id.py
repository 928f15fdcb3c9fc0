"""Language by rank-order profiles: out-of-place distance of character n-grams.

A language's profile is its ``PROFILE`` most frequent n-grams (1 to 3 letters of
a word, its ends marked), most frequent first. A document is ranked the same
way; an n-gram costs the difference of its two ranks, or ``PROFILE`` if the
profile lacks it, and the language with the smallest sum wins.

Defined results: a text that is null or has no letter is ``und`` with score 0,
as is every text if nothing was learned. Equal counts rank by code points, equal
distances go to the smaller language code. Repeated rows are learned from as
often as they occur. Null languages are not learned from. Profiles of more than
``MAX_LANGUAGES`` languages are refused with an error, as every task holds them.
Texts of any length are read whole, by blocks whose counts add up. Other columns may have any name, but
``lang_pred`` and ``score`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map

#: N-grams of a profile, and of a document that are compared with it.
PROFILE = 300
MAX_LANGUAGES = 8192
#: Characters whose n-grams are made at once, and n-grams that are held before they are counted.
BLOCK = 1 << 18
HELD = 1 << 20
UNDETERMINED = "und"

_BITS = 21  # of a code point
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def ngrams(text: str | None, block: int = BLOCK) -> Iterator[np.ndarray]:
    """The n-grams of a text as numbers, repeats included, of ``block`` characters at a time.

    Letters are lower-cased; a run of anything else is one 0, which marks the
    ends of words; n-grams never have it in the middle.
    """
    if not text:
        return
    lowered = text.lower()
    held = np.zeros(1, np.int64)  # the last two points before the block
    for at in range(0, len(lowered) + 1, block):
        points = np.frombuffer(lowered[at : at + block].encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        points = np.where(_is_letter()[points], points, 0)
        if at + block > len(lowered):
            points = np.append(points, 0)
        points = points[(points != 0) | (np.concatenate((held[-1:], points[:-1])) != 0)]
        both = np.concatenate((held, points))
        pairs = both[:-1] << _BITS | both[1:]
        triples = (pairs[:-1] << _BITS | both[2:])[both[1:-1] != 0]
        yield np.concatenate((points[points != 0], pairs[len(held) - 1 :], triples))
        held = both[-2:]


def counted(grams: Iterable[np.ndarray], most: int = HELD) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams in order with their numbers; ``most`` and one block are held uncounted."""
    values, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    held: list[np.ndarray] = []

    def add() -> tuple[np.ndarray, np.ndarray]:
        new, times = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        if not len(values):
            return new, times
        both, at = np.unique(np.concatenate((values, new)), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, at, np.concatenate((counts, times)))
        return both, total

    waiting = 0
    for part in grams:
        held.append(part)
        waiting += len(part)
        if waiting >= most:
            values, counts = add()
            waiting = 0
    return add() if held else (values, counts)


def ranked(text: str | None) -> np.ndarray:
    """The most frequent n-grams of a text, most frequent first, ties by number."""
    values, counts = counted(ngrams(text))
    return values[np.argsort(-counts, kind="stable")[:PROFILE]]


class Profiles:
    """Profiles as sorted n-grams with their ranks, to look many n-grams up at once."""

    def __init__(self, rows: list[tuple[str, int, int]]) -> None:
        by: dict[str, list[tuple[int, int]]] = {}
        for lang, gram, rank in rows:
            by.setdefault(lang, []).append((gram, rank))
        self.langs = sorted(by)
        self.tables = [tuple(np.array(sorted(by[lang])).T) for lang in self.langs]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and 1 - distance / greatest distance."""
        return self.nearest(ranked(text))

    def nearest(self, mine: np.ndarray) -> tuple[str, float]:
        """Language and score of ranked n-grams."""
        if not len(mine) or not self.langs:
            return UNDETERMINED, 0.0
        places = np.arange(len(mine))
        distances = []
        for grams, ranks in self.tables:
            at = np.minimum(np.searchsorted(grams, mine), len(grams) - 1)
            cost = np.where(grams[at] == mine, np.abs(ranks[at] - places), PROFILE)
            distances.append(int(cost.sum()))
        best = int(np.argmin(distances))
        return self.langs[best], 1.0 - distances[best] / (PROFILE * len(mine))


def profile_counts(docs: DataFrame, lang: str = "lang", column: str = "text") -> DataFrame:
    """``lang, gram, n`` of documents with a language, summed over all of them."""
    schema = T.StructType(
        [T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())]
    )

    def each(batch: pa.RecordBatch) -> dict:
        by: dict[str, list[str | None]] = {}
        for code, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by.setdefault(code, []).append(text)
        parts = [(code, *counted(chain.from_iterable(map(ngrams, texts)))) for code, texts in by.items()]
        return {
            "lang": [code for code, grams, _ in parts for _ in range(len(grams))],
            "gram": pa.array(np.concatenate([g for _, g, _ in parts])),
            "n": pa.array(np.concatenate([n for _, _, n in parts]).astype(np.int64)),
        }

    known = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(column).alias("text"))
    return arrow_map(known, each, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, lang: str = "lang", column: str = "text") -> Profiles:
    """The profiles of ``docs``: one job; at most ``PROFILE`` rows a language reach the driver."""
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = profile_counts(docs, lang, column).withColumn("place", F.row_number().over(order))
    # in this form the limit is known to the planner, and a task sends on a language's first rows only
    rows = top.where(F.col("place") <= PROFILE).select("lang", "gram", F.col("place") - 1).limit(PROFILE * MAX_LANGUAGES + 1).collect()
    if len(rows) > PROFILE * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return Profiles([tuple(r) for r in rows])


def predict(
    docs: DataFrame, profiles: Profiles, column: str = "text", keep: list[str] | None = None, counted: str | None = None
) -> DataFrame:
    """``docs`` (its columns ``keep``) with ``lang_pred`` and ``score``, in place of columns of those names.

    A column ``counted``, if asked for, has how many n-grams of a text were ranked.
    """
    counts = [counted] if counted else []
    added = ("lang_pred", "score", *counts)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    schema = T.StructType(
        [*(docs.schema[c] for c in kept), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
        + [T.StructField(c, T.LongType()) for c in counts]
    )
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def each(batch: pa.RecordBatch) -> dict:
        grams = [ranked(t) for t in batch.column("__text").to_pylist()]
        found = [shared.value.nearest(g) for g in grams]
        out = {c: batch.column(c) for c in kept} | {c: [len(g) for g in grams] for c in counts}
        return out | {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return arrow_map(docs.select(*kept, F.col(column).alias("__text")), each, schema)


def identify(docs: DataFrame, train: Column, keep: list[str] | None = None) -> DataFrame:
    """Learn from the rows where ``train`` holds, predict every row."""
    return predict(docs, learn(docs.where(train)), keep=keep)
