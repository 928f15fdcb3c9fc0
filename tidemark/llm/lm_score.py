"""Language-model scores: the marginal probability of a text over a lattice of subwords.

The vocabulary is an existing one, a sentencepiece model's pieces. Every way to
cut a word (behind a mark for the space before it) into pieces is a path of the
word's lattice, weighted by the product of its pieces' probabilities, and the
forward recursion sums all paths in log space. A text is its words and an end.
Characters that no piece has are spelled by byte pieces.

The vocabulary's own scores are ranks, not log-probabilities, so the weights are
fitted: how often its own segmentation of the training words uses each piece,
plus one. The same counts give the base score, an add-one unigram of words.

All that depends on a word alone is worked out once per distinct word of the
corpus, in a table of words: its training count and its log-probability. Words
with a share of 1 / ``FREQUENT`` of all tokens, at most that many, go to every
task (words above ``FREQUENT_BYTES`` as digests, so their size is bounded). The rest
are joined by word; no word that is left has more rows than that share.

Defined results: null texts are empty, just an end. Rows without a key train.
Without training rows every token is unknown. Repeated rows count and are scored
as often as they occur. Words and texts of any length are scored whole. Only the key, the text and what ``held_out``
names are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, lower_words, utf8, written

FREQUENT = 1 << 17
FREQUENT_BYTES = 128
MARK = "▁"
END = "</s>"
_BYTE = "<0x%02X>"


class Vocabulary:
    """The pieces of a sentencepiece model and its own segmentation."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        special = {i for i in range(len(self.model)) if self.model.is_control(i) or self.model.is_unknown(i)}
        spelled = [_BYTE % b for b in range(256)]
        self.pieces = [self.model.id_to_piece(i) for i in range(len(self.model)) if i not in special]
        self.pieces = list(dict.fromkeys([*self.pieces, *spelled]))
        self.names = {i: self.model.id_to_piece(i) for i in range(len(self.model))}

    def uses(self, words: list[str], times: list[int]) -> Counter:
        used: Counter = Counter()
        for ids, n in zip(self.model.encode(words, num_threads=1), times):
            for i in ids:
                used[i] += n
        return Counter({self.names[i]: n for i, n in used.items()})


class Lattice:
    """Natural log-probabilities of pieces, and sums over all segmentations."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights
        self.bytes = [weights[_BYTE % b] for b in range(256)]
        spelled = {_BYTE % b for b in range(256)}
        self.pieces = {p: w for p, w in weights.items() if p != END and p not in spelled}
        self.longest = max(map(len, self.pieces), default=1)

    def word(self, word: str) -> float:
        """Log-probability of a word, its segmentations together, by the forward recursion."""
        text = MARK + word
        get, longest, exp = self.pieces.get, self.longest, math.exp
        sums = [0.0]
        for end in range(1, len(text) + 1):
            paths = []
            for start in range(end - longest if end > longest else 0, end):
                weight = get(text[start:end])
                if weight is not None:
                    paths.append(sums[start] + weight)
            if text[end - 1] not in self.pieces:
                spelled = text[end - 1].encode("utf-8", "replace")
                paths.append(sums[-1] + sum(self.bytes[b] for b in spelled))
            if len(paths) == 1:
                sums.append(paths[0])
            else:
                top = max(paths)
                sums.append(top + math.log(sum([exp(p - top) for p in paths])))
        return sums[-1]


_loaded: dict[str, Vocabulary] = {}
_built: list[tuple[object, Lattice]] = []


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _lattice(weights: dict[str, float]) -> Lattice:
    """The lattice of weights that were broadcast, built once in a worker."""
    if not _built or _built[0][0] is not weights:
        _built[:] = [(weights, Lattice(weights))]
    return _built[0][1]


def known_as(word: bytes) -> bytes:
    """A word itself, or a digest in place of a very long one; words hold no space."""
    return word if len(word) <= FREQUENT_BYTES else b" " + hashlib.blake2b(word, digest_size=32).digest()


WORD_COUNTS = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` of every word in ``text``: its occurrences in rows that are not ``held_out``."""

    def each(batch: pa.RecordBatch) -> dict:
        counts: Counter = Counter()
        others: set[bytes] = set()
        for text, out in zip(utf8(batch.column("text")), batch.column("held_out").to_pylist()):
            if out:
                others.update(lower_words(text))
            else:
                counts.update(lower_words(text))
        others.difference_update(counts)
        return {"word": [*counts, *others], "n": [*counts.values(), *[0] * len(others)]}

    return arrow_map(docs.select("text", "held_out"), each, WORD_COUNTS).groupBy("word").agg(F.sum("n").alias("n"))


def fit(counts: DataFrame, n_ends: int, path: str) -> dict[str, float]:
    """Log-probabilities of the pieces and the end; a number per piece reaches the driver."""
    schema = T.StructType([T.StructField("piece", T.StringType()), T.StructField("n", T.LongType())])

    def each(batch: pa.RecordBatch) -> dict:
        words = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
        used = vocabulary(path).uses(words, batch.column("n").to_pylist())
        return {"piece": list(used), "n": list(used.values())}

    rows = arrow_map(counts.where("n > 0"), each, schema).groupBy("piece").agg(F.sum("n")).collect()
    found = dict.fromkeys(vocabulary(path).pieces, 1)
    for piece, n in rows:
        if piece in found:
            found[piece] += n
    found[END] = n_ends + 1
    total = math.log(sum(found.values()))
    return {p: math.log(n) - total for p, n in found.items()}


def word_table(counts: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``word, n, ln``: the words (as ``known_as`` has them) with their log-probability."""
    shared = counts.sparkSession.sparkContext.broadcast(weights)
    schema = T.StructType([*WORD_COUNTS.fields, T.StructField("ln", T.DoubleType())])

    def each(batch: pa.RecordBatch) -> dict:
        model = _lattice(shared.value)
        words = batch.column("word").to_pylist()
        scores = [model.word(w.decode("utf-8", "replace")) for w in words]
        return {"word": list(map(known_as, words)), "n": batch.column("n"), "ln": scores}

    return arrow_map(counts, each, schema)


RARE = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("times", T.IntegerType())]))


def score(docs: DataFrame, held_out: Column, path: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    The models learn from the rows where ``held_out`` does not hold; ``path`` is
    the sentencepiece model on every machine.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("key"), held_out.alias("held_out"), F.col(column).alias("text"))
    counts = written(count_words(docs), "word-counts")
    ends = docs.where(~F.col("held_out")).count()
    distinct, in_words = counts.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    total = in_words + ends
    base = total + distinct + (1 if ends else 0) + 1
    weights = fit(counts, ends, path)
    words = written(word_table(counts, weights), "words")
    often = (F.col("n") * FREQUENT >= total) & (F.col("n") > 0)
    frequent = {bytes(w): (math.log10((n + 1) / base), ln / math.log(10)) for w, n, ln in words.where(often).collect()}
    shared = spark.sparkContext.broadcast(frequent)
    end_base, end_score = math.log10((ends + 1) / base), weights[END] / math.log(10)
    schema = T.StructType(
        [
            docs.schema["key"],
            docs.schema["held_out"],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("known", T.LongType()),
            T.StructField("base", T.DoubleType()),
            T.StructField("part", T.DoubleType()),
            T.StructField("rare", RARE),
        ]
    )

    def each(batch: pa.RecordBatch) -> dict:
        known = shared.value
        rows = []
        for text in utf8(batch.column("text")):
            held = Counter(lower_words(text))
            n_tokens, n_known, in_base, in_score, rare = 1, int(ends > 0), end_base, end_score, []
            for word, times in held.items():
                n_tokens += times
                name = word if len(word) <= FREQUENT_BYTES else known_as(word)
                found = known.get(name)
                if found is None:
                    rare.append((name, times))
                else:
                    n_known += times
                    in_base += times * found[0]
                    in_score += times * found[1]
            rows.append((n_tokens, n_known, in_base, in_score, rare))
        tokens, n_known, in_base, in_score, rare = zip(*rows)
        pairs = pa.StructArray.from_arrays(
            [
                pa.array([w for r in rare for w, _ in r], pa.binary()),
                pa.array([t for r in rare for _, t in r], pa.int32()),
            ],
            ["word", "times"],
        )
        ends_at = [0]
        for r in rare:
            ends_at.append(ends_at[-1] + len(r))
        return {
            "key": batch.column("key"),
            "held_out": batch.column("held_out"),
            "n_tokens": list(tokens),
            "known": list(n_known),
            "base": list(in_base),
            "part": list(in_score),
            "rare": pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), pairs),
        }

    scored = arrow_map(docs, each, schema).withColumn("row", F.monotonically_increasing_id())
    scored = written(scored, "scored")
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    times = F.col("times")
    sums = (
        rare.join(words, "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") > 0, times).otherwise(0)).alias("more_known"),
            F.sum(times * F.log10((F.col("n") + 1) / F.lit(float(base)))).alias("more_base"),
            F.sum(times * F.col("ln") / math.log(10)).alias("more_score"),
        )
    )
    more = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.drop("rare").join(sums, "row", "left").select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("known") + more("more_known")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + more("more_base")).alias("base_score"),
        (F.col("part") + more("more_score")).alias("score"),
    )
