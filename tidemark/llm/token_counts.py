"""Token counts of a byte-level BPE tokenizer, compiled to finite-state transducers.

Two deterministic machines read a text:

* the pre-tokenizer, a table over classes of characters. A transition names the
  places (this character, the one before) where a pre-token begins, so the one
  character of look-ahead that white space needs is delayed output;
* the merges, whose transitions (state, byte) -> (state, tokens added) are compiled from the vocabulary as texts ask
  for them; where bytes merge into fewer tokens a transition takes tokens back. A state is a prefix of a
  pre-token. Its tokens end in the one token that
  stands in a valid pair with the last token of the prefix before it, so a new
  state follows from earlier states of its path without running the merges.

A text is read in chunks. A chunk's map gives, for every state of the pre-tokenizer in which it may
be entered, what it adds to the open pre-token, the tokens of the pre-tokens it closes, the one it leaves open, and the state it is left
in. White space after something else always begins a pre-token, so all entries share the rest of the chunk from the first such place on.
Maps compose associatively; ``scan`` composes neighbours as a parallel prefix scan does. A text of more than ``LONG`` bytes is
dealt to rows of ``CHUNK`` characters, mapped by any tasks and composed by text; only maps meet.

Null texts are empty and have no tokens. Rows are independent, so repeated rows
and empty tables need no rule. Texts of any length are read whole. Only key and text are read.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterable
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map

#: Characters that one state map covers, and bytes of a text from which on its chunks are rows.
CHUNK = 1 << 16
LONG = 1 << 24
#: Units (white space and what follows it) and pre-tokens with known counts, and states of the merges, that a worker keeps.
CACHED_UNITS = 1 << 20
CACHED_LENGTH = 64
TREE_STATES = 1 << 19

# Unicode's White_Space characters.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNITS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall
_SAFE = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")
_IS_WHITE = re.compile(f"[{WHITE}]").match

# Classes of characters. S, R, V and D-like letters may end or go on a contraction.
SPACE, BLANK, LETTER, NUMBER, OTHER, QUOTE, ENDS, NEEDS_E, NEEDS_L, LETTER_E = range(10)
_LETTERS = (LETTER, ENDS, NEEDS_E, NEEDS_L, LETTER_E)
# States: the class of the open pre-token, or how far a contraction has come.
BEGIN, IN_SPACE, IN_BLANK, IN_LETTERS, IN_NUMBER, IN_OTHER, AT_QUOTE, QUOTE_RV, QUOTE_L, DONE = range(10)


def _kind(cls: int) -> int:
    if cls in _LETTERS:
        return IN_LETTERS
    return {SPACE: IN_SPACE, BLANK: IN_BLANK, NUMBER: IN_NUMBER, OTHER: IN_OTHER, QUOTE: IN_OTHER}[cls]


def _fresh(cls: int) -> int:
    """The state of a pre-token that this character begins."""
    return AT_QUOTE if cls == QUOTE else _kind(cls)


def _step(state: int, cls: int) -> tuple[int, tuple[int, ...]]:
    """Next state, and where pre-tokens begin: 0 is this character, -1 the one before."""
    white = cls in (SPACE, BLANK)
    if state in (BEGIN, DONE):
        return _fresh(cls), (0,)
    if state in (IN_SPACE, IN_BLANK):
        if white:
            return _kind(cls), ()
        # the last of the white space leaves the run; a space joins what follows
        return (_kind(cls), (-1,)) if state == IN_SPACE else (_fresh(cls), (-1, 0))
    if state == AT_QUOTE:
        if cls == ENDS:
            return DONE, ()
        if cls in (NEEDS_E, NEEDS_L):
            return (QUOTE_RV if cls == NEEDS_E else QUOTE_L), ()
        state = IN_OTHER
    if state in (QUOTE_RV, QUOTE_L):
        if cls == (LETTER_E if state == QUOTE_RV else NEEDS_L):
            return DONE, ()
        # no contraction: the quote stands alone, its letter begins a word
        after, cuts = _step(IN_LETTERS, cls)
        return after, (-1, *cuts)
    return (state, ()) if _kind(cls) == state else (_fresh(cls), (0,))


TABLE = [[_step(state, cls) for cls in range(10)] for state in range(10)]


class Entry(NamedTuple):
    """What a chunk does if it is entered in one state.

    With ``back`` a pre-token begins at the last character before the chunk. ``join`` goes on the open pre-token; ``count``
    are the tokens of those closed after it; ``tail`` is the one left open, None if ``join`` is all of the chunk; ``state`` is the one it is left in.
    """

    back: bool
    join: str
    count: int
    tail: str | None
    state: int


#: An entry for each state in which a chunk may be entered (for a first chunk: ``BEGIN`` alone).
ChunkMap = dict[int, Entry]


class Units(dict):
    """Counts of units, worked out when first asked for; long units are not kept."""

    def __init__(self, count: Callable[[str], int]) -> None:
        self.count = count

    def __missing__(self, unit: str) -> int:
        known = self.count(unit)
        if len(unit) <= CACHED_LENGTH:
            if len(self) >= CACHED_UNITS:
                self.clear()
            self[unit] = known
        return known


def _byte_letters() -> dict[str, int]:
    """The character that stands for each byte: itself if it is printable Latin-1, else one above 255."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Transducer:
    """The compiled tokenizer of one worker."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before, model = spec["pre_tokenizer"], spec["model"]
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if (
            (before or {}).get("type") != "ByteLevel"
            or before["add_prefix_space"]
            or not before["use_regex"]
            or spec["normalizer"]
            or model["type"] != "BPE"
            or any(model.get(k) for k in plain)
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        ):
            raise ValueError(f"{path}: only plain byte-level BPE can be compiled")
        self.probe = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        letters = _byte_letters()
        as_bytes = lambda s: bytes(map(letters.__getitem__, s))
        added = {t["content"] for t in spec["added_tokens"]}
        self.vocabulary = {as_bytes(t) for t in model["vocab"] if t not in added}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {tuple(map(as_bytes, p)): rank for rank, p in enumerate(pairs)}
        self.longest = max(map(len, self.vocabulary))
        special = sorted(added, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.classes = {" ": SPACE, "'": QUOTE, "r": NEEDS_E, "v": NEEDS_E, "l": NEEDS_L, "e": LETTER_E}
        self.classes |= dict.fromkeys("stmd", ENDS)
        self.spines: tuple[dict, dict] = ({}, {})
        self.whole: dict[bytes, bool] = {}
        #: Transitions of the merges, by state and byte: the next state, and the tokens it adds.
        self.go: dict[int, tuple[int, int]] = {}
        #: Of each state: its number of tokens, and the last of them.
        self.states: list[tuple[int, bytes]] = [(0, b"")]
        self.units = Units(self.count_unit)
        self.known = Units(lambda pre_token: self.count_pre_token(pre_token.encode()))

    def class_of(self, char: str) -> int:
        """The class of a character, as the library's own tables have it."""
        cls = self.classes.get(char)
        if cls is None:
            if _IS_WHITE(char):
                cls = BLANK
            else:
                joins = [c for c, lead in ((LETTER, "a"), (NUMBER, "1")) if len(self.probe(lead + char)) == 1]
                cls = joins[0] if joins else OTHER
            self.classes[char] = cls
        return cls

    def run(self, state: int, text: str) -> tuple[int, list[int]]:
        """The state after a text, and the places in it (-1: before it) where pre-tokens begin."""
        starts, known = [], self.classes.get
        for i, char in enumerate(text):
            cls = known(char)
            state, cuts = TABLE[state][self.class_of(char) if cls is None else cls]
            for c in cuts:
                starts.append(i + c)
        return state, starts

    def pre_tokens(self, text: str) -> list[str]:
        state, starts = self.run(BEGIN, text)
        if state in (QUOTE_RV, QUOTE_L):
            starts.append(len(text) - 1)
        places = sorted({*starts, len(text)})
        return [text[a:b] for a, b in zip(places, places[1:])]

    def spine(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The pieces at one end of a token (0: its start, 1: its end), from a byte to the whole.

        With each goes the rank of the merge that uses it up.
        """
        known = self.spines[side].get(token)
        if known is None:
            parts, known = [token[i : i + 1] for i in range(len(token))], []
            at = -side
            while len(parts) > 1:
                rank, i = min((self.merges.get(p, len(self.merges)), i) for i, p in enumerate(zip(parts, parts[1:])))
                if i == (0 if side == 0 else len(parts) - 2):
                    known.append((parts[at], rank))
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            known.append((token, math.inf))
            self.spines[side][token] = known
        return known

    def is_whole(self, token: bytes) -> bool:
        """Whether the merges make this token of its bytes."""
        known = self.whole.get(token)
        if known is None:
            parts = [token[i : i + 1] for i in range(len(token))]
            while len(parts) > 1:
                rank, i = min((self.merges.get(p, len(self.merges)), i) for i, p in enumerate(zip(parts, parts[1:])))
                if rank == len(self.merges):
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            known = self.whole[token] = len(parts) == 1
        return known

    def is_valid(self, left: bytes, right: bytes) -> bool:
        """Whether the merges leave these two tokens side by side (or the one alone, after nothing).

        Pieces meet at the seam from the bytes up. If the pair that meets has a
        merge that comes before either piece is used up, it joins the two tokens;
        on equal ranks the merge further left comes first.
        """
        if not self.is_whole(right):
            return False
        if not left:
            return True
        ends, starts = self.spine(left, 1), self.spine(right, 0)
        merge, i, j = self.merges.get, 0, 0
        while True:
            (a, a_gone), (b, b_gone) = ends[i], starts[j]
            rank = merge((a, b))
            if rank is not None and rank < a_gone and rank <= b_gone:
                return False
            if a_gone == b_gone == math.inf:
                return True
            if a_gone <= b_gone:
                i += 1
            else:
                j += 1

    def count_pre_token(self, raw: bytes) -> int:
        """Tokens of a pre-token: the sum over its transitions."""
        state, total, go = 0, 0, self.go.get
        path = [0]
        for at, byte in enumerate(raw):
            step = go(state << 8 | byte)
            if step is None:
                return total + self.compile(raw, at, path)
            state, added = step
            total += added
            path.append(state)
        return total

    def compile(self, raw: bytes, at: int, path: list[int]) -> int:
        """Tokens that ``raw`` adds from place ``at`` on, where its first unknown transition is; transitions are kept up to a size.

        ``path``: the states up to there.
        """
        states, vocabulary = self.states, self.vocabulary
        first = max(0, at - self.longest)
        after = [states[s] for s in path[first:]]  # the counts and last tokens from place `first` on
        before, kept = after[-1][0], path[-1]
        for end in range(at + 1, len(raw) + 1):
            for start in range(max(0, end - self.longest), end):
                token = raw[start:end]
                if token in vocabulary:
                    count, last = after[start - first]
                    if self.is_valid(last, token):
                        break
            else:
                raise ValueError(f"no token ends {raw[:end]!r}")
            found = (count + 1, token)
            if kept is not None and end <= CACHED_LENGTH and len(states) < TREE_STATES:
                self.go[kept << 8 | raw[end - 1]] = len(states), found[0] - after[-1][0]
                kept = len(states)
                states.append(found)
            else:
                kept = None
            after.append(found)
            if len(after) > 8 * self.longest:  # states further back are not asked for
                drop = len(after) - self.longest - 1
                del after[:drop]
                first += drop
        return after[-1][0] - before

    def count_unit(self, unit: str) -> int:
        """Tokens of a text that begins where a pre-token begins, and after which one ends."""
        return sum([self.known[p] for p in self.pre_tokens(unit)])

    def tokens(self, pre_token: str) -> int:
        return self.known[pre_token] if pre_token else 0

    def chunk_map(self, chunk: str, entries: Iterable[int] = range(10)) -> ChunkMap:
        """The map of a chunk (not empty), for some entries or all."""
        safe = _SAFE.search(chunk)
        at = len(chunk) if safe is None else safe.start()
        count, tail, left = 0, None, None
        if safe is not None:  # from here on all entries are in one state
            units = _UNITS(chunk[at:])
            last = len(chunk) - len(units.pop())
            left, starts = self.run(BEGIN, chunk[last:])
            places = [last + p for p in starts]
            count = sum(map(self.units.__getitem__, units)) + sum(self.tokens(chunk[a:b]) for a, b in zip(places, places[1:]))
            tail = chunk[places[-1] :]
        out = {}
        for state in entries:
            after, starts = self.run(state, chunk[: at + 1] if safe is not None else chunk)
            places = sorted({p for p in starts if p >= 0})
            back = -1 in starts
            closed = sum(self.tokens(chunk[a:b]) for a, b in zip(places, places[1:]))
            if safe is not None:
                out[state] = Entry(back, chunk[: places[0]], closed + count, tail, left)
            elif places:
                out[state] = Entry(back, chunk[: places[0]], closed, chunk[places[-1] :], after)
            else:
                out[state] = Entry(back, chunk, 0, None, after)
        return out

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """The map of both chunks, entered as the first is."""
        out = {}
        for state, one in a.items():
            two = b[one.state]
            held = one.join if one.tail is None else one.tail  # what is open where the chunks meet
            if one.tail is None and not two.back:
                out[state] = Entry(one.back, held + two.join, two.count, two.tail, two.state)
                continue
            join = one.join if one.tail is not None else held[:-1]
            count = one.count
            if two.back:
                if one.tail is not None:
                    count += self.tokens(held[:-1])
                held = held[-1:]
            if two.tail is None:
                out[state] = Entry(one.back, join, count, held + two.join, two.state)
            else:
                out[state] = Entry(one.back, join, count + self.tokens(held + two.join) + two.count, two.tail, two.state)
        return out

    def scan(self, maps: list[ChunkMap]) -> ChunkMap:
        """All maps composed, neighbours first; their order stays."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def total(self, whole: ChunkMap) -> int:
        """Tokens of a text with this map."""
        one = whole[BEGIN]
        if one.state in (QUOTE_RV, QUOTE_L):  # no contraction after all
            return one.count + self.tokens(one.tail[:-1]) + self.tokens(one.tail[-1:])
        return one.count + self.tokens(one.tail)

    def count_ordinary(self, text: str) -> int:
        maps = [self.chunk_map(text[i : i + CHUNK], range(10) if i else (BEGIN,)) for i in range(0, len(text), CHUNK)]
        return self.total(self.scan(maps))

    def parts(self, text: str) -> list[str]:
        """The text between special tokens."""
        return [text] if self.special is None else self.special.split(text)

    def count(self, text: str | None) -> int:
        """Tokens of a text; a special token's text counts as that one token."""
        if not text:
            return 0
        parts = self.parts(text)
        return len(parts) - 1 + sum(map(self.count_ordinary, filter(None, parts)))


_compiled: dict[str, Transducer] = {}


def compiled(path: str) -> Transducer:
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` per row; ``path`` is the tokenizer file on every machine."""
    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def each(batch: pa.RecordBatch) -> dict:
        one = compiled(path)
        counts = [one.count(t) for t in batch.column("__text").to_pylist()]
        return {
            key: batch.column(key),
            "n_bytes": batch.column("__bytes"),
            "n_tokens": counts,
            "over_limit": [n > limit for n in counts],
        }

    text = F.col(column)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = docs.select(key, text.alias("__text"), size.alias("__bytes"))
    short, long = rows.where(F.col("__bytes") <= LONG), rows.where(F.col("__bytes") > LONG)
    return arrow_map(short, each, schema).unionByName(_count_long(long, path, limit, key, schema))


ENTRIES = T.ArrayType(
    T.StructType(
        [
            T.StructField("entered", T.IntegerType()),
            T.StructField("back", T.BooleanType()),
            T.StructField("join", T.StringType()),
            T.StructField("count", T.LongType()),
            T.StructField("tail", T.StringType()),
            T.StructField("state", T.IntegerType()),
        ]
    )
)


def _count_long(rows: DataFrame, path: str, limit: int, key: str, schema: T.StructType) -> DataFrame:
    """Very long texts: their chunks are rows, mapped by any task; the maps of one text are composed in order."""
    numbered = rows.withColumn("__row", F.monotonically_increasing_id())
    head = [T.StructField("__row", T.LongType()), schema[key], *(T.StructField(c, T.LongType()) for c in ("__bytes", "__part", "__at"))]

    def cut(batch: pa.RecordBatch) -> dict:
        one = compiled(path)
        out: dict[str, list] = {f.name: [] for f in head} | {"__chunk": []}
        for row, its_key, size, text in zip(*(batch.column(c).to_pylist() for c in ("__row", key, "__bytes", "__text"))):
            for part, between in enumerate(one.parts(text)):
                for at in range(0, max(len(between), 1), CHUNK):
                    for name, value in zip(out, (row, its_key, size, part, at, between[at : at + CHUNK])):
                        out[name].append(value)
        return out

    chunks = arrow_map(numbered, cut, T.StructType([*head, T.StructField("__chunk", T.StringType())]), rows=1)

    def mapped(batch: pa.RecordBatch) -> dict:
        one = compiled(path)
        maps = [
            [] if not chunk else [{"entered": s, **e._asdict()} for s, e in one.chunk_map(chunk, range(10) if at else (BEGIN,)).items()]
            for at, chunk in zip(batch.column("__at").to_pylist(), batch.column("__chunk").to_pylist())
        ]
        return {f.name: batch.column(f.name) for f in head} | {"__map": maps}

    dealt = chunks.repartition("__row", "__part", "__at")
    maps = arrow_map(dealt, mapped, T.StructType([*head, T.StructField("__map", ENTRIES)]))

    def composed(group: pd.DataFrame) -> pd.DataFrame:
        one = compiled(path)
        total = group["__part"].nunique() - 1
        for _, part in group.sort_values("__at").groupby("__part"):
            found = [{e.pop("entered"): Entry(**e) for e in map(dict, entries)} for entries in part["__map"] if len(entries)]
            total += one.total(one.scan(found)) if found else 0
        first = group.iloc[0]
        return pd.DataFrame({key: [first[key]], "n_bytes": [first["__bytes"]], "n_tokens": [total], "over_limit": [total > limit]})

    return maps.groupBy("__row").applyInPandas(composed, schema)
