"""License scan: exact containment join of text blocks with paragraphs of licenses.

A block is a window of twice as many words as a paragraph has, at every multiple
of its length, so each run of that many words lies in one. A paragraph is
found in a block that holds at least ``THRESHOLD`` of its distinct words and, if it has a name, the name's words in a row:

* words of the paragraphs are counted over all documents, and each paragraph is
  ordered by them, rarest first (a word no document has comes first);
* prefix filter: a block with enough of the words has one of the first
  ``n - needed + 1``, so only blocks around such a word are looked at;
* length filter: a block with fewer distinct words than needed is passed over;
* positional filter: a block is left as soon as the words found and those that
  are still to come are too few.

A text of under ``SHORT`` words is a name itself: all its words, in a row, are found at
their places. Of names that overlap, one that goes on in another gives way to it ("cc by" in "cc by nc").

Beside them the places of fixed phrases are listed (``base``).

Null texts are empty: no words, no labels. Rows are independent, and only key and text are read. Texts of any length are
read whole, ``PIECE`` bytes at a time. Paragraphs are a
parameter; they and their words go to every task and may have ``MAX_WORDS``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, utf8

THRESHOLD = 0.8
MAX_WORDS = 100_000
SHORT = 10
PIECE = 1 << 20

# The phrases of the contract.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Label, paragraph of the public license text, and words that must stand in it in a row.
PARAGRAPHS = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
        " (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do"
        " so, subject to the following conditions",
        "",
    ),
    (
        "mit",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "substantial portions",
    ),
    (
        "mit",
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of"
        " merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable"
        " for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in"
        " connection with the software or the use or other dealings in the software",
        "use or other dealings in the software",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met",
        "",
    ),
    (
        "bsd",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in"
        " the documentation and/or other materials provided with the distribution",
        "",
    ),
    (
        "bsd",
        "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not"
        " limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the"
        " copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages"
        " (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business"
        " interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence"
        " or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage",
        "",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided"
        " that the above copyright notice and this permission notice appear in all copies",
        "",
    ),
    (
        "isc",
        "The software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties"
        " of merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or consequential damages"
        " or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other"
        " tortious action, arising out of or in connection with the use or performance of this software",
        "",
    ),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You"
        " may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "apache license",
    ),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an as is basis,"
        " without warranties or conditions of any kind, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License",
        "",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "gnu general public license",
    ),
    (
        "gpl",
        "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of"
        " merchantability or fitness for a particular purpose. See the GNU General Public License for more details",
        "gnu general public license",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
        " published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
        "gnu lesser general public license",
    ),
    (
        "agpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "gnu affero general public license",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with"
        " this file, You can obtain one at https://mozilla.org/MPL/2.0/",
        "mozilla public license",
    ),
    (
        "epl",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available"
        " at https://www.eclipse.org/legal/epl-2.0/",
        "eclipse public license",
    ),
    (
        "unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled"
        " binary, for any purpose, commercial or non-commercial, and by any means",
        "",
    ),
    (
        "zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages"
        " arising from the use of this software",
        "without any express or implied warranty",
    ),
    (
        "zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and"
        " redistribute it freely, subject to the following restrictions",
        "",
    ),
    (
        "cc0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "",
    ),
]

# Names of licenses.
NAMES = [
    ("bsd", "BSD license"),
    ("bsd", "2-clause BSD"),
    ("bsd", "3-clause BSD"),
    ("isc", "ISC license"),
    ("lgpl", "Lesser General Public License"),
    ("agpl", "Affero General Public License"),
    ("mpl", "Mozilla Public License"),
    ("epl", "Eclipse Public License"),
    ("unlicense", "free and unencumbered software released into the public domain"),
    ("zlib", "zlib license"),
    ("cc0", "CC0 1.0 Universal"),
    ("cc-by", "CC BY"),
    ("cc-by-sa", "CC BY-SA"),
    ("cc-by-nd", "CC BY-ND"),
    ("cc-by-nc", "CC BY-NC"),
    ("cc-by-nc-sa", "CC BY-NC-SA"),
    ("cc-by-nc-nd", "CC BY-NC-ND"),
    ("cc-by", "Creative Commons Attribution"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike"),
    ("cc-by-nd", "Creative Commons Attribution-NoDerivatives"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial"),
    ("cc-by-nc-sa", "Creative Commons Attribution-NonCommercial-ShareAlike"),
    ("cc-by-nc-nd", "Creative Commons Attribution-NonCommercial-NoDerivatives"),
]

NOTICES = PARAGRAPHS + [(label, name, "") for label, name in NAMES]

#: Everything but digits, letters and bytes above 127 parts words; A-Z are lowered.
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD).split() if text else []


def pieces(text: bytes | None, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, in lists of those of about ``size`` bytes."""
    folded = (text or b"").translate(_WORD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + size)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def places_of(phrase: list[bytes], block: list[bytes]) -> Iterator[int]:
    """Where the words of the phrase stand in a row."""
    at = -1
    while (at := next((i for i in range(at + 1, len(block) - len(phrase) + 1) if block[i] == phrase[0]), -1)) >= 0:
        if block[at : at + len(phrase)] == phrase:
            yield at


class Notice:
    """A paragraph or name with its distinct words in global order."""

    def __init__(self, label: str, text: str, name: str, counts: dict[bytes, int], threshold: float) -> None:
        self.label = label
        listed = words(text.encode())
        self.span = len(listed)
        self.short = self.span < SHORT
        self.name = listed if self.short else words(name.encode())
        self.order = sorted(set(listed), key=lambda w: (counts.get(w, 0), w))
        self.needed = max(1, ceil((1 if self.short else threshold) * len(self.order) - 1e-9))
        self.prefix = self.order[: len(self.order) - self.needed + 1]

    def containment(self, block: list[bytes]) -> float:
        """Share of the words in the block; 0 if under the threshold, or without the name."""
        held = set(block)
        if len(held) < self.needed:
            return 0.0
        found, left = 0, len(self.order)
        for word in self.order:
            left -= 1
            found += word in held
            if found + left < self.needed:
                return 0.0
        if self.name and next(places_of(self.name, block), None) is None:
            return 0.0
        return found / len(self.order)


class Scanner:
    def __init__(
        self, notices: list[tuple[str, str, str]], phrases: dict[str, str], counts: dict[bytes, int], threshold: float
    ) -> None:
        self.notices = [Notice(*notice, counts, threshold) for notice in notices]
        self.by_word: dict[bytes, list[int]] = {}
        for i, notice in enumerate(self.notices):
            for word in notice.prefix:
                self.by_word.setdefault(word, []).append(i)
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        self.ends = {p[-1] for p, _ in self.phrases}
        #: Words that a window or phrase may reach back.
        self.reach = max([2 * n.span for n in self.notices] + [len(p) for p, _ in self.phrases], default=0)

    def scan(self, text: bytes | None, piece: int = PIECE) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int, float]]]:
        """Number of words, phrases as (first word, label), and blocks as (label, start, end, containment)."""
        base: list[tuple[int, str]] = []
        near: set[tuple[int, int]] = set()
        done: list[tuple[int, int, int, float]] = []
        asked = self.ends | self.by_word.keys()
        held: list[bytes] = []  # the last words, from place ``first``
        first = 0
        for listed in pieces(text, piece):
            new = first + len(held)
            held += listed
            for at, word in enumerate(listed, new):
                if word not in asked:
                    continue
                if word in self.ends:
                    for phrase, label in self.phrases:
                        start = at - len(phrase) + 1
                        if start >= 0 and held[start - first : at + 1 - first] == phrase:
                            base.append((start, label))
                for i in self.by_word.get(word, ()):
                    block = at // self.notices[i].span
                    near.update(((i, block), (i, block - 1)) if block else ((i, block),))
            whole = {(i, block) for i, block in near if (block + 2) * self.notices[i].span <= first + len(held)}
            done += self._blocks(whole, held, first)
            near -= whole
            # windows that are not whole yet begin among the last words
            cut = max(0, len(held) - self.reach)
            held, first = held[cut:], first + cut
        done += self._blocks(near, held, first)
        return first + len(held), sorted(base), self._settled(done)

    def _blocks(self, near: set[tuple[int, int]], held: list[bytes], first: int) -> Iterator[tuple[int, int, int, float]]:
        for i, block in sorted(near):
            notice = self.notices[i]
            start = block * notice.span - first
            inside = held[start : start + 2 * notice.span]
            share = notice.containment(inside)
            if share and notice.short:
                for at in places_of(notice.name, inside):
                    yield i, first + start + at, first + start + at + notice.span, share
            elif share:
                yield i, first + start, first + start + len(inside), share

    def _settled(self, found: list[tuple[int, int, int, float]]) -> list[tuple[str, int, int, float]]:
        """Blocks in order, names once for each place and without those that go on in a longer one."""
        longest: dict[int, int] = {}
        for i, start, end, _ in found:
            if self.notices[i].short:
                longest[start] = max(longest.get(start, 0), end)
        kept = {f for f in found if not self.notices[f[0]].short or longest[f[1]] == f[2]}
        return [(self.notices[i].label, start, end, share) for i, start, end, share in sorted(kept)]


def word_counts(docs: DataFrame, vocabulary: set[bytes], column: str = "text") -> dict[bytes, int]:
    """How many documents hold each word of the notices, over all documents."""
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def each(batch: pa.RecordBatch) -> dict:
        counts: dict[bytes, int] = {}
        for text in utf8(batch.column("text")):
            for word in vocabulary.intersection(chain.from_iterable(pieces(text, PIECE))):
                counts[word] = counts.get(word, 0) + 1
        return {"word": [w.decode() for w in counts], "n": list(counts.values())}

    rows = arrow_map(docs.select(F.col(column).alias("text")), each, schema).groupBy("word").agg(F.sum("n")).collect()
    return {word.encode(): n for word, n in rows}


PLACE = T.ArrayType(T.StructType([T.StructField("word", T.LongType()), T.StructField("label", T.StringType())]))
BLOCK = T.ArrayType(
    T.StructType(
        [
            T.StructField("label", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("containment", T.DoubleType()),
        ]
    )
)


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    column: str = "text",
    notices: list[tuple[str, str, str]] = NOTICES,
    phrases: dict[str, str] = PHRASES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``key, n_words, places, blocks`` per row: phrases and paragraphs found, by their words."""
    vocabulary = {w for _, text, _ in notices for w in words(text.encode())}
    if sum(len(words(text.encode())) for _, text, _ in notices) > MAX_WORDS:
        raise ValueError(f"notices of more than {MAX_WORDS} words")
    scanner = Scanner(notices, phrases, word_counts(docs, vocabulary, column), threshold)
    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("n_words", T.LongType()),
            T.StructField("places", PLACE),
            T.StructField("blocks", BLOCK),
        ]
    )

    def each(batch: pa.RecordBatch) -> dict:
        found = [scanner.scan(t, PIECE) for t in utf8(batch.column("__text"))]
        return {
            key: batch.column(key),
            "n_words": [f[0] for f in found],
            "places": [[{"word": w, "label": label} for w, label in f[1]] for f in found],
            "blocks": [[dict(zip(("label", "start", "end", "containment"), b)) for b in f[2]] for f in found],
        }

    return arrow_map(docs.select(key, F.col(column).alias("__text")), each, schema)
