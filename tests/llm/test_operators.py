"""Each operator against a brute-force version, on ordinary rows and on every odd case."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from tidemark.llm import (  # noqa: E402
    ann,
    bpe,
    components,
    language_id,
    licenses,
    line_dedup,
    lm_score,
    mixing,
    quality,
    queries,
    simhash,
    token_counts,
)
from tidemark.llm.common import is_remainder  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def listed(text):
    return WORD.findall(lowered(text))


def multiset(found):
    return sorted(map(repr, found))


# Tokens


def test_token_counts_are_those_of_the_library(docs, rows, no_docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(str(path))
    want = [
        (i, len((t or "").encode()), n, n > 1024)
        for i, t, *_ in rows
        for n in [len(library.encode(t or "", add_special_tokens=False).ids)]
    ]
    assert multiset(map(tuple, token_counts.count_tokens(docs, str(path)).collect())) == multiset(want)
    assert token_counts.count_tokens(no_docs, str(path)).count() == 0


@pytest.mark.parametrize("chunk", [1, 2, 7, 1 << 16])
def test_chunks_compose(monkeypatch, chunk):
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    library, one = Tokenizer.from_file(path), token_counts.compiled(path)
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    rng = random.Random(chunk)
    parts = ["'", "s", "'re", "'ll", "'v", " ", "  ", "\n", "the", "1", "!", "é", "日本", " ", "<|endoftext|>", "r", "\x1c", "\x00"]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randint(0, 20)))
        assert one.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_maps_compose_in_any_order():
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    one = token_counts.compiled(path)
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choices(["'", "s", "r", "e", " ", "  ", "\n", "the", "1", "!", "é", "日本", "ll"], k=rng.randint(1, 14)))
        cuts = sorted(rng.sample(range(1, len(text)), min(len(text) - 1, rng.randint(0, 5))))
        pieces = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        maps = [one.chunk_map(p) for p in pieces]
        while len(maps) > 1:
            i = rng.randrange(len(maps) - 1)
            maps[i : i + 2] = [one.compose(maps[i], maps[i + 1])]
        assert maps[0] == one.chunk_map(text), (text, pieces)
        assert one.total(maps[0]) == one.count(text)


def test_transitions_carry_counts():
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    one = token_counts.Transducer(path)
    word = b" unbelievable"
    assert one.count_pre_token(word) == one.count_pre_token(word)
    state, total = 0, 0
    for byte in word:
        state, added = one.go[state << 8 | byte]
        total += added
    assert total == one.count_pre_token(word) == one.states[state][0]


def test_long_texts_are_composed_over_rows(spark, monkeypatch):
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    library = Tokenizer.from_file(path)
    rng = random.Random(5)
    texts = ["".join(rng.choices(["'", "s", "'re", " ", "  ", "\n", "the", " of", "1", "é", "日本", "<|endoftext|>", "r"], k=400)) for _ in range(12)]
    texts += ["x" * 500, "", None, "<|endoftext|>" * 9, "short", " " * 300, "'r" + " " * 60 + "'l"]
    monkeypatch.setattr(token_counts, "LONG", 40)
    monkeypatch.setattr(token_counts, "CHUNK", 7)
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[0])], "doc_id long, text string").repartition(3)
    got = token_counts.count_tokens(df, path).collect()
    want = [(i, len((t or "").encode()), n, n > 1024) for i, t in [*enumerate(texts), (None, texts[0])] for n in [len(library.encode(t or "", add_special_tokens=False).ids)]]
    assert multiset(map(tuple, got)) == multiset(want)


def test_bpe_encodes_as_the_library_and_decodes(docs, rows, no_docs):
    import tiktoken

    path, pattern = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN
    library = tiktoken.Encoding("x", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    encoded = bpe.encode(docs, path, pattern)
    assert sorted(encoded.columns) == sorted(docs.columns)
    got = bpe.decode(encoded, path, pattern).select("doc_id", "ids", "decoded").collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows]
    assert multiset((i, ids, bytes(d)) for i, ids, d in got) == multiset(want)
    assert bpe.encode(no_docs, path, pattern).count() == 0


def test_bpe_query(spark, sf_dir, rows):
    got = {r.doc_id: r for r in queries.op6_byte_bpe(spark, sf_dir).collect()}
    assert got[43].n_tokens == 0 and got[43].ids_sha256 == hashlib.sha256(b"").hexdigest()
    for i, text, *_ in rows:
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest() or i is None


# Language models


def test_lattice_sums_all_segmentations():
    pieces = {"▁a": 0.2, "b": 0.1, "▁": 0.1, "a": 0.1, "ab": 0.05, "▁ab": 0.03} | {f"<0x{b:02X}>": 0.001 for b in range(256)}
    lattice = lm_score.Lattice({p: math.log(w) for p, w in pieces.items()} | {lm_score.END: math.log(0.1)})
    by_hand = 0.03 + 0.2 * 0.1 + 0.1 * 0.05 + 0.1 * 0.1 * 0.1
    assert math.isclose(math.exp(lattice.word("ab")), by_hand)
    assert math.isclose(math.exp(lattice.word("é")), 0.1 * 0.001**2)


def test_lm_score(docs, rows, no_docs):
    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    got = lm_score.score(docs, is_remainder(7, 2), path).collect()
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows]
    words = Counter(w for (_, t, *_), o in zip(rows, out) if not o for w in listed(t))
    ends = out.count(False)
    total, size = sum(words.values()) + ends, len(words) + 1
    vocabulary = lm_score.Vocabulary(path)
    used = vocabulary.uses(list(words), list(words.values()))
    counts = {p: used[p] + 1 for p in vocabulary.pieces} | {lm_score.END: ends + 1}
    lattice = lm_score.Lattice({p: math.log(n / sum(counts.values())) for p, n in counts.items()})
    want = []
    for (i, t, *_), o in zip(rows, out):
        mine = listed(t)
        tokens = [*(words[w] for w in mine), ends]
        base = sum(math.log10((c + 1) / (total + size + 1)) for c in tokens)
        score = (sum(map(lattice.word, mine)) + lattice.weights[lm_score.END]) / math.log(10)
        want.append((i, o, len(tokens), sum(c > 0 for c in tokens), total, round(base, 6), round(score, 6)))
    assert multiset((*r[:5], round(r[5], 6), round(r[6], 6)) for r in got) == multiset(want)
    assert lm_score.score(no_docs, is_remainder(7, 2), path).count() == 0


def test_lm_score_without_training_rows(docs):
    from pyspark.sql import functions as F

    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    got = lm_score.score(docs, F.lit(True), path).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.score < 0 for r in got)


# Near duplicates


def fingerprint(text):
    import xxhash

    w = listed(text)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(n, linked):
    label = list(range(n))
    for _ in range(n):
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_simhash_groups(docs, rows, no_docs):
    fps = [fingerprint(t) for _, t, *_ in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    label = closure(len(rows), pairs)
    least = defaultdict(lambda: None)
    for (i, *_), g in zip(rows, label):
        if i is not None:
            least[g] = i if least[g] is None else min(least[g], i)
    got = simhash.groups(docs).collect()
    want = [(i, f, least[g]) for (i, *_), f, g in zip(rows, fps, label)]
    assert multiset((i, f % (1 << 64), c) for i, f, c in got) == multiset(want)
    assert simhash.groups(no_docs).count() == 0


def test_simhash_links_find_every_pair(spark):
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in list(fps):
        for d in range(1, 6):
            fps.append(f ^ sum(1 << b for b in rng.sample(range(64), d)))
    signed = [f - (1 << 64) if f >> 63 else f for f in {*fps, 0, 1, (1 << 64) - 1}]
    got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).distinct().collect()
    mask = (1 << 64) - 1
    want = {frozenset((a, b)) for a in signed for b in signed if a != b and ((a ^ b) & mask).bit_count() <= 3}
    assert {frozenset((r.a, r.b)) for r in got} == want


def test_simhash_keeps_one_of_each_group(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 3 in ids and not {40, 41} & set(ids) and ids.count(None) == 1 and ids.count(43) + ids.count(44) + ids.count(45) == 1


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(30)] + [(500, i) for i in range(501, 560)]
    edges += [(None, 1), (7, 7), (900, 900)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    known = [(a, b) for a, b in edges if a is not None]
    nodes = sorted({n for e in known for n in e})
    at = {n: i for i, n in enumerate(nodes)}
    label = closure(len(nodes), [(at[a], at[b]) for a, b in known])
    assert got == {n: nodes[label[at[n]]] for n in nodes}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def similar(a, b):
    shared = sum((Counter(a) & Counter(b)).values())
    return 5 * shared >= 4 * (len(a) + len(b) - shared)


def brute_dedup(rows):
    """Kept text by (key, text); lines in order of key (None last), then place."""
    import itertools

    keys = sorted({(i is None, i or 0, t or "", i, t) for i, t, *_ in rows}, key=lambda k: k[:3])
    seen, out = [], {}
    for *_, i, t in keys:
        left = []
        for line in (t or "").split("\n"):
            w = listed(line)
            if not w or not any(similar(w, s) for s in itertools.chain(seen)):
                left.append(line)
            if w:
                seen.append(w)
        out[i, t] = None if t is None else "\n".join(left)
    return out


@pytest.mark.parametrize("held", [2, 1 << 16])
def test_line_dedup(spark, docs, rows, no_docs, monkeypatch, held):
    unique = [r for r in rows if r[0] is not None]
    want = brute_dedup(unique)
    monkeypatch.setattr(line_dedup, "HELD", held)
    given = docs.where("doc_id IS NOT NULL")
    out = line_dedup.dedup(given)
    assert sorted(out.columns) == sorted({*docs.columns, "n_lines", "n_removed"})
    assert multiset((r.doc_id, r.text) for r in out.collect()) == multiset((i, want[i, t]) for i, t, *_ in unique)
    assert line_dedup.dedup(docs).where("doc_id IS NULL").count() == 2
    assert line_dedup.dedup(no_docs).count() == 0


def test_line_dedup_of_many_near_copies(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(50)}" for _ in range(30)]
    rows = []
    for i in range(120):
        line = list(base)
        for at in rng.sample(range(30), rng.randrange(5)):
            line[at] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(line)))
    want = brute_dedup(rows)
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in got} == {(i, want[i, t]) for i, t in rows}


def lines_with_others(lines, times):
    """Documents of these lines, then of lines that bring each of their words ``times`` (by word, else 5) more."""
    words = sorted({w for line in lines for w in line})
    fill = [[w, *(f"{w}f{n}f{i}" for i in range(9))] for w in words for n in range(times.get(w, 5))]
    return [(i, " ".join(line)) for i, line in enumerate([*lines, *fill])]


def test_lines_are_parted_and_hashed_as_by_python():
    rng = random.Random(8)
    parts = ["a", "B", "é", "x" * 30, " ", "\t", "\n", "\n", "\r", "\x0b", "\x0c", "\x1c", "Zq"]
    for _ in range(200):
        texts = [None if rng.random() < 0.1 else "".join(rng.choices(parts, k=rng.choice([0, 1, 3, 40, 300]))) for _ in range(rng.randrange(6))]
        arrays = [pa.array(range(len(texts)), pa.int64()), pa.array(range(7, 7 + len(texts)), pa.int64()), pa.array(texts, pa.string())]
        want = [
            (doc, (7 + doc) << line_dedup.LINE_BITS | number, len(line.split()), b" ".join(line.split()))
            for doc, text in enumerate(texts)
            for number, line in enumerate((text or "").encode().lower().split(b"\n"))
            if line.split()
        ]
        doc, line, n, words = line_dedup.lines_of(pa.RecordBatch.from_arrays(arrays, names=["doc", "text_hash", "text"]))
        assert list(zip(doc.tolist(), line.tolist(), n.tolist(), words.to_pylist())) == want
        rest = words.slice(len(words) // 3)
        found, sizes = line_dedup.hashed(rest)
        split = [w.split() for w in rest.to_pylist()]
        assert found.tolist() == line_dedup.hashes(split).tolist() and sizes.tolist() == [len(w) for w in split]


@pytest.mark.parametrize("most", [None, 3, 1 << 16])
def test_packed_rows_meet_as_rows_do(spark, monkeypatch, most):
    """The same pairs, in a tenth of the rows; words of too many lines are named."""
    rng = random.Random(10)
    words = [f"u{i}" for i in range(500)]
    texts = [" ".join(rng.choices(words, k=rng.choice([3, 8, 30, 400]))) for _ in range(300)]
    for i in range(300):
        line = texts[i].split()
        line[rng.randrange(len(line))] = "other"
        texts.append(" ".join(line))
    monkeypatch.setattr(line_dedup, "MET_ROWS", 1 << 10)
    docs = spark.createDataFrame([(i, "\n".join(texts[2 * i : 2 * i + 2])) for i in range(300)], "doc_id long, text string").coalesce(2)
    lines = line_dedup.distinct_lines(line_dedup.keyed(docs, "doc_id", "text"))
    classes = line_dedup.rarity(lines)
    monkeypatch.setattr(line_dedup, "BUCKETS", (16, 16))
    rows, packed = (make(lines, classes, (160, 1.5, 1 << 10)) for make in (line_dedup.prefix_rows, line_dedup.packed_rows))
    assert packed.count() * 10 < rows.count()
    by_word = rows.groupBy(line_dedup._word().alias("word")).count().collect()
    many = {r.word for r in by_word if most is not None and r["count"] > most}
    few = rows.where(~line_dedup._word().isin(list(many))) if many else rows
    want, got = (line_dedup.near_pairs(x, False, m).collect() for x, m in ((few, None), (packed, most)))
    assert {r.full for r in got if r.full is not None} == many and (most != 3 or many)
    assert multiset(r for r in got if r.full is None) == multiset(want) and want


def test_lines_are_placed_once(spark, monkeypatch):
    """First places with words, other places without; repeated rows have no other places."""
    monkeypatch.setattr(line_dedup, "SENT_BYTES", 60)
    monkeypatch.setattr(line_dedup, "TEXT_BYTES", 20)
    rng = random.Random(13)
    rows = [(i, "\n".join(rng.choice(["a b", "A  b", "", " ", "c", "d e f", "g" * 40]) for _ in range(4))) for i in range(60)]
    rows += [rows[5], rows[5], rows[0], (70, None), (71, "only here")]
    given = line_dedup.keyed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text")
    places = sorted({(i, n, b" ".join(line.split())) for i, t in rows for n, line in enumerate((t or "").lower().encode().split(b"\n")) if line.split()})
    first = {}
    for i, n, line in places:
        first.setdefault(line, (i, n, len(line.split()), line))
    low = (1 << line_dedup.LINE_BITS) - 1
    got = [(r.doc, r.line & low, r.n, r.words and bytes(r.words)) for r in line_dedup.placed_lines(given).collect()]
    assert sorted(g for g in got if g[2] is not None) == sorted(first.values())
    assert {g[:2] for g in got if g[2] is None} == {p[:2] for p in places} - {f[:2] for f in first.values()}


def test_the_second_meeting_makes_rows_of_open_words_only(spark):
    rng = random.Random(12)
    texts = [" ".join(f"u{rng.randrange(3000)}" for _ in range(rng.choice([8, 30, 700]))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = line_dedup.distinct_lines(line_dedup.keyed(docs, "doc_id", "text"))
    classes = line_dedup.rarity(lines)
    still = lines.where("doc < 3").select("doc", "line")
    whole = line_dedup.prefix_rows(lines, classes, line_dedup.WIDE).withColumn("word", line_dedup._word())
    asked = whole.join(still, ["doc", "line"], "left_semi").select("word")
    want = whole.join(asked, "word", "left_semi").drop("word").collect()
    got = line_dedup.again(lines, classes, still)
    assert multiset(got.select(*whole.drop("word").columns).collect()) == multiset(want)
    assert 0 < len(want) < whole.count() / 2


def test_steps_taken_together_find_the_same_pairs(spark, monkeypatch):
    rng = random.Random(14)
    texts = []
    for i in range(400):
        line = [f"c{k}" for k in range(20)] if i % 2 else [f"d{rng.randrange(60)}" for _ in range(20)]
        for at in rng.sample(range(20), rng.randrange(6)):
            line[at] = f"u{rng.randrange(50)}"
        texts.append(" ".join(line))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = line_dedup.distinct_lines(line_dedup.keyed(docs, "doc_id", "text"))
    rows = line_dedup.packed_rows(lines, line_dedup.rarity(lines), line_dedup.NARROW_LINES)
    for every in (False, True):
        found = []
        for pairs in (1, 1 << 15):
            monkeypatch.setattr(line_dedup, "STEP_PAIRS", pairs)
            found.append(multiset(line_dedup.near_pairs(rows, every).collect()))
        assert found[0] == found[1] and found[0]


def test_a_bucket_of_too_many_rows_gives_up_words():
    held = line_dedup.Held(2)
    held.limit = 10
    rng = np.random.default_rng(3)
    for _ in range(30):
        word = np.sort(rng.integers(0, 12, 4))
        fixed = np.zeros((4, len(line_dedup.FIXED) + 1), np.int64)
        fixed[:, 0], fixed[:, -1] = word << 2 * line_dedup.SIZE_BITS, word
        held.add(fixed.view(np.uint8).T.tobytes(), b"".join(bytes([w] * w) for w in word.tolist()))
        assert held.new_rows <= 10
    held.settle()
    rows = np.concatenate([f for f, _ in held.whole])
    wide = np.concatenate([w for _, w in held.whole])
    assert held.given and not set(held.given) & set((rows[:, 0] >> 2 * line_dedup.SIZE_BITS).tolist())
    assert wide.tolist() == [w for w in rows[:, -1].tolist() for _ in range(w)]


def test_line_dedup_holds_no_line_against_itself(spark):
    import numpy

    # two words that share their 31 bits of a prefix word, the rarest of their line
    a, b = "w39343", "w68653"
    raw = numpy.array([zlib.crc32(w.encode()) for w in (a, b)], numpy.uint64)
    mixed = (raw + numpy.uint64(1)) * line_dedup._MIX >> numpy.uint64(33)
    assert a != b and mixed[0] == mixed[1]
    rows = lines_with_others([[a, b, *(f"common{i}" for i in range(8))]], {a: 1, b: 1})
    rows += [(1000, "a row that stands here two times"), (1000, "a row that stands here two times")]
    want = brute_dedup(rows)
    assert all(want[r] == r[1] for r in rows)
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert multiset((r.doc_id, r.text) for r in got) == multiset(rows)


def same_parity():
    """Four words a, b, c, d of which a and b, and c and d, turn the same bits of a line's parity."""
    mask, seen, found = (1 << 64) - 1, {}, []
    for i in range(20000):
        mixed = (zlib.crc32(f"p{i}".encode()) + 1) * int(line_dedup._MIX) & mask
        turned = (mixed >> 32) % line_dedup.PARITY_BITS, mixed >> 52
        if turned in seen:
            found += [seen.pop(turned), f"p{i}"]
        else:
            seen[turned] = f"p{i}"
    return found[:4]


def test_line_dedup_opens_lines_again_whose_likeliest_candidate_fails(spark, monkeypatch):
    a, b, c, d = same_parity()
    common = [f"common{i}" for i in range(8)]
    # the third line looks very near to the first, with which it shares too little, and matches the second
    rows = lines_with_others([[*common, a, c], [*common, b, "other"], [*common, b, d]], dict.fromkeys(common, 0) | {w: 9 for w in (a, b, c, d, "other")})
    want = brute_dedup(rows)
    assert [want[r] for r in rows[:3]] == [rows[0][1], rows[1][1], ""]
    once, calls = line_dedup.near_pairs, []

    def near_pairs(rows, every, held=None):
        calls.append(every)
        return once(rows, every, held)

    monkeypatch.setattr(line_dedup, "near_pairs", near_pairs)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.dedup(docs).collect()
    assert calls[0] is False and {(r.doc_id, r.text) for r in got} == {(i, want[i, t]) for i, t in rows}
    # parities that tell nothing leave all to the last meeting
    calls.clear()
    monkeypatch.setattr(line_dedup, "PARITY_BITS", 1)
    monkeypatch.setattr(line_dedup, "WIDE", (line_dedup.LONGEST, 1, 256))
    got = line_dedup.dedup(docs).collect()
    assert {(r.doc_id, r.text) for r in got} == {(i, want[i, t]) for i, t in rows}
    assert calls[:2] == [False, False]


def test_line_dedup_sends_few_candidates_however_many_lines_are_alike(spark):
    """20,000 near copies of one line, 100,000 copies: rows grow with the lines."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(20)]
    texts = []
    for i in range(20_000):
        line = list(base)
        for at in rng.sample(range(20), 2):
            line[at] = f"x{rng.randrange(3000)}"
        texts.append(" ".join(line))
    docs = spark.createDataFrame([(i, texts[i % 20_000]) for i in range(120_000)], "doc_id long, text string").repartition(8)
    lines = line_dedup.distinct_lines(line_dedup.keyed(docs, "doc_id", "text"))
    assert lines.count() == len(set(texts))
    classes = line_dedup.rarity(lines)
    rows = line_dedup.prefix_rows(lines, classes, line_dedup.NARROW_LINES)
    met = line_dedup.near_pairs(rows)
    assert met.count() <= line_dedup.LIKELIEST * rows.count() and met.groupBy("doc", "line", "a_doc", "a_line").count().count() <= 5 * line_dedup.LIKELIEST * 20_000
    kept = line_dedup.dedup(docs).where("n_removed = 0").select("doc_id", "text").collect()
    sets = [frozenset(r.text.split()) for r in sorted(kept)]
    assert 1 <= len(sets) < 1000
    assert all(5 * len(x & y) < 4 * len(x | y) for i, x in enumerate(sets) for y in sets[:i])


def test_similar_lines_have_similar_parts():
    rng = random.Random(9)
    for _ in range(300):
        one = [f"t{rng.randrange(10**6)}" for _ in range(rng.randint(300, 2500))]
        other = list(one)
        for _ in range(rng.randrange(len(one) // 8)):
            rng.choice([lambda: other.pop(rng.randrange(len(other))), lambda: other.append(f"u{rng.randrange(10**6)}")])()
        if not line_dedup.similar(one, other):
            continue
        found = []
        for line in (one, other):
            raw, repeats, starts = line_dedup.ordered([[w.encode() for w in line]], np.ones(1, np.uint8))
            mixed = (raw.astype(np.uint64) + np.uint64(1)) * line_dedup._MIX
            took, owner, parts, begin = line_dedup.dealt(mixed, starts)
            assert sorted(set(took.tolist())) == list(range(len(line)))
            found.append([(parts[i], set(raw[took[a:b]].tolist())) for i, (a, b) in enumerate(zip(begin, begin[1:]))])
        assert any(p == q and 5 * len(x & y) >= 4 * len(x | y) for p, x in found[0] for q, y in found[1])


@pytest.mark.parametrize("beyond,least", [(160, 1.5), (0, 8)])
def test_line_dedup_of_long_lines(spark, monkeypatch, beyond, least):
    rng = random.Random(7)
    monkeypatch.setattr(line_dedup, "NARROW_LINES", (beyond, least, 1 << 12))
    words = [f"v{i}" for i in range(400)]
    rows = []
    for i in range(60):
        line = rng.choices(words, k=rng.randint(150, 700)) if i % 3 == 0 else list(rows[rng.randrange(len(rows))][1].split())
        for at in rng.sample(range(len(line)), rng.randint(0, len(line) // 6)):
            line[at] = rng.choice(words)
        rows.append((i, " ".join(line)))
    want = brute_dedup(rows)
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in got} == {(i, want[i, t]) for i, t in rows}
    assert 0 < sum(t == "" for t in want.values()) < 60


# Neighbours


def neighbours(vectors, asked, k):
    out = []
    for q, v in asked:
        found = {}
        for i, w in vectors:
            if i != q:
                d = math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w)))
                found[i] = min(d, found.get(i, d))
        out += [(q, rank, i, d) for rank, (d, i) in enumerate(sorted((d, i) for i, d in found.items())[:k], 1)]
    return out


def test_nearest(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 40), ("LEAF_ROWS", 8), ("QUERY_ROWS", 3), ("SAMPLE_ROWS", 100)):
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16)) * 3
    rows = [(i, (centres[i % 6] + rng.normal(size=16) * 0.5).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(60)]  # one very common vector
    odd = [(1000, None), (1100, [0.0] * 16), (1200, [float("nan")] * 16), (1300, [float("inf")] * 16), (1400, [1.0, 2.0]), (None, rows[1][1])]
    odd.append((1500, [None, *rows[2][1][1:]]))
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(3)
    got = sorted(map(tuple, ann.nearest(df, df.where("vec_id % 100 = 0")).collect()))
    want = neighbours(rows, [r for r in rows if r[0] % 100 == 0], 10)
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
    found = sum(len({g[2] for g in got if g[0] == q} & {w[2] for w in want if w[0] == q}) for q in {w[0] for w in want})
    assert found >= 0.95 * len(want)
    score = {(w[0], w[2]): w[3] for w in want}
    assert all(math.isclose(g[3], score[g[0], g[2]]) for g in got if (g[0], g[2]) in score)
    # ties go to the smaller id
    assert [g[2] for g in got if g[0] == 0] == list(range(400, 410))


def test_nearest_of_few(spark):
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r)[:3] for r in ann.nearest(three, three.where("vec_id = 0")).collect()] == [(0, 1, 2), (0, 2, 1)]
    assert ann.nearest(three.limit(0), three.limit(0)).count() == 0
    assert ann.nearest(three.where("vec_id = 0"), three.where("vec_id = 0")).count() == 0


def test_chi_square():
    assert math.isclose(ann.chi_square_cdf(ann.chi_square_quantile(0.95, 8), 8), 0.95, rel_tol=1e-9)
    assert math.isclose(ann.chi_square_quantile(0.95, 8), 15.507, rel_tol=1e-4)


# Mixing


def water_fill(sizes, weights, total, epochs=3):
    capped = set()
    while True:
        left = total - sum(epochs * sizes[s] for s in capped)
        share = sum(weights[s] for s in sizes if s not in capped)
        over = {s for s in sizes if s not in capped and left * weights[s] / share >= epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in capped else left * weights[s] / share for s in sizes}
        capped |= over


def test_mixing(docs, rows, no_docs):
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(listed(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: n % 3 + 1 for n, s in enumerate(order)}
    want = water_fill(sizes, weights, sum(sizes.values()))
    got = mixing.repetitions(docs).collect()
    assert len(got) == len(rows)
    assert multiset((r.key, r.size) for r in got) == multiset((i, len(listed(t))) for i, t, *_ in rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6) and 0 <= r.times <= 3
        taken[r.source] += r.size * r.times
    longest = {s: max(len(listed(t)) for _, t, _, x in rows if x == s) for s in order}
    assert all(abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6 for s in order)
    assert multiset(got) == multiset(mixing.repetitions(docs.repartition(5)).collect())
    assert mixing.repetitions(no_docs).count() == 0


def test_mixing_samples_documents(spark):
    rows = [(i, "w " * (i % 9 + 1), "a" if i % 3 else "b") for i in range(3000)] + [(9000, "w", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.repetitions(df).collect()
    for s in "abc":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.size * r.times for r in own) - own[0].target) <= 5
    assert mixing.mix(df).count() == sum(r.times for r in got)


def test_mix_without_keys_and_with_clashing_names(spark, docs):
    """Rows without a key are told apart by their text, so the words taken come near the target."""
    rows = [(None, " ".join(f"w{i}" for _ in range(5 + i % 7)), "en", "a") for i in range(300)] + [(1, "one two", "en", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    target = {r.source: r.target for r in mixing.repetitions(df).collect()}
    taken = mixing.mix(df).where("source = 'a'").selectExpr("sum(size(split(text, ' '))) AS n").first().n
    assert abs(taken - target["a"]) <= 12
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    found = {(r.key, r.source, r.mark): r.times for r in mixing.repetitions(docs).collect()}
    from pyspark.sql import functions as F

    got = mixed.groupBy("doc_id", "source", F.xxhash64("text").alias("hash")).count().collect()
    copies = {(r.doc_id, r.source, r.hash): r["count"] for r in docs.groupBy("doc_id", "source", F.xxhash64("text").alias("hash")).count().collect()}
    assert {(r.doc_id, r.source, r.hash): r["count"] for r in got} == {k: n * copies[k] for k, n in found.items() if n}


def test_keep_one_without_keys(spark, docs):
    long = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(None, long), (None, long), (5, long), (None, other), (None, other), (None, other + " end"), (7, "alone in the world"), (7, "alone in the world"), (8, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.keep_one(df).collect()
    groups_ = {r.component for r in simhash.members(df).collect()}
    assert len(kept) == len(groups_) and [r.doc_id for r in kept if r.text == long] == [5]
    assert sum((r.text or "").startswith(other) for r in kept) == 1 and sum(r.doc_id == 7 for r in kept) == 1
    assert simhash.keep_one(docs).columns == docs.columns


def test_language_profiles_are_cut_before_the_shuffle(spark, docs):
    from pyspark.sql import functions as F
    from pyspark.sql import Window

    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = language_id.profile_counts(docs).withColumn("place", F.row_number().over(order)).where(F.col("place") <= language_id.PROFILE)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_ngrams_by_blocks():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(["a", "B", "é", "日", " ", "  ", "1", "-", "\U0001f642", "İ"]) for _ in range(rng.randrange(40)))
        whole = Counter(np.concatenate([*language_id.ngrams(text, 10**6), np.empty(0, np.int64)]).tolist())
        for block in (1, 2, 3, 7):
            parts = list(language_id.ngrams(text, block))
            assert Counter(np.concatenate([*parts, np.empty(0, np.int64)]).tolist()) == whole
            values, counts = language_id.counted(parts, 5)
            assert dict(zip(values.tolist(), counts.tolist())) == whole and values.tolist() == sorted(whole)


def test_long_texts_need_little_memory():
    """Language ID: a text of 50 MB, and 256 of 250 KB in one slice, in under 1 GB."""
    script = """
import resource, sys
import numpy as np
from tidemark.llm import language_id
words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(900)]
line = " ".join(words) + " "
long = line * (50_000_000 // len(line))
assert len(language_id.ranked(long)) == 300
texts = [line * (250_000 // len(line)) for _ in range(256)]
from itertools import chain
values, counts = language_id.counted(chain.from_iterable(map(language_id.ngrams, texts)))
assert counts.sum() > 64_000_000
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    import pathlib
    import subprocess
    import sys

    root = pathlib.Path(__file__).resolve().parents[2]
    done = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 1024


def test_classes_are_counted_by_blocks():
    text = "Aé日\U0001f642 1-+\n".encode() * 50
    whole = quality.class_counts(text)
    assert whole.sum() == 9 * 50
    assert all((quality.class_counts(text, block) == whole).all() for block in (1, 2, 3, 5, 64))


def test_a_long_document_leaves_the_reference_as_it_is(spark, monkeypatch):
    monkeypatch.setattr(quality, "MIN_REFERENCE_WORDS", 1000)
    rng = random.Random(4)
    pool = [f"word{i}" for i in range(80)]
    plain = [(i, " ".join(rng.choices(pool, k=150)), "en") for i in range(40)]
    junk = (100, "@@ ## " * 5000, "en")
    without, with_junk = (quality.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string")) for rows in (plain, [*plain, junk]))
    assert with_junk.langs == without.langs == ["en"] and np.allclose(with_junk.words, without.words) and np.allclose(with_junk.classes, without.classes)
    verdicts = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame([*plain, junk], "doc_id long, text string, lang string"), with_junk).collect()}
    assert all(verdicts[i] for i, _, _ in plain) and not verdicts[100]


def test_odd_queries_keep_no_other_from_its_neighbours(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 30)] + [(100, [1.0, 2.0, 3.0]), (200, [4.0, 5.0, 6.0]), (300, [0.5, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(df, df.where("vec_id % 100 = 0")).collect()
    assert {r.query_id for r in got} == {300} and [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 11))


def test_long_words_go_by_their_digest(spark):
    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    rule = "-" * 300
    rows = [(i, f"{rule} some words {'x' * (200 + i)}") for i in range(30)]
    got = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string"), is_remainder(7, 2), path).collect()
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    assert all(r.n_tokens == 5 and r.n_known == (4 if out[r.doc_id] else 5) for r in got)
    assert len(lm_score.known_as(rule.encode())) == 33 and lm_score.known_as(b"short") == b"short"


# Quality, licenses, languages


def brute_quality(text):
    w = WORD.findall(text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, t in enumerate(zip(w, w[1:], w[2:])) if windows[t] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, rows, no_docs):
    got = quality.judge(docs, quality.learn(docs)).collect()
    want = [brute_quality(t) for _, t, *_ in rows]
    assert multiset((r.doc_id, *r[1:6]) for r in got) == multiset((i, *b) for (i, *_), b in zip(rows, want))
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality.judge(no_docs, quality.learn(no_docs)).count() == 0
    assert all(r.kept != r.base_failed for r in quality.judge(docs, quality.learn(no_docs)).collect())


def test_quality_rejects_what_diverges(spark):
    rng = random.Random(6)
    prose = lambda n: " ".join(rng.choices(["the", "of", "and", "house", "river", "walked", "slowly", "green"], [8, 6, 5, 1, 1, 1, 1, 1], k=n))
    rows = [(i, prose(300), "en") for i in range(60)] + [(100, " ".join(f"@@{rng.random()}##" for _ in range(300)), "en"), (101, prose(300).upper(), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.judge(docs, quality.learn(docs)).collect()}
    assert not got[100].kept and not got[101].kept
    assert all(got[i].kept for i in range(60) if not got[i].base_failed)


def test_quality_of_rare_languages(spark):
    rng = random.Random(10)
    pool = {"en": "the of and house river walked slowly green", "de": "der und das haus ging fluss langsam grün", "fi": "ja on talo joki käveli hitaasti vihreä se"}
    prose = lambda k, n: " ".join(rng.choices(pool[k].split(), [8, 6, 5, 1, 1, 1, 1, 1], k=n))
    junk = " ".join(f"@@{rng.random()}##" for _ in range(300))
    rows = [(i, prose("en", 60), "en") for i in range(6000)]
    rows += [(6000 + i, prose("de", 700), "de") for i in range(20)] + [(7000, junk, "de")]
    # too little text, and one document that is most of it
    rows += [(8000 + i, prose("fi", 300), "fi") for i in range(3)] + [(9000, prose("fi", 300), "xx"), (9001, " ".join(f"y{i}" for i in range(20000)), "xx")]
    rows += [(9100, junk, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    references = quality.learn(docs)
    assert references.langs == ["de", "en"]
    got = {r.doc_id: r for r in quality.judge(docs, references).collect()}
    rare = [got[i] for i, _, lang in rows if lang in ("de", "fi", "xx") and i != 7000]
    assert all(r.kept or r.base_failed for r in rare)
    assert all(r.word_distance is None and r.class_distance is None for r in rare if r.doc_id >= 8000)
    assert not got[7000].kept and not got[9100].kept and not got[9100].base_failed


def test_quality_refuses_too_many_languages(docs, monkeypatch):
    for name, value in (("MIN_REFERENCE_WORDS", 1), ("MAX_DOCUMENT_SHARE", 1), ("MAX_LANGUAGES", 1)):
        monkeypatch.setattr(quality, name, value)
    with pytest.raises(ValueError, match="languages"):
        quality.learn(docs)


def test_js_distance():
    p = np.array([1.0, 0.0])
    assert quality.js_distance(p, p) == 0 and quality.js_distance(p, p[::-1]) == 1


def test_licenses(spark, docs, rows, no_docs):
    filler = " ".join(f"w{i}" for i in range(30))
    texts = {
        0: "Released under the MIT License. MIT license, again",
        1: f"{filler}\nReleased under\n* the BSD-License * {filler}",
        2: "an apache LICENSE and the General Public License",
        3: f"{filler} The above copyright notice and the permission notice shall be included in copies or substantial portions of the Software {filler}",
        4: filler,
        5: "mit 	license",
        6: "Licensed under CC BY-NC 4.0.",
        7: "mit licenses",
        8: None,
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    places = {i: [(p.word, p.label) for p in r.places] for i, r in got.items()}
    assert places[0] == [(3, "mit"), (5, "mit")] and places[5] == [(0, "mit")]
    assert places[2] == [(1, "apache"), (5, "gpl")] and not places[1] and not places[7]
    labels = {i: {b.label for b in r.blocks} for i, r in got.items()}
    assert labels[1] == {"bsd"} and labels[3] == {"mit"} and labels[6] == {"cc-by-nc"} and not labels[4]
    assert got[8].n_words == 0 and not got[8].blocks
    scanned = licenses.scan(docs).collect()
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    assert multiset((r.doc_id, r.n_words) for r in scanned) == multiset((i, len(split.findall(lowered(t)))) for i, t, *_ in rows)
    assert licenses.scan(no_docs).count() == 0


def test_license_filters_lose_nothing():
    rng = random.Random(8)
    text = "permission to use copy modify and or distribute this software"
    notice = licenses.Notice("x", text, "", {b"and": 9, b"to": 8}, 0.8)
    scanner = licenses.Scanner([("x", text, "")], {}, {b"and": 9, b"to": 8}, 0.8)
    pool = text.split() + ["other", "words"]
    for _ in range(400):
        mine = [rng.choice(pool).encode() for _ in range(60)]
        span = notice.span
        blocks = [mine[k * span : k * span + 2 * span] for k in range(len(mine) // span + 1)]
        want = [k for k, b in enumerate(blocks) if len(set(b) & set(notice.order)) >= notice.needed]
        for piece in (1, 100, 1 << 20):
            assert [b[1] // span for b in scanner.scan(b" ".join(mine), piece)[2]] == want


def found_labels(text):
    scanner = licenses.Scanner(licenses.NOTICES, licenses.PHRASES, {}, licenses.THRESHOLD)
    _, base, blocks = scanner.scan(text.encode())
    return {label for _, label in base} | {b[0] for b in blocks}


def test_each_license_is_told_from_every_other():
    for label, text, _ in licenses.NOTICES:
        base = {x for phrase, x in licenses.PHRASES.items() if phrase in " ".join(w.decode() for w in licenses.words(text.encode()))}
        assert found_labels(f"so it begins {text}, and so on") == {label} | base, text
    whole = {}
    for label, text, _ in licenses.PARAGRAPHS:
        whole[label] = whole.get(label, "") + text + ". "
    for label, text in whole.items():
        assert found_labels(text) - {"gpl", "apache"} <= {label}


@pytest.mark.parametrize(
    "text,labels",
    [
        ("Released under the BSD license", {"bsd"}),
        ("the film was released under the license of the studio", set()),
        ("Licensed under CC BY 4.0", {"cc-by"}),
        ("CC BY SA 4.0", {"cc-by-sa"}),
        ("CC BY-NC 4.0 and also CC BY 4.0", {"cc-by", "cc-by-nc"}),
        ("Creative Commons Attribution-NonCommercial 4.0 International License", {"cc-by-nc"}),
        ("Creative Commons Attribution-NoDerivatives 4.0 International License", {"cc-by-nd"}),
        ("Eclipse Public License version 2.0", {"epl"}),
        ("released under the mit license", {"mit"}),
        ("licensed under cc by nc 4 0", {"cc-by-nc"}),
        ("a copy was sent cc to all by mail, with permission to use the software for any purpose", set()),
    ],
)
def test_license_names(text, labels):
    assert found_labels(text) == labels


def brute_profile(texts):
    counts = Counter()
    for t in texts:
        for w in re.findall(r"[^\W\d_]+", (t or "").lower()):
            p = [0, *map(ord, w), 0]
            counts.update((c,) for c in p[1:-1])
            counts.update(zip(p, p[1:]))
            counts.update(zip(p, p[1:], p[2:]))

    def number(g):
        n = 0
        for c in g:
            n = n << 21 | c
        return n

    totals = Counter()
    for g, n in counts.items():
        totals[number(g)] += n
    return [g for g, _ in sorted(totals.items(), key=lambda x: (-x[1], x[0]))[: language_id.PROFILE]]


def test_language_id(docs, rows, no_docs):
    train = ~is_remainder(3, 1)
    got = language_id.identify(docs, train, keep=["doc_id", "text"]).collect()
    by = defaultdict(list)
    for i, t, lang, _ in rows:
        if lang is not None and (i is None or zlib.crc32(str(i).encode()) % 3 != 1):
            by[lang].append(t)
    profiles = {lang: brute_profile(ts) for lang, ts in by.items()}
    want = []
    for i, t, *_ in rows:
        mine = brute_profile([t])
        if not mine:
            want.append((i, t, "und", 0.0))
            continue
        cost = {
            lang: sum(abs(r - p.index(g)) if g in p else language_id.PROFILE for r, g in enumerate(mine)) for lang, p in profiles.items()
        }
        best = min(sorted(cost), key=cost.get)
        want.append((i, t, best, 1 - cost[best] / (language_id.PROFILE * len(mine))))
    assert multiset(map(tuple, got)) == multiset(want)
    assert language_id.identify(no_docs, train).count() == 0
    assert {r.lang_pred for r in language_id.predict(docs, language_id.learn(no_docs)).collect()} == {"und"}


def test_language_id_held_out(spark, tmp_path):
    rng = random.Random(9)
    pools = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ung", "ter"], "cc": ["eau", "ois", "ent"]}
    rows = [(i, " ".join("".join(rng.choices(pools[k], k=2)) for _ in range(40)), k) for i in range(300) for k in ["abc"[i % 3] * 2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.identify(docs, ~is_remainder(3, 1)).where(is_remainder(3, 1)).collect()
    assert len(got) > 50 and sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
