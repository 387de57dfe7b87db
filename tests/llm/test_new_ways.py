"""Importance draw, lexicon tokenizer and filter audit against brute force and the public library."""

import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from enrolmeter.llm import filter_audit, importance, lexicon_bpe

from ..conftest import SMALL

# --- importance -------------------------------------------------------------------------------


def brute_features(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(run.encode()) % 10000 for run in runs]


PARTS = st.sampled_from(["a", "B", "é", "日", "1", " ", "  ", "-", "\n", "x" * 300, "word ", "the ", "y" * 70000])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=30).map("".join), max_size=5), st.sampled_from([1, 9, 60, 1 << 20]))
def test_buckets_are_those_of_the_plain_crc(texts, piece):
    before, importance.PIECE, importance.MATRIX = (importance.PIECE, importance.MATRIX), piece, 50 * piece
    try:
        got = [Counter() for _ in texts]
        for _, owner, buckets in importance.features([t.encode() for t in texts]):
            for i, bucket in zip(owner.tolist(), buckets.tolist()):
                got[i][bucket] += 1
    finally:
        importance.PIECE, importance.MATRIX = before
    assert got == [Counter(brute_features(t)[1]) for t in texts]


@pytest.mark.parametrize("size", [1, 3, 4, 255, 256, 257, 512, 1000, 65537])
def test_crcs_of_every_length(size):
    data = np.random.default_rng(size).integers(0, 256, size, np.uint8)
    assert importance.crcs(data, np.array([0]), np.array([size])).tolist() == [zlib.crc32(data.tobytes())]


def brute_draw(rows, target):
    per_row = [(i, *brute_features(t or "")) for i, t, *_ in rows]
    s = Counter(b for _, _, found in per_row for b in found)
    t = Counter(b for text in target for b in brute_features(text or "")[1])
    every, wanted = s.total() + 10000, t.total() + 10000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * every / ((s[b] + 1) * wanted))) for b in s}
    out = []
    for i, n_words, found in per_row:
        weight, score = sum(gain[b] for b in found), None
        if i is not None:
            h = int(sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n_words, len(found), weight, score, None])
    fit = sorted((r for r in out if r[1] >= 20 and r[0] is not None), key=lambda r: (-r[4], r[0], r[2]))
    for place, row in enumerate(fit[: 5 * len(fit) // 100], 1):
        row[5] = place
    return Counter((r[0], *r[2:]) for r in out)


def test_draw_of_awkward_documents(spark, documents, awkward):
    many = [(100 + i % 110, "some words to weigh " * (1 + i % 9) + "a b c d e f g h i j k " * 2) for i in range(150)]
    rows, target = awkward + many, ["weigh some words", None, "", "é 日本 x"]
    df, wanted = documents(rows), spark.createDataFrame([(t,) for t in target], "text string")
    gains = importance.gains_of(importance.bucket_counts(df), importance.bucket_counts(wanted))
    got = importance.draw(importance.weigh(df, gains))
    assert [c for c in df.columns if c != "score"] == got.columns[: len(df.columns) - 1]
    rows_got = got.collect()
    assert all(r.pos == "x0" and r.row == "x1" for r in rows_got)
    expected = brute_draw(rows, target)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in rows_got) == expected
    assert sorted(r.rank for r in rows_got if r.rank) == list(range(1, 8))


# --- lexicon tokenizer --------------------------------------------------------------------------

VOCABULARY = lexicon_bpe.Vocabulary.load(public_tokenizers.path(lexicon_bpe.VOCABULARY))
LIBRARY = tokenizers.Tokenizer.from_file(public_tokenizers.path(lexicon_bpe.VOCABULARY))
WORDS = [" the", "the", " thing", "ing", " sing", "é", " 日", "!", "\n"]
LEXICON = lexicon_bpe.Lexicon(lexicon_bpe.compiled({w.encode(): VOCABULARY.merge(w.encode()) for w in WORDS}))
CODER = lexicon_bpe.Coder(VOCABULARY, LEXICON, public_tokenizers.PATTERN)


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


PIECES = st.sampled_from(
    ["a", "the", " the", "thing", "é", "日", " ", "  ", "\n", "'", "'s", "'ll", "1", "!", "\t", "😀", "́", "ing",
     "<|endoftext|>", "<|endof", "\x1c", "\x85", "q" * 70]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=40).map("".join), max_size=4))
def test_ids_are_those_of_the_library(texts):
    sizes, ids = CODER.encode(texts)
    runs = [run.tolist() for run in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []
    assert runs == [library_ids(t) for t in texts]
    assert CODER.decode(sizes, ids).to_pylist() == [LIBRARY.decode(run, skip_special_tokens=False) for run in runs]


@pytest.mark.parametrize("unit", ["a", "ab", " ", "\n ", "'s", "é", "thing", "1", "..", "a'"])
def test_long_words(unit):
    _, ids = CODER.encode([unit * 6000])
    assert ids.tolist() == library_ids(unit * 6000)


def test_a_single_token_merges_to_itself():
    tokens = [t for t in VOCABULARY.tokens if t not in VOCABULARY.special.values()]
    sizes, ids = VOCABULARY.merge_all([VOCABULARY.tokens[t] for t in tokens])
    assert (sizes == 1).all() and ids.tolist() == tokens


@settings(max_examples=100, deadline=None)
@given(st.sets(st.binary(max_size=5), max_size=40), st.lists(st.binary(max_size=6), max_size=40))
def test_transducer_is_minimal_and_numbers_its_words(words, others):
    states, start = lexicon_bpe.minimal_states(sorted(words))
    assert len({(s, n == start) for n, s in enumerate(states)}) == len(states)  # equal states are one

    def language(state):
        final, arcs = states[state]
        return ({b""} if final else set()) | {bytes([b]) + w for b, t in arcs for w in language(t)}

    assert language(start) == words
    assert len({frozenset(language(s)) for s in range(len(states))}) >= len(states) - 1
    lexicon = lexicon_bpe.Lexicon(lexicon_bpe.compiled({w: [i] for i, w in enumerate(sorted(words))}))
    asked = [*sorted(words), *others]
    lengths = np.array([len(w) for w in asked], np.int64)
    data = np.frombuffer(b"".join(asked), np.uint8)
    numbers = lexicon.numbers(data, np.cumsum(lengths) - lengths, lengths).tolist()
    assert numbers == [sorted(words).index(w) if w in words else -1 for w in asked]


def test_endings_are_shared():
    words = [a + b for a in (b"x", b"yy", b"zz") for b in (b"ing", b"ings")]
    assert len(lexicon_bpe.minimal_states(sorted(words))[0]) == 8


def test_frequent_words_are_bounded_and_change_nothing(spark, documents, awkward):
    rows = awkward + [(20, "the cat <|endoftext|> the dog"), (21, "the the the cat")]
    df, path = documents(rows), public_tokenizers.path(lexicon_bpe.VOCABULARY)
    found = lexicon_bpe.frequent_words(df, VOCABULARY, public_tokenizers.PATTERN, 3)
    assert 0 < len(found) <= 3 and b" word" in found
    tokenizer = lexicon_bpe.Tokenizer(df, path, most=3)
    once, twice = tokenizer.round_trip(df), tokenizer.decode(tokenizer.encode(df))
    for got in (once, twice):
        assert got.columns == [c for c in df.columns if c != "ids"] + ["ids", "decoded"]
        out = got.collect()
        assert all(r.ids == library_ids(r.text or "") and r.pos == "x0" for r in out)
        assert Counter((r.doc_id, r.decoded) for r in out) == Counter((r[0], r[1] or "") for r in rows)
    odd = spark.createDataFrame([(None,), ([],), ([50256, None, -5, 99999, 64],), ([VOCABULARY.of_byte[128]],)], "ids array<int>")
    assert [r.decoded for r in tokenizer.decode(odd).collect()] == ["", "", "<|endoftext|>a", "�"]


def test_lexicon_query_against_the_library(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = lexicon_bpe.op12_lexicon_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library_ids(texts[row.doc_id])
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        digests = [sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]
        assert [row.n_tokens, row.ids_sha256, row.decoded_sha256] == [len(ids), *digests]


# --- filter audit -------------------------------------------------------------------------------


def brute_audit(rows, labels):
    """Every order applied, document by document."""
    good, toxic = ({i for i, *marks in labels if marks[k] == 1} for k in (0, 1))
    parts = defaultdict(list)
    for i, text, lang in rows:
        text = text or ""
        words = [w for w in re.split("[ \t-\r]+", text) if w]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": any(j < i for j, other, _ in rows if j is not None and (other or "") == text) if i is not None else False,
        }
        parts[lang or ""].append(({f for f, failed in fails.items() if failed}, i in good, i in toxic))
    out = []
    for part, docs in parts.items():
        removed_by = Counter()
        mine = []
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                gone = [d for d in docs if f in d[0] and not d[0] & set(order[: step - 1])]
                removed_by[f] += len(gone)
                mine.append((
                    part, order, step, sum(not d[0] & set(order[:step]) for d in docs), len(gone),
                    sum(f in d[0] for d in docs) - len(gone), sum(d[0] == {f} for d in docs),
                    sum(d[1] for d in gone), sum(d[2] for d in gone),
                ))
        out += [(*row, removed_by[row[1][row[2] - 1]]) for row in mine]
    return Counter(out)


def test_audit_against_brute_force(spark, awkward):
    varied = "Word number {} and more of them, each one new as they go along {} "
    rows = [(r[0], r[1], r[2] if len(r) > 2 else "s") for r in awkward]
    rows += [(30, "".join(varied.format(i, i * i) for i in range(40)).lower(), None), (31, "a # b", ""), (31, "a # b", "s")]
    rows += [(32 + i, "same words here", "s") for i in range(5)] + [(None, "same words here", "s"), (2, "TOO LOUD", "t")]
    names = ("part", "h1", "mask", "n", "v", "least", "first", "quality", "toxic", "good", "at")
    docs = spark.createDataFrame(
        [(*r, *names) for r in rows], "doc_id long, text string, lang string, " + ", ".join(f"{n} string" for n in names)
    )
    labels = [(2, 1, None), (5, 1, 1), (5, 0, 0), (33, None, 1), (None, 1, 1), (99, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, marks)
    assert Counter(map(tuple, got.collect())) == brute_audit(rows, [x for x in labels if x[0] is not None])


@pytest.mark.parametrize("n", [2, 3, 5])
def test_shares_are_shapley_s(n):
    """The least squares solution against the textbook sum over coalitions."""
    shares = filter_audit.shapley_shares(n)
    for i in range(n):
        for s in range(2**n):
            size = bin(s).count("1")
            inside = s >> i & 1
            other = size - inside
            weight = Fraction(math.factorial(other) * math.factorial(n - other - 1), math.factorial(n))
            expected = weight if inside else -weight
            assert shares[i][s] == expected or s == 0  # no coalition removes nothing
