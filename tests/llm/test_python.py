"""Tokens, personal data, the network, vectors and near-duplicates against brute force."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from enrolmeter.llm import bpe, minmax_dedup, pii, quality_net
from enrolmeter.llm import components as component_rows
from enrolmeter.llm.boosting import boost
from enrolmeter.llm.components import components
from enrolmeter.llm.pivot_topk import top_k

from ..conftest import SMALL

PATH = public_tokenizers.path(bpe.VOCABULARY)
RANKS = bpe.load_ranks(PATH)
CODEC = bpe.Codec(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
FOLD = {c: c + 32 for c in range(65, 91)}

# --- tokens -----------------------------------------------------------------------------------

PIECES = st.sampled_from(["a", "the", "é", "日", " ", "  ", "\n", "'", "'s", "'ll", "1", "!", "\t", "😀", "́", "ing"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=60).map("".join))
def test_small_leaves_give_the_library_s_tokens(text):
    before, bpe.LEAF_CHARS = bpe.LEAF_CHARS, 3
    try:
        ids = CODEC.encode(text)
    finally:
        bpe.LEAF_CHARS = before
    assert ids == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@pytest.mark.parametrize("unit", ["a", "ab", " ", "\n ", "'s", "é", "thing", "1", "..", "a'"])
def test_long_runs_without_a_break(unit):
    text = unit * 6000
    assert CODEC.encode(text) == LIBRARY.encode_ordinary(text)


def test_every_token_is_its_own_encoding():
    assert all(CODEC.merge(token) == [rank] for token, rank in list(RANKS.items())[::97])


def test_columns_pass_through_both_ways(documents, awkward):
    df = documents(awkward)
    got = bpe.decode(bpe.encode(df, PATH), PATH)
    assert got.columns == [c for c in df.columns if c != "ids"] + ["ids", "decoded"]
    rows = got.collect()
    assert Counter((r.doc_id, bytes(r.decoded)) for r in rows) == Counter((r[0], (r[1] or "").encode()) for r in awkward)
    assert all(r.ids == LIBRARY.encode_ordinary(r.text or "") and r.pos == "x0" for r in rows)


# --- personal data ----------------------------------------------------------------------------


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def brute_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


PARTS = st.sampled_from(
    ["a", "b@", "@", "c.", "1", "255", "256", ".", "-", " ", "+1", "(", ")", "4111111111111111", "_", "%", "x.y", "é", "\n", "00"]
)


@settings(max_examples=1500, deadline=None)
@given(st.lists(PARTS, max_size=25).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_found_spans_keep_the_base_and_never_overlap_it(spark, documents, awkward):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    judge = pii.learn(docs)
    # A judge that accepts every proposal: added spans still give way to base ones.
    eager = pii.Judge(judge.model, dict.fromkeys(pii.KINDS, 0.0)) if judge else None
    rows = awkward + [(50, "mail a.b@c.de or call +1 (504) 555-2652, not 4111 1111 1111 1112"), (51, 'token = "0123456789abcdef0123"')]
    for one in (judge, eager, None):
        for r in pii.find(documents(rows), one).collect():
            base = [(s.kind, s.start, s.end) for s in r.spans if s.base]
            assert sorted(base) == sorted(brute_spans(r.text or ""))
            for s in r.spans:
                if not s.base:
                    assert all(s.end <= b or e <= s.start for _, b, e in base)


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    order = {kind: i for i, kind in enumerate(pii.KINDS)}
    rows = pii.op3_pii(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = sorted(brute_spans(texts[r.doc_id]), key=lambda s: (order[s[0]], s[1]))
        shown = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
        assert set(filter(None, shown.split(","))) <= set(r.spans.split(","))


def test_a_kind_with_few_examples_is_added_to(spark, documents):
    rng = np.random.default_rng(5)
    text = lambda n: "".join(rng.choice(list("abcdefghjkmnpqrstuvwxyz23456789"), n)) + "7a"
    rows = [(i, f"write to {'abc'[i % 3]}{i}@example.com, item-number-{i}-of-{i * 7}-all") for i in range(300)]
    rows += [(1000 + i, f"see password={text(20)} there") for i in range(9)]
    docs = documents(rows)
    judge = pii.learn(docs)
    assert set(judge.thresholds) == set(pii.KINDS)
    spans = {r.doc_id: [s.kind for s in r.spans if not s.base] for r in pii.find(docs, judge).collect()}
    assert sum("secret" in spans[1000 + i] for i in range(9)) == 9
    assert not any(spans[i] for i in range(300))


def test_a_rare_kind_is_learned_from_however_many_others_there_are(monkeypatch):
    monkeypatch.setattr(pii, "STRATUM", 30)
    texts = [f"a{i}@example.com" for i in range(2000)] + [f"token={i:010d}abcdef" for i in range(25)]
    batch = pd.DataFrame({"doc_id": [str(i) for i in range(len(texts))], "text": texts})
    (got,) = pii._examples(iter([batch]))
    counts = got[got["n"] > 0].set_index(["kind", "verdict"])["n"].to_dict()
    assert counts["email", 1] == 2000 and counts["secret", 1] == 25
    taken = got[got["n"] == 0].groupby(["kind", "verdict"]).size().to_dict()
    assert taken["email", 1] == 30 and taken["secret", 1] == 25


def test_thresholds_count_the_corpus_not_the_sample():
    chances, good = np.array([0.9, 0.8, 0.7]), np.array([True, False, True])
    assert pii._lowest(chances, good, np.array([1e4, 1.0, 1e4])) == 0.7
    assert pii._lowest(chances, good, np.array([1e4, 1e4, 1e4])) == 0.9


def test_one_error_among_few_examples_takes_no_kind_away():
    rows, counts = [], Counter()
    for kind, good, odd in (("email", 400, 0), ("card", 60, 1)):
        for i in range(good + 40 + odd):
            verdict = int(i < good)
            # The odd ones are refused but look like accepted ones.
            looks = [float(verdict or i >= good + 40), float(kind == "card")]
            rows.append(dict(kind=kind, verdict=verdict, content=f"{i:04d}", place=f"{i:04d}", features=looks))
            counts[kind, verdict] += 1
    judge = pii._judge(rows, counts)
    assert {"email", "card"} <= set(judge.thresholds)


def test_formats_without_digits_or_at_are_proposed(spark, documents):
    class Sure:
        probability = staticmethod(lambda x: np.ones(len(x)))

    judge = pii.Judge(Sure, dict.fromkeys(pii.KINDS, 0.5))
    rows = [(1, "write to ann (at) example (dot) com"), (2, "ann[at]example[dot]com"), (3, "password=correcthorse"), (4, "plain words")]
    got = {r.doc_id: [(s.kind, r.text[s.start : s.end]) for s in r.spans] for r in pii.find(documents(rows), judge).collect()}
    assert got == {
        1: [("email", "ann (at) example (dot) com")], 2: [("email", "ann[at]example[dot]com")],
        3: [("secret", "correcthorse")], 4: [],
    }


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é a@b.cd, 1.2.3.4!"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(pii.find(docs, None)).collect()}
    assert got == {1: "é [EMAIL], [IP]!", 2: ""}


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(int)
    model = boost(x[:1500], y[:1500])
    assert ((model.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


# --- the network ------------------------------------------------------------------------------


def test_chunks_cover_every_window():
    for n in (0, 1, 511, 512, 513, 2000):
        chunks = quality_net.chunks_of("x" * n)
        assert (chunks[:, : quality_net.CHUNK] != quality_net.PAD).sum() == n
        assert len(chunks) == max(1, -(-n // quality_net.CHUNK))


def test_layers_after_the_filters_learn_from_all_chunks(spark, documents, monkeypatch):
    texts = {i: ("ab c" * 9000 if i % 2 else "x y." * 9000)[: 5000 * i] + f" {i} Q" for i in range(1, 8)}
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int")
    seen, fit = [], quality_net.fit

    def spied(samples, labels, share, whole=None):
        def kept(net):
            seen.append((net.features, whole(net), samples))
            return seen[-1][1]

        return fit(samples, labels, share, kept)

    monkeypatch.setattr(quality_net, "fit", spied)
    monkeypatch.setattr(quality_net, "TRAIN_CHUNKS", 60)
    quality_net.train(documents(list(texts.items())), labels)
    ((features, (pooled, of_class), samples),) = seen
    used = [features(quality_net.chunks_of(t)) for t in texts.values()]
    expected = [quality_net.ByteNet.pooled(f, np.array([0]))[0] for f in used]
    # Filters learn from whole texts that fit into the bound, the layers after them from all.
    sizes, taught = sorted(map(len, used)), [i % 2 for i in texts if zlib.crc32(str(i).encode()) % 4 != 2]
    assert 2 <= len(samples) < len(pooled) == len(taught) and sizes[-1] > 60
    assert all(len(s) in sizes for s in samples) and sum(map(len, samples)) <= 2 * 60
    assert sorted(of_class.tolist()) == sorted(taught)
    assert all(min(np.abs(row - e).max() for e in expected) < 1e-4 for row in pooled)


def test_an_id_with_both_labels_teaches_nothing(spark, documents):
    labels = spark.createDataFrame([(1, 0), (1, 1), (3, 1), (3, 1)], "doc_id long, quality int")
    assert quality_net.train(documents([(1, "a b"), (3, "c d")]), labels) == 2 / 3


def plain_score(net, text):
    """The forward pass written as loops over places, filters and chunks."""
    data = text.encode()
    if not data:
        return 0.0
    rows = []
    for at in range(0, len(data), quality_net.CHUNK):
        best = [-8.0] * quality_net.FILTERS
        for place in range(at, min(at + quality_net.CHUNK, len(data))):
            window = [data[place + k] if place + k < len(data) else quality_net.PAD for k in range(quality_net.WIDTH)]
            for f in range(quality_net.FILTERS):
                best[f] = max(best[f], float(sum(net.filters[k, b, f] for k, b in enumerate(window))))
        rows.append([*best, np.log1p(min(quality_net.CHUNK, len(data) - at)) / 3])
    lanes = list(zip(*rows))
    pooled = [sum(x) / len(x) for x in lanes] + [max(x) for x in lanes] + [min(x) for x in lanes]
    inner = [
        np.tanh(sum(p * w for p, w in zip(pooled, net.hidden[:, j])) + net.hidden_bias[j])
        for j in range(quality_net.HIDDEN)
    ]
    raw = sum(i * w for i, w in zip(inner, net.out)) + net.out_bias[0]
    return 1 / (1 + np.exp(-(net.scale * raw + net.shift)))


def test_quality_query_against_plain_loops(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    net = quality_net.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert isinstance(net, quality_net.ByteNet)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = quality_net.op5_quality_net(spark, SMALL).collect()
    assert len(rows) == len(texts)
    assert all(r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    short = sorted(rows, key=lambda r: (len(texts[r.doc_id]), r.doc_id))
    for row in [*short[:4], *(r for r in short if 600 < len(texts[r.doc_id]) < 1600)][:9]:
        assert row.score == pytest.approx(plain_score(net, texts[row.doc_id]), abs=1e-4)


def test_byte_bpe_query_against_the_library(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = bpe.op8_byte_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = LIBRARY.encode_ordinary(texts[row.doc_id])
        digests = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), LIBRARY.decode_bytes(ids))]
        assert [row.n_tokens, row.ids_sha256, row.decoded_sha256] == [len(ids), *digests]


def test_near_duplicate_query_against_exact_search(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = minmax_dedup.op10_minmax_dedup(spark, SMALL).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows) == sorted(brute_groups(docs, 4))


def test_many_spans_of_one_text_take_linear_time():
    """Overlaps are looked up in order, not against all that is taken."""
    judge = pii.Judge(None, {"secret": 0.0})
    text = " ".join(f"token: a{i:09d}bcdefgh x@y.z" for i in range(16000))
    judge.model = type("Sure", (), {"probability": staticmethod(lambda x: np.ones(len(x)))})()
    base = pii.base_spans(text)
    start = time.process_time()
    found = judge.accepted(text, base)
    assert len(found) == 16000 == len(base) and time.process_time() - start < 20
    spans = sorted(s[1:3] for s in [*found, *base])
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    net = quality_net.ByteNet.fresh(rng)
    for p in net.parameters():
        p[...] = p.astype(np.float32)
    texts = [quality_net.chunks_of("".join(rng.choice(list("abc de"), 900))) for _ in range(3)]
    chunks, starts = quality_net._stacked(texts)
    labels = np.array([1, 0, 1])

    def loss():
        z = net.logits(net.features(chunks), starts).astype(float)
        return float(np.mean(np.log1p(np.exp(-z)) * labels + np.log1p(np.exp(z)) * (1 - labels)))

    found = net.gradients(chunks, starts, labels)
    for p, g in zip(net.parameters()[1:], found[1:]):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        step = 1e-2
        p[at] += step
        up = loss()
        p[at] -= 2 * step
        down = loss()
        p[at] += step
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 1e-3


def test_held_out_rows_are_predicted(spark):
    folder = SMALL.replace("0.001", "0.01")
    got = quality_net.op5_quality_net(spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert got.score.between(0, 1).all() and len(got) == 1000
    ranks = held.score.rank()
    good = held.quality == 1
    auc = (ranks[good].mean() - ranks[~good].mean()) / len(held) + 0.5
    assert auc > 0.85 and (held.predicted == held.quality).mean() > 0.85


def test_awkward_texts_are_scored(spark, documents, awkward):
    net = quality_net.ByteNet.fresh(np.random.default_rng(1))
    rows = quality_net.score(documents(awkward), net).collect()
    assert len(rows) == len(awkward) and all(0 <= r.score <= 1 for r in rows)
    assert [r.score for r in rows if not r.text] == [0.0, 0.0]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    share = quality_net.train(documents(awkward), labels)
    assert share == 0.5
    assert {r.score for r in quality_net.score(documents(awkward), share).collect()} == {0.0, 0.5}


# --- vectors ----------------------------------------------------------------------------------


def test_top_k_with_ties_nulls_and_ragged_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 2]) for i in range(150)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [float("inf"), 0.0, 0.0, 0.0]),
             (None, [1.0] * 4), (250, [1.0, 2.0]), (251, [3.0, 1.0]), (0, rows[0][1]), (300, []), (301, [])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, v string, far string")
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole[i] = [int(np.floor(256 * x)) for x in v]
    expected = []
    for q in (i for i in whole if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1)]
    got = [tuple(r) for r in top_k(df, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == sorted(expected)


# --- near-duplicates --------------------------------------------------------------------------


@pytest.mark.parametrize("chain, small_graph", [(2, 10**6), (3, 0), (40, 70)])
def test_components_of_chains_and_stars(spark, chain, small_graph, monkeypatch):
    """By broadcast, by shuffled joins, and from one to the other as the graph shrinks."""
    monkeypatch.setattr(component_rows, "SMALL_GRAPH", small_graph)
    edges = [(i, i + 1) for i in range(100, 100 + chain)] + [(7, i) for i in range(500, 560)] + [(3, 3)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r.node: r.label for r in got} == {i: 100 for i in range(100, 101 + chain)} | {i: 7 for i in [7, *range(500, 560)]}
    assert len(got) == chain + 1 + 61


def brute_groups(rows, size):
    sets = []
    for i, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(FOLD))
        sets.append((i, {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()))
    label = {i: i for i, _ in sets}
    changed = True
    while changed:
        changed = False
        for i, a in sets:
            for j, b in sets:
                if None not in (i, j) and label[i] > label[j] and (i == j or a and 100 * len(a & b) >= 80 * len(a | b)):
                    label[i], changed = label[j], True
    return sorted(((i, len(s), label[i] if i is not None else None, i is None or label[i] == i) for i, s in sets), key=repr)


def near_copies(rng, base, n, most):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.integers(0, most)):
            words[rng.integers(0, len(words))] = f"edit{rng.integers(0, 10**6)}"
        out.append(" ".join(words))
    return out


def test_groups_against_brute_force(documents, awkward):
    rng = np.random.default_rng(5)
    rows = [(i, t) for i, t, *_ in awkward]
    for k in range(4):
        base = [f"w{rng.integers(0, 400)}" for _ in range(120)]
        rows += [(100 * (k + 1) + j, t) for j, t in enumerate(near_copies(rng, base, 30, 6))]
    # A chain of versions, each close to the next only.
    words = [f"c{i}" for i in range(200)]
    for k in range(12):
        words[k * 5 : k * 5 + 3] = [f"new{k}", f"newer{k}", f"newest{k}"]
        rows.append((900 + k, " ".join(words)))
    rows += [(970, "Two Words"), (971, "two\twords"), (972, "two words more"), (980, rows[-1][1]), (980, "of another text altogether")]
    got = minmax_dedup.group_near_duplicates(documents(rows), shingle_words=4)
    found = sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    assert found == brute_groups(rows, 4)
    assert {r["pos"] for r in got.select("pos").collect()} == {"x0"}


def test_small_blocks_lose_no_link(spark, documents, monkeypatch):
    """Strays and members of one bucket dealt to several blocks still all meet."""
    monkeypatch.setattr(minmax_dedup, "POSTING_BLOCK", 3)
    monkeypatch.setattr(minmax_dedup, "SET_BLOCK", 700)
    monkeypatch.setattr(minmax_dedup, "SIGNATURES", 5)
    monkeypatch.setattr(minmax_dedup, "FIRST_TRIES", 1)
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(150)]
    rows = list(enumerate(near_copies(rng, base, 60, 9)))
    got = minmax_dedup.group_near_duplicates(documents(rows, clashing=False), shingle_words=4)
    found = sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    assert found == brute_groups(rows, 4)


def test_signature_values_agree_as_often_as_sets_do():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 2**63, 900, np.uint64), rng.integers(0, 2**63, 100, np.uint64)
    x, y = minmax_dedup.signature(np.unique(a)), minmax_dedup.signature(np.unique(np.concatenate([a, b])))
    assert abs((x == y).mean() - 0.9) < 0.1
    parts = [minmax_dedup.signature(a[:450]), minmax_dedup.signature(a[450:])]
    n = minmax_dedup.PERMUTATIONS
    assert (np.minimum(*[p[:n] for p in parts]) == minmax_dedup.signature(a)[:n]).all()


def test_pages_of_one_template_never_meet(spark, tmp_path):
    """Sets alike below the threshold have rare shingles of their own; a close pair among them is found."""
    rng = np.random.default_rng(11)
    template = rng.integers(-(2**62), 2**62, 70)
    sets = [np.concatenate([template, rng.integers(-(2**62), 2**62, 30)]) for _ in range(300)]
    close = sets[7].copy()
    close[95:] = rng.integers(-(2**62), 2**62, 5)
    rows = [(1, i, i, 100, i, [int(x) for x in s]) for i, s in enumerate([*sets, close])]
    columns = "cluster long, node long, label long, n long, piece long, shingles array<long>"
    rows = spark.createDataFrame(rows, columns)
    sigs = [(i, 100, bytearray(minmax_dedup.signature(np.asarray(s).view(np.uint64)).astype(np.uint8).tobytes())) for i, s in enumerate([*sets, close])]
    nodes = spark.createDataFrame(sigs, "node long, n long, sig binary")
    pairs = minmax_dedup._prefix_pairs(rows, nodes, str(tmp_path), None)
    assert [(r.a, r.b) for r in pairs.collect()] == [(7, 300)]
    links = minmax_dedup._confirmed_in_clusters(pairs, rows, str(tmp_path))
    assert [(r.a, r.b) for r in links.collect()] == [(7, 300)]
