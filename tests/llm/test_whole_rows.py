"""Round 3's findings: learning from all examples, links instead of pairs, memories that keep what is used."""

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from enrolmeter.llm import bpe, lexicon_bpe, minmax_dedup, pii
from enrolmeter.llm import components as component_rows
from enrolmeter.llm.boosting import boost, boost_table
from enrolmeter.llm.common import written
from enrolmeter.llm.components import components


def test_all_examples_are_learned_from_beyond_a_stratum(spark, documents, monkeypatch):
    seen = []

    def spied(rows, edges, folds):
        seen.append(rows.agg({"weight": "sum"}).first()[0])
        return boost_table(rows, edges, folds, rounds=2)

    monkeypatch.setattr(pii, "boost_table", spied)
    n = pii.STRATUM + 500
    rows = [(i, f"write to a{i}@example.com, item-number-{i}-of-{i}-all") for i in range(n)]
    worth = documents(rows).select("doc_id", "text")
    judge = pii.learn(worth)
    assert len(seen) == 1 and set(judge.thresholds) == set(pii.KINDS)
    counts = {("email", 1): n, ("secret", 0): n}
    table = pii._example_table(worth, counts)
    assert {tuple(r) for r in table.groupBy("kind", "y").sum("n").collect()} == {("email", 1, n), ("secret", 0, n)}
    assert abs(seen[0] - 2 * pii.STRATUM) < 1e-6


def test_trees_over_a_table_are_those_over_an_array(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, (400, 3)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 5)).astype(int)
    rows = spark.createDataFrame(
        [(a.tolist(), int(b), 1.0, i % 2) for i, (a, b) in enumerate(zip(x, y))],
        "features array<double>, y int, weight double, fold int",
    ).repartition(3)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 32)))[:-1] for f in range(3)]
    without_even, without_odd, whole = boost_table(rows, edges, 2, rounds=2)
    assert np.allclose(whole.probability(x), boost(x, y, rounds=2).probability(x), atol=1e-4)
    assert not np.allclose(without_even.probability(x), without_odd.probability(x), atol=1e-4)


def test_a_cell_returns_links_that_join_and_no_pairs():
    rng = np.random.default_rng(2)
    base = np.arange(300)
    sets = [np.sort(np.where(rng.random(300) < 0.02, rng.integers(1000, 10**9, 300), base)) for _ in range(60)]
    sigs = [minmax_dedup.signature(np.unique(s).astype(np.uint64)) for s in sets]
    rows = pd.DataFrame({
        "cluster": 1, "node": range(60), "label": range(60), "shingles": [np.unique(s) for s in sets],
        "sig": [s.astype(np.uint8).tobytes() for s in sigs], "asks": True, "met": True,
    })
    found = minmax_dedup._cell(rows)
    assert len(found) == 59 and set(found["a"]) | set(found["b"]) == set(range(60))


def test_a_piece_in_use_is_not_merged_again():
    codec = bpe.Codec(bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY)), public_tokenizers.PATTERN)
    codec.codes = bpe.Recent(3)
    merged, tree = [], codec.tree
    codec.tree = lambda piece: merged.append(piece) or tree(piece)
    for i in range(40):
        assert codec.encode("aprovechar") == tree(b"aprovechar")
        codec.encode(f"x{'abcdefghij'[i % 10] * 3}{'klmnopqrst'[i // 10]}")
    assert merged.count(b"aprovechar") == 1


def test_a_merged_word_in_use_is_not_merged_again(monkeypatch):
    monkeypatch.setattr(lexicon_bpe, "MERGED_BYTES", 400)
    vocabulary = lexicon_bpe.Vocabulary.load(public_tokenizers.path(lexicon_bpe.VOCABULARY))
    merged, merge_all = [], vocabulary.merge_all
    monkeypatch.setattr(vocabulary, "merge_all", lambda words: merged.extend(words) or merge_all(words))
    memory = lexicon_bpe.Merged(vocabulary)
    for i in range(30):
        words = [b"aprovechar", b"word%d" % i]
        sizes, ids = memory.of(words)
        expected = merge_all(words)
        assert sizes.tolist() == expected[0].tolist() and ids.tolist() == expected[1].tolist()
    assert merged.count(b"aprovechar") == 1
    assert memory.of([])[1].tolist() == []


def test_a_small_graph_is_labelled_without_rounds_of_jobs(spark, monkeypatch):
    """A chain of 60 takes several star rounds, each with shuffles; below SMALL_GRAPH there is one task and none."""
    tables = []
    monkeypatch.setattr(component_rows, "written", lambda df, path: tables.append(path) or written(df, path))
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(101, 100)], "a long, b long")
    labels = components(edges, "a", "b")
    assert len(tables) == 1
    assert "Exchange" not in labels._jdf.queryExecution().executedPlan().toString()
    assert {(r.node, r.label) for r in labels.collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


@pytest.mark.parametrize("small_graph", [0, 1000])
def test_more_links_label_only_what_they_tie(spark, small_graph, monkeypatch, tmp_path):
    monkeypatch.setattr(component_rows, "SMALL_GRAPH", small_graph)
    seen = []
    monkeypatch.setattr(minmax_dedup, "components", lambda edges, a, b: seen.append(edges.distinct().count()) or components(edges, a, b))
    old = [(i, i + 1) for i in range(0, 40, 2)] + [(50, 51), (51, 52)]
    new = [(1, 3), (52, 7), (90, 51), (95, 96), (2, 3), (40, 95)]  # labels, singles, one that is known
    frame = lambda links: spark.createDataFrame(links, "a long, b long")
    labels = written(components(frame(old), "a", "b"), f"{tmp_path}/labels")
    got = minmax_dedup._relabelled(labels, frame(new), str(tmp_path / "more")).collect()
    expected = components(frame(old + new), "a", "b").collect()
    assert sorted((r.node, r.label) for r in got) == sorted((r.node, r.label) for r in expected)
    assert seen == [6]


def test_a_worker_keeps_no_words_after_a_task():
    """Workers go on to other stages: in the pipeline words of the near-duplicates lay beside the tokenizer's codes."""
    rows = [(i, i, " ".join(f"w{i}x{k}" for k in range(400))) for i in range(200)]
    batch = pd.DataFrame(rows, columns=["doc_id", "text_hash", "text"])
    most = []
    for work in (minmax_dedup._signed, minmax_dedup._sets):
        for made in work(iter([batch, batch]), 5):
            most.append(len(minmax_dedup._words))
            assert len(made) == 200
        assert not minmax_dedup._words
    assert 0 < max(most) <= minmax_dedup.CACHED_WORDS <= 50_000


def test_halves_and_pairs_are_kept_within_a_bound_of_their_own(monkeypatch):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    texts = ["".join(f"wörter{i * 7919}ohne " for i in range(k, k + 300)) for k in range(0, 1500, 300)]
    whole = [bpe.Codec(ranks, public_tokenizers.PATTERN).encode(t) for t in texts]
    monkeypatch.setattr(bpe, "CACHED_PARTS", 40, raising=False)
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    assert [codec.encode(t) for t in texts] == whole
    assert all(len(kept) + len(kept.older) <= 80 for kept in (codec.leaves, codec.pairs)) and len(codec.codes) > 80


def test_new_leaves_of_a_batch_are_merged_together_and_longer_pieces_by_the_tree(monkeypatch):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    text = "".join(f" {a}{b}{c}ung" for a in "aäbc" for b in ("st", "日本", "ee", "nn") for c in ("or", "ch", "xq"))
    text += " " + " ".join("unzweifelhaft" * n + "keiten" for n in range(2, 9))
    one_by_one = bpe.Codec(ranks, public_tokenizers.PATTERN)
    expected = [i for piece in one_by_one.split(text) for i in one_by_one.merge(piece.encode())]
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    grown, tree = [], codec.tree
    monkeypatch.setattr(codec, "tree", lambda piece: grown.append(piece) or tree(piece))
    assert codec.encode(text) == expected and codec.encode(text) == expected
    long = {p.encode() for p in codec.split(text) if len(p.encode()) > bpe.LEAF_BYTES}
    assert len(long) == 7 and long <= set(grown)
    assert not [p for p in map(str.encode, codec.split(text)) if len(p) <= bpe.LEAF_BYTES and p in grown]


@pytest.mark.parametrize("seed", range(4))
def test_leaves_merged_together_are_those_merged_one_by_one(seed):
    """With a vocabulary of few letters, so that equal ranks meet and pieces end in every round."""
    rng = np.random.default_rng(seed)
    tokens = [bytes([b]) for b in range(256)]
    while len(tokens) < 290:
        made = b"".join(tokens[i] for i in rng.choice([97, 98, 99, *range(256, len(tokens))], 2))
        if made not in tokens and len(made) <= 12:
            tokens.append(made)
    codec = bpe.Codec({token: rank for rank, token in enumerate(tokens)}, public_tokenizers.PATTERN)
    pieces = [bytes(rng.choice([97, 98, 99, 195], rng.integers(1, bpe.LEAF_BYTES + 1)).tolist()) for _ in range(3000)]
    together = codec.merge_together(pieces)
    assert [np.frombuffer(code, np.int32).tolist() for code in together] == [codec.merge(p) for p in pieces]
    assert codec.merge_together([]) == []


def test_many_new_words_with_a_vocabulary_that_lacks_bytes():
    ranks = {bytes([b]): i for i, b in enumerate(b" abcdefghij")} | {b"ab": 11, b"abc": 12}
    text = "".join(f" {a}ab{b}abc" for a in "abcdefghij" for b in "abcdefghij")
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    assert codec.decode(codec.encode(text)) == text.encode() and 12 in codec.encode(text)
