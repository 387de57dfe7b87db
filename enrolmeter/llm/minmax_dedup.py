"""Near-duplicates by min-max hashing, with links confirmed on the full shingle sets.

Each text's set of word shingles is hashed by ``PERMUTATIONS`` permutations, and both the least
and the largest value under each is kept: twice as many signature values for the same hash
evaluations, each an unbiased sign of similarity, and of lower variance together. Four values
make a band; least values fill one half of the bands, largest values the other.

1. Texts with equal sets become one node, so copies cost one row each.
2. Nodes that share a band's value share a bucket. In every bucket each node meets the bucket's
   least node (a star, linear in the bucket), links are confirmed, components are labelled.
3. Buckets of more than two nodes that still hold several labels are joined to clusters, whose
   sets are dealt into cells of bounded size. In a cell an exact prefix filter finds candidates:
   shingles are put in one order, those held by one label first, then from rare to frequent, and
   only nodes of labels still apart that have one of their first n - ceil(0.8 n) + 1 in common
   are tried. Sizes and the share of equal signature values rule out more. What passes is compared
   on full sets in the cell, and a cell returns only links that join two labels: fewer than its nodes.
4. A small cluster is one cell. A large one is dealt into blocks, at most ``FIRST_TRIES`` times,
   each by another hash, and nodes labelled again, until nearly all that belong together have one
   label. In a last turn the nodes beside its largest label meet all others of the cluster.

So a group of thousands of near copies is not expanded into rows of pairs, pages of one template
that share too little are not tried (their own shingles fill the prefixes), and yet no pair of a
cluster in different components stays untested. Links are confirmed on full sets, here and once
more when cells are brought together.

What can be missed: two sets of similarity s share no bucket with chance (1 - s^4)^32, below
6e-8 at 0.8 and less above; fewer than half of the 128 signature values agree with a chance
below 1e-9 for sets of ordinary size.

Sets, signatures and confirmations run on Arrow batches in tasks; grouping, joining and
labelling are Spark's. Tables between rounds are written to the shared folder.

Defined cases: a text with fewer words than a shingle is one shingle; without words it has none
and links with nothing. A row without id is linked with nothing and kept. Rows of the same id
are one document: a link of one is a link of all. Other columns come back as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, scratch, table, text_of, without, written
from .components import components

PERMUTATIONS, ROWS = 64, 4
BANDS = 2 * PERMUTATIONS // ROWS
THRESHOLD = 80  # per cent
LEAST_EQUAL = PERMUTATIONS  # half of the signature's values
#: Dealings of a large cluster before all of its labels meet.
FIRST_TRIES = 3
#: Blocks of a cluster's sets hold so many shingles, where a set counts as POSTING_BLOCK at least.
POSTING_BLOCK, SET_BLOCK = 512, 500_000
#: Pairs whose signatures are compared at once.
SIGNATURES = 100_000
SLICE = 8192
#: Hashes of words that a task keeps; most words that are not among so many come once.
CACHED_WORDS = 50_000

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_RANDOM = np.random.default_rng(20240229)
_TIMES = _RANDOM.integers(0, 2**63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 2**63, PERMUTATIONS, np.uint64)
_PLACES = _RANDOM.integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_words: dict[bytes, int] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word(word: bytes) -> int:
    if len(_words) >= CACHED_WORDS:
        _words.clear()
    value = _words[word] = xxhash.xxh3_64_intdigest(word)
    return value


def _forget() -> None:
    """A worker lives on for other stages: what this one kept goes with its task."""
    _words.clear()
    pa.default_memory_pool().release_unused()


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of ``size`` words."""
    words = text.encode("utf-8", "replace").translate(_FOLD).split()
    if not words:
        return np.zeros(0, np.uint64)
    known = _words.get
    hashes = np.array([known(w) or _word(w) for w in words], np.uint64)
    length = min(size, len(words))
    total = np.full(len(words) - length + 1, length, np.uint64)
    for k in range(length):
        total += hashes[k : k + len(total)] * _PLACES[k]
    return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least values of all permutations, then largest ones."""
    low, high = np.full(PERMUTATIONS, 2**64 - 1, np.uint64), np.zeros(PERMUTATIONS, np.uint64)
    for i in range(0, len(shingles), SLICE):
        values = shingles[i : i + SLICE, None] * _TIMES + _PLUS
        low, high = np.minimum(low, values.min(axis=0)), np.maximum(high, values.max(axis=0))
    return np.concatenate([low, high])


def _signed(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    places = np.resize(_PLACES[:ROWS], 2 * PERMUTATIONS)
    for batch in batches:
        out = {"n": [], "f1": [], "f2": [], "bands": [], "sig": []}
        for text in batch["text"]:
            shingles = shingle_set(text, size)
            values = signature(shingles)
            bands = _mixed((_mixed(values) * places).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64))
            out["n"].append(len(shingles))
            out["f1"].append(np.int64(shingles.sum(dtype=np.uint64).astype(np.int64)))
            twice = _mixed(shingles ^ _PLACES[9])
            out["f2"].append(np.int64(twice.sum(dtype=np.uint64).astype(np.int64)))
            out["bands"].append(bands.astype(np.int64))
            out["sig"].append((_mixed(values) >> np.uint64(56)).astype(np.uint8).tobytes())
        yield pd.DataFrame({"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], **out})
    _forget()


def _sets(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingle_set(text, size).view(np.int64) for text in batch["text"]]
        yield pd.DataFrame({"node": batch["doc_id"], "shingles": sets})
    _forget()


# --- buckets --------------------------------------------------------------------------------


def _memberships(nodes: DataFrame, folder: str) -> DataFrame:
    """(band, value, node, n): the buckets of at least two nodes."""
    rows = nodes.select("node", "n", F.posexplode("bands").alias("band", "value"))
    shared = (
        rows.groupBy("band", "value")
        .agg(F.min("node").alias("least"), F.max("node").alias("most"))
        .where(F.col("least") != F.col("most"))
        .select("band", "value", "least")
    )
    # A table beside the join, so that a large bucket may be split.
    return written(rows.join(written(shared, f"{folder}/shared"), ["band", "value"]), f"{folder}/members")


def _alike_size(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= THRESHOLD * F.greatest(a, b)


def _star_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each node with the least node of each of its buckets, once."""
    pairs = members.where(F.col("node") != F.col("least")).select("node", "n", "least").distinct()
    centres = nodes.select(F.col("node").alias("least"), F.col("n").alias("least_n")).distinct()
    return pairs.join(centres, "least").where(_alike_size(F.col("n"), F.col("least_n"))).select(
        F.col("least").alias("a"), F.col("node").alias("b")
    ).distinct()


# --- clusters: links between labels, by prefixes of the rarest shingles ----------------------


def _clusters(members: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """(cluster, node): buckets of more than two nodes that hold several labels, joined."""
    now = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    now = written(now.select("band", "value", "node", "least", "label"), f"{folder}/now")
    held = now.groupBy("band", "value").agg(
        F.min("label").alias("first"), F.max("label").alias("last"), F.count("*").alias("size")
    )
    # Two nodes have met in the star.
    several = held.where((F.col("first") != F.col("last")) & (F.col("size") > 2)).select("band", "value")
    met = now.join(written(several, f"{folder}/several"), ["band", "value"])
    joined = components(met, "least", "node")
    return written(joined.select(F.col("label").alias("cluster"), "node"), f"{folder}/clusters")


def _blocks(groups: DataFrame, weight: str, block: int, *keys: str) -> DataFrame:
    """Groups with their number of ``blocks``, and small ones gathered to about one block.

    ``cell`` is a group's own if it takes several blocks, else shared with other small groups.
    """
    blocks = F.ceil(F.col(weight) / block).cast("int")
    small = groups.where(blocks == 1).agg(F.sum(weight)).first()[0] or 0
    gathered = F.pmod(F.xxhash64(*keys), F.lit(-(-small // block) or 1))
    return groups.select(
        *keys, blocks.alias("blocks"), F.when(blocks == 1, gathered).otherwise(F.xxhash64(*keys)).alias("cell")
    )


def _weights(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(F.greatest("n", F.lit(POSTING_BLOCK))).alias("weight"))


def _prefix_pairs(rows: DataFrame, nodes: DataFrame, folder: str, turn: int | None) -> DataFrame:
    """(cluster, a, b): links that tie two labels, in every cell no more than tie its labels together.

    In a numbered ``turn`` sets meet those of their own block, by a dealing of that number. Without
    a number all meet that have different labels: those beside the cluster's largest label ask,
    in blocks of their own, all others of the cluster.
    """
    cells = written(_blocks(_weights(rows, "cluster"), "weight", SET_BLOCK, "cluster"), f"{folder}/cells")
    placed = rows.select("cluster", "node", "label", "n", "shingles").join(nodes.select("node", "n", "sig"), ["node", "n"])
    if turn is not None:
        block = F.pmod(F.xxhash64("node", F.lit(turn)), F.col("blocks")).cast("int")
        every = placed.join(cells, "cluster").select(
            "*", F.lit(0).alias("low"), block.alias("high"), F.lit(True).alias("asks"), F.lit(True).alias("met")
        )
    else:
        largest = _weights(rows, "cluster", "label").groupBy("cluster").agg(
            F.max(F.struct("weight", "label")).alias("most"), F.sum("weight").alias("weight")
        )
        asking = F.ceil((F.col("weight") - F.col("most.weight")) / SET_BLOCK).cast("int")
        dealt = cells.join(largest, "cluster").where(asking > 0).select(
            "cluster", "cell", "blocks", F.col("most.label").alias("largest"), asking.alias("asking")
        )
        placed = placed.join(written(dealt, f"{folder}/dealt"), "cluster")
        own = lambda blocks: F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
        other = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
        ask = placed.where(F.col("label") != F.col("largest")).select(
            "*", own("asking").alias("low"), other("blocks").alias("high"), F.lit(True).alias("asks"), F.lit(False).alias("met")
        )
        met = placed.select(
            "*", other("asking").alias("low"), own("blocks").alias("high"), F.lit(False).alias("asks"), F.lit(True).alias("met")
        )
        every = ask.unionByName(met)
    every = every.select("cell", "low", "high", "cluster", "node", "label", "n", "shingles", "sig", "asks", "met")
    found = every.groupBy("cell", "low", "high").applyInPandas(_cell, "cluster long, a long, b long")
    return written(found.distinct(), f"{folder}/pairs")


def _cell(rows: pd.DataFrame) -> pd.DataFrame:
    ties = [(cluster, a, b) for cluster, part in rows.groupby("cluster") for a, b in _ties(part)]
    return pd.DataFrame(ties, columns=["cluster", "a", "b"], dtype="int64")


def _prefixes(codes: np.ndarray, owner: np.ndarray, sizes: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The places in ``codes`` of the shingles by which two labels can be linked.

    A cell's shingles have one order: those of a single label, then the others from rare to
    frequent. Two sets of similarity 0.8 have in common one of the first n - ceil(0.8 n) + 1 of
    each. One that a single label holds cannot tie two, so only the rest is returned.
    """
    by_code = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.diff(codes[by_code], prepend=-1))
    labels = label[owner[by_code]]
    several = np.minimum.reduceat(labels, starts) != np.maximum.reduceat(labels, starts)
    frequency = np.diff(np.append(starts, len(codes)))
    rank = np.empty(len(starts), np.int64)
    rank[np.lexsort((frequency, several))] = np.arange(len(starts))
    by_rank = np.lexsort((rank[codes], owner))
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    prefix = sizes + (-sizes * THRESHOLD) // 100 + 1
    return by_rank[(place < prefix[owner]) & several[codes[by_rank]]]


def _ties(rows: pd.DataFrame) -> list[tuple[int, int]]:
    """Links between the labels of some sets of one cluster, each joining two that were apart.

    Every pair of an asking and a met set of two labels that are still apart, with a prefix shingle
    in common and alike by size and signature, is tried on full sets, the most alike first.
    """
    node, asks, met = (rows[c].to_numpy() for c in ("node", "asks", "met"))
    label = np.unique(rows["label"].to_numpy(), return_inverse=True)[1]
    if not label.any():
        return []
    held = list(rows["shingles"])
    sizes = np.array(list(map(len, held)))
    stops = np.cumsum(sizes)
    codes = np.unique(np.concatenate(held), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(held)), sizes)
    prefixes = _prefixes(codes, owner, sizes, label)
    asked = prefixes[asks[owner[prefixes]]]
    listed = prefixes[met[owner[prefixes]]]
    listed = listed[np.argsort(codes[listed], kind="stable")]
    bounds = np.searchsorted(codes[listed], np.arange(codes.max() + 2))
    listed = owner[listed]
    sigs = np.frombuffer(b"".join(rows["sig"]), np.uint8).reshape(len(rows), -1)
    own = np.zeros(len(bounds), bool)
    ties = []
    for part in np.split(asked, np.flatnonzero(np.diff(owner[asked])) + 1) if len(asked) else ():
        one = owner[part[0]]
        near = np.zeros(len(rows), bool)
        for code in codes[part].tolist():
            near[listed[bounds[code] : bounds[code + 1]]] = True
        near &= (label != label[one]) & (100 * np.minimum(sizes, sizes[one]) >= THRESHOLD * np.maximum(sizes, sizes[one]))
        near = np.flatnonzero(near)
        equal = [(sigs[near[i : i + SIGNATURES]] == sigs[one]).sum(axis=1) for i in range(0, len(near), SIGNATURES)]
        equal = np.concatenate([np.zeros(0, np.int64), *equal])
        order = np.argsort(-equal, kind="stable")
        mine = codes[stops[one] - sizes[one] : stops[one]]
        own[mine] = True
        for other in near[order[: (equal >= LEAST_EQUAL).sum()]].tolist():
            if label[other] == label[one]:
                continue
            both = np.count_nonzero(own[codes[stops[other] - sizes[other] : stops[other]]])
            if 100 * both >= THRESHOLD * (len(mine) + sizes[other] - both):
                ties.append((min(node[one], node[other]), max(node[one], node[other])))
                label[label == label[other]] = label[one]
        own[mine] = False
    return ties


def _confirmed_in_clusters(pairs: DataFrame, rows: DataFrame, folder: str) -> DataFrame:
    """The pairs that are links by their full sets.

    Cells return fewer pairs than they have nodes, and the two sets of a pair are alike in size, so
    a set for each of its pairs is no more than the cells held. Only sets in pairs are moved.
    """
    met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = written(met, f"{folder}/met").join(rows.select("node", "shingles"), "node")
    return _confirmed(pairs.select("a", "b"), written(sets, f"{folder}/met-sets")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for left, right in zip(batch["left_set"], batch["right_set"]):
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= THRESHOLD * (len(left) + len(right) - both))
            yield batch.loc[keep, ["a", "b"]]

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left_set"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right_set"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "left_set", "right_set")
    return met.mapInPandas(alike, "a long, b long")


# --- the operator ---------------------------------------------------------------------------


def group_near_duplicates(docs: DataFrame, shingle_words: int = 5) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` (the least id of its group) and ``kept``."""
    spark = docs.sparkSession
    folder = scratch(spark, "near-duplicates")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_of()).alias("text_hash"),
        text_of().alias("text"),
    )
    signed = written(
        texts.mapInPandas(
            lambda batches: _signed(batches, shingle_words),
            "doc_id long, text_hash long, n long, f1 long, f2 long, bands array<long>, sig binary",
        ),
        f"{folder}/signed",
    )
    usable = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    first = usable.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("node"))
    first = written(first, f"{folder}/first")
    owners = usable.select("doc_id", "f1", "f2", "n").join(first, ["f1", "f2", "n"]).select("doc_id", "node")
    nodes = usable.withColumnRenamed("doc_id", "node").join(first, ["node", "f1", "f2", "n"], "left_semi")
    nodes = written(nodes.select("node", "n", "bands", "sig").dropDuplicates(["node", "n", "sig"]), f"{folder}/nodes")

    members = _memberships(nodes, folder)
    met = members.select(F.col("node").alias("doc_id")).distinct()
    sets = written(
        texts.where(F.col("text") != "").join(met, "doc_id", "left_semi").dropDuplicates()
        .mapInPandas(lambda batches: _sets(batches, shingle_words), "node long, shingles array<long>"),
        f"{folder}/sets",
    )
    links = written(_confirmed(_star_pairs(members, nodes), sets), f"{folder}/star")
    labels = written(components(links, "a", "b"), f"{folder}/labels")
    clusters = _clusters(members, labels, folder)
    for turn in (*range(FIRST_TRIES), None):
        tried = f"{folder}/turn-{turn}"
        rows = clusters.join(labels, "node", "left").join(sets, "node").select(
            "cluster", "node", F.coalesce("label", "node").alias("label"), "shingles",
            F.size("shingles").cast("long").alias("n"),
        )
        rows = written(rows, f"{tried}/rows")
        pairs = _prefix_pairs(rows, nodes, tried, turn)
        if not pairs.isEmpty():
            new = written(_confirmed_in_clusters(pairs, rows, tried), f"{tried}/links")
            labels = _relabelled(labels, new, tried)
        if turn is None:
            break
        clusters = written(_still_open(clusters, rows, labels, tried), f"{tried}/more")
        if clusters.isEmpty():
            break
    # Several rows of one id tie the nodes of their texts together.
    ids = written(
        owners.groupBy("doc_id").agg(F.min("node").alias("node"), F.max("node").alias("last")), f"{folder}/ids"
    )
    several = ids.where(F.col("node") != F.col("last")).select("doc_id", F.col("node").alias("a"))
    if not several.isEmpty():
        tied = owners.join(several, "doc_id").select("a", F.col("node").alias("b"))
        labels = _relabelled(labels, written(tied, f"{folder}/tied"), f"{folder}/by-id")
    grouped = ids.join(labels, "node", "left").select("doc_id", F.coalesce("label", "node").alias("component_id"))
    return _labelled(docs, signed, grouped)


def _relabelled(labels: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """``labels`` after more ``links``: only the labels that these tie are labelled anew."""
    ends = [
        labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label")) for side in ("a", "b")
    ]
    ties = links.join(ends[0], "a", "left").join(ends[1], "b", "left").select(
        F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")
    )
    tied = components(ties, "a", "b").select(F.col("node").alias("old"), F.col("label").alias("new"))
    tied = written(tied, f"{folder}/tied-labels")
    known = labels.join(tied, F.col("label") == F.col("old"), "left").select("node", F.coalesce("new", "label").alias("label"))
    alone = tied.join(labels, F.col("old") == F.col("node"), "left_anti").select(
        F.col("old").alias("node"), F.col("new").alias("label")
    )
    return written(known.unionByName(alone), f"{folder}/labels")


def _still_open(clusters: DataFrame, rows: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """The clusters of several blocks that hold several labels: not all of their sets have met."""
    now = rows.select("cluster", "node", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    held = now.groupBy("cluster").agg(
        F.sum(F.greatest("n", F.lit(POSTING_BLOCK))).alias("weight"), F.min("label").alias("first"), F.max("label").alias("last")
    )
    several = held.where((F.col("weight") > SET_BLOCK) & (F.col("first") != F.col("last"))).select("cluster")
    return clusters.join(written(several, f"{folder}/several"), "cluster", "left_semi")


def _labelled(docs: DataFrame, signed: DataFrame, grouped: DataFrame) -> DataFrame:
    """``docs`` with the size of their sets and the group of their id."""
    known = (
        signed.select("doc_id", "text_hash", F.col("n").alias("n_shingles")).dropDuplicates(["doc_id", "text_hash"])
        .join(grouped, "doc_id", "left")
        .select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "n_shingles", "component_id")
    )
    same = F.col("row.doc_id").eqNullSafe(F.col("own_id")) & (F.col("hash") == F.col("own_hash"))
    component = F.coalesce("component_id", F.col("row.doc_id").cast("long"))
    return (
        docs.select(F.struct(*without(docs)).alias("row"), F.xxhash64(text_of()).alias("hash"))
        .join(known, same, "left")
        .select(
            *(f"row.{c}" for c in without(docs, "n_shingles", "component_id", "kept")),
            "n_shingles", component.alias("component_id"),
            F.coalesce(F.col("row.doc_id") == component, F.lit(True)).alias("kept"),
        )
    )


def op10_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return group_near_duplicates(docs, shingle_words=4).drop("text")
