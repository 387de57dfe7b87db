"""Quality classifier: a convolutional network over the bytes of a text, in numpy.

A text's UTF-8 bytes are cut into chunks of ``CHUNK`` positions that overlap by the filter
width less one, so every window of the whole text is seen once. Each of ``FILTERS`` learned
filters has a weight for every byte at each of its ``WIDTH`` places; its largest value in a chunk
is the chunk's feature, and the logarithm of its filled bytes is one more. Mean, maximum and minimum of the features over the chunks go through one
hidden layer to a single probability. A chunk of a few words repeated excites fewer filters than
prose does, so repetition shows as well as odd characters do.

Training is by back-propagation on the driver from a bounded sample: at most ``TRAIN_DOCS``
labelled rows of each class, the first by a hash of their id. Filters learn from the whole texts of
those rows that together fit into ``TRAIN_CHUNKS`` chunks of a class, taken in the same order; the driver
receives at most 2 x TRAIN_CHUNKS x 1,034 bytes of them. Rows of the held-out fold are never
taken. With the filters the executors then pool the features of every chunk of all sampled texts, however
long (3 x 21 numbers a text), and on these, as scoring has them, the layers after
the filters are trained again. A fifth of the sample is kept from both and calibrates the probability,
also on all chunks, to the class shares of all labelled rows outside the fold.

Scoring covers every byte of every text in Arrow batches, ``SCORE_CHUNKS`` chunks at a time: the
memory for a text does not depend on its length. The weights (some 150 kB) travel with the task.

Defined cases: null or empty text scores 0. Without labels of both classes every other text
scores the smoothed share of label 1 (0.5 without any). An id labelled both 0 and 1 teaches nothing. A
null id is not held out. Repeated rows score alike, other columns come back as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import table, text_of, without

CHUNK, WIDTH, FILTERS, HIDDEN = 512, 6, 20, 16
LANES = FILTERS + 1
PAD = 256
TRAIN_DOCS, TRAIN_CHUNKS = 1000, 12_000
SCORE_CHUNKS = 256
EPOCHS, BATCH, RATE, SEED = 14, 64, 0.01, 11
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def chunks_of(text: str) -> np.ndarray:
    """(chunks, CHUNK + WIDTH - 1) byte numbers; PAD past the end. At least one row."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    rows = max(1, -(-len(data) // CHUNK))
    padded = np.full(rows * CHUNK + WIDTH - 1, PAD, np.int16)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK + WIDTH - 1)[::CHUNK]


@dataclass
class ByteNet:
    """Filters (WIDTH, 257, FILTERS), a hidden layer and an output, all float32."""

    filters: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> ByteNet:
        filters = rng.normal(0, 0.3, (WIDTH, PAD + 1, FILTERS)).astype(np.float32)
        hidden = rng.normal(0, 0.15, (3 * LANES, HIDDEN)).astype(np.float32)
        out = rng.normal(0, 0.3, HIDDEN).astype(np.float32)
        net = cls(filters, hidden, np.zeros(HIDDEN, np.float32), out, np.zeros(1, np.float32))
        return net.masked()

    def masked(self) -> ByteNet:
        """A window that starts past the end never wins; places past the end add nothing."""
        self.filters[:, PAD] = 0
        self.filters[0, PAD] = -1e4
        return self

    def parameters(self) -> list[np.ndarray]:
        return [self.filters, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def responses(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, CHUNK, FILTERS): every filter at every position."""
        total = self.filters[0].take(chunks[:, :CHUNK], axis=0)
        for k in range(1, WIDTH):
            total += self.filters[k].take(chunks[:, k : k + CHUNK], axis=0)
        return total

    def features(self, chunks: np.ndarray) -> np.ndarray:
        parts = [
            self.responses(chunks[i : i + SCORE_CHUNKS]).max(axis=1)
            for i in range(0, len(chunks), SCORE_CHUNKS)
        ]
        return self.with_fill(np.maximum(np.concatenate(parts), -8), chunks)

    @staticmethod
    def with_fill(features: np.ndarray, chunks: np.ndarray) -> np.ndarray:
        """A short text excites few filters as well: how full its chunk is tells it apart."""
        filled = (chunks[:, :CHUNK] != PAD).sum(axis=1)
        return np.column_stack([features, (np.log1p(filled) / 3).astype(np.float32)])

    @staticmethod
    def pooled(features: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Mean, maximum and minimum of texts whose chunks begin at ``starts``."""
        counts = np.diff(np.append(starts, len(features)))[:, None]
        return np.hstack(
            [
                np.add.reduceat(features, starts) / counts,
                np.maximum.reduceat(features, starts),
                np.minimum.reduceat(features, starts),
            ]
        )

    def head(self, pooled: np.ndarray) -> np.ndarray:
        return np.tanh(pooled @ self.hidden + self.hidden_bias) @ self.out + self.out_bias[0]

    def logits(self, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Raw output of texts whose chunks begin at ``starts``."""
        return self.head(self.pooled(features, starts))

    def head_gradients(self, pooled: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean log loss, for the layers after the filters."""
        inner = np.tanh(pooled @ self.hidden + self.hidden_bias)
        guess = 1 / (1 + np.exp(-np.clip(inner @ self.out + self.out_bias[0], -30, 30)))
        error = ((guess - labels) / len(labels)).astype(np.float32)
        d_inner = np.outer(error, self.out) * (1 - inner**2)
        return [pooled.T @ d_inner, d_inner.sum(0), inner.T @ error, error.sum(keepdims=True)]

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits.astype(float) + self.shift, -30, 30)))

    def gradients(self, chunks: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean log loss, in the order of ``parameters``."""
        places, tops = [], []
        for i in range(0, len(chunks), SCORE_CHUNKS):
            responses = self.responses(chunks[i : i + SCORE_CHUNKS])
            places.append(responses.argmax(axis=1))
            tops.append(np.take_along_axis(responses, places[-1][:, None], axis=1)[:, 0])
        where, raw = np.concatenate(places), np.concatenate(tops)
        features = self.with_fill(np.maximum(raw, -8), chunks)
        counts = np.diff(np.append(starts, len(chunks)))
        owner = np.repeat(np.arange(len(starts)), counts)
        mean = np.add.reduceat(features, starts) / counts[:, None]
        most, least = np.maximum.reduceat(features, starts), np.minimum.reduceat(features, starts)
        pooled = np.hstack([mean, most, least])
        inner = np.tanh(pooled @ self.hidden + self.hidden_bias)
        guess = 1 / (1 + np.exp(-np.clip(inner @ self.out + self.out_bias[0], -30, 30)))
        error = ((guess - labels) / len(labels)).astype(np.float32)
        d_inner = np.outer(error, self.out) * (1 - inner**2)
        d_pooled = d_inner @ self.hidden.T
        d_mean, d_most, d_least = np.split(d_pooled, 3, axis=1)
        d_features = d_mean[owner] / counts[owner, None]
        d_features += d_most[owner] * (features == most[owner])
        d_features += d_least[owner] * (features == least[owner])
        d_features = d_features[:, :FILTERS] * (raw > -8)
        d_filters = np.zeros_like(self.filters)
        rows, lane = np.arange(len(chunks))[:, None], np.arange(FILTERS)[None]
        for k in range(WIDTH):
            byte = chunks[rows, where + k].astype(np.int64)
            flat = np.bincount((byte * FILTERS + lane).ravel(), d_features.ravel(), (PAD + 1) * FILTERS)
            d_filters[k] = flat.reshape(PAD + 1, FILTERS)
        return [d_filters, pooled.T @ d_inner, d_inner.sum(0), inner.T @ error, error.sum(keepdims=True)]


def _stacked(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
    return np.concatenate(texts), starts


def fit(
    samples: list[np.ndarray], labels: np.ndarray, share: float,
    whole: Callable[[ByteNet], tuple[np.ndarray, np.ndarray]] | None = None,
) -> ByteNet:
    """Train on chunked samples with labels 0 and 1; ``share`` is that of label 1 in the corpus.
    ``whole`` gives pooled features and labels of more texts, for the layers after the filters."""
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(samples))
    kept, learned = order[: len(order) // 5], order[len(order) // 5 :]
    net = ByteNet.fresh(rng)
    _descend(net.parameters(), lambda some: net.gradients(*_stacked([samples[j] for j in some]), labels[some]), learned, rng, net.masked)
    if whole is None:
        chunks, starts = _stacked(samples)
        _calibrate(net, net.pooled(net.features(chunks), starts)[kept], labels[kept], share)
        return net
    pooled, labels = whole(net)
    order = rng.permutation(len(labels))
    kept, learned = order[: len(order) // 5], order[len(order) // 5 :]
    _descend(net.parameters()[1:], lambda some: net.head_gradients(pooled[some], labels[some]), learned, rng)
    _calibrate(net, pooled[kept], labels[kept], share)
    return net


def _descend(parameters: list[np.ndarray], gradients, learned: np.ndarray, rng: np.random.Generator, after=lambda: None) -> None:
    """EPOCHS rounds of Adam over batches of ``learned``."""
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    steps = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        learned = rng.permutation(learned)
        for i in range(0, len(learned), BATCH):
            found = gradients(learned[i : i + BATCH])
            steps += 1
            for p, (m, v), g in zip(parameters, moments, found):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-7)).astype(np.float32)
            after()


def _calibrate(net: ByteNet, pooled: np.ndarray, labels: np.ndarray, share: float) -> None:
    """Scale and shift of the logit by Newton's method, each class weighted to its true share."""
    if len(set(labels.tolist())) < 2:
        return
    x = net.head(pooled).astype(float)
    ones = labels == 1
    weight = np.where(ones, share / ones.sum(), (1 - share) / (~ones).sum())
    # Soft targets keep a clean split from driving the scale without bound.
    target = np.where(ones, (ones.sum() + 1) / (ones.sum() + 2), 1 / ((~ones).sum() + 2))
    inputs, beta = np.stack([x, np.ones_like(x)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        guess = 1 / (1 + np.exp(-np.clip(inputs @ beta, -30, 30)))
        slope = inputs.T @ (weight * (guess - target)) + 1e-3 * (beta - [1.0, 0.0])
        curve = (inputs * (weight * guess * (1 - guess))[:, None]).T @ inputs + 1e-3 * np.eye(2)
        beta -= np.clip(np.linalg.solve(curve, slope), -1, 1)
    net.scale, net.shift = float(max(beta[0], 0.05)), float(beta[1])


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [np.ascontiguousarray(chunks_of(text)).tobytes() for text in batch["text"]]
        yield pd.DataFrame({"place": batch["place"], "chunks": rows})


def _within(rows: list) -> dict[int, int]:
    """Place and label of the rows whose whole texts fit into TRAIN_CHUNKS chunks of their class."""
    taken, room = {}, {0: TRAIN_CHUNKS, 1: TRAIN_CHUNKS}
    for row in rows:
        if row["n"] <= room[row["label"]] and row["place"] not in taken:
            room[row["label"]] -= row["n"]
            taken[row["place"]] = row["label"]
    return taken


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> ByteNet | float:
    """A network, or the share of label 1 where there is nothing to tell apart."""
    usable = labels.where(
        F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))
    ).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("most"))
    usable = usable.where(F.col("label") == F.col("most")).drop("most")
    counted = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    bad, good = counted.get(0, 0), counted.get(1, 0)
    share = (good + 1) / (bad + good + 2)
    if not bad or not good:
        return share
    first = [
        usable.where(F.col("label") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
        for kind in (0, 1)
    ]
    # At most 2 x TRAIN_DOCS ids: a bounded side.
    chosen = F.broadcast(first[0].unionByName(first[1]))
    texts = docs.select("doc_id", text_of().alias("text")).where(F.col("text") != "")
    sampled = texts.join(chosen, "doc_id").select("label", F.xxhash64("doc_id", "text").alias("place"), "text")
    n = F.ceil(F.octet_length("text") / CHUNK).cast("long").alias("n")
    # Rows, whole texts and pooled features of a bounded sample, in the order of their hash.
    rows = sampled.select("label", "place", n).orderBy("place").limit(2 * TRAIN_DOCS).collect()
    taken = _within(rows)
    if len(set(taken.values())) < 2:
        return share
    # A bounded side again: the places that fit.
    some = F.broadcast(docs.sparkSession.createDataFrame([(p,) for p in taken], "place long"))
    cut = sampled.select("place", "text").join(some, "place", "left_semi")
    got = cut.mapInPandas(_cut, "place long, chunks binary").dropDuplicates(["place"]).collect()
    chunks = {r["place"]: np.frombuffer(r["chunks"], np.int16).reshape(-1, CHUNK + WIDTH - 1) for r in got}
    places = sorted(chunks)

    def whole(net: ByteNet) -> tuple[np.ndarray, np.ndarray]:
        pooled = sampled.mapInPandas(_pooling(net), "place long, label int, pooled array<float>")
        every = pooled.orderBy("place").limit(2 * TRAIN_DOCS).collect()
        return np.array([r["pooled"] for r in every], np.float32), np.array([r["label"] for r in every])

    return fit([chunks[p] for p in places], np.array([taken[p] for p in places]), share, whole)


def _pooling(net: ByteNet):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [net.pooled(net.features(chunks_of(text)), np.array([0]))[0] for text in batch["text"]]
            yield pd.DataFrame({"place": batch["place"], "label": batch["label"], "pooled": rows})

    return run


def probability(model: ByteNet | float) -> Column:
    """The probability of label 1 of ``text``: one column goes to Python, one number a row comes back."""
    text = text_of()
    if isinstance(model, float):
        return F.when(text == "", 0.0).otherwise(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(_scores((t.as_py() for t in batch), model), pa.float64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Not deterministic to Spark: a filter on the score must not have it computed twice.
    return arrow_udf(run, "double").asNondeterministic()(text)


def score(docs: DataFrame, model: ByteNet | float) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1."""
    return docs.select(*without(docs, "score"), probability(model).alias("score"))


def _scores(texts: Iterable[str], net: ByteNet) -> np.ndarray:
    """Chunks of several texts are filtered together, at most SCORE_CHUNKS at a time."""
    features, counts, empty, waiting, size = [], [], [], [], 0

    def flush() -> None:
        nonlocal waiting, size
        if waiting:
            features.append(net.features(np.concatenate(waiting)))
        waiting, size = [], 0

    for text in texts:
        chunks = chunks_of(text)
        counts.append(len(chunks))
        empty.append(not text)
        for i in range(0, len(chunks), SCORE_CHUNKS):
            waiting.append(chunks[i : i + SCORE_CHUNKS])
            size += len(waiting[-1])
            if size >= SCORE_CHUNKS:
                flush()
    flush()
    if not counts:
        return np.zeros(0)
    starts = np.cumsum([0, *counts[:-1]])
    scores = net.probability(net.logits(np.concatenate(features), starts))
    return np.where(empty, 0.0, scores)


def op5_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
