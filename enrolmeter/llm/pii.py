"""Personal data: generators with high recall, boosted trees, calibrated thresholds.

Base spans (e-mail, IP address, payment card, phone) are found by their formats and always
stay. Beside them generators propose spans of looser formats that may overlap: numbers with
other separators or no country code, addresses that are spelt out, assigned secrets, access
keys, long mixed tokens. Boosted trees judge every proposal by its format (kind, length,
character classes, separators, checksum, entropy) and context (what stands before and after,
words such as "tel" or "password" shortly before). A proposal is redacted where its probability
reaches its kind's threshold and it overlaps nothing stronger.

The trees learn from the corpus itself: proposals that a strict rule of their
kind accepts are examples for, those that it refuses examples against, and those that it does
not speak of are left out. All documents are searched for examples and these are counted by kind
and verdict. Where no such stratum has more than ``STRATUM``, all are taken to the driver and learned
from there. Where one has more, none is left out either: all examples become a table, equal ones
one row with their number, and trees grow over that table, from sums that Spark adds up
(``boosting.boost_table``). An example of a stratum beyond ``STRATUM`` weighs so much less that the
stratum weighs as much as ``STRATUM`` examples, so a rare kind is learned from however large the corpus is.

Each example is judged by trees that did not see it or a copy of it, and counts for as many as it
stands for in the corpus: a kind's threshold is the lowest that keeps a precision of ``PRECISION`` (over
a table, the lowest of ``LEVELS`` steps). A kind with fewer than ``FEWEST`` accepted examples, or with too
few to measure that precision and no such threshold, takes the threshold of all kinds together. The
passes for learning (two where a table is needed) and for finding go over whole texts in Arrow batches;
examples are written between the jobs.

Offsets are code points, ends exclusive. All patterns run in linear time on long runs of digits,
dots or letters: each starts only where a run starts and gives nothing back.

Defined cases: null text is empty and has no spans. Without documents or proposals to learn
from only base spans are found. Repeated rows are searched alike. Other columns come back as
they are.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType, StructField, StructType

from .boosting import BINS, Boosted, boost, boost_table
from .common import hex_sha256, scratch, table, text_of, without, written

#: The kinds in the order of the output. The last is the method's own.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
TRAIN_SPANS = 20000
#: Examples of one kind and verdict.
STRATUM = TRAIN_SPANS // (2 * len(KINDS))
PRECISION, FEWEST = 0.995, 20
FOLDS = 3
#: Steps of chances and thresholds over a table.
LEVELS = 10_000

#: What every base format needs, and what every format needs.
_WORTH_A_LOOK = re.compile("[0-9@]")
_NEEDS = r"[0-9@:=]|[(\[]at[)\]]"
_WORTH_ANYTHING = re.compile(_NEEDS)
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Looser formats: kind, what a text with one must hold, pattern.
_LOOSE = (
    ("email", re.compile(r"[(\[]at[)\]]"), re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63}+)++")),
    ("card", re.compile("[0-9]"), re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]{1,2}[0-9]{4,6}){2,3}(?:[ ./_-]{1,2}[0-9]{1,4})?(?![0-9])")),
    ("phone", re.compile("[0-9]"), re.compile(r"(?<![0-9+])(?:00[1-9][0-9]{0,2}[ ./-]?)?\(?[0-9]{2,4}\)?[ ./-]{1,2}[0-9]{3,4}[ ./-][0-9]{3,4}(?![0-9])")),
    ("secret", re.compile("[:=]"), re.compile(r"[:=] ?[\"']?([^\s\"'<>|&*#$%]{8,}+)")),
    ("secret", re.compile("[0-9]"), re.compile(r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]{0,64}[0-9])[A-Za-z0-9_+/-]{16,}+")),
)
#: Words that speak for a kind when they stand shortly before.
_CUES = (
    re.compile(r"(?i)mail|contact"), re.compile(r"(?i)\bip\b|host|addr|server"),
    re.compile(r"(?i)card|visa|karte|tarjeta|carte"), re.compile(r"(?i)tel|phone|call|fax|mobil"),
    re.compile(r"(?i)(?:password|passwd|pwd|token|secret|key)[\"']?\s?[:=]\s?[\"']?$"),
)
_BEFORE = 30


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(d * 2 - 9 * (d > 4) for d in values[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern finds them, from each @ outwards: the name is all that may belong to it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        elif start < at:
            free = start
        at = text.find("@", max(at + 1, free))


def formats(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, whether it passes its check) of every match of a base format."""
    for start, end in _emails(text):
        yield "email", start, end, True
    for m in _IP.finditer(text):
        yield "ip", *m.span(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        yield "card", *m.span(), 16 <= len(digits) <= 19 and _luhn(digits)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield "phone", *m.span(), 8 <= sum(c.isdigit() for c in m[0]) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    if not _WORTH_A_LOOK.search(text):
        return []
    return [(kind, start, end) for kind, start, end, passed in formats(text) if passed]


def proposals(text: str) -> list[tuple[str, int, int, int | None]]:
    """(kind, start, end, verdict of the kind's strict rule: 1, 0 or None), overlaps included."""
    out: dict[tuple[str, int, int], int | None] = {}
    for kind, start, end, passed in formats(text) if _WORTH_A_LOOK.search(text) else ():
        if passed or end - start >= 7:
            out[kind, start, end] = int(passed)
    for kind, needed, pattern in _LOOSE:
        for m in pattern.finditer(text) if needed.search(text) else ():
            start, end = m.span(m.lastindex or 0)
            out.setdefault((kind, start, end), _strict_secret(text, start, end) if kind == "secret" else None)
    return [(*span, verdict) for span, verdict in out.items()]


def _strict_secret(text: str, start: int, end: int) -> int | None:
    """An assigned mixed value or an access key is one; plain words and numbers are none."""
    value = text[start:end]
    mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    if not mixed:
        return 0
    cued = bool(_CUES[4].search(text[max(0, start - _BEFORE) : start]))
    if cued and len(value) >= 12 or re.fullmatch("AKIA[0-9A-Z]{16}", value):
        return 1
    return None if cued or len(value) >= 32 else 0


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    span = text[start:end]
    digits = "".join(c for c in span if "0" <= c <= "9")
    letters = sum(c.isalpha() for c in span)
    upper = sum(c.isupper() for c in span)
    shares = np.unique(np.frombuffer(span.encode("utf-32-le", "replace"), np.uint32), return_counts=True)[1] / max(1, len(span))
    before, after = text[start - 1 : start] if start else "", text[end : end + 1]
    context = text[max(0, start - _BEFORE) : start]
    numbers = [int(n) if len(n) < 10 else 10**9 for n in re.findall("[0-9]+", span[:64])]
    return [
        *(float(kind == k) for k in KINDS),
        len(span), len(digits), letters, upper, len(span) - len(digits) - letters,
        float(-(shares * np.log2(shares)).sum()), len(set(digits)),
        float(len(digits) > 1 and _luhn(digits)), max(numbers, default=0), len(numbers),
        span.count("."), span.count("-"), span.count(" "), float(span[:1] == "+"), float(span[:1] == "("),
        float("@" in span), float(span[:4] == "AKIA"),
        float(before.isalnum()), float(before in "=:\"'"), float(after.isalnum()), float(after in ".,;"),
        *(float(bool(cue.search(context))) for cue in _CUES),
    ]


@dataclass
class Judge:
    model: Boosted
    thresholds: dict[str, float]

    def accepted(self, text: str, found: list[tuple[str, int, int]]) -> list[tuple[str, int, int, float]]:
        """Proposals over their kind's threshold, strongest first, that overlap nothing so far."""
        own = set(found)
        open_to = [p[:3] for p in proposals(text) if p[0] in self.thresholds and p[:3] not in own]
        if not open_to:
            return []
        chances = self.model.probability(np.array([features(text, *p) for p in open_to]))
        ranked = sorted(zip(chances, open_to), key=lambda c: (-c[0], c[1][1], -c[1][2], c[1][0]))
        # Ends and starts of what is taken, in order and apart from each other.
        starts, ends, out = [], [], []
        for _, start, end in sorted(found, key=lambda s: s[1:]):
            if ends and start < ends[-1]:
                ends[-1] = max(ends[-1], end)
            else:
                starts.append(start)
                ends.append(end)
        for chance, (kind, start, end) in ranked:
            at = bisect_right(ends, start)  # the first one that ends later
            if chance >= self.thresholds[kind] and (at == len(starts) or end <= starts[at]):
                starts.insert(at, start)
                ends.insert(at, end)
                out.append((kind, start, end, float(chance)))
        return out


def _digest(*parts: object) -> str:
    return hashlib.blake2b("\0".join(map(str, parts)).encode("utf-8", "replace"), digest_size=8).hexdigest()


def _examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's number of examples of each kind and verdict (n), and the first of each by hash (n is 0)."""
    counts: Counter = Counter()
    first: defaultdict = defaultdict(list)
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            for kind, start, end, verdict in proposals(text):
                if verdict is None:
                    continue
                counts[kind, verdict] += 1
                since = max(0, start - _BEFORE)
                # All that features() looks at: copies have it in common.
                content = _digest(kind, start - since, end - start, text[since : end + 1])
                place = _digest(doc_id, start, content)
                heap = first[kind, verdict]  # the greatest hash on top
                key = (-int(place, 16), place, content)
                if len(heap) < STRATUM:
                    heapq.heappush(heap, (*key, features(text, kind, start, end)))
                elif key > heap[0][:3]:
                    heapq.heapreplace(heap, (*key, features(text, kind, start, end)))
    rows = [(*stratum, n, None, None, None) for stratum, n in counts.items()]
    rows += [(*stratum, 0, *one[1:]) for stratum, heap in first.items() for one in heap]
    yield pd.DataFrame(rows, columns=["kind", "verdict", "n", "place", "content", "features"])


def _lowest(chances: np.ndarray, good: np.ndarray, weights: np.ndarray) -> float | None:
    """The lowest chance of a good example from which on the precision holds, if any."""
    order = np.argsort(-chances, kind="stable")
    level = chances[order]
    right, every = np.cumsum((weights * good)[order]), np.cumsum(weights[order])
    whole = np.append(level[1:] != level[:-1], True)  # equal chances enter together
    fits = whole & np.isin(level, chances[good]) & (right >= PRECISION * every)
    return max(float(level[fits][-1]), 0.5) if fits.any() else None


def learn(docs: DataFrame) -> Judge | None:
    """A judge from the examples of all documents, or None where there is nothing to learn."""
    worth = docs.where(F.regexp_like("text", F.lit(_NEEDS))).select(F.col("doc_id").cast("string"), "text")
    found = worth.mapInPandas(
        _examples, "kind string, verdict int, n long, place string, content string, features array<double>"
    )
    found = written(found, f"{scratch(docs.sparkSession, 'pii')}/examples")
    sums = found.where("n > 0").groupBy("kind", "verdict").agg(F.sum("n").alias("n")).collect()
    counts = {(r["kind"], r["verdict"]): r["n"] for r in sums}
    if len({verdict for _, verdict in counts}) < 2:
        return None
    if max(counts.values()) > STRATUM:
        return _judge_of_table(worth, counts)
    strata = [
        found.where((F.col("n") == 0) & (F.col("kind") == kind) & (F.col("verdict") == verdict))
        .orderBy("place", "content").limit(STRATUM)
        for kind, verdict in sorted(counts)
    ]
    rows = reduce(DataFrame.unionByName, strata).collect()
    return _judge(rows, counts)


def _judge(rows: list, counts: dict[tuple[str, int], int]) -> Judge:
    """Trees from the examples, and thresholds as if all that ``counts`` has were judged."""
    rows = sorted(rows, key=lambda r: (r["kind"], r["verdict"], r["content"], r["place"]))
    strata = [(r["kind"], r["verdict"]) for r in rows]
    contents = sorted({(*s, r["content"]) for s, r in zip(strata, rows)})
    fold_of = {content: i % FOLDS for i, content in enumerate(contents)}
    folds = np.array([fold_of[*s, r["content"]] for s, r in zip(strata, rows)])
    x, y = np.array([r["features"] for r in rows]), np.array([r["verdict"] for r in rows])
    taken = Counter(strata)
    weights = np.array([counts[s] / taken[s] for s in strata])
    chances = np.full(len(y), y.mean())
    for fold in np.unique(folds):
        mine = folds == fold
        if not mine.all():
            chances[mine] = boost(x[~mine], y[~mine]).probability(x[mine])
    kinds = np.array([r["kind"] for r in rows])
    accepted = Counter(k for k, v in strata if v)
    return Judge(boost(x, y), _thresholds(kinds, chances, y == 1, weights, accepted))


def _thresholds(kinds, chances, good, weights, accepted_of: dict[str, int]) -> dict[str, float]:
    """Every kind's threshold by judged examples and their weights; a kind without one is left out."""
    pooled = _lowest(chances, good, weights)
    levels = {}
    for kind in KINDS:
        mine, accepted = kinds == kind, accepted_of.get(kind, 0)
        level = _lowest(chances[mine], good[mine], weights[mine]) if accepted >= FEWEST else None
        # One error among fewer than 1 / (1 - PRECISION) decides alone: the pool tells more.
        few = accepted < 1 / (1 - PRECISION)
        levels[kind] = pooled if level is None and few else level
    return {kind: level for kind, level in levels.items() if level is not None}


def _every_example(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All examples; those of a batch with equal features are one row and their number."""
    for batch in batches:
        counts: Counter = Counter()
        for text in batch["text"]:
            for kind, start, end, verdict in proposals(text):
                if verdict is not None:
                    counts[kind, verdict, tuple(features(text, kind, start, end))] += 1
        rows = [(*one, n) for one, n in counts.items()]
        yield pd.DataFrame(rows, columns=["kind", "y", "features", "n"])


def _example_table(worth: DataFrame, counts: dict[tuple[str, int], int]) -> DataFrame:
    """(kind, y, features, n, weight, fold) of all examples; equal ones share a row."""
    found = worth.mapInPandas(_every_example, "kind string, y int, features array<double>, n long")
    weight = F.lit(1.0)
    for (kind, verdict), n in counts.items():
        if n > STRATUM:
            weight = F.when((F.col("kind") == kind) & (F.col("y") == verdict), STRATUM / n).otherwise(weight)
    rows = found.groupBy("kind", "y", "features").agg(F.sum("n").alias("n")).select(
        "*", (F.col("n") * weight).alias("weight"), F.pmod(F.xxhash64("features"), F.lit(FOLDS)).cast("int").alias("fold")
    )
    return written(rows, f"{scratch(worth.sparkSession, 'pii')}/every-example")


def _judge_of_table(worth: DataFrame, counts: dict[tuple[str, int], int]) -> Judge:
    """Trees and thresholds from all examples, however many there are."""
    rows = _example_table(worth, counts)
    width = rows.select(F.size("features")).first()[0]
    steps = [float(q) for q in np.linspace(0, 1, BINS)]
    cuts = rows.agg(*(F.percentile_approx(F.get("features", i), steps).alias(f"f{i}") for i in range(width))).first()
    edges = [np.unique(np.array(values))[:-1] for values in cuts]
    models = boost_table(rows.select("features", "y", "weight", "fold"), edges, FOLDS)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            level = np.zeros(len(batch), np.int64)
            fold = batch["fold"].to_numpy()
            for one in np.unique(fold):
                x = np.array(batch["features"][fold == one].tolist())
                level[fold == one] = np.floor(models[one].probability(x) * LEVELS)
            yield pd.DataFrame({"kind": batch["kind"], "y": batch["y"], "level": level, "n": batch["n"]})

    # At most 5 x 2 x LEVELS rows.
    seen = rows.mapInPandas(judged, "kind string, y int, level long, n long")
    seen = seen.groupBy("kind", "y", "level").agg(F.sum("n").alias("n")).orderBy("kind", "y", "level").toPandas()
    accepted = {kind: n for (kind, verdict), n in counts.items() if verdict}
    chances, good = seen["level"].to_numpy() / LEVELS, seen["y"].to_numpy() == 1
    return Judge(models[-1], _thresholds(seen["kind"].to_numpy(), chances, good, seen["n"].to_numpy(float), accepted))


_SPAN = "array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"
_SPAN_FIELDS = {
    "kind": pa.string(), "start": pa.int32(), "end": pa.int32(), "base": pa.bool_(), "score": pa.float64()
}
_SPANS = pa.list_(pa.struct(list(_SPAN_FIELDS.items())))


def find(docs: DataFrame, judge: Judge | None) -> DataFrame:
    """``docs`` with ``spans`` (kind, start, end, base, score), by kind and start."""

    def spans(text: str) -> list[dict]:
        if not _WORTH_ANYTHING.search(text):
            return []
        base = base_spans(text)
        added = judge.accepted(text, base) if judge else []
        every = [(k, s, e, True, 1.0) for k, s, e in base] + [(k, s, e, False, c) for k, s, e, c in added]
        every.sort(key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
        return [dict(zip(_SPAN_FIELDS, one)) for one in every]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([spans(text.as_py()) for text in batch], _SPANS)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # One column goes to Python and its spans come back; a filter on them must not search twice.
    search = arrow_udf(run, _SPAN).asNondeterministic()
    return docs.select(*without(docs, "spans"), search(text_of()).alias("spans"))


def redact(found: DataFrame) -> DataFrame:
    """``text`` with every span of ``spans`` replaced by its kind in brackets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["text"] = [_redacted(t or "", s) for t, s in zip(batch["text"], batch["spans"])]
            yield batch

    fields = [StructField("text", StringType()) if f.name == "text" else f for f in found.schema.fields]
    return found.mapInPandas(run, StructType(fields))


def _redacted(text: str, spans) -> str:
    """Base spans of two kinds may overlap: what they cover together goes once."""
    parts, at = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if span["end"] <= at:
            continue
        if span["start"] >= at:
            parts += [text[at : span["start"]], f"[{span['kind'].upper()}]"]
        at = span["end"]
    return "".join([*parts, text[at:]])


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, learn(docs)).drop("text")
    base = F.filter("spans", lambda s: s["base"])
    shown = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE_KINDS]
    secrets = F.size(F.filter("spans", lambda s: s["kind"] == "secret")).cast("long").alias("n_secret")
    return found.select(
        "doc_id", *counts, secrets, F.size("spans").cast("long").alias("n_spans"),
        hex_sha256(shown(base)).alias("base_sha256"), shown("spans").alias("spans"),
    )
