"""BPE encoding and decoding with a minimal acyclic transducer as the lexicon of frequent words.

The words of all documents (matches of the tokenizer's split pattern) are counted, the most
frequent ones, up to ``LEXICON_WORDS``, are encoded by exact merges and compiled:

* An acyclic automaton over their bytes is built from the sorted words, minimal at every step: a state
  whose word is done is exchanged for an equal state already there, so common endings are shared.
* An arc's output is the number of words that come before those behind it. Along a word's path the
  outputs add up to the word's number, under which its ids are listed. So sharing loses nothing.
* Arcs, states and ids are one array of int32 in a file. Spark hands the file to every executor, whose
  workers map it into memory: they share its pages, and open it at no cost.

Encoding splits whole texts, takes the distinct words of a piece of text, and walks all of them
through the transducer together, one look-up for each byte place. Words it does not hold are merged
exactly: lowest rank first, leftmost of equals, over pairs as the tokenizer lists them; a worker
remembers the last of those, in ``MERGED_BYTES`` or those of one piece of text. Special
tokens in a text are found first and are ids of their own, as in the tokenizer. Decoding concatenates
the tokens' bytes; bytes that are no UTF-8 become U+FFFD.

Spark maps over the texts twice, once to count words (shuffled as partial sums) and once to encode. What
reaches the driver: a histogram of counts by eighths of an octave, and the words above the bound
it gives, at most LEXICON_WORDS of at most ``LEXICON_BYTES`` bytes. Which words are in the lexicon
changes no result. Texts are taken in pieces of some ``PIECE_CHARS`` characters; a single text is one row.

Defined cases: null text is empty text and has no tokens; null ids decode to nothing, as do ids without
a token. Repeated rows are encoded alike. Without words the lexicon is empty and all is merged. Columns of
the same names as the results are replaced, others come back as they are.
"""

from __future__ import annotations

import heapq
import json
import os
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import hex_sha256, scratch, table, text_of, without, written

VOCABULARY = "byte_bpe_50k.json"
LEXICON_WORDS, LEXICON_BYTES = 65_536, 32
PIECE_CHARS = 1 << 19
#: Words up to this many bytes are merged together, so many at a time; longer ones with a heap each.
SCAN_BYTES, SCAN_ROWS = 48, 1024
#: What a worker keeps of merged words, and what a word takes beside its bytes.
MERGED_BYTES, WORD_BYTES = 32 << 20, 160
#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 100_000
#: Steps of the histogram of counts in a doubling.
STEPS = 8


# --- the vocabulary ----------------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@dataclass
class Vocabulary:
    """Pairs of ids by (rank, merged id), the ids of bytes, the bytes of ids, special tokens."""

    pairs: dict[tuple[int, int], tuple[int, int]]
    of_byte: list[int]
    tokens: dict[int, bytes]
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, split = said["model"], said["pre_tokenizer"] or {}
        plain = (
            model["type"] == "BPE" and split.get("type") == "ByteLevel" and split["use_regex"]
            and not split["add_prefix_space"] and not said["normalizer"] and not said["post_processor"]
            and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
            and not any(t[k] for t in said["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not plain:
            raise ValueError(f"{path} is no plain byte-level BPE")
        alphabet, ids = byte_alphabet(), model["vocab"]
        pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            pairs[ids[a], ids[b]] = rank, ids[a + b]
        of_byte = [0] * 256
        for char, byte in alphabet.items():
            of_byte[byte] = ids[char]
        special = {t["content"]: t["id"] for t in said["added_tokens"]}
        tokens = {i: bytes(map(alphabet.__getitem__, token)) for token, i in ids.items()}
        return cls(pairs, of_byte, tokens | {i: t.encode() for t, i in special.items()}, special)

    def __post_init__(self):
        self.scale = 1 + max(self.tokens)
        keys = np.array([a * self.scale + b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array([rank for rank, _ in self.pairs.values()], np.int32)[order]
        self.merged = np.zeros(len(keys) + 1, np.int32)  # by rank
        for rank, made in self.pairs.values():
            self.merged[rank] = made

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: lowest rank first, leftmost of equals, until no pair merges."""
        return self.merge_all([word])[1].tolist()

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids): words of about a length step by step together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        short = int(np.searchsorted(lengths[order], SCAN_BYTES, "right"))
        sizes, parts = np.zeros(len(words), np.int64), [np.zeros(0, np.int32)]
        for at in range(0, short, SCAN_ROWS):
            some = order[at : min(at + SCAN_ROWS, short)]
            sizes[some], ids = self._merge_rows([words[i] for i in some.tolist()])
            parts.append(ids)
        for i in order[short:].tolist():
            parts.append(np.array(self._merge_long(list(map(self.of_byte.__getitem__, words[i]))), np.int32))
            sizes[i] = len(parts[-1])
        return sizes, _reordered(order, sizes[order], np.concatenate(parts))

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs; those that do not merge, or lie past an end, have the greatest number."""
        keys = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.scale + right, -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], len(self.keys)).astype(np.int32)

    def _merge_rows(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids): in each round every word that still merges does so once."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids = np.full((len(words), int(lengths.max()) + 1), -1, np.int32)
        every = np.frombuffer(b"".join(words), np.uint8)
        ids[np.arange(ids.shape[1]) < lengths[:, None]] = np.array(self.of_byte, np.int32)[every]
        rows, none = np.arange(len(words)), len(self.keys)
        done_rows, done_sizes, done_ids = [], [], []

        def end(which: np.ndarray) -> None:
            there = ids[which] >= 0
            done_rows.append(rows[which])
            done_sizes.append(there.sum(axis=1))
            done_ids.append(ids[which][there])

        ranks = self._ranks_of(ids[:, :-1], ids[:, 1:])
        while len(rows) and ranks.shape[1]:
            best = ranks.argmin(axis=1)
            low = ranks[np.arange(len(rows)), best]
            goes = low < none
            end(~goes)
            rows, ids, ranks, best, low = rows[goes], ids[goes], ranks[goes], best[goes], low[goes]
            # The right one of the pair goes, and with it the pair's rank; all have one place less.
            after = np.arange(ids.shape[1] - 1) > best[:, None]
            ids = np.where(after, ids[:, 1:], ids[:, :-1])
            row = np.arange(len(rows))
            ids[row, best] = self.merged[low]
            ranks = np.where(after[:, 1:], ranks[:, 1:], ranks[:, :-1])
            for near in (best - 1, best):
                ok = (near >= 0) & (near < ranks.shape[1])
                ranks[row[ok], near[ok]] = self._ranks_of(ids[row[ok], near[ok]], ids[row[ok], near[ok] + 1])
        end(np.ones(len(rows), bool))
        order, sizes = np.concatenate(done_rows), np.concatenate(done_sizes)
        in_order = np.zeros(len(words), np.int64)
        in_order[order] = sizes
        return in_order, _reordered(order, sizes, np.concatenate(done_ids))

    def _merge_long(self, ids: list[int]) -> list[int]:
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        end, known = len(ids), self.pairs.get
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < end:
                pair = known((ids[at], ids[after[at]]))
                if pair:
                    heap.append((pair[0], at, ids[at], ids[after[at]], pair[1]))

        for at in range(end):
            offer(at)
        heapq.heapify(heap)
        while heap:
            _, at, left, right, merged = heapq.heappop(heap)
            gone = after[at]
            if ids[at] != left or gone >= end or ids[gone] != right:
                continue  # one of the two has been merged since
            ids[at], ids[gone], after[at] = merged, -1, after[gone]
            if after[at] < end:
                before[after[at]] = at
            for near in (before[at], at):
                size = len(heap)
                offer(near)
                if len(heap) > size:
                    heapq.heappush(heap, heap.pop())
        return [i for i in ids if i >= 0]


# --- the lexicon -------------------------------------------------------------------------------


def minimal_states(words: Iterable[bytes]) -> tuple[list[tuple[bool, tuple[tuple[int, int], ...]]], int]:
    """States (final, arcs as (byte, state)) of the least automaton of sorted distinct words, and its start."""
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    register: dict[tuple[bool, tuple[tuple[int, int], ...]], int] = {}
    path: list[tuple[list[bool], list[tuple[int, int]]]] = [([False], [])]  # open states of the last word

    def close(depth: int) -> None:
        """States below ``depth`` get no more arcs: each is an equal one that is there, or new."""
        while len(path) > depth + 1:
            (final,), arcs = path.pop()
            state = final, tuple(arcs)
            number = register.setdefault(state, len(states))
            if number == len(states):
                states.append(state)
            byte = last[len(path) - 1]
            path[-1][1].append((byte, number))

    last = b""
    for word in words:
        shared = len(os.path.commonprefix([last, word]))
        close(shared)
        path += [([False], []) for _ in word[shared:]]
        path[-1][0][0] = True
        last = word
    close(0)
    states.append((path[0][0][0], tuple(path[0][1])))
    return states, len(states) - 1


def compiled(words: Mapping[bytes, Sequence[int]]) -> np.ndarray:
    """The transducer of words and their ids, as one array: eight sizes, then the parts."""
    ordered = sorted(words)
    states, start = minimal_states(ordered)
    below = []  # words from a state on; states come after those they lead to
    for final, arcs in states:
        below.append(final + sum(below[target] for _, target in arcs))
    keys, targets, outputs = [], [], []
    for number, (final, arcs) in enumerate(states):
        passed = int(final)
        for byte, target in arcs:
            keys.append(number * 256 + byte)
            targets.append(target)
            outputs.append(passed)
            passed += below[target]
    finals = [final for final, _ in states]
    stops = np.cumsum([0, *(len(words[w]) for w in ordered)])
    ids = [i for w in ordered for i in words[w]]
    parts = [np.array(p, np.int32) for p in (keys, targets, outputs, finals, stops, ids)]
    sizes = np.array([start, *map(len, parts), 0], np.int32)
    return np.concatenate([sizes, *parts])


class Lexicon:
    """Looks words up in a compiled transducer, which may be a file mapped into memory."""

    def __init__(self, array: np.ndarray):
        self.start = int(array[0])
        stops = np.cumsum([8, *array[1:7].tolist()])
        self.keys, self.targets, self.outputs, self.finals, self.stops, self.ids = (
            array[a:b] for a, b in zip(stops, stops[1:])
        )

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        return cls(np.load(path, mmap_mode="r"))

    def numbers(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each word ``data[start : start + length]``, -1 where it is not there."""
        out = np.full(len(starts), -1, np.int64)
        state, total = np.full(len(starts), self.start, np.int32), np.zeros(len(starts), np.int32)
        walking, place = np.flatnonzero(lengths <= LEXICON_BYTES), 0
        while len(walking):
            done = lengths[walking] == place
            ended = walking[done]
            final = self.finals[state[ended]] == 1
            out[ended[final]] = total[ended[final]]
            walking = walking[~done]
            if not len(self.keys):
                break
            keys = state[walking] * 256 + data[starts[walking] + place]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            there = self.keys[at] == keys
            walking, at = walking[there], at[there]
            state[walking] = self.targets[at]
            total[walking] += self.outputs[at]
            place += 1
        return out


# --- texts -------------------------------------------------------------------------------------


class _Numbering(dict):
    """Numbers keys as they come."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def _stretches(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all stretches in a row."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _reordered(order: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Runs of ``flat``, the k-th of ``sizes[k]`` for place ``order[k]``, in the order of places."""
    back = np.argsort(order)
    return flat[_stretches((np.cumsum(sizes) - sizes)[back], sizes[back])]


class Merged:
    """Ids of words merged before: the last ``MERGED_BYTES``, and as many that were used before those.

    What is forgotten is merged again: it spares time, nothing else.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.held, self.last, self.older = 0, {}, {}

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids) of distinct words."""
        if self.held > MERGED_BYTES:
            self.held, self.last, self.older = 0, {}, self.last
        known, before = self.last.get, self.older.get
        codes = [known(w) or before(w) for w in words]
        new = [i for i, code in enumerate(codes) if code is None]
        if new:
            sizes, ids = self.vocabulary.merge_all([words[i] for i in new])
            data, stops = ids.astype(np.int32).tobytes(), (4 * np.cumsum(sizes)).tolist()
            for i, start, stop in zip(new, [0, *stops], stops):
                codes[i] = data[start:stop]
        if self.older:
            fresh = [(w, c) for w, c in zip(words, codes) if w not in self.last]
        else:
            fresh = [(words[i], codes[i]) for i in new]
        self.last.update(fresh)
        self.held += sum(len(w) for w, _ in fresh) + WORD_BYTES * len(fresh)
        sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        return sizes, np.frombuffer(b"".join(codes), np.int32)


class Coder:
    """Encodes and decodes texts with a vocabulary and a lexicon."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon, pattern: str):
        self.vocabulary, self.lexicon, self.merged = vocabulary, lexicon, Merged(vocabulary)
        self.split = regex.compile(pattern).findall
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile(f"({'|'.join(map(regex.escape, names))})").split if names else None
        size = max(vocabulary.tokens, default=-1) + 1
        tokens = [vocabulary.tokens.get(i, b"") for i in range(size)]
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_sizes = np.array([*map(len, tokens), 0], np.int64)  # the last is that of no token
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes

    def words(self, text: str) -> list[str | int]:
        """The words of a text; a special token is its id."""
        if self.special is None:
            return self.split(text)
        parts = self.special(text)
        if len(parts) == 1:
            return self.split(text)
        found: list[str | int] = []
        for i, part in enumerate(parts):
            found += [self.vocabulary.special[part]] if i % 2 else self.split(part)
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids)."""
        numbering, codes, n_words = _Numbering(), [], []
        for text in texts:
            found = list(map(numbering.__getitem__, self.words(text)))
            codes += found
            n_words.append(len(found))
        sizes, flat = self._ids_of(list(numbering))
        codes = np.array(codes, np.int64)
        ids = flat[_stretches((np.cumsum(sizes) - sizes)[codes], sizes[codes])]
        ends = np.cumsum(np.append(0, sizes[codes]))
        stops = ends[np.cumsum([0, *n_words])]
        return np.diff(stops), ids

    def _ids_of(self, words: list[str | int]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all of them): from the lexicon, else merged."""
        special = [i for i, w in enumerate(words) if isinstance(w, int)] if self.special else []
        plain = list(words)
        for i in special:
            plain[i] = ""
        try:
            raw = "".join(plain).encode()
            # The same bytes by word: in ASCII a character is a byte.
            sized = plain if len(raw) == sum(map(len, plain)) else [w.encode() for w in plain]
        except UnicodeEncodeError:  # a lone surrogate
            sized = [w.encode("utf-8", "replace") for w in plain]
            raw = b"".join(sized)
        lengths = np.fromiter(map(len, sized), np.int64, len(sized))
        data = np.frombuffer(raw, np.uint8)
        starts = np.cumsum(lengths) - lengths
        numbers = self.lexicon.numbers(data, starts, lengths)
        known = numbers >= 0
        stops = self.lexicon.stops
        sizes = np.zeros(len(words), np.int64)
        sizes[known] = stops[numbers[known] + 1] - stops[numbers[known]]
        known[special], sizes[special] = False, 1
        unseen = ~known
        unseen[special] = False
        begun, ended = starts[unseen].tolist(), (starts + lengths)[unseen].tolist()
        sizes[unseen], merged = self.merged.of([raw[a:b] for a, b in zip(begun, ended)])
        flat, places = np.zeros(int(sizes.sum()), np.int32), np.cumsum(sizes) - sizes
        flat[places[special]] = [words[i] for i in special]
        flat[_stretches(places[unseen], sizes[unseen])] = merged
        flat[_stretches(places[known], sizes[known])] = self.lexicon.ids[
            _stretches(stops[numbers[known]].astype(np.int64), sizes[known])
        ]
        return sizes, flat

    def decode(self, sizes: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The texts of runs of ids."""
        ids = np.where((ids >= 0) & (ids < len(self.token_sizes) - 1), ids, len(self.token_sizes) - 1)
        data = self.token_bytes[_stretches(self.token_starts[ids], self.token_sizes[ids])]
        ends = np.cumsum(np.append(0, self.token_sizes[ids]))
        stops = ends[np.cumsum(np.append(0, sizes))]
        raw = data.tobytes()
        return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(stops, stops[1:])], pa.string())


def _in_pieces(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in a row, some PIECE_CHARS characters at a time."""
    waiting, size = [], 0
    for text in texts:
        waiting.append(text.as_py() or "")
        size += len(waiting[-1])
        if size >= PIECE_CHARS:
            yield waiting
            waiting, size = [], 0
    if waiting:
        yield waiting


# --- the operator ------------------------------------------------------------------------------


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, pattern: str, most: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent words of all texts, at most ``most``: all above a bound on their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def partial(counts: Counter) -> pa.RecordBatch:
        some = {w: n for w, n in counts.items() if isinstance(w, str) and len(w) <= LEXICON_BYTES}
        return pa.RecordBatch.from_arrays(
            [pa.array(some.keys(), pa.string()), pa.array(some.values(), pa.int64())], ["word", "n"]
        )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value, Lexicon(compiled({})), pattern)
        counts: Counter = Counter()
        for batch in batches:
            for texts in _in_pieces(batch.column(0)):
                for text in texts:
                    counts.update(coder.words(text))
                if len(counts) >= COUNTED_WORDS:
                    yield partial(counts)
                    counts = Counter()
        yield partial(counts)

    found = docs.select(text_of().alias("text")).where("text <> ''").mapInArrow(counted, "word string, n long")
    found = found.where(F.octet_length("word") <= LEXICON_BYTES).groupBy("word").agg(F.sum("n").alias("n"))
    found = found.withColumn("step", F.floor(F.log2("n") * STEPS).cast("int"))
    found = written(found, scratch(docs.sparkSession, "words"))
    total, least = 0, None
    for row in found.groupBy("step").count().orderBy(F.desc("step")).collect():  # 64 * STEPS rows at most
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    if least is None:
        return []
    return sorted(r["word"].encode() for r in found.where(F.col("step") >= least).select("word").collect())


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, pattern: str, most: int = LEXICON_WORDS) -> str:
    """Compile the frequent words and hand the file to all executors; its name there.

    The driver's own copy is what Spark serves executors from, those that join later too.
    """
    words = frequent_words(docs, vocabulary, pattern, most)
    sizes, ids = vocabulary.merge_all(words)
    array = compiled(dict(zip(words, np.split(ids, np.cumsum(sizes)[:-1]))))
    name = f"lexicon-{uuid.uuid4().hex}.npy"  # Spark refuses a known name from another folder
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    np.save(path, array)
    docs.sparkSession.sparkContext.addFile(path)
    return name


#: The coders of this worker by lexicon file and pattern.
_CODERS: dict[tuple[str, str], Coder] = {}


class Tokenizer:
    """A vocabulary file, its split pattern and a lexicon compiled from the words of ``docs``."""

    def __init__(self, docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, most: int = LEXICON_WORDS):
        vocabulary = Vocabulary.load(path)
        self.pattern, self.lexicon = pattern, build_lexicon(docs, vocabulary, pattern, most)
        self.vocabulary = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def _coder(self):
        shared, name, pattern = self.vocabulary, self.lexicon, self.pattern

        def coder() -> Coder:
            if (name, pattern) not in _CODERS:
                if len(_CODERS) >= 4:
                    _CODERS.clear()
                _CODERS[name, pattern] = Coder(shared.value, Lexicon.mapped(SparkFiles.get(name)), pattern)
            return _CODERS[name, pattern]

        return coder

    def _coded(self, convert, returned: str):
        """A function of one column that comes back piece by piece."""
        coder = self._coder()

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                yield from convert(coder(), batch)

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        # Not deterministic to Spark: a filter on a result must not have it computed twice.
        return arrow_udf(run, returned).asNondeterministic()

    def encode(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``ids``, the tokens of ``text``."""
        ids = self._coded(_encoded, "array<int>")(text_of())
        return docs.select(*without(docs, "ids"), ids.alias("ids"))

    def decode(self, encoded: DataFrame) -> DataFrame:
        """``encoded`` with ``decoded``, the text that the tokens in ``ids`` stand for."""
        text = self._coded(_decoded, "string")(F.col("ids"))
        return encoded.select(*without(encoded, "decoded"), text.alias("decoded"))

    def round_trip(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``ids`` and what these decode to, ``decoded``, in one pass."""
        both = self._coded(_both, "ids array<int>, decoded string")(text_of())
        rows = docs.select(F.struct(*docs.columns).alias("row"), both.alias("coded"))
        return rows.select(*(f"row.{c}" for c in without(docs, "ids", "decoded")), "coded.ids", "coded.decoded")


def _lists(sizes: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum(np.append(0, sizes)), pa.int32()), pa.array(ids, pa.int32()))


def _encoded(coder: Coder, batch: pa.Array) -> Iterator[pa.Array]:
    for texts in _in_pieces(batch):
        yield _lists(*coder.encode(texts))


def _decoded(coder: Coder, batch: pa.Array) -> Iterator[pa.Array]:
    for at in range(0, len(batch), 1024):
        some = batch.slice(at, 1024)
        sizes = np.array([0 if x is None else x for x in some.value_lengths().to_pylist()], np.int64)
        ids = np.array([-1 if i is None else i for i in some.flatten().to_pylist()], np.int64)
        yield coder.decode(sizes, ids)


def _both(coder: Coder, batch: pa.Array) -> Iterator[pa.Array]:
    for texts in _in_pieces(batch):
        sizes, ids = coder.encode(texts)
        yield pa.StructArray.from_arrays([_lists(sizes, ids), coder.decode(sizes, ids)], ["ids", "decoded"])


def op12_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = Tokenizer(docs, public_tokenizers.path(VOCABULARY)).round_trip(docs)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        hex_sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        hex_sha256(F.col("decoded")).alias("decoded_sha256"),
    )
