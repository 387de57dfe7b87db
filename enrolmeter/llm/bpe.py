"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is halved down to leaves, each half is encoded, and neighbours are joined by encoding a
boundary window anew that grows until everything outside it provably stays. Two joins, one for
each level of the tokenizer:

*Pieces* (matches of the split pattern). A match depends only on the text from its start on, up
to ``AHEAD`` characters past its end (an apostrophe is decided by the two letters after it). So
in the left half every match that ends so far before the end of the half is final. The window
is the matches after those and a growing number of the right half's matches, matched anew; once
a final match of the window stops where a match of the right half starts, all later matches of
the right half are final too.

*Tokens within a piece*. A sequence of tokens is the encoding of its bytes if and only if each
adjacent pair is the encoding of its own bytes: merges run by (rank, position), so before the
first merge across any token boundary the two tokens beside it have gone through the very
states they go through as a pair alone, and that merge would happen there too. Inside an
encoding all pairs hold; so a join needs to grow its window only until the two pairs at its
edges hold.

A piece of at most ``LEAF_BYTES`` bytes is a leaf. The leaves that a batch brings for the first time are
merged together, one merge of each in a round.

Decoding concatenates the tokens' bytes up a tree in the same way.

Both run on Arrow batches in tasks, one text after the other, with no shuffle. The ranks (some
50,000 entries, one vocabulary file) are the only broadcast. A worker keeps the codes of frequent
pieces in a cache of bounded size between batches.

Defined cases: null text is empty text and has no tokens; repeated rows are encoded alike;
null ids decode to no bytes; other columns come back as they are.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import hex_sha256, table, text_of, without

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: How far past its end a match of the pattern may look.
AHEAD = 2
LEAF_CHARS = 2048
#: Pieces up to this many bytes are merged outright; beyond a short piece is long.
LEAF_BYTES = 16
SHORT_BYTES = 48
#: Pieces whose codes a worker keeps, and halves and pairs of tokens, of which few come back that often.
CACHED, CACHED_PARTS = 200_000, 50_000
#: New leaves that are merged together, at most and at least.
TOGETHER, FEW = 2048, 32
#: Characters or ids that come back to Spark at once.
PIECE = 1 << 19


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file (base64 and number per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Recent(dict):
    """What was used last: of ``size`` entries, and as many that were used before those."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.older = size, {}

    def find(self, key):
        """The value, None without one. A value in use comes back among the last."""
        value = self.get(key)
        if value is None:
            value = self.older.get(key)
            if value is not None:
                self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value


class Codec:
    """Encodes and decodes with one vocabulary and one split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.none = 1 + max(ranks.values(), default=0)  # the rank of what does not merge
        self.of_byte = [ranks.get(bytes([b])) for b in range(256)]
        # left * none + right: the rank, and so the id, of the token that two tokens make.
        self.made = {
            left * self.none + right: rank
            for token, rank in ranks.items()
            for at in range(1, len(token))
            if (left := ranks.get(token[:at])) is not None and (right := ranks.get(token[at:])) is not None
        }
        # The same as sorted arrays, whose last entry is that of no pair, and for bytes as a table.
        self.made_keys = np.array([*sorted(self.made), np.iinfo(np.int64).max], np.int64)
        self.made_ranks = np.array([*map(self.made.get, self.made_keys[:-1].tolist()), self.none], np.int32)
        if None not in self.of_byte:
            self.byte_ids = np.array(self.of_byte, np.int32)
            self.byte_ranks = self._ranks_of(self.byte_ids[:, None], self.byte_ids)
        self.codes, self.leaves, self.pairs = Recent(CACHED), Recent(CACHED_PARTS), Recent(CACHED_PARTS)

    # --- tokens within a piece ------------------------------------------------------------

    def merge(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost of equals, until no neighbours merge."""
        if len(piece) > SHORT_BYTES:
            return self._merge_long(piece)
        known, none = self.made.get, self.none
        ids = [self.of_byte[b] for b in piece]
        near = [known(a * none + b, none) for a, b in zip(ids, ids[1:])]
        while near:
            low = min(near)
            if low == none:
                break
            i = near.index(low)
            ids[i] = low
            del ids[i + 1], near[i]
            if i:
                near[i - 1] = known(ids[i - 1] * none + low, none)
            if i < len(near):
                near[i] = known(low * none + ids[i + 1], none)
        return ids

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.none + right
        at = np.searchsorted(self.made_keys, keys)
        return np.where(self.made_keys[at] == keys, self.made_ranks[at], np.int32(self.none))

    def merge_together(self, pieces: list[bytes]) -> list[bytes]:
        """``merge`` of each of some short pieces, as int32 in a row: in each round all that still merge do so once.

        A piece is a column; its place i holds a token and the rank of this one with the next.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(lengths.max(initial=1))
        every = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8)
        every = every.reshape(-1, width).T
        places = np.arange(width)[:, None]
        done, ids = np.zeros((len(pieces), width), np.int32), self.byte_ids[every]
        ranks = np.full(ids.shape, self.none, np.int32)
        ranks[:-1] = self.byte_ranks[every[:-1], every[1:]]
        ranks[places >= lengths - 1] = self.none
        columns, sizes = np.arange(len(pieces)), lengths.copy()
        while True:
            best = ranks.argmin(axis=0)
            low = ranks[best, np.arange(len(columns))]
            goes = low < self.none
            if not goes.all():
                done[columns[~goes]] = ids[:, ~goes].T
                columns, ids, ranks, best, low = columns[goes], ids[:, goes], ranks[:, goes], best[goes], low[goes]
            if not len(columns):
                data = done[np.arange(width) < sizes[:, None]].tobytes()
                stops = (4 * np.cumsum(sizes)).tolist()
                return [data[start:stop] for start, stop in zip([0, *stops], stops)]
            sizes[columns] -= 1
            # The right one of the pair goes; all after it move up by one place.
            after = places[:-1] > best
            np.copyto(ids[:-1], ids[1:], where=after)
            np.copyto(ranks[:-1], ranks[1:], where=after)
            ranks[-1] = self.none
            column = np.arange(len(columns))
            ids[best, column] = low
            ranks[best, column] = self.none
            for near, there in ((best - 1, best > 0), (best, best + 1 < sizes[columns])):
                place, where = near[there], column[there]
                ranks[place, where] = self._ranks_of(ids[place, where], ids[place + 1, where])

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap over linked parts, for windows that have grown."""
        n, ranks = len(piece), self.ranks
        end = list(range(1, n + 1))  # of the part that starts here; 0 once merged away
        before = list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(start: int) -> None:
            middle = end[start]
            if middle < n:
                rank = ranks.get(piece[start : end[middle]])
                if rank is not None:
                    heapq.heappush(heap, (rank, start, end[middle]))

        for start in range(n):
            offer(start)
        while heap:
            _, start, stop = heapq.heappop(heap)
            middle = end[start]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the two has been merged since
            end[start], end[middle] = stop, 0
            if stop < n:
                before[stop] = start
            offer(start)
            if before[start] >= 0:
                offer(before[start])
        out, at = [], 0
        while at < n:
            out.append(ranks[piece[at : end[at]]])
            at = end[at]
        return out

    def pair(self, left: int, right: int) -> list[int]:
        """The encoding of two tokens' bytes: the two themselves where they are stable."""
        key = left * self.none + right
        known = self.pairs.find(key)
        if known is None:
            known = self.merge(self.bytes_of[left] + self.bytes_of[right])
            self.pairs.keep(key, known)
        return known

    def stable(self, left: int, right: int) -> bool:
        code = self.pairs.get(left * self.none + right) or self.pair(left, right)
        return len(code) == 2 and code[0] == left

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded neighbours of one piece."""
        if not left or not right:
            return left + right
        a = b = 1
        window = self.pairs.get(left[-1] * self.none + right[0]) or self.pair(left[-1], right[0])
        if len(window) == 2 and window[0] == left[-1]:
            return left + right  # and the pairs at its edges are those of the two encodings
        while True:
            left_holds = a >= len(left) or self.stable(left[-a - 1], window[0])
            right_holds = b >= len(right) or self.stable(window[-1], right[b])
            if left_holds and right_holds:
                return left[:-a] + window + right[b:]
            if not left_holds:
                a = min(2 * a, len(left))
            if not right_holds:
                b = min(2 * b, len(right))
            window = self.merge(self.decode(left[-a:]) + self.decode(right[:b]))

    def tree(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF_BYTES:
            code = self.leaves.find(piece)
            if code is None:
                code = self.merge(piece)
                self.leaves.keep(piece, code)
            return code
        half = len(piece) // 2
        left, right, leaf = piece[:half], piece[half:], self.leaves.get
        return self.join(leaf(left) or self.tree(left), leaf(right) or self.tree(right))

    def piece(self, text: str) -> bytes:
        """The tokens of a piece, as int32 in a row."""
        return self.codes.find(text) or self.new_piece(text)

    def new_piece(self, text: str) -> bytes:
        code = array("i", self.tree(text.encode())).tobytes()
        if len(text) <= SHORT_BYTES:
            self.codes.keep(text, code)
        return code

    def known(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """The tokens of each piece. New ones that are a leaf each are merged together if they are many."""
        get = self.codes.get
        codes = {p: get(p) for p in pieces}
        leaves = []
        for p in [p for p, code in codes.items() if code is None]:
            codes[p] = self.codes.find(p)
            if codes[p] is None:
                piece = p.encode()
                if len(piece) <= LEAF_BYTES:
                    leaves.append((len(piece), piece, p))
                else:
                    codes[p] = self.new_piece(p)
        leaves.sort()
        for at in range(0, len(leaves), TOGETHER):
            some = leaves[at : at + TOGETHER]
            if len(some) < FEW or None in self.of_byte:
                codes.update((p, self.new_piece(p)) for _, _, p in some)
                continue
            for (_, _, p), code in zip(some, self.merge_together([piece for _, piece, _ in some])):
                codes[p] = code
                self.codes.keep(p, code)
        return codes

    # --- pieces of a text -----------------------------------------------------------------

    def cut(self, text: str) -> list[list[str]]:
        """The pieces of each leaf of the text's tree."""
        if len(text) <= LEAF_CHARS:
            return [self.split(text)]
        half = len(text) // 2
        return self.cut(text[:half]) + self.cut(text[half:])

    def joined(self, length: int, leaves: Iterator[list[str]], known: dict[str, bytes]):
        """The pieces, and the tokens of each, of a text of that length, whose leaves come in a row."""
        if length <= LEAF_CHARS:
            found = next(leaves)
            return found, list(map(known.__getitem__, found))
        half = length // 2
        left = self.joined(half, leaves, known)
        return self.join_pieces(left, self.joined(length - half, leaves, known))

    def join_pieces(self, left, right):
        (pieces, codes), (after, after_codes) = left, right
        if not pieces or not after:
            return pieces + after, codes + after_codes
        unsure, reach = len(pieces), 0
        while unsure and reach < AHEAD:
            unsure -= 1
            reach += len(pieces[unsure])
        open_pieces, open_codes = pieces[unsure:], codes[unsure:]
        taken = 1
        while True:
            whole = taken >= len(after)
            window = "".join(open_pieces) + "".join(after[:taken])
            sure = len(window) if whole else len(window) - AHEAD
            starts, at = {reach: 0}, reach  # where right pieces start: how many come before
            for number, piece in enumerate(after[:taken], 1):
                at += len(piece)
                starts[at] = number
            new, at = [], 0
            for piece in self.split(window):
                at += len(piece)
                if at > sure:
                    break
                new.append(piece)
                if at in starts:
                    rest = starts[at]
                    parts = open_pieces + after[:rest], open_codes + after_codes[:rest]
                    new_codes = [self._grown(new[0], *parts), *map(self.piece, new[1:])]
                    return (
                        pieces[:unsure] + new + after[rest:],
                        codes[:unsure] + new_codes + after_codes[rest:],
                    )
            taken *= 2

    def _grown(self, piece: str, parts: list[str], codes: list[bytes]) -> bytes:
        """Tokens of a long piece made of the first whole parts: those joined, else anew."""
        if len(piece) <= SHORT_BYTES:
            return self.piece(piece)
        length, code = 0, []
        for part, more in zip(parts, codes):
            length += len(part)
            code = self.join(code, array("i", more).tolist())
            if length >= len(piece):
                break
        return array("i", code).tobytes() if length == len(piece) else self.piece(piece)

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The tokens of each text."""
        cuts = [self.cut(text) for text in texts]
        known = self.known(dict.fromkeys(chain.from_iterable(chain.from_iterable(cuts))))
        for text, leaves in zip(texts, cuts):
            yield np.frombuffer(b"".join(self.joined(len(text), iter(leaves), known)[1]), np.int32)

    def encode(self, text: str) -> list[int]:
        (ids,) = self.encode_all([text])
        return ids.tolist()

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_CHARS:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


#: The codecs of this worker, with their caches, by vocabulary file and pattern.
_CODECS: dict[tuple[str, str], Codec] = {}


def _codec(name: str, ranks, pattern: str) -> Codec:
    if (name, pattern) not in _CODECS:
        _CODECS[name, pattern] = Codec(ranks.value, pattern)
    return _CODECS[name, pattern]


def _ranks(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(load_ranks(path))


def _coded(ranks, path: str, pattern: str, convert, returned: str):
    """A function of one column that comes back in pieces: no other column goes to Python."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path, ranks, pattern)
        for batch in batches:
            yield from convert(codec, batch)
            # Arrow's pool would keep what the batch took until the worker ends.
            pa.default_memory_pool().release_unused()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Not deterministic to Spark: a filter on a result must not have it computed twice.
    return arrow_udf(run, returned).asNondeterministic()


def _pieces(sizes: Iterator[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with some PIECE characters or ids together."""
    start, size, stop = 0, 0, 0
    for stop, more in enumerate(sizes, 1):
        size += more
        if size >= PIECE:
            yield start, stop
            start, size = stop, 0
    if stop > start:
        yield start, stop


def _encoded(codec: Codec, texts: pa.Array) -> Iterator[pa.Array]:
    sizes = pc.binary_length(texts).to_pylist()
    for start, stop in _pieces(iter(sizes)):
        some = texts.slice(start, stop - start).to_pylist()
        lists = list(codec.encode_all(some))
        offsets = np.cumsum([0, *map(len, lists)])
        yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(lists)))


def _decoded(codec: Codec, ids: pa.Array) -> Iterator[pa.Array]:
    sizes = pc.list_value_length(ids).fill_null(0).to_pylist()
    for start, stop in _pieces(iter(sizes)):
        some = ids.slice(start, stop - start)
        flat = some.flatten().to_numpy(zero_copy_only=False)
        stops = np.cumsum([0, *sizes[start:stop]])
        yield pa.array([codec.decode(flat[a:b].tolist()) for a, b in zip(stops, stops[1:])], pa.binary())


def _both(codec: Codec, texts: pa.Array) -> Iterator[pa.Array]:
    for ids in _encoded(codec, texts):
        decoded = pa.concat_arrays(list(_decoded(codec, ids)))
        yield pa.StructArray.from_arrays([ids, decoded], ["ids", "decoded"])


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with ``ids``, the tokens of ``text`` by the rank file at ``path``."""
    code = _coded(_ranks(docs.sparkSession, path), path, pattern, _encoded, "array<int>")
    return docs.select(*without(docs, "ids"), code(text_of()).alias("ids"))


def decode(encoded: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes that the tokens in ``ids`` stand for."""
    code = _coded(_ranks(encoded.sparkSession, path), path, pattern, _decoded, "binary")
    return encoded.select(*without(encoded, "decoded"), code(F.col("ids")).alias("decoded"))


def round_trip(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with ``ids`` and what these decode to, ``decoded``, by one worker and in one pass."""
    code = _coded(_ranks(docs.sparkSession, path), path, pattern, _both, "ids array<int>, decoded binary")
    rows = docs.select(F.struct(*docs.columns).alias("row"), code(text_of()).alias("coded"))
    return rows.select(*(f"row.{c}" for c in without(docs, "ids", "decoded")), "coded.ids", "coded.decoded")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = round_trip(docs, path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        hex_sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
