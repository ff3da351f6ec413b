"""Byte-level BPE with a queue of ranks in a hierarchical bitmap.

A pre-token is a linked list of byte positions. Every rank has a bucket with
the positions whose pair has that rank; a tree of 64-bit words says which
buckets hold something. Find-first-set from the top word gives the next rank,
the bucket its leftmost position. A merge only pushes the two new pairs: what
they replace stays behind as stale entries, which are recognised and skipped
when they come up. A pre-token of n bytes so takes O(n log n) steps at most,
whatever its length.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.common import id_and_text, slices
from tallyhouse.llm.tokens import GENERATION, Recent

#: A space beside white space: such a text is split by the pattern as a whole.
_SPACES_MEET = re.compile(r"\s | \s")
#: Letters with one mark at most; the pattern splits a space and such a word in this way.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)\Z")


class RankQueue:
    """Buckets of positions by rank under a hierarchical bitmap, for the lowest rank's leftmost position.

    ``low`` has a bit for each rank whose bucket holds something, in words of
    512 bits; ``middle`` is one such word with a bit for each word of ``low``
    that is not zero. Everything is empty between pre-tokens. Two levels serve
    262,144 ranks.
    """

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.low, self.middle = [0] * 512, [0]
        self.bit = [1 << i for i in range(512)]


class Ranks:
    """A rank file: bytes to rank and back."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.rank = {base64.b64decode(token): int(number) for token, number in map(bytes.split, file)}
        self.size = 1 + max(self.rank.values())
        if self.size > 1 << 18:
            raise ValueError("the rank queue has two levels, for 262,144 ranks")
        self.bytes = [b""] * self.size
        for token, number in self.rank.items():
            self.bytes[number] = token
        self.single = [self.rank[bytes([byte])] for byte in range(256)]
        self.pair = [self.rank.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self.queue = RankQueue()  # empty again after each pre-token

    @cached_property
    def tables(self) -> tuple[pa.Array, pa.Array]:
        """Every id's bytes; every id in decimal after a comma, and then without one."""
        decimal = list(map(str, range(self.size)))
        return pa.array(self.bytes, pa.large_binary()), pa.array([f",{d}" for d in decimal] + decimal, pa.large_string())

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        lookup = self.rank.get
        whole = lookup(piece)
        if whole is not None:
            return [whole]
        n, pairs = len(piece), self.pair
        after = list(range(1, n + 1))      # the next list position; n ends the list
        before = list(range(-1, n - 1))
        pair = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]  # rank of the pair that begins here, -1: none
        pair.append(-1)
        token = [self.single[byte] for byte in piece]
        # The queue's operations stand in line here: they are nearly all of the work.
        queue = self.queue
        buckets, low, bit, (top,) = queue.buckets, queue.low, queue.bit, queue.middle
        for at, number in enumerate(pair):
            if number >= 0:
                if number in buckets:
                    buckets[number].append(at)     # ascending, and so a heap
                else:
                    buckets[number] = [at]
                    word = number >> 9
                    top |= bit[word]
                    low[word] |= bit[number & 511]
        while top:
            word = (top & -top).bit_length() - 1   # pop: find first set, level by level
            bits = low[word]
            number = word << 9 | (bits & -bits).bit_length() - 1
            bucket = buckets[number]
            if len(bucket) > 1:
                at = heappop(bucket)
            else:
                at = bucket[0]
                del buckets[number]
                low[word] = bits = bits & bits - 1
                if not bits:
                    top &= top - 1
            if pair[at] != number:
                continue                   # stale
            gone = after[at]
            after[at] = follower = after[gone]
            token[at] = number
            pair[gone] = pair[at] = -1
            if follower < n:
                before[follower] = at
                found = lookup(piece[at:after[follower]])
                if found is not None:
                    pair[at] = found
                    if found in buckets:
                        heappush(buckets[found], at)
                    else:
                        buckets[found] = [at]
                        word = found >> 9
                        top |= bit[word]
                        low[word] |= bit[found & 511]
            left = before[at]
            if left >= 0:
                found = lookup(piece[left:follower])
                if found is None:
                    pair[left] = -1
                else:
                    pair[left] = found
                    if found in buckets:
                        heappush(buckets[found], left)
                    else:
                        buckets[found] = [left]
                        word = found >> 9
                        top |= bit[word]
                        low[word] |= bit[found & 511]
        ids, at = [], 0                    # nothing is left in the queue, its middle word is zero as before
        while at < n:
            ids.append(token[at])
            at = after[at]
        return ids


class _Pieces(Recent):
    def __init__(self, ranks: Ranks):
        super().__init__(350_000)  # a merge takes some 20 microseconds, a word of known pieces one
        self.merge = ranks.merge

    def make(self, piece: str) -> bytes:
        return array("I", self.merge(piece.encode())).tobytes()


class _SpacedWords(Recent):
    """Ids of a space and the word after it."""

    def __init__(self, pieces: _Pieces, split):
        super().__init__(GENERATION)
        self.pieces, self.split = pieces, split

    def make(self, word: str) -> bytes:
        plain = _PLAIN.match(word)
        if not plain:
            return b"".join(map(self.pieces.__getitem__, self.split(f" {word}")))
        letters, mark = plain.groups()
        return self.pieces[f" {letters}"] + self.pieces[mark] if mark else self.pieces[f" {letters}"]


class ByteBpe:
    """Encoder and decoder for one rank file and one splitting pattern."""

    def __init__(self, path: str, pattern: str):
        import regex
        self.ranks = Ranks(path)
        # White space as in the pattern's own engine: without the four separators U+001C to U+001F.
        self.split = regex.compile(pattern.replace(r"\S", r"[^\p{White_Space}]")
                                   .replace(r"[^\s", r"[^\p{White_Space}")
                                   .replace(r"\s", r"\p{White_Space}")).findall
        self.pieces = _Pieces(self.ranks)
        self.spaced = _SpacedWords(self.pieces, self.split)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers.

        A single space between two other characters always begins a new
        pre-token, so such texts are looked up word by word.
        """
        if _SPACES_MEET.search(text):
            return b"".join(map(self.pieces.__getitem__, self.split(text)))
        first, *rest = text.split(" ")
        head = b"".join(map(self.pieces.__getitem__, self.split(first)))
        return head + b"".join(map(self.spaced.__getitem__, rest))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.ranks.bytes.__getitem__, ids))

    def decode_all(self, ids: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """Of several texts, one after another from ``starts``: the bytes, and the ids in decimal with commas between.

        Each is a gather from a table whose result lies in memory as wanted;
        only the places where texts begin must be told.
        """
        held, decimal = self.ranks.tables
        listed = ids.astype(np.int64)
        full = starts[:-1][starts[:-1] < starts[1:]]
        listed[full] += self.ranks.size    # a text's first id has no comma before it
        return _cut(held.take(pa.array(ids)), starts, pa.binary()), _cut(decimal.take(pa.array(listed)), starts, pa.string())


def _cut(parts: pa.Array, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """``parts`` joined between each start and the next."""
    _, offsets, data = parts.buffers()
    ends = np.frombuffer(offsets, np.int64, len(parts) + 1)[starts]
    return pa.Array.from_buffers(kind, len(starts) - 1, [None, pa.py_buffer(ends.astype(np.int32)), data])


@lru_cache(maxsize=4)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """The worker's encoder."""
    return ByteBpe(path, pattern)


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id",
                     text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers) of every row.

    A null or empty text has no ids. Ids of documents may be null or repeated:
    each row is encoded on its own. No row moves between tasks.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(ranks, pattern)
        for batch in slices(batches):
            ids = list(map(encoder.encode, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], schema=schema)

    return id_and_text(docs, id_column, text_column).mapInArrow(run, "doc_id long, ids binary")


def _bounded(batch: pa.RecordBatch, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Stretches of the batch with about ``most`` ids at most, or single rows with more."""
    begin = held = 0
    for row, ids in enumerate(batch.column("ids")):
        size = len(ids.as_buffer()) // 4
        if row > begin and held + size > most:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += size
    yield batch.slice(begin)


def decode_documents(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes its ids stand for, and ``listing``, the ids in decimal."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("listing", pa.string()),
                        ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(ranks, pattern)
        for batch in slices(batches):
            for part in _bounded(batch):
                ids = part.column("ids").to_pylist()
                lengths = np.array([len(i) // 4 for i in ids], np.int64)
                starts = np.concatenate(([0], np.cumsum(lengths)))
                decoded, listing = coder.decode_all(np.frombuffer(b"".join(ids), "<u4"), starts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lengths), listing, decoded], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, listing string, decoded binary")
