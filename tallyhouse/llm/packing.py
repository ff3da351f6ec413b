"""Packing by lexical retrieval: a sharded BM25 index finds unused neighbours that fill a seed's window.

Documents are encoded once and cut into segments, so no row is unbounded.
Segments are ordered by three min-hashes of the few terms that weigh most in
them by BM25, with frequencies of all segments, which brings documents with
rare terms in common together, and cut into shards of about ``shard_tokens``
tokens; equal hashes are told apart by the document, so a crowd of copies is
spread over shards as well. Each shard is one task: an inverted index over its
segments, with term weights from document frequencies of the whole corpus,
gives for the seed's heaviest terms the best segments not yet used. Those that
fit go in whole; when none of the next ones fits, the best is cut and its rest
is the next seed. Only a shard's last window is padded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import id_and_text, slices
from tallyhouse.llm.tokens import word_ids
from tallyhouse.session import written


class Packing(NamedTuple):
    """``window`` tokens a sequence; segments of ``segment`` tokens; ``terms`` of a seed asked for;
    ``tries`` neighbours looked at before one is cut; ``k1`` and ``b`` of BM25; ``words`` whose ids a worker
    keeps, in each of two generations (some 150 bytes a word); segments are placed by ``marking`` terms each."""
    window: int = 4096
    shard_tokens: int = 1 << 20
    segment: int = 1 << 16
    terms: int = 24
    tries: int = 32
    k1: float = 1.2
    b: float = 0.75
    words: int = 500_000
    marking: int = 8


def _by_weight(groups: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Order by group, then falling weight, then place: one sort of a number whose fraction falls as the weight grows."""
    most = weights.max(initial=0.0) + 1.0
    return np.argsort(groups + (most - weights) / (2 * most), kind="stable")


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(31)
    return values * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)


def _held(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which segment holds which terms how often, by segment, then term."""
    pairs = np.repeat(np.arange(len(parts)) << 32, list(map(len, parts))) | np.concatenate(parts)
    pairs.sort()
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
    tf, pairs = np.diff(first, append=len(pairs)), pairs[first]
    return pairs >> 32, pairs & 0xFFFFFFFF, tf


class Places:
    """Where segments go: by terms' weights in the whole corpus, three orders of the vocabulary and the document's mark."""

    def __init__(self, frequencies: dict[int, int], n: int, mean_length: float, vocabulary: int, plan: Packing):
        self.plan, self.mean_length = plan, max(mean_length, 1.0)
        self.idf = np.zeros(vocabulary)
        for term, count in frequencies.items():
            if count > 1:          # a term of one segment brings nothing together
                self.idf[term] = math.log(1 + (n - count + 0.5) / (count + 0.5))
        draw = np.random.default_rng(17)
        # 16 bits each, so that three and the mark make one number.
        self.ranks = [draw.permutation(vocabulary) * min(1 << 16, vocabulary) // vocabulary for _ in range(3)]

    def of(self, parts: list[np.ndarray], marks: np.ndarray) -> np.ndarray:
        """Places of several segments."""
        plan, n = self.plan, len(parts)
        lengths = np.array(list(map(len, parts)))
        owner, terms, tf = _held(parts)
        norm = plan.k1 * (1 - plan.b + plan.b * lengths / self.mean_length)
        weights = self.idf[terms] * tf / (tf + norm[owner])
        # Of each segment's terms the heaviest; those that weigh nothing only where no other is left.
        order = _by_weight(owner, weights)
        rank = np.arange(len(order)) - np.searchsorted(owner, np.arange(n))[owner]
        heaviest = order[rank < plan.marking]
        weigh = weights[heaviest] > 0
        some = np.bincount(owner[heaviest], weigh, n) > 0
        heaviest = heaviest[weigh | ~some[owner[heaviest]]]
        begin = np.searchsorted(owner[heaviest], np.arange(n))
        place = np.zeros(n, np.int64)
        for ranks in self.ranks:
            place = place << 16 | np.minimum.reduceat(ranks[terms[heaviest]], begin)
        return place << 15 | marks & 0x7FFF


#: Rows of ``_encoded`` with so many tokens are no segments: they tell how many of a task's segments hold each term.
COUNTS = -1


def _encoded(docs: DataFrame, tokenizer: str, end_id: int, plan: Packing) -> DataFrame:
    """Segments with the ``mark`` of their id and start; rows without an id get one of their own each.

    A task's last row holds the frequencies of terms in its segments as
    ``ids`` (64 bits for each term).
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("doc_tokens", pa.int64()),
                        ("n_tokens", pa.int64()), ("mark", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer, plan.words)
        end = np.array([end_id], encoder.dtype).tobytes()
        size = encoder.dtype.itemsize
        frequencies = np.zeros(max(encoder.tokenizer.get_vocab_size(), end_id + 1), np.int64)
        unnamed = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            rows, marks = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encoder.encode(text) + end
                total = len(ids) // size
                for start in range(0, total, plan.segment):
                    part = ids[start * size:(start + plan.segment) * size]
                    rows.append((doc_id, start, total, len(part) // size, part))
                    unnamed += doc_id is None
                    marks.append(unnamed if doc_id is None else doc_id * 31 + start & (1 << 63) - 1)
            frequencies += np.bincount(_held([np.frombuffer(row[-1], encoder.dtype) for row in rows])[1], minlength=len(frequencies))
            *columns, parts = zip(*rows)
            found = _mixed(np.array(marks, np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((*columns, found, parts), schema)], schema=schema)
        row = (None, 0, 0, COUNTS, 0, frequencies.astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    return id_and_text(docs).mapInArrow(
        run, "doc_id long, start long, doc_tokens long, n_tokens long, mark long, ids binary")


def _frequencies(counts: DataFrame) -> dict[int, int]:
    """Segments that hold each term, from the tasks' own counts; as many entries as the vocabulary has at most."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            totals = sum(np.frombuffer(ids, "<i8") for ids in batch.column("ids").to_pylist())
            some = np.flatnonzero(totals)
            yield pa.RecordBatch.from_pydict({"term": pa.array(some, pa.int64()), "n": pa.array(totals[some], pa.int64())})

    counted = counts.select("ids").mapInArrow(listed, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {row.term: row.n for row in counted.collect()}


def _told(made: DataFrame) -> tuple[dict[int, int], int, int]:
    """Frequencies, number and tokens of all segments of a stored ``_encoded``."""
    size = made.where(F.col("n_tokens") != COUNTS).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens")).first()
    return _frequencies(made.where(F.col("n_tokens") == COUNTS)), size.n, size.tokens


def _placed(made: DataFrame, tokenizer: str, end_id: int, plan: Packing, told: tuple[dict[int, int], int, float]) -> DataFrame:
    """The segments of ``_encoded`` with their ``place``; ``told``: frequencies, number and mean length of all segments."""
    columns = ["doc_id", "start", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer, plan.words)
        places = Places(*told, max(encoder.tokenizer.get_vocab_size(), end_id + 1), plan)
        for batch in slices(batches):
            parts = [np.frombuffer(ids, encoder.dtype) for ids in batch.column("ids").to_pylist()]
            found = places.of(parts, batch.column("mark").to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(found), batch.column("ids")],
                                             names=[*columns, "place", "ids"])

    return (made.where(F.col("n_tokens") != COUNTS).select(*columns, "mark", "ids")
            .mapInArrow(run, "doc_id long, start long, doc_tokens long, place long, ids binary"))


def _sampled(docs: DataFrame, tokenizer: str, end_id: int, plan: Packing) -> tuple[dict[int, int], int, float]:
    """Frequencies, number and mean length of the segments of ``docs``, all of them: for trials of places alone."""
    frequencies, n, tokens = _told(written(_encoded(docs, tokenizer, end_id, plan), "segments"))
    return frequencies, n, tokens / max(n, 1)


def _segments(docs: DataFrame, tokenizer: str, end_id: int, plan: Packing, told: tuple[dict[int, int], int, float]) -> DataFrame:
    """Placed segments of ``docs`` with what ``_sampled`` told: for trials of places alone."""
    return _placed(_encoded(docs, tokenizer, end_id, plan), tokenizer, end_id, plan, told)


class ShardIndex:
    """Inverted BM25 index over one shard's segments; the weights use the whole corpus's statistics."""

    def __init__(self, segments: list[np.ndarray], idf: np.ndarray, mean_length: float, plan: Packing):
        self.n, self.terms = len(segments), plan.terms
        lengths = np.array(list(map(len, segments)))
        owner = np.repeat(np.arange(self.n), lengths)
        pairs, tf = np.unique(np.concatenate(segments).astype(np.int64) * self.n + owner, return_counts=True)
        term, self.docs = pairs // self.n, pairs % self.n
        norm = plan.k1 * (1 - plan.b + plan.b * lengths / mean_length)
        self.weights = idf[term] * tf * (plan.k1 + 1) / (tf + norm[self.docs])
        self.first = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
        self.known = term[self.first]
        self.last = np.append(self.first[1:], len(term))
        # Each segment's heaviest terms that other segments of the shard have too.
        held = self.last - self.first
        position = np.repeat(np.arange(len(held)), held)
        shared = np.flatnonzero(np.repeat(held > 1, held))
        by_doc = shared[_by_weight(self.docs[shared], self.weights[shared])]
        starts = np.searchsorted(self.docs[by_doc], np.arange(self.n + 1))
        self.heavy = [position[by_doc[a:min(b, a + plan.terms)]] for a, b in zip(starts[:-1], starts[1:])]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every segment for the seed's heaviest terms."""
        found = np.zeros(self.n)
        for at in self.heavy[seed]:
            entries = slice(self.first[at], self.last[at])
            found[self.docs[entries]] += self.weights[entries]
        return found


def pack_shard(segments: list[np.ndarray], index: ShardIndex, plan: Packing) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces as (sequence, offset, segment, start in it, length), every token of every segment once."""
    unused = np.ones(len(segments), bool)
    lengths = np.array(list(map(len, segments)))
    sequence = offset = 0
    following = 0              # no unused segment comes before this one
    rest: tuple[int, int] | None = None
    while True:
        if rest is None:
            while following < len(segments) and not unused[following]:
                following += 1
            if following == len(segments):
                return
            seed, start = following, 0
            unused[seed] = False
        else:
            (seed, start), rest = rest, None
        room = plan.window - offset
        length = min(room, int(lengths[seed]) - start)
        yield sequence, offset, seed, start, length
        offset += length
        if offset == plan.window:
            sequence, offset = sequence + 1, 0
            if start + length < lengths[seed]:
                rest = seed, start + length
            continue
        scores = index.scores(seed)
        scores[~unused] = -1
        order = np.argsort(-scores, kind="stable")[:int(unused.sum())]
        at = 0
        while offset < plan.window and at < len(order):
            near = order[at:at + plan.tries]
            near = near[unused[near]]
            room = plan.window - offset
            fits = near[lengths[near] <= room]
            if len(fits):
                chosen, length = int(fits[0]), int(lengths[fits[0]])
            elif len(near):
                chosen, length = int(near[0]), room
                rest = chosen, room
            else:
                at += plan.tries
                continue
            unused[chosen] = False
            yield sequence, offset, chosen, 0, length
            offset += length
        if offset == plan.window:
            sequence, offset = sequence + 1, 0


_PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def packed(docs: DataFrame, tokenizer: str, end_id: int, plan: Packing = Packing()) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset and ``ids``.

    ``ids`` are the piece's tokens as little-endian unsigned 32-bit integers;
    ``start`` counts from the document's first token; pieces of a sequence are
    gapless from offset 0. Every document ends with ``end_id``; a null or empty
    text is that id alone. Null and repeated ids are documents of their own,
    packed like others. An empty table gives no rows. A sequence's number is
    its shard's number times 2^32 plus its own.
    """
    spark = docs.sparkSession
    made = written(_encoded(docs, tokenizer, end_id, plan), "segments")
    frequencies, n_segments, tokens = _told(made)
    mean_length = tokens / max(n_segments, 1)
    segments = _placed(made, tokenizer, end_id, plan, (frequencies, n_segments, mean_length))
    dtype = word_ids(tokenizer, plan.words).dtype.str
    idf = np.zeros(max(frequencies, default=0) + 1)
    for term, n in frequencies.items():
        idf[term] = math.log(1 + (n_segments - n + 0.5) / (n + 0.5))
    shared = spark.sparkContext.broadcast((idf, mean_length))
    schema = pa.schema([*((c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")),
                        ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in (
            "place", "doc_id", "start", "doc_tokens", "ids")))), key=lambda row: (row[0], row[2], row[1] or 0))
        if not rows:
            return
        idf, mean_length = shared.value
        ids = [np.frombuffer(row[4], dtype) for row in rows]
        shard = TaskContext.get().partitionId() << 32
        pieces = []
        for sequence, offset, at, start, length in pack_shard(ids, ShardIndex(ids, idf, mean_length, plan), plan):
            _, doc_id, before, doc_tokens, _ = rows[at]
            pieces.append((doc_id, before + start, length, doc_tokens, shard + sequence, offset,
                           ids[at][start:start + length].astype("<u4").tobytes()))
        for first in range(0, len(pieces), 1024):
            columns = zip(*pieces[first:first + 1024])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    shards = max(1, math.ceil(tokens / plan.shard_tokens))
    return segments.repartitionByRange(shards, "place").mapInArrow(run, _PIECE)
