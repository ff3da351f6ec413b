"""Exact duplicates by composable polynomial fingerprints, settled by comparing chunks.

The fingerprint of bytes b1 … bn is the polynomial b1·B^(n-1) + … + bn, modulo
two primes. Chunks are hashed apart and combined by length-shifted arithmetic,
H(xy) = H(x)·B^|y| + H(y), so a huge document's chunks can be hashed by many
tasks. Documents whose fingerprints and lengths are equal are then compared
chunk by chunk: for every chunk number of a group, the smallest and largest
chunk must be the same bytes. These extremes are combined before the shuffle,
so a group that owns a third of all rows sends one chunk pair per task. A
group that fails (a collision) is split by its whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import id_and_text, shuffle_width, slices
from tallyhouse.session import written

_BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
#: The same normal form in the JVM, for documents that are hashed by many tasks.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


class Scheme(NamedTuple):
    """How texts are cut and hashed.

    ``chunk`` bytes are hashed at once; a text of more than ``spread``
    characters is dealt out chunk by chunk; up to ``broadcast_rows`` duplicate
    documents (24 bytes each) are sent to the scan that fetches their texts,
    more of them are joined by a shuffle.
    """
    chunk: int = 1 << 16
    spread: int = 1 << 22
    primes: tuple[int, int] = ((1 << 31) - 1, (1 << 31) - 19)
    base: int = 1_000_003
    broadcast_rows: int = 1_000_000


def one_space(text: bytes) -> bytes:
    """The text with every run of ASCII white space replaced by one space."""
    kept = b" ".join(text.split())
    if not kept:
        return b" " if text else b""
    return (b" " if text[0] in _BLANKS else b"") + kept + (b" " if text[-1] in _BLANKS else b"")


class Polynomials:
    """Chunk hashes and their combination for one scheme."""

    def __init__(self, scheme: Scheme):
        self.scheme = scheme
        self.powers = []
        for prime in scheme.primes:
            powers = np.empty(scheme.chunk, np.uint64)
            value = 1
            for i in range(scheme.chunk):
                powers[scheme.chunk - 1 - i] = value
                value = value * scheme.base % prime
            self.powers.append(powers)

    def of_chunk(self, chunk: bytes) -> tuple[int, int]:
        """A product is below 2^39 and there are at most 2^16 of them, so sums fit 64 bits."""
        values = np.frombuffer(chunk, np.uint8).astype(np.uint64)
        first = self.scheme.chunk - len(values)
        return tuple(int(values @ powers[first:]) % prime
                     for powers, prime in zip(self.powers, self.scheme.primes))

    def combined(self, parts: Iterator[tuple[tuple[int, int], int]]) -> tuple[int, int, int]:
        """Both hashes and the length of the whole, from the hashes and lengths of its parts in order."""
        one = two = length = 0
        p, q = self.scheme.primes
        for (a, b), n in parts:
            one = (one * pow(self.scheme.base, n, p) + a) % p
            two = (two * pow(self.scheme.base, n, q) + b) % q
            length += n
        return one, two, length

    def of_text(self, text: bytes) -> tuple[int, int, int]:
        step = self.scheme.chunk
        cuts = (text[i:i + step] for i in range(0, len(text), step))
        return self.combined((self.of_chunk(cut), len(cut)) for cut in cuts)


_PRINT = "one long, two long, n_bytes long"
_PRINT_FIELDS = [("one", pa.int64()), ("two", pa.int64()), ("n_bytes", pa.int64())]


def _short_prints(docs: DataFrame, scheme: Scheme) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), *_PRINT_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomials = Polynomials(scheme)
        for batch in slices(batches):
            texts = list(map(one_space, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([sha256(text).hexdigest() for text in texts]),
                 *(pa.array(column, pa.int64()) for column in zip(*map(polynomials.of_text, texts)))],
                schema=schema)

    return docs.mapInArrow(run, f"doc_id long, text_sha256 string, {_PRINT}")


def _chunks(texts: DataFrame, scheme: Scheme) -> DataFrame:
    """Rows of ``texts`` (binary ``text``) as one row per chunk with its number."""
    size = F.lit(scheme.chunk)
    last = F.greatest(F.floor((F.octet_length("text") - 1) / size), F.lit(0)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("text"), i * size + 1, size))
    kept = [c for c in texts.columns if c != "text"]
    return texts.select(*kept, F.posexplode(cut).alias("number", "chunk"))


def _long_prints(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """Chunks of huge documents are dealt to all tasks and hashed there; rows with equal id and text are counted."""
    normal = F.regexp_replace("text", _RUNS, " ").cast("binary")
    marked = docs.select("doc_id", normal.alias("text")).withColumn("text_sha256", F.sha2("text", 256))
    dealt = _chunks(marked, scheme).repartition(shuffle_width(docs.sparkSession), "doc_id", "text_sha256", "number")
    names = [("doc_id", pa.int64()), ("text_sha256", pa.string()), ("number", pa.int32()), *_PRINT_FIELDS]

    def hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomials = Polynomials(scheme)
        for batch in slices(batches):
            chunks = batch.column("chunk").to_pylist()
            hashes = [(*polynomials.of_chunk(chunk), len(chunk)) for chunk in chunks]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("doc_id", "text_sha256", "number")),
                 *(pa.array(column, pa.int64()) for column in zip(*hashes))], schema=pa.schema(names))

    hashed = dealt.mapInArrow(hash_chunks, f"doc_id long, text_sha256 string, number int, {_PRINT}")
    once = hashed.groupBy("doc_id", "text_sha256", "number", "one", "two", "n_bytes").agg(
        F.count(F.lit(1)).alias("copies"))
    parts = once.groupBy("doc_id", "text_sha256", "copies").agg(
        F.sort_array(F.collect_list(F.struct("number", "one", "two", "n_bytes"))).alias("parts"))
    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("copies", pa.int64()), *_PRINT_FIELDS])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomials = Polynomials(scheme)
        for batch in slices(batches, 16):
            made = [polynomials.combined(((p["one"], p["two"]), p["n_bytes"]) for p in parts)
                    for parts in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("doc_id", "text_sha256", "copies")),
                 *(pa.array(column, pa.int64()) for column in zip(*made))], schema=schema)

    prints = parts.mapInArrow(combine, f"doc_id long, text_sha256 string, copies long, {_PRINT}")
    return prints.select("doc_id", "text_sha256", "one", "two", "n_bytes",
                         F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def fingerprints(docs: DataFrame, scheme: Scheme = Scheme(), id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """``doc_id``, fingerprint ``one``, ``two``, ``n_bytes`` and SHA-256 of every row's normalised text."""
    texts = id_and_text(docs, id_column, text_column)
    huge = F.length("text") > scheme.spread
    short = texts.where(~huge).select("doc_id", F.col("text").cast("binary").alias("text"))
    return _short_prints(short, scheme).unionByName(_long_prints(texts.where(huge), scheme))


def _members(docs: DataFrame, wanted: DataFrame, few: bool) -> DataFrame:
    """Normalised binary texts of the rows of ``wanted`` with its columns."""
    texts = docs.select("doc_id", F.regexp_replace("text", _RUNS, " ").cast("binary").alias("text"))
    side = F.broadcast(wanted) if few else wanted
    return texts.withColumnRenamed("doc_id", "member").join(side, F.col("member").eqNullSafe(F.col("doc_id")))


def exact_groups(docs: DataFrame, scheme: Scheme = Scheme(), id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after replacing each run of ASCII white
    space by one space; a null text is empty. ``keep_id`` is the smallest id of
    the group, nulls last. Rows that repeat an id with an equal text count in
    ``group_size``, and one of them is kept; rows that repeat an id with
    another text belong to that text's group. An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_column, text_column)
    rows = written(fingerprints(docs, scheme, id_column, text_column)
                   .groupBy("doc_id", "text_sha256", "one", "two", "n_bytes")
                   .agg(F.count(F.lit(1)).alias("copies")), "prints")
    key = ["one", "two", "n_bytes"]
    # Stored, so that the joins below shuffle both sides themselves and a large group's rows can be split.
    groups = written(rows.groupBy(*key).agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"),
                                            F.count(F.lit(1)).alias("documents")), "groups")
    shared = groups.where("documents > 1")
    wanted = written(rows.select("doc_id", *key).join(shared.select(*key), key), "suspects")
    few = wanted.count() <= scheme.broadcast_rows
    # A row may meet the prints of another text under its id; comparing lengths leaves that to chance no longer.
    cut = _chunks(_members(texts, wanted, few).where(F.octet_length("text") == F.col("n_bytes"))
                  .select(*key, "text"), scheme)
    failed = written(cut.groupBy(*key, "number").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
                     .where("low <> high").select(*key).distinct(), "collisions")
    placed = rows.join(groups.drop("documents"), key)
    if not failed.isEmpty():
        placed = _split(texts, rows, placed, failed, key)
    return placed.select(
        "doc_id", "keep_id", "group_size", "text_sha256",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def _split(texts: DataFrame, rows: DataFrame, placed: DataFrame, failed: DataFrame, key: list[str]) -> DataFrame:
    """Groups that hold different texts, grouped by the whole normalised texts instead."""
    doubtful = written(rows.join(failed, key, "left_semi").select("doc_id").distinct(), "doubtful")
    normal = _members(texts, doubtful, False).select(
        "doc_id", "text", F.sha2("text", 256).alias("text_sha256"))
    folded = normal.groupBy("text").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
                                        F.first("text_sha256").alias("text_sha256"))
    exact = written(folded.select("text_sha256", "keep_id", "group_size"), "regrouped")
    untouched = placed.join(failed, key, "left_anti")
    again = rows.join(failed, key, "left_semi").join(exact, "text_sha256")
    return untouched.unionByName(again.select(*untouched.columns))
