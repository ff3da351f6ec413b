"""SimHash fingerprints and near duplicates by a byte-position index with count filtering.

Two 64-bit fingerprints with at most two differing bits agree in at least six
of their eight bytes. Posting lists of single bytes hold a 256th of all
fingerprints each, so their pairs grow with the square of the corpus. The
index is therefore keyed by several positions at once: the eight positions are
dealt into ``groups`` groups, and a posting list belongs to the bytes of all
groups but two. Two differing bytes lie in two groups at most, so every pair
sought meets in one list. Per pair in a list the shared positional bytes are
tallied, pairs below the guaranteed minimum of six go, the rest is verified
bit by bit.

A list of more than ``longest`` fingerprints is not paired up. Its members
are listed again under each value that one flip of a free bit gives, and
under their own: two fingerprints at distance one or two meet in one of these
lists (the one between them), no list has more than 33 members (with four
groups), and a member has 33 entries however long the list was.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.common import components, id_and_text, local_roots, slices
from tallyhouse.session import written

SHINGLE, SEED, DISTANCE = 3, 42, 2
_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_BLOCK = 1 << 20


def _word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The lower-case words, about a megabyte of text at a time."""
    text = text.translate(_LOWER)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + _BLOCK)
        end = len(text) if end < 0 else end
        if words := text[at:end].split():
            yield words
        at = end


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over shingles of words, repeats included; as a signed integer."""
    import xxhash
    votes, total = np.zeros(64, np.int64), 0
    hashed = xxhash.xxh64_intdigest

    def count(shingles: Iterator[bytes]) -> int:
        values = np.fromiter(map(hashed, shingles, repeat(SEED)), np.uint64)
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes[:] += bits.sum(axis=0, dtype=np.int64)
        return len(values)

    carried: list[bytes] = []
    for words in _word_blocks(text):
        words = carried + words
        if len(words) >= shingle:
            total += count(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
            carried = words[len(words) - shingle + 1:]
        else:
            carried = words
    if not total and carried:
        total = count([b" ".join(carried)])
    return int(np.packbits(2 * votes > total, bitorder="little").view("<i8")[0]) if total else 0


def mark_of(text_column: str) -> Column:
    """Tells rows apart that share an id: a hash of the text, null as empty."""
    return F.xxhash64(F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """``doc_id``, ``mark`` and ``print``, the signed 64-bit fingerprint, of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("print", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = [fingerprint(text, shingle) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(prints, pa.int64())],
                                             schema=schema)

    texts = id_and_text(docs, id_column, text_column, binary=True).withColumn("mark", mark_of("text"))
    return texts.mapInArrow(run, "doc_id long, mark long, print long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def position_masks(groups: int) -> list[int]:
    """For each choice of all groups but two, the bits of their bytes."""
    width = 8 // groups
    parts = [((1 << 8 * width) - 1) << 8 * width * g for g in range(groups)]
    return [sum(chosen) for chosen in combinations(parts, groups - 2)]


def verified_links(prints: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of one list that share at least six positional bytes and differ in at most two bits."""
    unsigned = prints.view(np.uint64)
    bytewise = unsigned.view(np.uint8).reshape(-1, 8)
    left, right = np.triu_indices(len(prints), 1)
    tally = (bytewise[left] == bytewise[right]).sum(axis=1)
    enough = tally >= 8 - DISTANCE
    left, right = left[enough], right[enough]
    close = np.bitwise_count(unsigned[left] ^ unsigned[right]) <= DISTANCE
    return zip(prints[left[close]].tolist(), prints[right[close]].tolist())


def _list_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each list's links, cut down to one link per member and connected part."""
    for batch in slices(batches, 1024):
        u, v = [], []
        for prints in batch.column("prints"):
            for node, root in local_roots(verified_links(np.array(prints.values, np.int64))).items():
                if node != root:
                    u.append(node)
                    v.append(root)
        yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def linked(prints: DataFrame, groups: int = 4, longest: int = 64) -> DataFrame:
    """``u`` and ``v``: links that connect the distinct values of ``prints.print`` as all links would.

    ``groups`` is 4 (keys of 32 bits) or, for several thousand million
    fingerprints, 8 (keys of 48 bits).
    """
    masks = [_signed(mask) for mask in position_masks(groups)]
    free = [[_signed(1 << bit) for bit in range(64) if not (mask >> bit) & 1] for mask in position_masks(groups)]
    value = F.col("print")
    postings = prints.select(value, F.posexplode(F.array(
        *(value.bitwiseAND(F.lit(mask)) for mask in masks))).alias("choice", "key"))
    counted = (postings.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("members"))
               .where("members > 1"))
    met = postings.join(counted, ["choice", "key"])
    flips: Column = F.array(*(F.array(F.lit(0).cast("long"), *(F.lit(bit).cast("long") for bit in bits)) for bits in free))
    # In a short list all members share one entry, marked by null; in a long one they meet between each two.
    between = F.when(F.col("members") > longest,
                     F.transform(F.get(flips, F.col("choice")), lambda bit: value.bitwiseXOR(bit)))
    entries = met.select(value, "choice", "key", F.explode(
        F.coalesce(between, F.array(F.lit(None).cast("long")))).alias("middle"))
    lists = (entries.groupBy(F.struct("choice", "key", "middle").alias("list"))
             .agg(F.collect_list("print").alias("prints")).where(F.size("prints") > 1))
    return lists.select("prints").mapInArrow(_list_links, "u long, v long").distinct()


def near_groups(docs: DataFrame, shingle: int = SHINGLE, groups: int = 4, longest: int = 64,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``mark``, ``print`` and ``component_id``.

    Documents are linked when their fingerprints differ in at most two bits;
    ``component_id`` is the smallest id reachable, nulls last. Texts without
    words (null, empty) have fingerprint zero and are linked like others.
    Equal fingerprints count as one until the end, so a group of copies adds
    nothing to the index. An empty table gives no rows.
    """
    rows = written(fingerprints(docs, shingle, id_column, text_column), "simhash")
    prints = written(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "prints")
    found = components(linked(prints.select("print"), groups, longest), "near")
    placed = prints.join(found.withColumnRenamed("node", "print"), "print")
    lowest = written(placed.groupBy("root").agg(F.min("first").alias("lowest")), "lowest")
    moved = placed.join(lowest, "root").select("print", "lowest")
    # Stored, so that the join below shuffles both sides itself and a very common fingerprint's rows can be split.
    named = written(prints.join(moved, "print", "left").select(
        "print", F.coalesce("lowest", "first").alias("component_id")), "named")
    return rows.join(named, "print").select("doc_id", "mark", "print", "component_id")
