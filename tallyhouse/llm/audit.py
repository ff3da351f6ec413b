"""What each filter of a chain removes, in every order of the filters.

Texts that occur once need no comparison: a counting Bloom filter over hashes
of all texts is built from partial counts, block by block, and clears every
text one of whose counters stays at one. Only the others are shuffled, folded
to one row per hash with the smallest and the largest text, so that the
smallest id of a text is known by comparing whole texts. A document's failed
filters are bits of a mask. All that an order of filters removes or keeps is a
sum of counts of masks, so documents are counted once for each part and mask
and the orders are worked out on these counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations
from math import factorial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.common import slices
from tallyhouse.session import written

#: Bits of one block of the sketch: what Spark's bitmap functions hold in one value.
BLOCK = 32_768
#: Counters that a text touches, all in one block.
TOUCHED = 4


class Limits(NamedTuple):
    """Failure conditions A to D; E (an earlier copy) is not a matter of one text.

    A: fewer than ``words`` words. B: less than ``distinct`` percent of them
    differ. C: more than ``capitals`` percent of the code points are A-Z.
    D: holds one of ``marks``.
    """
    words: int = 50
    distinct: int = 65
    capitals: int = 5
    marks: str = "[#$%&*|]"


class Sketch(NamedTuple):
    """``counters`` for each text; blocks of up to ``sent`` bytes in all are sent to the scan, others are joined by a shuffle."""
    counters: int = 16
    sent: int = 64 << 20


def _masks(texts: pa.Array, limits: Limits) -> pa.Array:
    """Bits 0 to 3: conditions A to D."""
    words = distinct = None
    split = [text.split() for text in texts.cast(pa.binary()).to_pylist()]  # bytes split at ASCII white space
    words = np.fromiter(map(len, split), np.int64, len(split))
    distinct = np.fromiter((len(set(w)) for w in split), np.int64, len(split))
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    seen = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    capitals = np.diff(seen[offsets - offsets[0]])
    points = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    marked = pc.match_substring_regex(texts, limits.marks).to_numpy(zero_copy_only=False)
    failed = [words < limits.words, 100 * distinct < limits.distinct * words,
              100 * capitals > limits.capitals * points, marked]
    return pa.array(sum(f.astype(np.int32) << bit for bit, f in enumerate(failed)), pa.int32())


def _masked(texts: DataFrame, limits: Limits, keep_text: bool = False) -> DataFrame:
    kept = ["doc_id", "part", "h", *(["text"] if keep_text else [])]
    fields = {"doc_id": pa.int64(), "part": pa.string(), "h": pa.int64(), "text": pa.string()}
    schema = pa.schema([*((name, fields[name]) for name in kept), ("mask", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text = batch.column("text").cast(pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(name).cast(fields[name]) for name in kept), _masks(text, limits)],
                                             schema=schema)

    columns = "doc_id long, part string, h long" + (", text string" if keep_text else "")
    return texts.select("doc_id", "part", "h", "text").mapInArrow(run, f"{columns}, mask int")


def _touched() -> Column:
    """The counters of a text in its block, from its hash."""
    drawn = F.xxhash64("h", F.lit(1))
    return F.array(*(F.shiftrightunsigned(drawn, 15 * i).bitwiseAND(F.lit(BLOCK - 1)) for i in range(TOUCHED)))


def _all_set() -> Column:
    """Whether every counter of a text has reached two, by ``bits`` of its block."""
    def is_set(at: Column) -> Column:
        byte = F.ascii(F.decode(F.substring(F.col("bits"), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
        return F.call_function("shiftrightunsigned", byte, at.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return F.forall(_touched(), is_set)


def _sketched(keys: DataFrame, blocks: int) -> DataFrame:
    """One row per ``block``: its counters that have reached two, as ``bits``.

    Spark adds the counts up within each task before they are shuffled, so a
    very common text gives a task's worth of partial counts.
    """
    touched = keys.select(F.pmod("h", F.lit(blocks)).alias("block"), F.explode(_touched()).alias("at"))
    reached = touched.groupBy("block", "at").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return reached.groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits"))


def _possible(texts: DataFrame, keys: DataFrame, rows: int, sketch: Sketch) -> DataFrame:
    """Rows of ``texts`` that the sketch cannot clear."""
    blocks = max(1, -(-rows * sketch.counters // BLOCK))
    found = written(_sketched(keys, blocks), "sketch")
    block = F.pmod("h", F.lit(blocks)).alias("block")
    if blocks * BLOCK // 8 <= sketch.sent:
        return texts.withColumn("block", block).join(F.broadcast(found), "block").where(_all_set()).select(*texts.columns)
    doubtful = keys.select("h", block).join(found, "block").where(_all_set()).select("h").distinct()
    return texts.join(written(doubtful, "doubtful"), "h", "left_semi").select(*texts.columns)


def masks(docs: DataFrame, limits: Limits = Limits(), sketch: Sketch = Sketch(), id_column: str = "doc_id",
          text_column: str = "text", part_column: str = "source",
          hashed: Callable[[str], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``part`` and ``mask``, whose bits 0 to 4 are the failed filters A to E.

    A null text is empty, a null part is the empty string. A row fails E if a
    row with a smaller id has the identical text, whatever else is true of
    either; a row without an id neither fails E nor makes others fail. Rows
    that repeat an id with the same text do not make each other fail.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(text_column, F.lit("")).alias("text"))
    texts = texts.withColumn("h", hashed("text").cast("long"))
    keys = written(_masked(texts, limits), "masks")
    doubtful = _possible(texts.select("doc_id", "h", "text"), keys, keys.count(), sketch)
    # Stored, so that the join below shuffles both sides itself and a very common text's rows can be split.
    folded = written(doubtful.groupBy("h").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"),
        (F.min("text") != F.max("text")).alias("mixed")).where("copies > 1").select("h", "first", "mixed"), "first-ids")
    earlier = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    with_copies = (F.col("mask") + F.when(earlier, 16).otherwise(0)).alias("mask")
    result = ["doc_id", "part", with_copies]
    mixed = folded.where("mixed").select("h")
    if mixed.isEmpty():
        return keys.join(folded.drop("mixed"), "h", "left").select(*result)
    # Different texts under one hash: those rows are told apart by their whole texts.
    apart = keys.join(mixed, "h", "left_anti").join(folded.drop("mixed"), "h", "left").select(*result)
    again = written(_masked(texts.join(mixed, "h", "left_semi"), limits, keep_text=True), "mixed")
    firsts = written(again.groupBy("text").agg(F.min("doc_id").alias("first")), "mixed-first-ids")
    return apart.unionByName(again.join(firsts, "text", "left").select(*result))


def effects(counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Every part, order of the filters and step, worked out from counts of masks.

    ``counts`` has ``part``, ``mask`` and the additive ``n``, ``good``,
    ``toxic``; bit i of a mask is the filter ``letters[i]``. What a set of
    filters leaves is the sum over masks without any of their bits: one such
    sum for each set and part. A part's orders are then looked up in it, so the
    work for orders does not depend on the number of documents.
    """
    filters, sets = len(letters), 1 << len(letters)
    free = lambda name: F.array(*(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) == 0, F.col(name)).otherwise(0))
                                  for s in range(sets)))
    left = counts.groupBy("part").agg(*(free(name).alias(name) for name in ("n", "good", "toxic")))

    def removed(name: str, before, own) -> Column:
        return F.get(name, before) - F.get(name, before.bitwiseOR(own) if isinstance(before, Column) else F.lit(before | own))

    def over_all_orders(bit: int) -> Column:
        ways = ((s, factorial(s.bit_count()) * factorial(filters - 1 - s.bit_count()))
                for s in range(sets) if not s >> bit & 1)
        return sum((F.get("n", F.lit(s)) - F.get("n", F.lit(s | 1 << bit))) * F.lit(w) for s, w in ways)

    shares = left.withColumn("shares", F.array(*map(over_all_orders, range(filters))))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(letters)))
    steps = (shares.withColumn("filter_order", F.explode(orders))
             .withColumn("step", F.explode(F.array(*(F.lit(s) for s in range(1, filters + 1))))))
    number = F.instr(F.lit(letters), F.substring("filter_order", F.col("step"), F.lit(1))) - 1
    before = sum(F.when(F.instr("filter_order", letter) < F.col("step"), 1 << bit).otherwise(0)
                 for bit, letter in enumerate(letters))
    placed = steps.withColumns({"number": number, "before": before}).withColumn(
        "own", F.expr("shiftleft(1, number)"))
    own, before = F.col("own"), F.col("before")
    fails = F.get("n", F.lit(0)) - F.get("n", own)
    return placed.select(
        "part", "filter_order", "step", F.get("n", before.bitwiseOR(own)).alias("kept"),
        removed("n", before, own).alias("removed"), (fails - removed("n", before, own)).alias("redundant"),
        (F.get("n", F.lit(sets - 1).bitwiseXOR(own)) - F.get("n", F.lit(sets - 1))).alias("unique_fails"),
        removed("good", before, own).alias("good_lost"), removed("toxic", before, own).alias("toxic_lost"),
        F.get("shares", F.col("number")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), sketch: Sketch = Sketch()) -> DataFrame:
    """The effects of the five filters on ``docs``, for each value of ``source``.

    ``labels`` has ``doc_id``, ``quality`` and ``toxic``; a document is good or
    toxic if any row of its id says 1. Rows without an id have no labels. An
    empty table gives no rows; every part found gives all orders and steps.
    """
    # Stored, as the mask's plan is long and the join with labels may be split at a common id.
    found = written(masks(docs, limits, sketch), "all-masks")
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"))
    told = written(told, "told")
    counts = found.join(told, "doc_id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    return effects(counts)
