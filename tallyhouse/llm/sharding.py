"""A shuffled corpus in shards: two passes over external storage, no Python code.

The first pass scatters whole records uniformly into buckets that fit in a
task's memory, by a seeded hash of the record's id and row number; Spark's
exchange holds them on disk. The second collects each bucket in the order of
its hashes, applies a Fisher-Yates shuffle (``shuffle`` of Spark SQL, in its
inside-out form) seeded by seed and bucket, and writes it. Buckets one after
another are the shuffled corpus; the number of records in earlier buckets is a
prefix sum over one row per bucket. Shards are equal stretches of that order,
so their counts differ by one at most.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.session import written


class Shuffle(NamedTuple):
    """``bucket_bytes`` is what one task holds at once; no more than ``most_buckets`` are made.

    The counts of buckets (24 bytes each) are broadcast, so ``most_buckets``
    bounds that. Beyond it buckets grow: 100 TB make a million of 100 MB.
    """
    shards: int = 40
    seed: int = 13
    bucket_bytes: int = 32 << 20
    most_buckets: int = 1_000_000


def record_size(text_column: str = "text") -> Column:
    """Bytes of the text (none for null) and 16 for what goes with it."""
    return F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long") + 16


def _buckets(docs: DataFrame, plan: Shuffle, text_column: str) -> int:
    held = docs.agg(F.sum(record_size(text_column)).alias("bytes")).first()["bytes"] or 0
    return min(max(1, -(-int(held) // plan.bucket_bytes)), plan.most_buckets)


def shuffled(docs: DataFrame, plan: Shuffle = Shuffle(), id_column: str = "doc_id",
             text_column: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``record`` (a struct of all its columns) with ``shard`` and ``slot``.

    Slots of a shard count from 0 without gaps. Null ids and texts, empty and
    repeated rows are records like any other; rows that repeat an id or a text
    are scattered apart, so no bucket is larger for them. Given columns cannot
    clash with new ones. With fewer rows than shards some shards have none; an
    empty table gives no rows. ``docs`` should be a scan or a stored table: the
    order depends on the seed and on how its files are split, and a lost task
    must read the same rows in the same order again.
    """
    number = _buckets(docs, plan, text_column)
    draw = F.xxhash64(F.lit(plan.seed), F.col(id_column), F.monotonically_increasing_id())
    scattered = (docs.select(F.struct(*docs.columns).alias("record"), draw.alias("draw"))
                 .withColumn("bucket", F.pmod("draw", F.lit(number)).cast("int"))
                 .repartitionById(number, "bucket").sortWithinPartitions("draw"))
    whole = scattered.groupBy("bucket").agg(F.collect_list("record").alias("records"))
    dealt = written(whole.select("bucket", F.posexplode(F.shuffle("records", plan.seed)).alias("place", "record")), "shuffled")

    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    bases = counts.select("bucket", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("base"))
    rows = dealt.count()
    place, shards = F.col("base") + F.col("place"), F.lit(plan.shards).cast("long")
    shard = F.expr(f"(base + place) * {plan.shards} div {max(rows, 1)}")
    first = F.expr(f"(shard * {rows} + {plan.shards - 1}) div {plan.shards}")
    return (dealt.join(F.broadcast(bases), "bucket").withColumn("shard", shard)
            .select(F.col("shard").cast("int").alias("shard"), (place - first).alias("slot"), "record"))


def write_shards(rows: DataFrame, folder: str) -> None:
    """Store the result of :func:`shuffled` with a subfolder for each shard, in the order of its slots within a file.

    A stored bucket is read by one task and lies in one shard or a few
    neighbouring ones, so nothing is shuffled for it.
    """
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
