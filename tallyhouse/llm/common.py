"""What several operators of this package need: document columns, slices of Arrow batches, components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.session import written


def shuffle_width(spark: SparkSession) -> int:
    """The number of partitions the cluster wants after a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                binary: bool = False) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty); other columns cannot clash afterwards."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       (text.cast("binary") if binary else text).alias("text"))


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder; Spark writes local ones with one slash or three."""
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that the Python objects of few rows live at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def local_roots(pairs: Iterator[tuple[int, int]]) -> dict[int, int]:
    """Smallest member of each group that the pairs connect, by member."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def _signature(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mark),
                           F.sum(mark.cast("decimal(20,0)"))).first())


def components(edges: DataFrame, name: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of ``edges``.

    ``edges`` has two long columns ``u`` and ``v``; direction, repeats and loops
    do not matter; a row with a null is left out. Alternates large and small
    stars: each round links all larger neighbours of a node to its smallest
    one. The number of rounds grows with the logarithm of the longest chain.
    Every round is written to the shared folder. Minima are combined before
    the shuffle, and the joins may be split, so a hub is not one task's work.
    """
    def ordered(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                         F.least("u", "v").alias("v")).distinct()

    current = written(ordered(edges), f"{name}-edges")
    before = _signature(current)
    while before[0]:
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large = written(large, f"{name}-large")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        current = written(ordered(small.select("e.*")), f"{name}-edges")
        after = _signature(current)
        if after == before:
            break
        before = after
    return (current.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
