"""Loading newly arrived files into a keyed Parquet table, each key once.

The table is dealt by a hash of its key: ``bucket=<number>/batch=<stream>-<number>``.
A batch looks for known keys in its own buckets only, which Spark prunes to
those folders, and writes by dynamic partition overwrite: a batch repeated
after a failure replaces its own subfolders and so changes nothing. Other
writers may add subfolders of their own. The number of buckets is fixed when
the table is made and kept beside it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tallyhouse.operators.changes import one_per_key
from tallyhouse.session import written

BUCKET, BATCH = "bucket", "batch"
_START = "start"


class KeyedTable(NamedTuple):
    """Where a keyed table lies, its columns and into how many buckets its keys are dealt."""
    path: str
    schema: T.StructType
    buckets: int

    def stored(self, spark: SparkSession) -> DataFrame:
        """All rows with their bucket and batch; a filter on either becomes a choice of folders."""
        whole = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(BATCH, T.StringType())])
        return spark.read.schema(whole).parquet(self.path)

    def bucket_of(self, keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")


def open_table(spark: SparkSession, path: str, schema: T.StructType, buckets: int = 8) -> KeyedTable:
    """The table at ``path``, made if there is none; one that exists keeps the buckets it was made with."""
    clash = {BUCKET, BATCH} & set(schema.fieldNames())
    if clash:
        raise ValueError(f"columns {sorted(clash)} name the table's own folders")
    try:
        held = spark.read.schema("buckets int").parquet(f"{path}/_keyed").first()
    except AnalysisException:
        held = None
    if held is None:
        nothing = spark.createDataFrame([], schema)
        nothing.write.mode("ignore").parquet(f"{path}/{BUCKET}=0/{BATCH}={_START}")
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/_keyed")
        return KeyedTable(path, schema, buckets)
    return KeyedTable(path, schema, held["buckets"])


def loaded_rows(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    return open_table(spark, target, schema).stored(spark).drop(BUCKET, BATCH)


def loaded_per_batch(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """How many rows each batch inserted."""
    return open_table(spark, target, schema).stored(spark).groupBy(BATCH).agg(F.count(F.lit(1)).alias("inserted_rows"))


def earlier_rows(spark: SparkSession, table: KeyedTable, touched: Sequence[int], batch: str) -> DataFrame:
    """What other batches left in the given buckets; no file of another bucket is read."""
    return table.stored(spark).filter(F.col(BUCKET).isin(list(touched)) & (F.col(BATCH) != batch))


def merge_into(rows: DataFrame, table: KeyedTable, keys: Sequence[str], batch: str, session: SparkSession | None = None) -> bool:
    """Insert the rows whose key the other batches lack, one per key; False for a batch without rows.

    Once stored, the batch is handled in ``session`` where one is given: that
    of a stream's batches is a copy without adaptive execution.

    The batch is stored once and read from there; what must be known of it is
    observed on the way: rows, rows with a whole key, and its buckets. A NULL
    in a key stops the load before anything is inserted.
    """
    spark = session or rows.sparkSession
    seen = Observation()
    dealt = rows.select(*table.schema.fieldNames()).withColumn(BUCKET, table.bucket_of(keys))
    whole = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 0
    staged = written(dealt.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(whole).alias("keyed"),
                                   F.collect_set(BUCKET).alias("touched")), "batch", spark)
    found = seen.get
    if not found["rows"]:
        return False
    if found["rows"] > found["keyed"]:
        raise ValueError(f"a row of batch {batch} has no key")
    by = [BUCKET, *keys]
    # One shuffle of the batch serves the look-up and the fold to one row per key.
    known = earlier_rows(spark, table, found["touched"], batch).select(*by)
    fresh = one_per_key(staged.join(known, by, "left_anti"), by).withColumn(BATCH, F.lit(batch))
    # Rebalanced: a bucket's rows come together in few files, and Spark may split a large one.
    (fresh.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET, BATCH).parquet(table.path))
    return True


def merge_batch(rows: DataFrame, target: str, schema: T.StructType, keys: Sequence[str], batch: str) -> bool:
    """:func:`merge_into` for the table at ``target``."""
    return merge_into(rows, open_table(rows.sparkSession, target, schema), keys, batch)


def load_new_files(stream: DataFrame, target: str, keys: Sequence[str], progress: str, buckets: int = 8) -> int:
    """Take in what arrived since the last call; returns the number of batches that held rows.

    ``stream`` is a streaming DataFrame, for instance of
    :func:`tallyhouse.sources.delimited.stream_table`; ``progress`` is its
    checkpoint folder. This is the body of a daily job: call it from any
    scheduler. ``buckets`` counts only where the table is new.
    """
    table, done, name = open_table(stream.sparkSession, target, stream.schema, buckets), [], []

    def take_in(rows: DataFrame, number: int) -> None:
        if not name:
            name.append(_stream_id(rows.sparkSession, progress))
        if merge_into(rows, table, keys, f"{name[0]}-{number}", stream.sparkSession):
            done.append(number)

    query = (stream.writeStream.foreachBatch(take_in).option("checkpointLocation", progress)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return len(done)


def _stream_id(spark: SparkSession, progress: str) -> str:
    """The id Spark gave to the stream that keeps its progress in this folder."""
    return json.loads(spark.read.text(f"{progress}/metadata").first()[0])["id"]
