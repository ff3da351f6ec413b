"""New files into a keyed table, each key once."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.session import new_table_path
from tallyhouse.sources.delimited import stream_table
from tallyhouse.streaming.incremental import (
    BUCKET, earlier_rows, load_new_files, loaded_per_batch, loaded_rows, merge_batch, merge_into, open_table)

SCHEMA = "id int, v string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_batches_are_idempotent(spark):
    schema, target = frame(spark).schema, new_table_path(spark, "t")
    assert rows(loaded_rows(spark, target, schema)) == []
    batch = frame(spark, (4, "other"), (8, "h"), (8, "i"))
    for _ in range(2):
        assert merge_batch(batch, target, schema, ["id"], "s-0")
        assert rows(loaded_rows(spark, target, schema)) == [(4, "other"), (8, "i")]
    assert merge_batch(frame(spark, (4, "late"), (9, "j")), target, schema, ["id"], "s-1")
    assert not merge_batch(frame(spark), target, schema, ["id"], "s-2")
    assert rows(loaded_rows(spark, target, schema)) == [(4, "other"), (8, "i"), (9, "j")]
    assert rows(loaded_per_batch(spark, target, schema)) == [("s-0", 2), ("s-1", 1)]
    with pytest.raises(ValueError):
        merge_batch(frame(spark, (None, "x"), (10, "k")), target, schema, ["id"], "s-3")


def test_csv_files_as_they_arrive(spark, tmp_path):
    """The header is no row, columns bind by position, and every batch is counted beyond the kept progress."""
    source, progress, target = tmp_path / "in", str(tmp_path / "progress"), new_table_path(spark, "stream")
    source.mkdir()
    schema = frame(spark).schema
    load = lambda: load_new_files(
        stream_table(spark, str(source), schema, quote='"', null_tokens=("NULL",), files_per_batch=1), target, ["id"], progress)
    for n in range(5):
        (source / f"{n}.csv").write_text(f'other,names\n{n},"say ""{n}"""\n0,NULL\n')
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        assert load() == 5
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert load() == 0
    assert [r[0] for r in rows(loaded_rows(spark, target, schema))] == [0, 1, 2, 3, 4]
    (source / "bad.csv").write_text("x,y\nten,z\n")
    with pytest.raises(Exception):
        load()


def test_a_batch_reads_its_own_buckets(spark):
    """Files of other buckets are not opened; keys of all buckets are found."""
    table = open_table(spark, new_table_path(spark, "keyed"), frame(spark).schema, 8)
    many = spark.range(1000).selectExpr("cast(id as int) as id", "'first' as v")
    assert merge_into(many, table, ["id"], "s-0")
    few = frame(spark, (1, "again"), (2, "again"), (2000, "new"))
    own = {r[0] for r in few.select(table.bucket_of(["id"])).collect()}
    read = earlier_rows(spark, table, sorted(own), "s-1")
    files = {r[0] for r in read.select(F.input_file_name()).distinct().collect()}
    assert files and {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in files} == own != set(range(8))
    scans = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scans and "PartitionFilters: []" not in scans
    assert merge_into(few, table, ["id"], "s-1") and merge_into(few, table, ["id"], "s-1")
    assert rows(loaded_per_batch(spark, table.path, table.schema)) == [("s-0", 1000), ("s-1", 1)]
    assert rows(loaded_rows(spark, table.path, table.schema)) == rows(many.union(frame(spark, (2000, "new"))))


def test_buckets_stay_as_the_table_was_made(spark):
    path, schema = new_table_path(spark, "keyed"), frame(spark).schema
    assert open_table(spark, path, schema, 4).buckets == open_table(spark, path, schema, 32).buckets == 4
    with pytest.raises(ValueError):
        open_table(spark, path, spark.createDataFrame([], "id int, batch string").schema)
