"""Distributed ranks, numbers and running totals against plain windows."""

import pytest
from pyspark.sql import Window, functions as F

from tallyhouse.operators import ordering
from tallyhouse.operators.joins import join_on_same


@pytest.fixture(scope="module")
def sales(spark):
    """Forty groups, one of which owns a third; a third of all amounts equal; some NULLs."""
    n = F.col("id")
    return spark.range(3000).select(
        n.alias("id"), F.when(n % 3 == 0, 0).otherwise(n * 7919 % 40).cast("int").alias("grp"),
        F.when(n % 3 == 1, 500).when(n % 101 == 0, None).otherwise(n * 104729 % 997).cast("long").alias("amount"),
        F.date_add(F.lit("2026-01-01").cast("date"), (n * 31 % 60).cast("int")).alias("day"))


def rows(df, *columns):
    return sorted(df.select(*columns).collect(), key=lambda r: r[0])


def test_numbered(sales):
    plain = sales.withColumn("row_number", F.row_number().over(
        Window.partitionBy("grp").orderBy(F.desc_nulls_last("amount"), "id")).cast("long"))
    ours = ordering.numbered(sales, ["-amount", "id"], ["grp"])
    assert rows(ours, "id", "row_number") == rows(plain, "id", "row_number")
    whole = ordering.numbered(sales, ["-id"], number_as="n", after=10)
    assert {r.n for r in whole.collect()} == set(range(11, 3011))


def test_rank_all(sales):
    plain = sales.withColumn("rank", F.rank().over(Window.orderBy(F.desc_nulls_last("amount"))).cast("long"))
    assert rows(ordering.rank_all(sales, "amount"), "id", "rank") == rows(plain, "id", "rank")


@pytest.mark.parametrize("n", [1, 5, 1400, 1700])
def test_rank_top(sales, n):
    plain = sales.withColumn("rank", F.rank().over(Window.orderBy(F.desc_nulls_last("amount"))).cast("long"))
    assert rows(ordering.rank_top(sales, "amount", n), "id", "rank") == rows(
        plain.filter(F.col("rank") <= n), "id", "rank")


@pytest.mark.parametrize("descending", [False, True])
def test_running_total_with_ties(sales, descending):
    key = "-day" if descending else "day"
    over = Window.orderBy(*ordering.sort_columns([key]))
    plain = sales.withColumns({"run": F.sum("amount").over(over), "seen": F.count("amount").over(over)})
    ours = ordering.running_total(sales, [key], "amount", "run", count_as="seen")
    assert rows(ours, "id", "run", "seen") == rows(plain, "id", "run", "seen")


def test_running_total_in_groups(sales):
    over = Window.partitionBy("grp").orderBy("day", "id")
    plain = sales.withColumn("run", F.sum("amount").over(over))
    ours = ordering.running_total(sales, ["day", "id"], "amount", "run", within=["grp"], unique=True)
    assert rows(ours, "id", "run") == rows(plain, "id", "run")


def test_running_by_day(sales):
    over = Window.orderBy(F.desc("day"))
    plain = sales.withColumns({"run": F.sum("amount").over(over), "mean": F.avg("amount").over(over)})
    ours = ordering.running_by_day(sales, "day", "amount", "run", "mean", descending=True)
    assert rows(ours, "id", "run") == rows(plain, "id", "run")
    for mine, theirs in zip(rows(ours, "id", "mean"), rows(plain, "id", "mean"), strict=True):
        assert mine["mean"] == pytest.approx(theirs["mean"])
    with pytest.raises(TypeError):
        ordering.running_by_day(sales, "id", "amount", "run")


def test_first_per_group_and_top_n(sales):
    best = ordering.first_per_group(sales, ["grp"], ["-amount", "id"])
    plain = sales.withColumn("rn", F.row_number().over(
        Window.partitionBy("grp").orderBy(F.desc_nulls_last("amount"), "id"))).filter("rn = 1")
    assert rows(best, "id", "grp") == rows(plain, "id", "grp")
    assert [r.id for r in ordering.top_n(sales, ["-amount", "id"], 3).collect()] == [
        r.id for r in sales.orderBy(F.desc_nulls_last("amount"), "id").limit(3).collect()]


def test_empty_input(spark, sales):
    none = sales.filter("id < 0")
    assert ordering.numbered(none, ["id"]).count() == 0
    assert ordering.running_total(none, ["day"], "amount", "run").count() == 0
    assert ordering.rank_all(none, "amount").count() == 0


def test_ranks_do_not_sort_the_rows_in_one_task(sales):
    plan = ordering.rank_top(sales, "amount", 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    plan = ordering.first_per_group(sales, ["grp"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_join_on_same_matches_nulls(spark):
    left = spark.createDataFrame([(None, 1), (2, 3)], "k int, a int")
    right = spark.createDataFrame([(None, "n"), (2, "t")], "k int, b string")
    assert {r.b for r in join_on_same(left, right, ["k"]).collect()} == {"n", "t"}
