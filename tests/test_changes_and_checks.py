"""Merges, deletes, checks and loaders on hand-built rows."""

import pytest
from pyspark.sql import functions as F, types as T

from tallyhouse.functions.expressions import code_of
from tallyhouse.operators import changes, quality
from tallyhouse.operators.dimensions import extract_lookup, normalise_dimension
from tallyhouse.operators.totals import count_per_entity, totals_by_attribute
from tallyhouse.session import new_table_path, shared_folder
from tallyhouse.operators.stored_totals import add_totals, read_totals
from tallyhouse.sources.delimited import NULL_TOKENS, read_table
from tallyhouse.sources.tables import append_rows, literal_rows, replace_rows


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")


def both(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merge_takes_one_row_per_key(spark, people):
    batch = spark.createDataFrame([(3, "x"), (4, "p"), (4, "q"), (5, None)], "id int, v string")
    merged = changes.merge_insert(people, batch, ["id"])
    assert both(merged) == both(people) + [(4, "q"), (5, None)]
    assert both(changes.merge_insert(merged, batch, ["id"])) == both(merged)
    assert both(changes.merge_insert(people.limit(0), batch, ["id"])) == [(3, "x"), (4, "q"), (5, None)]


def test_delete_keeps_unknown(people):
    assert both(changes.delete_where(people, F.col("v") == "a")) == [(2, None), (3, "c")]


def test_restore_twice(people):
    left = changes.delete_where(people, F.col("id") == 3)
    back = changes.restore_rows(left, people, ["id"], F.col("id") == 3)
    assert both(back) == both(people)
    assert both(changes.restore_rows(back, people, ["id"], F.col("id") == 3)) == both(people)


def test_one_per_key_is_definite(spark):
    rows = spark.createDataFrame([(1, 5, "b"), (1, 9, "a"), (1, 9, "c")], "id int, at int, v string")
    assert both(changes.one_per_key(rows, ["id"], ["at"])) == [(1, 9, "c")]


def test_checks(spark):
    fact = spark.createDataFrame([(1, 10), (1, 11), (2, None), (None, 99)], "id int, k int")
    dim = spark.createDataFrame([(10,), (11,)], "k int")
    assert both(quality.duplicate_keys(fact, ["id"])) == [(1, 2)]
    assert both(quality.orphan_rows(fact, dim, "k")) == [(2, None), (None, 99)]
    assert both(quality.orphan_counts(fact, {"d": (dim, "k")})) == [("d", 2)]
    assert both(quality.key_report({"f": (fact, ["id"])})) == [("f", 4, 1, 1)]
    assert both(quality.row_counts({"f": fact, "d": dim})) == [("d", 2), ("f", 4)]
    assert both(quality.orphan_counts(fact.limit(0), {"d": (dim, "k")})) == [("d", 0)]


def test_hot_key_totals(spark):
    fact = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.lit(2).alias("v"))
    dim = spark.range(60).select(F.col("id").alias("k"), (F.col("id") % 2).alias("side"))
    measures = {"total": ("sum", "v"), "n": ("count", "v")}
    got = totals_by_attribute(fact, dim, "k", ["side"], measures, count_keys_as="keys")
    plain = fact.join(dim, "k").groupBy("side").agg(
        F.countDistinct("k").alias("keys"), F.sum("v").alias("total"), F.count("v").alias("n"))
    assert both(got) == both(plain)
    assert count_per_entity(fact, dim, "k", ["side"], "n").filter("n = 0").count() == 10


def test_brand_in_two_categories_does_not_multiply(spark):
    flat = spark.createDataFrame(
        [(1, "HP", "Mice"), (2, "HP", "Printers"), (3, None, "Mice")], "id int, brand string, category string")
    lookup = extract_lookup(flat, ["brand", "category"], "brand_id")
    assert lookup.count() == 3
    lean = normalise_dimension(flat, lookup, ["brand", "category"], "brand_id")
    assert lean.count() == 3 and lean.filter("brand_id is null").count() == 0


def test_codes(spark):
    df = spark.createDataFrame([("North",), ("Mars",), (None,)], "r string")
    assert [r[0] for r in df.select(code_of("r", {"North": 1})).collect()] == [1, None, None]


def test_loader_rejects_bad_numbers(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])
    (tmp_path / "a.csv").write_text('x,y\n1,"one, two"\nNULL,null\n')
    loaded = read_table(spark, str(tmp_path / "a.csv"), schema, quote='"', null_tokens=NULL_TOKENS)
    assert both(loaded) == [(1, "one, two"), (None, None)]
    (tmp_path / "b.csv").write_text("x,y\nten,z\n")
    for tokens in ((), NULL_TOKENS):
        with pytest.raises(Exception):
            read_table(spark, str(tmp_path / "b.csv"), schema, null_tokens=tokens).collect()
    picked = read_table(spark, str(tmp_path), schema, quote='"', null_tokens=NULL_TOKENS, name_pattern="a*.csv")
    assert picked.count() == 2


@pytest.mark.parametrize("bad", ["2,bad", "3,7,8", "4"])
@pytest.mark.parametrize("tokens", [(), NULL_TOKENS])
def test_a_malformed_record_stops_every_use(spark, tmp_path, bad, tokens):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.IntegerType())])
    (tmp_path / "a.csv").write_text(f"x,y\n1,5\n{bad}\n")
    loaded = read_table(spark, str(tmp_path / "a.csv"), schema, quote='"', null_tokens=tokens)
    for use in (loaded.count, loaded.collect, loaded.select("id").collect, loaded.groupBy().count().collect):
        with pytest.raises(Exception):
            use()


def test_doubled_quotes_and_lines_in_fields(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])
    (tmp_path / "a.csv").write_text('x,y\n1,"say ""hi"", ok"\n2,"two\nlines"\n')
    loaded = read_table(spark, str(tmp_path / "a.csv"), schema, quote='"', multi_line=True)
    assert both(loaded) == [(1, 'say "hi", ok'), (2, "two\nlines")]


def test_rows_without_a_key(spark):
    """A NULL in a key matches nothing in a merge; between two states of one table it is a value."""
    rows = lambda *r: spark.createDataFrame(list(r), "id int, v string")
    target = rows((1, "a"), (None, "held"))
    batch = rows((None, "x"), (None, "x"), (None, "y"), (1, "again"), (2, "new"), (2, "new"))
    once = changes.merge_insert(target, batch, ["id"])
    assert sorted(both(once), key=repr) == sorted([(1, "a"), (2, "new"), (None, "held"), (None, "x"), (None, "x"), (None, "y")], key=repr)
    assert changes.merge_insert(once, batch, ["id"]).filter("id is not null").count() == 2
    left = changes.delete_where(target, F.col("v") == "held")
    assert sorted(both(changes.restore_rows(left, target, ["id"], F.lit(True))), key=repr) == sorted(both(target), key=repr)
    assert both(changes.restore_rows(target, target, ["id"], F.lit(True))) == both(target)


def test_states_and_net_changes(spark):
    log = spark.createDataFrame(
        [(1, "a", "I", 1), (2, "b", "I", 1), (3, None, "I", 1), (None, "n", "I", 1), (1, None, "D", 2), (2, None, "D", 2),
         (2, "B", "I", 2), (1, "a", "I", 3), (4, "d", "I", 3)], "id int, v string, op string, version long")
    states = {n: changes.state_of(log, ["id"], n) for n in range(4)}
    as_set = lambda df: set(map(tuple, df.collect()))
    assert as_set(states[2]) == {(2, "B"), (3, None), (None, "n")}
    assert as_set(states[3]) == {(1, "a"), (2, "B"), (3, None), (4, "d"), (None, "n")}
    for first in range(4):
        for last in range(first, 4):
            feed = changes.net_changes(states[first], states[last], ["id"]).collect()
            assert {(r.id, r.v) for r in feed if r.action == "DELETE"} == as_set(states[first]) - as_set(states[last])
            assert {(r.id, r.v) for r in feed if r.action == "INSERT"} == as_set(states[last]) - as_set(states[first])
            assert all(r.is_update == (r.id == 2) for r in feed if (first, last) == (1, 2) and r.id != 1)


def test_stored_totals(spark):
    sales = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    path, measures = new_table_path(spark, "sums"), {"total": ("sum", "v"), "n": ("count", "v")}
    add_totals(sales, path, ["k"], measures, "1")
    for _ in range(2):
        add_totals(sales.filter("k = 'b'"), path, ["k"], measures, "2")
    assert both(read_totals(spark, path, ["k"], list(measures))) == [("a", 3, 2), ("b", 6, 2)]


def test_writes(spark, people):
    path = new_table_path(spark, "people")
    assert path.startswith(shared_folder(spark))
    append_rows(people, path)
    append_rows(literal_rows(spark, [(4, "d")], people.schema), path)
    assert spark.read.parquet(path).count() == 4
    replace_rows(people, path)
    assert spark.read.parquet(path).count() == 3
