"""Customer history: types 1, 2, 3 and 6 on five customers, and the rules of versions."""

from datetime import date

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import changes, history
from tallyhouse.operators.dimensions import assign_keys
from tallyhouse.plans import model
from tallyhouse.sources.delimited import read_table

COMPARED = ["city", "state", "membership", "segment"]
TRACKED = ["customer_name", *COMPARED]
OTHERS = ["customer_name", "city", "state", "segment"]
OPEN = date(9999, 12, 31)


@pytest.fixture(scope="module")
def initial(spark, tmp_path_factory):
    path = fx.put(tmp_path_factory.mktemp("initial"), "customers.csv", fx.CUSTOMER_STATE)
    return read_table(spark, path, model.CUSTOMER_STATE)


@pytest.fixture(scope="module")
def updates(spark, tmp_path_factory):
    path = fx.put(tmp_path_factory.mktemp("updates"), "updates.csv", fx.CUSTOMER_UPDATES)
    return read_table(spark, path, model.CUSTOMER_UPDATES)


def table(df, *columns):
    return sorted(tuple(row[c] for c in columns) for row in df.collect())


def test_change_reports(initial, updates):
    wide = changes.changed_rows(initial, updates, "customer_id", COMPARED)
    assert table(wide, "customer_id", "old_city", "new_city", "old_segment", "new_segment") == [
        (101, "Hyderabad", "Bengaluru", "Regular", "Premium"),
        (103, "Vijayawada", "Chennai", "Regular", "Premium"),
        (104, "Hyderabad", "Hyderabad", "Premium", "Premium")]
    three = changes.changed_attributes(initial, updates, "customer_id", COMPARED[:3])
    assert table(three, "customer_id", "attribute", "old_value", "new_value") == [
        (101, "city", "Hyderabad", "Bengaluru"), (101, "membership", "Silver", "Gold"),
        (101, "state", "Telangana", "Karnataka"), (103, "city", "Vijayawada", "Chennai"),
        (103, "membership", "Silver", "Gold"), (103, "state", "Andhra Pradesh", "Tamil Nadu"),
        (104, "membership", "Gold", "Platinum")]
    assert changes.changed_attributes(initial, updates, "customer_id", COMPARED).count() == 9


def test_null_is_a_change(spark):
    old = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "id int, v string")
    assert table(changes.changed_rows(old, new, "id", ["v"]), "id") == [(1,), (2,)]


def test_type_1(initial, updates):
    after = changes.overwrite_attributes(initial, updates, "customer_id", TRACKED)
    assert table(after, "customer_id", "city", "membership") == [
        (101, "Bengaluru", "Gold"), (102, "Warangal", "Gold"), (103, "Chennai", "Gold"),
        (104, "Hyderabad", "Platinum"), (105, "Nagpur", "Bronze")]


def test_type_2(initial, updates):
    loaded = history.start_versions(initial, "2026-01-01")
    after = history.apply_versions(loaded, updates, "customer_id", TRACKED)
    assert table(after.filter("customer_id in (101, 103, 104)"), "customer_id", "city", "membership",
                 "effective_date", "expiry_date", "is_current") == [
        (101, "Bengaluru", "Gold", date(2026, 4, 1), OPEN, True),
        (101, "Hyderabad", "Silver", date(2026, 1, 1), date(2026, 3, 31), False),
        (103, "Chennai", "Gold", date(2026, 4, 5), OPEN, True),
        (103, "Vijayawada", "Silver", date(2026, 1, 1), date(2026, 4, 4), False),
        (104, "Hyderabad", "Gold", date(2026, 1, 1), date(2026, 4, 9), False),
        (104, "Hyderabad", "Platinum", date(2026, 4, 10), OPEN, True)]
    assert tuple(history.version_counts(after).first()) == (8, 5, 3)
    assert history.current_rows(after).count() == 5
    then = history.as_of(after, "2026-03-15").filter("customer_id = 101")
    assert table(then, "membership", "city") == [("Silver", "Hyderabad")]
    assert history.version_faults(after, "customer_id").count() == 0
    assert [r.membership for r in history.history_of(after, "customer_id", [101]).collect()] == ["Silver", "Gold"]
    again = history.apply_versions(after, updates, "customer_id", TRACKED)
    assert table(again, *again.columns) == table(after, *after.columns)


def test_type_2_surrogates(initial, updates):
    loaded = history.start_versions(assign_keys(initial, "customer_key", ["customer_id"]), "2026-01-01")
    with pytest.raises(ValueError):
        history.apply_versions(loaded, updates, "customer_id", TRACKED)
    after = history.apply_versions(loaded, updates, "customer_id", TRACKED, surrogate="customer_key")
    filled = history.fill_surrogates(after, "customer_key", ["customer_id"])
    assert table(filled.filter("customer_key > 5"), "customer_key", "customer_id") == [
        (6, 101), (7, 103), (8, 104)]
    assert filled.select("customer_key").distinct().count() == 8


def test_type_2_several_changes_in_one_batch(spark):
    dim = history.start_versions(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), "2026-01-01")
    batch = spark.createDataFrame([
        (1, "a", "2026-02-01"),   # nothing changes
        (1, "c", "2026-03-01"),
        (1, "c", "2026-04-01"),   # nothing changes
        (1, None, "2026-05-01"),  # value lost
        (1, "a", "2026-06-01"),   # back to the first value
        (2, "z", "2025-12-31"),   # before the current version
        (3, "n", "2026-02-02"),   # a new key
    ], "id int, v string, d string").withColumn("effective_date", F.to_date("d")).drop("d")
    after = history.apply_versions(dim, batch, "id", ["v"])
    rows = [(r.id, r.v, r.effective_date, r.expiry_date, r.is_current)
            for r in after.orderBy("id", "effective_date").collect()]
    assert rows == [
        (1, "a", date(2026, 1, 1), date(2026, 2, 28), False),
        (1, "c", date(2026, 3, 1), date(2026, 4, 30), False),
        (1, None, date(2026, 5, 1), date(2026, 5, 31), False),
        (1, "a", date(2026, 6, 1), OPEN, True),
        (2, "b", date(2026, 1, 1), OPEN, True),
        (3, "n", date(2026, 2, 2), OPEN, True)]
    assert table(history.late_changes(dim, batch, "id", ["v"]), "id", "v") == [(2, "z")]
    assert history.version_faults(after, "id").count() == 0


def test_type_2_two_changes_on_one_day(spark):
    dim = history.start_versions(spark.createDataFrame([(1, "a")], "id int, v string"), "2026-01-01")
    batch = spark.createDataFrame([(1, "z", 1), (1, "b", 2)], "id int, v string, seq int") \
        .withColumn("effective_date", F.lit("2026-02-01").cast("date"))
    after = history.apply_versions(dim, batch, "id", ["v"], last_by=["seq"])
    assert table(after.filter("is_current"), "v") == [("b",)]
    assert after.count() == 2


def test_type_3(initial, updates):
    loaded = history.start_previous_value(initial, "membership")
    after = history.shift_previous_value(loaded, updates, "customer_id", "membership", OTHERS)
    assert sorted(((r.customer_id, r.current_membership, r.previous_membership) for r in after.collect())) == [
        (101, "Gold", "Silver"), (102, "Gold", None), (103, "Gold", "Silver"),
        (104, "Platinum", "Gold"), (105, "Bronze", None)]
    again = history.shift_previous_value(after, updates, "customer_id", "membership", OTHERS)
    assert sorted(map(str, again.collect())) == sorted(map(str, after.collect()))


def test_type_6(initial, updates):
    loaded = history.start_hybrid(initial, "membership", "2026-01-01")
    assert tuple(history.version_counts(loaded).first()) == (5, 5, 0)
    after = history.apply_hybrid(loaded, updates, "customer_id", "membership", OTHERS)
    assert after.columns == loaded.columns
    rows = [(r.current_membership, r.previous_membership, r.historical_membership, r.expiry_date, r.is_current)
            for r in history.history_of(after, "customer_id", [101]).collect()]
    assert rows == [("Silver", None, "Silver", date(2026, 3, 31), False),
                    ("Gold", "Silver", "Gold", OPEN, True)]
    assert tuple(history.version_counts(after).first()) == (8, 5, 3)
    current = {r.customer_id: (r.current_membership, r.previous_membership)
               for r in history.current_rows(after).collect()}
    assert current == {101: ("Gold", "Silver"), 102: ("Gold", None), 103: ("Gold", "Silver"),
                       104: ("Platinum", "Gold"), 105: ("Bronze", None)}


def test_type_6_second_change_adds_one_version(initial, updates):
    loaded = history.start_hybrid(initial, "membership", "2026-01-01")
    once = history.apply_hybrid(loaded, updates, "customer_id", "membership", OTHERS)
    later = updates.filter("customer_id = 101").withColumns({
        "membership": F.lit("Platinum"), "effective_date": F.lit("2026-09-01").cast("date")})
    twice = history.apply_hybrid(once, later, "customer_id", "membership", OTHERS)
    rows = [(r.current_membership, r.previous_membership)
            for r in history.history_of(twice, "customer_id", [101]).collect()]
    assert rows == [("Silver", None), ("Gold", "Silver"), ("Platinum", "Gold")]


def test_version_faults(spark):
    bad = spark.createDataFrame([
        (1, "2026-01-01", "2026-03-01", False), (1, "2026-02-01", "9999-12-31", True),
        (2, "2026-01-01", "9999-12-31", True), (2, "2026-01-01", "9999-12-31", True),
        (3, "2026-01-01", "2025-01-01", False),
        (4, "2026-01-01", "2026-01-31", False), (4, "2026-02-01", "9999-12-31", True),
    ], "id int, a string, b string, is_current boolean").select(
        "id", F.to_date("a").alias("effective_date"), F.to_date("b").alias("expiry_date"), "is_current")
    assert table(history.version_faults(bad, "id"), "id", "fault") == [
        (1, "overlapping versions"), (2, "not exactly one current version"),
        (2, "overlapping versions"), (3, "expiry before start"), (3, "not exactly one current version")]


def test_null_is_a_key_of_versions(spark):
    """Applied twice, a batch with a NULL key and several changes a key adds nothing the second time."""
    d = lambda n: date(2020, 1, n)
    start = history.start_versions(spark.createDataFrame([(1, "a"), (None, "n"), (3, None)], "id int, v string"), "2019-01-01")
    batch = spark.createDataFrame([(None, "m", d(2)), (1, "a", d(3)), (1, "b", d(4)), (1, "b", d(5)), (1, "c", d(6)),
                                   (2, "new", d(7)), (3, None, d(8)), (None, "m", d(9))], "id int, v string, effective_date date")
    once = history.apply_versions(start, batch, "id", ["v"])
    rows = sorted(map(tuple, once.select("id", "v", "effective_date", "expiry_date", "is_current").collect()), key=repr)
    assert rows == sorted([
        (1, "a", date(2019, 1, 1), d(3), False), (1, "b", d(4), d(5), False), (1, "c", d(6), OPEN, True),
        (2, "new", d(7), OPEN, True), (3, None, date(2019, 1, 1), OPEN, True),
        (None, "n", date(2019, 1, 1), d(1), False), (None, "m", d(2), OPEN, True)], key=repr)
    twice = history.apply_versions(once, batch, "id", ["v"])
    assert sorted(map(tuple, twice.select(once.columns).collect()), key=repr) == sorted(map(tuple, once.collect()), key=repr)
    hybrid = history.start_hybrid(spark.createDataFrame([(None, "n")], "id int, v string"), "v", "2019-01-01")
    first = history.apply_hybrid(hybrid, batch.filter("id is null"), "id", "v")
    second = history.apply_hybrid(first, batch.filter("id is null"), "id", "v")
    assert sorted(map(tuple, first.collect()), key=repr) == sorted(map(tuple, second.collect()), key=repr)
    assert first.filter("is_current").select("previous_v").first()[0] == "n"
