"""Facts with the version of their day; stored dashboards; totals that follow deletes."""

import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import asof
from tallyhouse.operators.changes import changes_at, net_changes, present_at, row_spans, state_of
from tallyhouse.operators.stored_totals import Dashboard, Maintained
from tallyhouse.operators.totals import key_profile
from tallyhouse.session import new_table_path, written

D = date(2020, 1, 1)


def plain_asof(facts, versions):
    """The greatest of the versions that begin latest, unless it has ended."""
    for key, day in facts:
        known = [v for v in versions if None not in (key, day, v[0], v[1]) and v[0] == key and v[1] <= day]
        if known:
            since = max(v[1] for v in known)
            version = max((v for v in known if v[1] == since), key=lambda v: (v[2] is not None, v[2] or D, v[3]))
            if version[2] is None or day <= version[2]:
                yield key, day, version[3]
                continue
        yield key, day, None


@pytest.mark.parametrize("days", [1, 30, 366])
@pytest.mark.parametrize("until", [None, "until"])
def test_asof_join(spark, days, until):
    draw = random.Random(7)
    day = lambda: D + timedelta(draw.randrange(900))
    versions = [(draw.choice([1, 1, 1, 2, 3, None]), draw.choice([day(), day(), None]), None, f"v{i}") for i in range(60)]
    versions = [(k, s, s + timedelta(draw.randrange(200)) if until and s and draw.random() < .7 else None, v) for k, s, _, v in versions]
    facts = [(draw.choice([1, 1, 1, 2, 3, 4, None]), draw.choice([day(), day(), day(), None])) for _ in range(300)] * 2
    left = spark.createDataFrame(facts, "k int, day date")
    right = spark.createDataFrame(versions, "k int, since date, until date, name string")
    found = asof.asof_join(left, right, "k", "day", ["name"], "since", until, days=days)
    assert Counter(map(tuple, found.collect())) == Counter(plain_asof(facts, versions))
    inner = asof.asof_join(left, right, "k", "day", ["name"], "since", until, how="inner", days=days)
    assert Counter(map(tuple, inner.collect())) == Counter(r for r in plain_asof(facts, versions) if r[2])


def test_asof_of_nothing_and_clashes(spark):
    left, right = spark.createDataFrame([(1, D)], "k int, day date"), spark.createDataFrame([(1, D, "x")], "k int, since date, name string")
    join = lambda a, b: asof.asof_join(a, b, "k", "day", ["name"], "since").collect()
    assert join(left.limit(0), right) == [] and [tuple(r) for r in join(left, right.limit(0))] == [(1, D, None)]
    with pytest.raises(ValueError):
        join(left.withColumn("name", F.lit("own")), right)


def test_hot_key_is_dealt_by_spans(spark):
    """One key with all facts: its rows go to as many partitions as it has spans, up to the shuffle's."""
    facts = spark.range(4000).select(F.lit(1).alias("k"), F.date_add(F.lit(D), (F.col("id") % 1460).cast("int")).alias("day"))
    versions = spark.range(48).select(F.lit(1).alias("k"), F.date_add(F.lit(D), (F.col("id") * 30).cast("int")).alias("since"), F.col("id").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        found = asof.asof_join(facts, versions, "k", "day", ["name"], "since", days=60)
        used = [r[1] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(used) == 4000 and len(used) > 4 and max(used) < 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_key_profile_of_all_types(spark):
    rows = [(1, -5, D, "a"), (1, 40_000, None, "b"), (None, 0, D, "a"), (3_000_000_000, -5, D + timedelta(1), None)]
    df = spark.createDataFrame(rows, "i long, j int, d date, s string")
    keys = {"n_s": "s", "n_i": "i", "n_j": "j", "n_d": "d"}
    found = key_profile(df, keys, "rows")
    assert found.columns == ["rows", *keys] and tuple(found.first()) == (4, 2, 2, 3, 2)
    assert tuple(key_profile(df.limit(0), keys, "rows").first()) == (0, 0, 0, 0, 0)
    assert tuple(key_profile(df, {"n_s": "s"}, "rows").first()) == (4, 2)
    whole = key_profile(df, {"n_i": "i", "n_j": "j", "n_d": "d"}, "rows")._jdf.queryExecution().executedPlan().toString()
    assert whole.count("Scan ExistingRDD") == 1 and "Expand" not in whole


def test_dashboard_takes_batches(spark):
    schema = "g string, k long, day date, v int"
    batches = {"1": [("a", 1, D, 5), ("a", 2, D, None), (None, 1, D, 1)], "2": [("a", 2, D, 7), ("b", 99_999, None, None)], "3": []}
    board = Dashboard(new_table_path(spark, "board"), ["g"], "rows", {"total": "v"}, {"mean": "v"}, {"keys": "k", "days": "day"})
    for name in ("1", "2", "3", "2"):
        board.add(spark.createDataFrame(batches[name], schema), name)
    assert {tuple(r) for r in board.read(spark).collect()} == {
        ("a", 3, 12, 6.0, 2, 1), ("b", 1, None, None, 1, 0), (None, 1, 1, 1.0, 1, 1)}
    board.add(spark.createDataFrame([("b", 1, D, 2)], schema), "2")
    assert {tuple(r) for r in board.read(spark).collect()} == {
        ("a", 2, 5, 5.0, 2, 1), ("b", 1, 2, 2.0, 1, 1), (None, 1, 1, 1.0, 1, 1)}


def totals_of(state):
    groups = defaultdict(list)
    for _, g, v in state:
        groups[g].append(v)
    told = lambda f, vs: f(vs) if vs else None
    return {(g, len(vs), told(sum, w := [v for v in vs if v is not None]), told(min, w), told(max, w)) for g, vs in groups.items()}


def test_maintained_totals_follow_random_changes(spark):
    """Random states in a row: every version's totals equal those of its state, whichever rows left."""
    draw = random.Random(3)
    kept = Maintained(new_table_path(spark, "kept"), ["g"], "rows", {"total": "v"}, {"low": ("min", "v"), "high": ("max", "v")})
    states = [{}]
    for _ in range(5):
        rows = dict(states[-1])
        for key in draw.sample(range(12), 6):
            rows.pop(key, None)
            if draw.random() < .55:
                rows[key] = (draw.choice(["a", "b", None]), draw.choice([None, 1, 2, 3, 9]))
        states.append(rows)
    states.append({})
    states.append({1: ("a", 4)})
    frames = [spark.createDataFrame([(k, *r) for k, r in state.items()], "k int, g string, v int") for state in states]
    for version in range(1, len(states)):
        for _ in range(1 + version % 2):
            kept.apply(net_changes(frames[version - 1], frames[version], ["k"]), version, frames[version])
    for version in range(1, len(states)):
        assert {tuple(r) for r in kept.read(spark, version).collect()} == totals_of([(k, *r) for k, r in states[version].items()])
    assert {tuple(r) for r in kept.read(spark).collect()} == {("a", 1, 4, 4, 4)}


def test_spans_give_every_state_and_change_of_a_log(spark):
    """Random logs with null keys and two inserts in one version: filters of the spans equal what the log gives."""
    draw = random.Random(5)
    entries = [(draw.choice([None, *range(9)]), draw.choice([None, 1, 2]), draw.choice("ID"), draw.randint(1, 5)) for _ in range(60)]
    log = spark.createDataFrame(entries, "k int, v int, op string, version long")
    spans = row_spans(log, ["k"])
    bag = lambda df: Counter(tuple(r) for r in df.select("k", "v").collect())
    for version in range(6):
        assert bag(present_at(spans, version)) == bag(state_of(log, ["k"], version))
        feed = changes_at(spans, version)
        before, after = (bag(present_at(spans, v)) for v in (version - 1, version))
        came, went = (bag(feed.filter(F.col("action") == action)) for action in ("INSERT", "DELETE"))
        before.update(came)
        assert before - went == after and sum(before.values()) - sum(went.values()) == sum(after.values())
    stored = written(spans, "spans")
    assert "Exchange" not in changes_at(stored, 3)._jdf.queryExecution().executedPlan().toString()
