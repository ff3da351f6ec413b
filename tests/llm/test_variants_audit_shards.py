"""Spelling variants, filter audit and shards against brute force, on the smallest tables and on hostile rows."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations, permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import audit, queries, sharding, spelling
from tallyhouse.session import new_table_path

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, slot int, bucket int, mask int, part int, h int, word int"
WORDS = "straße strasse strase colour color colors colours colouur Colour ÀÉÎÕÜ×÷ÿabc àéîõü÷abc "
ROWS = [(1, None, None), (2, "", ""), (2, "", "x"), (3, " \t ", "x"), (4, WORDS * 3, "x"), (4, WORDS * 3, "x"), (5, WORDS * 3, None),
        (None, WORDS, "y"), (None, None, None), (6, "colour " * 40_000 + "colours " * 3, "y"), (7, "x" * 100_000, "y"), (7, "ABC def", "y"),
        (8, "a$ " + "one two three " * 30, "z"), (-9, "ABC def", "z"), (10, "日本語 Ωmega İstanbul letters lettters", "z"), (11, "letters letters letter letter letter", "z")]


@pytest.fixture(scope="module")
def hostile(spark):
    return spark.createDataFrame([(i, t, "en", s, 1, "clash", 1, 1, 1, 1, 1, 1) for i, t, s in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# -- spelling variants ---------------------------------------------------------------------------

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(rows, every=97):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    links = defaultdict(list)
    by_variant = defaultdict(set)
    for w in counts:
        for key in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))} if len(w) < 1000 else {w}:
            by_variant[key].add(w)
    for pair in {p for words in by_variant.values() for p in combinations(sorted(words), 2)}:
        if near(*pair):
            links[pair[0]].append(pair[1])
            links[pair[1]].append(pair[0])
    form = {}
    for w, n in counts.items():
        best = min(links[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n, len(links[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


@pytest.mark.parametrize("block, classes", [(2048, None), (7, 2), (3, 6)])
def test_spelling_groups(spark, hostile, block, classes, monkeypatch):
    if classes:
        monkeypatch.setattr(spelling, "classes_for", lambda words: classes)
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    everything = hostile.select("doc_id", "text").union(given)
    for every in (97, 3):
        found = spelling.spelling_groups(everything, spelling.Spelling(every=every, block=block, held=50)).collect()
        assert {tuple(r) for r in found} == plain_groups(everything.collect(), every) and len(found) == len({r.word for r in found})


def test_spelling_query(spark, empty):
    found = queries.QUERIES["op11_spelling_variants"](spark, FOLDER)
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert {tuple(r) for r in found.collect()} == plain_groups(rows)
    assert spelling.spelling_groups(empty).count() == 0


def test_near_in_block_keeps_only_single_edits():
    words = ["aabb", "abab", "abba", "aabc", "aabbb", "aab", "babb", "bbaa"]
    for length in {len(w) for w in words}:
        homes = [w.encode() for w in words if len(w) == length]
        guests = [w.encode() for w in words if len(w) in (length, length - 1)]
        a, b = spelling.near_in_block(homes, guests, np.array([len(g) == length for g in guests]), rows=2)
        got = Counter(tuple(sorted((homes[x], guests[y]))) for x, y in zip(a, b))
        assert got == Counter(tuple(sorted((x.encode(), y.encode()))) for x, y in combinations(words, 2)
                              if max(len(x), len(y)) == length and near(x, y))


# -- filter audit ----------------------------------------------------------------------------------

def plain_mask(rows):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, s in rows:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0D]+", t)
        bits = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                bool(re.search("[#$%&*|]", t)), i is not None and i > first[t]]
        out.append((i, s or "", sum(b << k for k, b in enumerate(bits))))
    return out


def plain_audit(rows, labels):
    masked = plain_mask(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    result = {}
    for part in {p for _, p, _ in masked}:
        own = [(i, m) for i, p, m in masked if p == part]
        shares = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                lost, left = [r for r in left if r[1] & bit], [r for r in left if not r[1] & bit]
                fails = [r for r in own if r[1] & bit]
                shares[letter] += len(lost)
                result[part, "".join(order), step] = (letter, len(left), len(lost), len(fails) - len(lost), sum(m == bit for _, m in own),
                                                      sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost))
        for key in [k for k in result if k[0] == part]:
            result[key] = (*result[key][1:], shares[result[key][0]])
    return result


LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (4, 1, 1), (None, 1, 1), (8, None, 1), (77, 1, 1), (7, 1, 0)]


@pytest.mark.parametrize("hashed", [F.xxhash64, lambda c: F.length(c), lambda c: F.lit(5)])
@pytest.mark.parametrize("sketch", [audit.Sketch(), audit.Sketch(sent=0), audit.Sketch(counters=1)])
def test_masks(hostile, sketch, hashed):
    found = audit.masks(hostile, sketch=sketch, hashed=hashed).collect()
    assert Counter(map(tuple, found)) == Counter(plain_mask(ROWS))


def test_audit(spark, hostile, empty):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    found = audit.audit(hostile, labels).collect()
    expected = plain_audit(ROWS, LABELS)
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found} == expected and len(found) == len(expected) == 4 * 600
    assert audit.audit(empty, labels).count() == 0
    assert audit.audit(hostile, labels.limit(0)).where("good_lost > 0 or toxic_lost > 0").count() == 0


def test_sketch_clears_most_unique_texts(spark):
    """The prepass passes all repeats and few others."""
    texts = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.when(F.col("id") < 19_900, F.col("id")).otherwise(0)).alias("text"))
    keys = texts.withColumn("h", F.xxhash64("text"))
    left = {r.doc_id for r in audit._possible(keys, keys.select("h"), 20_000, audit.Sketch()).collect()}
    assert {0, *range(19_900, 20_000)} <= left and len(left) < 101 + 200


# -- shards ----------------------------------------------------------------------------------------

def check_shards(rows, shards):
    """Counts one apart at most, slots without gaps."""
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1


@pytest.mark.parametrize("plan", [sharding.Shuffle(), sharding.Shuffle(shards=3, bucket_bytes=4000), sharding.Shuffle(shards=1, bucket_bytes=1, most_buckets=5)])
def test_shards(hostile, plan):
    found = sharding.shuffled(hostile, plan).collect()
    check_shards(found, plan.shards)
    assert Counter((r.record.doc_id, r.record.text, r.record.source, r.record.shard) for r in found) == Counter((i, t, s, "clash") for i, t, s in ROWS)


def test_shards_of_nothing_and_stored(spark, empty, hostile):
    assert sharding.shuffled(empty).count() == 0
    folder = new_table_path(spark, "shards")
    rows = sharding.shuffled(hostile, sharding.Shuffle(shards=3))
    sharding.write_shards(rows, folder)
    back = spark.read.parquet(folder)
    assert Counter((r.shard, r.slot, r.record.doc_id, r.record.text) for r in back.collect()) == Counter(
        (r.shard, r.slot, r.record.doc_id, r.record.text) for r in rows.collect())


def test_shuffle_is_uniform_and_seeded(spark):
    """Places after the shuffle don't follow ids; one seed gives one order; rows with one id and text spread over all buckets."""
    docs = spark.range(0, 20_000, 1, 4).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    plan = sharding.Shuffle(shards=10, bucket_bytes=25_000)
    ids = {seed: {(r.shard, r.slot): r.record.doc_id for r in sharding.shuffled(docs, plan._replace(seed=seed)).collect()} for seed in (1, 2)}
    assert {(r.shard, r.slot): r.record.doc_id for r in sharding.shuffled(docs, plan._replace(seed=1)).collect()} == ids[1] != ids[2]
    order = np.array([ids[1][k] for k in sorted(ids[1])])
    assert sorted(order) == list(range(20_000))
    assert abs(np.corrcoef(order, np.arange(20_000))[0, 1]) < 0.03 and abs(np.corrcoef(order[:-1], order[1:])[0, 1]) < 0.03
    halves = [np.mean(order[i:i + 2000]) for i in range(0, 20_000, 2000)]
    assert max(abs(h - 10_000) for h in halves) < 6 * 5774 / 2000 ** 0.5
    copies = spark.range(0, 20_000, 1, 4).select(F.lit(1).alias("doc_id"), F.lit("same text").alias("text"))
    assert sharding.shuffled(copies, plan).count() == 20_000


def test_shard_query(spark):
    rows = queries.QUERIES["op13_shuffled_shards"](spark, FOLDER).collect()
    check_shards(rows, 40)
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        r.doc_id: (16 + len((r.text or "").encode()), zlib.crc32((r.text or "").encode())) for r in given} and len(rows) == len(given)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
