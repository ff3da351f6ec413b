"""How many of a segment's best BM25 neighbours are in its shard, against all segments."""

import numpy as np

from tallyhouse.llm import packing, queries
from tallyhouse.llm.tokens import word_ids


def share_of_neighbours(spark, rows):
    plan = packing.Packing(shard_tokens=1 << 15)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").orderBy("doc_id").limit(rows)
    told = packing._sampled(docs, queries.WORD_VOCABULARY, 2, plan)
    found = packing._segments(docs, queries.WORD_VOCABULARY, 2, plan, told).collect()
    dtype = word_ids(queries.WORD_VOCABULARY, plan.words).dtype
    ids = [np.frombuffer(r.ids, dtype) for r in found]
    lengths = np.array(list(map(len, ids)))
    terms = [np.unique(x) for x in ids]
    df = np.bincount(np.concatenate(terms))
    idf = np.log(1 + (len(ids) - df + 0.5) / (df + 0.5))
    index = packing.ShardIndex(ids, idf, lengths.mean(), plan)
    shards = int(np.ceil(lengths.sum() / plan.shard_tokens))
    seeds = np.random.default_rng(1).choice(len(ids), 300, replace=False)
    best = []
    for seed in seeds:
        scores = index.scores(seed)
        scores[seed] = -1
        best.append(np.argsort(-scores, kind="stable")[:10])

    def shared(places):
        shard = np.empty(len(ids), int)
        order = np.argsort(places, kind="stable")
        shard[order] = np.minimum(np.cumsum(lengths[order]) * shards // lengths.sum(), shards - 1)
        return np.mean([(shard[near] == shard[seed]).mean() for seed, near in zip(seeds, best)])

    mixed = packing._mixed(np.arange(len(df)))
    of_all_terms = np.array([int(mixed[x].min()) << 31 | r.place & 0x7FFF for x, r in zip(terms, found)])
    now, before = shared(np.array([r.place for r in found])), shared(of_all_terms)
    print(f"{rows} rows, {shards} shards: {now:.4f}; by one min-hash of all terms {before:.4f}; by chance {1 / shards:.4f}")
    return now, before, 1 / shards


def test_neighbours_share_a_shard_at_every_size(spark):
    small, before_small, _ = share_of_neighbours(spark, 1000)
    large, before, chance = share_of_neighbours(spark, 4000)
    assert small > before_small and large > 2 * before and large > 5 * chance
    assert large > 0.8 * small  # four times the shards, and about as many neighbours in one


def test_frequencies_are_those_of_all_documents(spark):
    """More documents than the 10,000 that once gave the frequencies: each of them counts."""
    docs = spark.range(12_000).selectExpr("id as doc_id", "'the same line' as text")
    frequencies, n, mean = packing._sampled(docs, queries.WORD_VOCABULARY, 2, packing.Packing())
    assert n == 12_000 and set(frequencies.values()) == {12_000} and mean >= 2
