"""The law of the matrix and of whole shuffles, large urns, and the query's shards."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np

from orograph.llm import sharding


def test_large_urns_have_the_exact_law():
    rng = np.random.default_rng(1)
    good, bad, n = 2 * 10**9, 5 * 10**9, 7
    got = Counter(sharding._draw(rng, good, bad, n) for _ in range(20_000))
    for k in range(n + 1):
        p = math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n)
        assert abs(got[k] / 20_000 - p) < 5 * math.sqrt(p * (1 - p) / 20_000) + 1e-9
    draws = np.array([sharding._draw(rng, 3 * 10**9, 10**9, 50_000) for _ in range(3000)])
    assert abs(draws.mean() - 37_500) < 10 and abs(draws.var() / (50_000 * 0.75 * 0.25 * (4 * 10**9 - 50_000) / (4 * 10**9 - 1)) - 1) < 0.15
    assert sharding._draw(rng, 10**10, 0, 5) == 5 and sharding._draw(rng, 0, 10**10, 5) == 0 and sharding._draw(rng, 10**10, 3, 10**10) >= 10**10 - 3


def test_places_are_uniform(spark):
    """Over many seeds each row is in each place about equally often, also the first row in the first place."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(12)], "doc_id long, text string")
    places = Counter()
    for seed in range(16):
        for r in sharding.shuffled(docs, shards=3, seed=seed, part_rows=4).collect():
            places[r["doc_id"], r["shard"]] += 1
    assert all(0 < places[i, s] < 15 for i in range(12) for s in range(3))


def test_query_slots_are_gapless_and_sizes_exact(spark, sf):
    rows = sharding.op2_hypergeometric(spark, sf).collect()
    by_shard = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(16)}
    assert all(slots == list(range(len(slots))) for slots in by_shard.values())
    sizes = [len(slots) for slots in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_clashing_names(spark):
    rows = [(i, f"t{i}", i, i, i, i) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __part int, __order int, shard int, slot int")
    out = sharding.sharded(docs, shards=2).collect()
    assert sorted(tuple(r["row"]) for r in out) == rows
