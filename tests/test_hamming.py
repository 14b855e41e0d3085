"""Hamming search against nested loops."""

from collections import defaultdict

import numpy as np
import pytest
from conftest import SF

from gleanery.operators import hamming
from gleanery.plans import vector_queries


def cluster(seed, bases, copies, flips=14):
    rng = np.random.default_rng(seed)
    base = rng.integers(-(2**63), 2**63, bases)
    return [int(b) ^ sum(1 << int(x) for x in rng.choice(63, rng.integers(0, flips), replace=False)) for b in np.repeat(base, copies)]


def distance(x, y):
    return ((x ^ y) & (2**64 - 1)).bit_count()


@pytest.mark.parametrize(("radius", "agree"), [(0, 1), (3, 1), (3, 2), (10, 0), (10, 1), (10, 2), (63, 1), (64, 0)])
def test_every_number_of_key_blocks_finds_all_pairs_once(monkeypatch, radius, agree):
    monkeypatch.setattr(hamming, "_agreement", lambda *_: agree)
    monkeypatch.setattr(hamming, "CHUNK", 1000)
    a, b = (np.unique(np.array(cluster(1, 20, 30)[k::2], np.int64).view(np.uint64)) for k in (0, 1))
    found = [(int(x), int(y)) for i, j in hamming.near_places(a, b, radius) for x, y in zip(i, j, strict=True)]
    want = np.argwhere(np.bitwise_count(a[:, None] ^ b) <= radius)
    assert sorted(found) == [tuple(map(int, w)) for w in want] and found


def test_keys_are_used_where_they_pay():
    rng = np.random.default_rng(0)
    apart = rng.integers(0, 2**64, 20_000, np.uint64)
    assert hamming._agreement(apart, apart, 10) > 0 == hamming._agreement(apart[:50], apart[:50], 10)
    assert hamming._agreement(np.arange(20_000, dtype=np.uint64), np.arange(20_000, dtype=np.uint64), 10) == 0  # all share most keys


def test_pairs_and_neighbours_with_copies_and_repeated_ids(spark):
    hashes = cluster(2, 8, 12)
    rows = [(k // 2 if k % 7 == 0 else k, h) for k, h in enumerate(hashes + hashes[:20] + [hashes[0]] * 30)] + [(None, hashes[1]), (5000, None)]
    df = spark.createDataFrame(rows, "id long, hash long").repartition(3)
    whole = [r for r in rows if None not in r]
    near = [(a, b, d) for a, x in whole for b, y in whole if a != b and (d := distance(x, y)) <= 10]
    got = sorted(tuple(r) for r in hamming.hamming_self_join(df, 10).collect())
    assert got == sorted(p for p in near if p[0] < p[1])
    want = defaultdict(list)
    for a, _, d in near:
        want[a].append(d)
    assert {r.id: (r.n_near, r.nearest) for r in hamming.neighbours(df, 10).collect()} == {a: (len(d), min(d)) for a, d in want.items()}


def test_first_match_counts_copies_and_repeated_queries(spark):
    queries = spark.createDataFrame([(1, 0), (1, 0), (2, 7), (3, -1), (4, None)], "id_a long, hash_a long")
    index = spark.createDataFrame([(k, 0, 100 - k) for k in range(50)] + [(60, 1, 0), (61, None, 0)], "id_b long, hash_b long, seq long")
    out = {r.id_a: (r.match_id, r.distance, r.n_within) for r in hamming.first_match(queries, index, 10).collect()}
    assert out == {1: (60, 1, 102), 2: (60, 2, 51)}


@pytest.mark.parametrize("name", ["hamming_multi_index", "hamming_pairs", "hamming_first_match"])
def test_no_keys_or_pairs_are_sent_to_the_driver(spark, name):
    plan = getattr(vector_queries, name)(spark, SF)._jdf.queryExecution().toString()
    assert "Broadcast" not in plan
