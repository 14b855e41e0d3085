"""Exact Hamming search: all pairs of distinct 64-bit hashes within a radius.

Distinct hashes are dealt to tiles, and each pair of tiles is a group of its own. Within a group,
hashes are cut to radius + k blocks, of which two within the radius agree in at least k; each k of
them make a key, and only hashes that share a key are compared, in numpy. The k with the fewest
comparisons is taken, counted on the group's own hashes; none is taken where keys don't pay.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILES = 16  # a hash is copied this many times; a group holds two of so many parts of the hashes
CHUNK = 1 << 16  # comparisons at once
BUCKET, SORTED = 6000, 80  # what a bucket and a sorted hash cost, in comparisons

Found = Iterator[tuple[np.ndarray, np.ndarray]]


def key_masks(radius: int, agree: int) -> list[np.uint64]:
    """Masks of the bits of each key: every `agree` of radius + agree blocks."""
    blocks = radius + agree
    edges = [round(k * 64 / blocks) for k in range(blocks + 1)]
    masks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    return [np.uint64(sum(some)) for some in combinations(masks, agree)]


def _buckets(a: np.ndarray, b: np.ndarray, mask: np.uint64) -> tuple:
    """Places of a and b by key, and where the keys that both have begin and end."""
    sides = []
    for x in (a, b):
        key = x & mask
        order = np.argsort(key, kind="stable")
        values, start, n = np.unique(key[order], return_index=True, return_counts=True)
        sides.append((order, values, start, start + n))
    (a_order, a_values, a_start, a_end), (b_order, b_values, b_start, b_end) = sides
    _, i, j = np.intersect1d(a_values, b_values, assume_unique=True, return_indices=True)
    return a_order, b_order, a_start[i], a_end[i], b_start[j], b_end[j]


def _compare(a: np.ndarray, b: np.ndarray, radius: int) -> Found:
    """Places of all pairs within the radius."""
    width = max(1, min(len(b), CHUNK))
    height = max(1, CHUNK // width)
    for low in range(0, len(a), height):
        for left in range(0, len(b), width):
            part = b[left : left + width]
            hits = np.flatnonzero(np.bitwise_count(a[low : low + height, None] ^ part) <= radius)
            if len(hits):
                i, j = np.divmod(hits, len(part))
                yield i + low, j + left


def _agreement(a: np.ndarray, b: np.ndarray, radius: int) -> int:
    """How many blocks a key has; 0: no keys."""
    best, least = 0, len(a) * len(b)
    for agree in (1, 2):
        if radius + agree > 64 or len(key_masks(radius, agree)) * SORTED * (len(a) + len(b)) > least / 4:
            continue
        cost = 0
        for mask in key_masks(radius, agree):
            *_, a_start, a_end, b_start, b_end = _buckets(a, b, mask)
            cost += int(((a_end - a_start) * (b_end - b_start)).sum()) + BUCKET * len(a_start) + SORTED * (len(a) + len(b))
            if cost >= least:
                break
        else:
            best, least = agree, cost
    return best


def near_places(a: np.ndarray, b: np.ndarray, radius: int) -> Found:
    """Places of all pairs of a and b (uint64) within the radius, each pair once: by the first key
    that it shares."""
    agree = _agreement(a, b, radius)
    if not agree:
        yield from _compare(a, b, radius)
        return
    masks = key_masks(radius, agree)
    for k, mask in enumerate(masks):
        a_order, b_order, *ends = _buckets(a, b, mask)
        a_by_key, b_by_key = a[a_order], b[b_order]
        for a_start, a_end, b_start, b_end in zip(*(e.tolist() for e in ends), strict=True):
            for i, j in _compare(a_by_key[a_start:a_end], b_by_key[b_start:b_end], radius):
                i, j = a_order[i + a_start], b_order[j + b_start]
                differ = a[i] ^ b[j]
                new = np.ones(len(i), bool)
                for earlier in masks[:k]:
                    new &= differ & earlier != 0
                if new.any():
                    yield i[new], j[new]


def _batches(a: np.ndarray, b: np.ndarray, radius: int, once: bool) -> Iterator[pa.RecordBatch]:
    """The pairs found as rows, as many at once as fit a batch; `once`: a is b, and a pair comes in one order."""

    def batch() -> pa.RecordBatch:
        x, y = (np.concatenate(side) for side in zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), pa.array(np.bitwise_count(x ^ y).astype(np.int32))], ["hash_a", "hash_b", "distance"])

    held, n = [], 0
    for i, j in near_places(a, b, radius):
        if once:
            i, j = i[i < j], j[i < j]
        held.append((a[i], b[j]))
        n += len(i)
        if n >= CHUNK:
            yield batch()
            held, n = [], 0
    if n:
        yield batch()


def near_hashes(left: DataFrame, right: DataFrame | None, radius: int, tiles: int = TILES) -> DataFrame:
    """left (hash), right (hash), each hash once -> hash_a, hash_b, distance of all pairs within the
    radius. Without right, the pairs of left with itself: each in one order, none of a hash with itself.

    Rows are few bytes and comparisons are the work, so the groups' number of partitions is fixed."""
    tile = F.pmod(F.xxhash64("hash"), F.lit(tiles)).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("other")
    place = lambda row, column: (row * tiles + column).alias("tile")

    def dealt(df: DataFrame) -> DataFrame:
        return df.select("hash").where("hash is not null").select("hash", tile.alias("own"), others)

    own, other = F.col("own"), F.col("other")
    if right is None:
        rows = dealt(left).select(place(F.least(own, other), F.greatest(own, other)), (own > other).alias("second"), "hash")
    else:
        rows = dealt(left).select(place(own, other), F.lit(False).alias("second"), "hash").unionByName(dealt(right).select(place(other, own), F.lit(True).alias("second"), "hash"))
    alone = right is None

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(batches)
        hashes, second = (group.column(c).to_numpy() for c in ("hash", "second"))
        a, b = (np.sort(hashes[second == side].view(np.uint64)) for side in (False, True))
        row, column = divmod(key[0].as_py(), tiles)
        once = alone and row == column
        yield from _batches(a, a if once else b, radius, once)

    groups = tiles * (tiles + 1) // 2 if alone else tiles * tiles
    return rows.repartition(groups, "tile").groupBy("tile").applyInArrow(run, "hash_a long, hash_b long, distance int")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("int")


# Joins with the pairs found are sort-merge joins: the planner takes the pairs to be as few as the
# hashes and would send them to the driver.


def hamming_join(left: DataFrame, right: DataFrame, radius: int) -> DataFrame:
    """left (id_a, hash_a), right (id_b, hash_b) -> pairs within the radius, with their distance."""
    distinct = [df.select(F.col(c).alias("hash")).distinct() for df, c in ((left, "hash_a"), (right, "hash_b"))]
    near = near_hashes(*distinct, radius)
    pairs = near.join(left.select("id_a", "hash_a").hint("merge"), "hash_a").join(right.select("id_b", "hash_b").hint("merge"), "hash_b")
    return pairs.select("id_a", "id_b", "hash_a", "hash_b", "distance")


def hamming_self_join(items: DataFrame, radius: int) -> DataFrame:
    """items (id, hash) -> id_a < id_b, distance of all pairs of rows within the radius."""
    rows = items.where("id is not null and hash is not null")
    hashes = rows.select("hash").distinct()
    near = near_hashes(hashes, None, radius).unionByName(hashes.select(F.col("hash").alias("hash_a"), F.col("hash").alias("hash_b"), F.lit(0).alias("distance")))
    a, b = (rows.select(F.col("id").alias(f"id_{x}"), F.col("hash").alias(f"hash_{x}")) for x in "ab")
    pairs = near.join(a.hint("merge"), "hash_a").join(b.hint("merge"), "hash_b")
    # Two hashes come in one order, so that either id may be the less; a hash with itself gives both orders.
    pairs = pairs.where((F.col("id_a") < F.col("id_b")) | ((F.col("id_a") > F.col("id_b")) & (F.col("hash_a") != F.col("hash_b"))))
    return pairs.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "distance")


def neighbours(items: DataFrame, radius: int) -> DataFrame:
    """items (id, hash) -> of each id with others within the radius: n_near, the pairs of its rows and
    theirs, and nearest, the least distance. Equal hashes are counted, not expanded."""
    rows = items.where("id is not null and hash is not null")
    groups = rows.groupBy("hash").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    near = near_hashes(groups, None, radius)
    end = lambda x, y: F.struct(F.col(x).alias("hash"), F.col(y).alias("other"), "distance")
    ends = near.select(F.inline(F.array(end("hash_a", "hash_b"), end("hash_b", "hash_a")))).unionByName(groups.select("hash", F.col("hash").alias("other"), F.lit(0).alias("distance")))
    levels = ends.join(groups.withColumnRenamed("hash", "other").hint("merge"), "other").groupBy("hash", "distance").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    around = levels.groupBy("hash").agg(F.sum("n").alias("n"), F.collect_list(F.struct("distance", "low", "high")).alias("levels"))  # a level a distance, at most
    of_others = F.filter("levels", lambda x: (x["low"] != F.col("id")) | (x["high"] != F.col("id")))
    found = rows.join(around.hint("merge"), "hash").select("id", "hash", "n", F.array_min(F.transform(of_others, lambda x: x["distance"])).alias("nearest"))
    ids = found.groupBy("id").agg(F.sum("n").alias("n"), F.min("nearest").alias("nearest"), F.collect_list("hash").alias("own"))
    # An id's own rows are no neighbours of each other.
    same = F.aggregate("own", F.lit(0).cast("long"), lambda s, x: s + F.size(F.filter("own", lambda y: hamming(x, y) <= radius)))
    return ids.select("id", (F.col("n") - same).alias("n_near"), "nearest").where("n_near > 0")


def first_match(queries: DataFrame, index: DataFrame, radius: int) -> DataFrame:
    """For each query (id_a, hash_a) the entry of the index (id_b, hash_b, seq) within the radius
    that was inserted first; not the nearest. Equal hashes of the index are counted, not expanded."""
    order = F.when(F.col("seq").isNotNull(), F.struct("seq", "id_b"))
    entries = index.where("id_b is not null").groupBy("hash_b").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    near = near_hashes(queries.select(F.col("hash_a").alias("hash")).distinct(), entries.select(F.col("hash_b").alias("hash")), radius)
    hit = F.struct("first", F.col("distance").alias("distance"))
    best = near.join(entries.hint("merge"), "hash_b").groupBy("hash_a").agg(F.min_by(hit, "first").alias("hit"), F.sum("n").alias("n"))
    found = queries.select("id_a", "hash_a").join(best.hint("merge"), "hash_a").groupBy("id_a").agg(F.min_by("hit", "hit.first").alias("hit"), F.sum("n").alias("n_within"))
    return found.select("id_a", F.col("hit.first.id_b").alias("match_id"), F.col("hit.distance").alias("distance"), "n_within")
