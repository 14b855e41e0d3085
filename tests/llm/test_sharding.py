"""The hash tree: growth moves rows only into the new shard, weights are kept, slots have no gaps."""

import hashlib
import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from gleanery.llm.sharding import Node, place, shard_documents, shard_tree

ROWS = [(k, "ü" * (k % 7)) for k in range(3000)] + [(None, None), (None, "x"), (5, "again"), (9000, "v" * 100_000)]


def test_contract(spark):
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in ROWS], "doc_id long, text string, shard string, slot int").repartition(7)
    out = shard_documents(df, 24, rows_per_block=20).collect()
    assert len(out) == len(ROWS)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ROWS)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want
    by_shard = {}
    for r in out:
        by_shard.setdefault(r.shard, []).append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 24)
    assert set(by_shard) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    moved = sum(r.grown_shard == 24 for r in out)
    assert 0.5 / 25 < moved / len(out) < 2 / 25
    again = {(r.doc_id, r["size"]): r.shard for r in shard_documents(df.repartition(2), 24, rows_per_block=1000).collect()}
    assert all(again[r.doc_id, r["size"]] == r.shard for r in out)


def test_each_growth_is_confined(spark):
    ids = spark.range(2000).withColumn("k", F.col("id").cast("string"))
    for n in (1, 2, 5, 11, 23, 24, 25, 30):
        rows = ids.select(place(F.col("k"), shard_tree(n)).alias("a"), place(F.col("k"), shard_tree(n + 1)).alias("b"))
        assert rows.where(f"a <> b and b <> {n}").count() == 0
        assert rows.where(f"a < 0 or a >= {n}").count() == 0


def test_weights_and_confinement(spark):
    def tree(w):
        return (Node("r0", 3.0, (Node("k0", 3.0, (Node("s0", 1.0, shard=0), Node("s1", 2.0, shard=1))),)), Node("r1", 1.0 + w, (Node("k1", w, (Node("s2", w, shard=2),)), Node("k2", 1.0, (Node("s3", 1.0, shard=3),)))))

    ids = spark.range(8000).withColumn("k", F.col("id").cast("string"))
    out = ids.select(place(F.col("k"), tree(2.0)).alias("a"), place(F.col("k"), tree(4.0)).alias("b"))
    share = {r.a: r["count"] / 8000 for r in out.groupBy("a").count().collect()}
    assert all(abs(share[s] - w / 6) < 0.03 for s, w in ((0, 1), (1, 2), (2, 2), (3, 1)))
    assert out.where("a <> b and b in (0, 1)").count() == 0  # only into the subtree that gained


def test_brute_force(spark):
    """Level by level, with hashes and logarithms of Python."""

    def draw(key, node, path=""):
        path += node.name
        if node.shard is not None:
            u = (int(hashlib.md5(f"{key}:{path}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return -math.log(u) / node.weight
        return min(draw(key, c, path + "/") for c in node.children)

    def descend(key, nodes, path=""):
        best = min(nodes, key=lambda n: draw(key, n, path))
        return best.shard if best.shard is not None else descend(key, best.children, path + best.name + "/")

    rows = ROWS[:400] + ROWS[3000:]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = []
    for i, t in rows:
        key, data = "" if i is None else str(i), (t or "").encode()
        turn = int(hashlib.md5(f"{key}:{len(data) + 8}:{zlib.crc32(data)}".encode()).hexdigest()[:13], 16)
        want.append((descend(key, shard_tree(24)), turn, i, descend(key, shard_tree(25))))
    slots = Counter()
    expected = []
    for shard, turn, i, grown in sorted(want, key=lambda r: (r[0], r[1], r[2] or 0)):
        expected.append((str(i), shard, slots[shard], grown))
        slots[shard] += 1
    assert sorted((str(r.doc_id), r.shard, r.slot, r.grown_shard) for r in shard_documents(df, rows_per_block=5).collect()) == sorted(expected)


def test_equal_rows_are_dealt_out(spark):
    df = spark.range(4000).selectExpr("case when id % 3 = 0 then null else id end as doc_id", "case when id % 3 = 0 then 'x' else repeat('y', cast(id % 5 as int)) end as text")
    out = shard_documents(df, 24, rows_per_block=1).collect()
    by_shard = {}
    for r in out:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert len(out) == 4000 and all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_empty(spark):
    assert shard_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
