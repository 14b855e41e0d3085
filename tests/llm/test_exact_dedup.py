"""Exact dedup against brute force, with nulls, ties, collisions and a hot group."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gleanery.llm.exact_dedup import exact_dedup

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def brute(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append((k, i))
    out = []
    for t, members in groups.items():
        ids = [i for _, i in members if i is not None]
        keep = min(ids) if ids else None
        out += [(i, keep, len(members), i == keep, hashlib.sha256(t.encode()).hexdigest()) for _, i in members]
    return sorted(map(str, out))


ROWS = [(1, "a  b"), (2, "a b"), (3, "a\tb"), (4, "a\xa0b"), (5, None), (6, ""), (None, "x"), (7, "x"), (None, "lone"), (8, "ü" * 5000), (9, "ü" * 5000), (10, " a b"), (11, "c"), (11, "c"), (12, "\x0b\x0c"), (13, " "), (None, "n"), (None, "n")]
ROWS += [(100 + k, "hot text\nof many") for k in range(500)]


@pytest.mark.parametrize("digest_bytes", [32, 1])
@pytest.mark.parametrize("filter_bits", [1 << 15, 1 << 18])
def test_brute_force(spark, digest_bytes, filter_bits):
    rows = ROWS + [(1000 + k, f"text {k % 150}") for k in range(300)]
    df = spark.createDataFrame([(t, "x", i, "y") for i, t in rows], "text string, keep_id string, doc_id long, digest string").repartition(5)
    out = exact_dedup(df, digest_bytes=digest_bytes, filter_bits=filter_bits, copies_per_task=64, memtable=17)
    assert out.columns == COLUMNS
    assert sorted(str(tuple(r)) for r in out.collect()) == brute(rows)


def test_empty(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_index_grows_by_runs(spark):
    from gleanery.llm.common import scratch_path
    from gleanery.llm.exact_dedup import DigestIndex

    index = DigestIndex(spark, scratch_path(spark, "t"))
    flush = lambda rows: index.flush(spark.createDataFrame([(bytearray(d), i) for d, i in rows], "digest binary, doc_id long"))
    flush([(b"a", 5), (b"b", 2)])
    flush([(b"a", 3)])
    index.compact()
    flush([(b"a", 9), (b"c", 1)])
    index.compact()
    assert {(bytes(r.digest), r.keep_id, r.n) for r in index.entries().collect()} == {(b"a", 3, 3), (b"b", 2, 1), (b"c", 1, 1)}
    probes = spark.createDataFrame([(bytearray(b"a"),), (bytearray(b"z"),)], "digest binary")
    probes = probes.withColumn("text", F.lit("t"))
    found = index.lookup(probes, F.xxhash64("text"))
    assert {(bytes(r.digest), r.keep_id, r.n, r.text) for r in found.collect()} == {(b"a", 3, 3, "t")}
    assert "bitmap" in found._jdf.queryExecution().toString()


def test_runs_are_memtables_and_levels_are_sorted(spark):
    from gleanery.llm.common import scratch_path
    from gleanery.llm.exact_dedup import DigestIndex

    index = DigestIndex(spark, scratch_path(spark, "t"), memtable=50)
    entries = spark.range(0, 1000, 1, 4).select(F.unhex(F.sha2((F.col("id") % 700).cast("string"), 256)).alias("digest"), F.col("id").alias("doc_id"))
    index.flush(entries)
    runs = spark.read.parquet(*index.runs)
    assert runs.select("run").distinct().count() == 20 and runs.groupBy("run").agg(F.sum("n").alias("s")).where("s <> 50").count() == 0
    index.compact()
    level = [(r.f, bytes(r.digest)) for r in index.entries().select(F.input_file_name().alias("f"), "digest").collect()]
    ranges = {}
    for f, d in level:
        ranges.setdefault(f, []).append(d)
    assert all(x == sorted(x) for x in ranges.values())
    spans = sorted((x[0], x[-1]) for x in ranges.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False)) and len(level) == 700
