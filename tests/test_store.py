"""Index versions, listings, uploads with retries, model extraction."""

import gzip

import numpy as np
from pyspark.sql import functions as F

from gleanery.functions import image
from gleanery.operators import filters, models
from gleanery.sources import store


def test_index_versions(spark, tmp_path):
    path = str(tmp_path / "index")
    empty = store.load_index(spark, path)
    assert all(t.count() == 0 for t in empty.values())
    one = empty | {"seen_ids": spark.createDataFrame([("a", 1)], "id string, seq long")}
    store.save_index(spark, path, one)
    (tmp_path / "index" / "v99999999999999999999-dead").mkdir()  # a job that died
    again = store.load_index(spark, path)
    assert [r.id for r in again["seen_ids"].collect()] == ["a"]
    store.save_index(spark, path, again | {"seen_ids": again["seen_ids"].unionByName(spark.createDataFrame([("b", 2)], "id string, seq long"))})
    assert sorted(r.id for r in store.load_index(spark, path)["seen_ids"].collect()) == ["a", "b"]


def test_listing(spark, tmp_path):
    for name in ("a.json.gz", "b.json.gz"):
        (tmp_path / name).write_bytes(gzip.compress(b"{}"))
    (tmp_path / "c.txt").write_text("x")
    assert sorted(r.name for r in store.list_files(spark, str(tmp_path)).collect()) == ["a.json.gz", "b.json.gz"]


def test_upload_retries_and_attaches(spark):
    def put(row):
        if row["k"] == "bad":
            raise OSError("refused")
        return f"https://h/{row['k']}"

    items = spark.createDataFrame([("a",), ("bad",)], "k string")
    results = store.upload(items, put, "k", sleep=lambda s: None)
    out = {r.id: (r.success, r.attempts, r.error) for r in results.collect()}
    assert out == {"a": (True, 1, None), "bad": (False, 3, "refused")}
    assert {(r.k, r.url) for r in store.attach_urls(items, results, "k").collect()} == {("a", "https://h/a"), ("bad", "")}


def test_extraction_resumes(spark):
    def load():
        def infer(batch):
            if any(x is None for x in batch):
                raise ValueError("undecodable")
            return np.array([[len(x), 1.0] for x in batch])

        return infer

    items = spark.createDataFrame([(1, "ab"), (2, "abc")], "k int, c string")
    done = models.extract(items, load, "k", "c", "m")
    assert sorted((r.k, list(r.vector)) for r in done.collect()) == [(1, [2.0, 1.0]), (2, [3.0, 1.0])]
    failed = models.extract(spark.createDataFrame([(3, None)], "k int, c string"), load, "k", "c", "m")
    left = models.to_do(items.unionByName(failed.select("k", F.lit(None).cast("string").alias("c"))), done.unionByName(failed), "k", ["m", "n"])
    assert sorted((r.k, r.model) for r in left.collect()) == [(1, "n"), (2, "n"), (3, "m"), (3, "n")]
    assert spark.range(1).select(models.is_complete([F.lit(1), F.lit(None)]).alias("x")).first().x is False


def test_rejected_side_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "File too small"), (2, None)], "k int, reason string")
    store.write_rejected(df, F.when(F.col("reason").isNotNull(), filters.reason_bucket(F.col("reason"))), str(tmp_path / "r"))
    assert [(r.k, r.bucket) for r in spark.read.parquet(str(tmp_path / "r")).collect()] == [(1, "file_size")]


def test_stage_log(spark, tmp_path):
    store.log_stage(spark, str(tmp_path / "l"), "filter", [("INFO", "done")])
    store.log_stage(spark, str(tmp_path / "l"), "score", [("WARN", "slow")])
    assert spark.read.json(str(tmp_path / "l")).count() == 2


def test_pixel_sample_is_fixed():
    pixels = np.arange(30_000 * 3).reshape(100, 300, 3)
    assert len(image.pixel_sample(pixels)) == 10_000 and (image.pixel_sample(pixels) == image.pixel_sample(pixels)).all()
