"""Run control: resume, retention, deadlines, states, and image extras."""

import numpy as np
from pyspark.sql import functions as F

from gleanery.functions import image
from gleanery.operators import control
from gleanery.streaming.incremental import dedup_stream


def test_dates_in_names(spark):
    df = spark.createDataFrame([("run_20240101.log",), ("run_20249901.log",), ("latest.log",), ("run_20240131_20230101.log",)], "name string")
    assert [str(r.d) for r in df.select(control.date_in_name(F.col("name")).alias("d")).collect()] == ["2024-01-01", "None", "None", "2024-01-31"]
    assert [r.name for r in control.expired_logs(df, "name", F.lit("2024-02-01").cast("date")).collect()] == ["run_20240101.log"]


def test_uploads_resume(spark):
    queue = spark.createDataFrame([("a", None), ("b", 3), ("c", 1), ("d", 0)], "k string, retry_count int")
    assert sorted(r.k for r in control.to_upload(queue, spark.createDataFrame([("d",), ("d",)], "k string"), "k").collect()) == ["a", "c"]


def test_preflight(spark):
    def broken(_):
        raise OSError("no such bucket")

    out = {r.check_name: r.severity for r in control.preflight(spark, {"a": lambda s: True, "b": broken, "c": lambda s: False}, frozenset({"b"})).collect()}
    assert out == {"a": "ok", "b": "fatal", "c": "warning"}


def test_deadline():
    now = [0.0]
    d = control.Deadline(100, reserve=30, clock=lambda: now[0])
    assert d.allows() and not d.is_near()
    now[0] = 75
    assert not d.allows() and d.allows(last_stage=True) and not d.is_near()
    now[0] = 120
    assert d.left == 0 and not d.allows(last_stage=True) and d.is_near()


def test_state_and_dry_run(spark, tmp_path):
    path = str(tmp_path / "state")
    control.save_state(spark, path, "r1", "filter", {"n": 3})
    control.save_state(spark, path, "r1", "score", {"n": 2})
    row = control.last_state(spark, path, "r1").first()
    assert (row.stage, row.counts) == ("score", {"n": 2}) and control.last_state(spark, path, "r2").count() == 0
    assert "Range" in control.dry_run(spark.range(5))


def test_bar_is_cropped():
    pixels = np.full((800, 20, 3), 200.0)
    pixels[-60:] = 5
    assert image.crop_bar(pixels).shape == (740, 20, 3) and image.crop_bar(pixels[:700]).shape == (700, 20, 3)


def test_harmony_and_cast(spark):
    row = spark.range(1).select(image.harmony(F.array(F.lit(0.0), F.lit(180.0), F.lit(20.0))).alias("h"), image.colour_cast(F.lit(130.0), F.lit(120.0), F.lit(110.0)).alias("c")).first()
    assert row.h == (1 + 0.5 + 1) / 5 and abs(row.c - 0.8) < 1e-9


def test_stream_batch_runs_again(spark, tmp_path):
    rows = [(1, "a"), (2, "b"), (3, "a")]
    spark.createDataFrame(rows, "doc_id long, digest string").coalesce(1).write.parquet(str(tmp_path / "in/k=0"))
    for n in range(2):
        if n:
            spark.createDataFrame([(4, "b"), (5, "c")], "doc_id long, digest string").coalesce(1).write.parquet(str(tmp_path / "in/k=1"))
        for _ in range(2):  # nothing new: nothing changes
            stream = spark.readStream.schema("doc_id long, digest string").option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
            dedup_stream(spark, stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert {(r.doc_id, r.digest) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(1, "a"), (2, "b"), (5, "c")}


def test_fresh_start_and_memory(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "state"))
    assert control.fresh_start(spark, [str(tmp_path / "state"), str(tmp_path / "none")]) == [str(tmp_path / "state")] and not (tmp_path / "state").exists()
    rows = control.memory_status(spark).collect()
    assert rows and all(r.limit_mb > 0 and r.level == "ok" for r in rows)
