"""The dedup index on storage, file listings, uploads through a callable, and stage logs."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables of the index and their columns.
INDEX = {"seen_urls": "url string, seq long", "seen_ids": "id string, seq long", "content_hashes": "sha256 string, id string, seq long", "phash_index": "phash long, id string, seq long"}


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions below the path, oldest first."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop)]
    return sorted(n for n in names if n.startswith("v") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_complete")))


def save_index(spark: SparkSession, path: str, tables: dict[str, DataFrame]) -> str:
    """A new version beside the old ones, marked complete at the end: a reader never sees half an
    index, and a job that dies leaves the last version as it was."""
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for name in INDEX:
        tables[name].write.parquet(f"{path}/{version}/{name}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{version}/_complete")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop, True).close()
    return version


def load_index(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The last complete version; empty tables where there is none."""
    versions = _versions(spark, path)
    if not versions:
        return {name: spark.createDataFrame([], schema) for name, schema in INDEX.items()}
    return {name: spark.read.schema(schema).parquet(f"{path}/{versions[-1]}/{name}") for name, schema in INDEX.items()}


def list_files(spark: SparkSession, path: str, pattern: str = "*.json.gz") -> DataFrame:
    """path, name, modified, size of files below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def upload(items: DataFrame, put: Callable[[dict], str], key: str, attempts: int = 3, base_delay: float = 2.0, most_delay: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """id, success, url, error, attempts: each row goes through `put` (to a store that Spark has no
    writer for), with waits that double. A failing row is a result, not a failed task; as a task may
    run again, `put` must be able to store an object twice."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                url, error, n = None, None, 0
                for n in range(1, attempts + 1):
                    try:
                        url, error = put(row), None
                        break
                    except Exception as e:  # goes to the row's result
                        error = str(e)[:500]
                        if n < attempts:
                            sleep(min(most_delay, base_delay * 2 ** (n - 1)))
                out.append((str(row[key]), error is None, url, error, n))
            yield pd.DataFrame(out, columns=["id", "success", "url", "error", "attempts"])

    return items.mapInPandas(run, "id string, success boolean, url string, error string, attempts int")


def attach_urls(items: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Items with the url of their successful upload, or an empty one. Of several results for an
    item the last attempt holds."""
    good = results.where("success").groupBy("id").agg(F.max_by("url", "attempts").alias("url"))
    return items.join(good.withColumnRenamed("id", "upload_id"), F.col(key).cast("string") == F.col("upload_id"), "left").drop("upload_id").withColumn("url", F.coalesce("url", F.lit("")))


def log_stage(spark: SparkSession, path: str, stage: str, events: list[tuple[str, str]]) -> None:
    """Append (level, message) lines of a stage as JSON."""
    rows = spark.createDataFrame([(stage, *e) for e in events], "stage string, level string, message string")
    rows.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").json(path)


def write_rejected(df: DataFrame, reason: Column, path: str) -> None:
    """Rejected rows to a side table, partitioned by their bucket."""
    df.where(reason.isNotNull()).withColumn("bucket", reason).write.mode("append").partitionBy("bucket").parquet(path)
