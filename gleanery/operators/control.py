"""Run control over tables: state, resume, retention, degradation, preflight and deadlines."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def is_recent(when: Column, now: Column, hours: int = 24) -> Column:
    """Whether a saved state is young enough to resume from."""
    return when > now - F.make_dt_interval(hours=F.lit(hours))


def date_in_name(name: Column) -> Column:
    """The first yyyymmdd token of a file name as a date; null if it's none."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(name, r"(\d{8})", 1), F.lit("")), F.lit("yyyyMMdd")).cast("date")


def expired_logs(files: DataFrame, name: str, today: Column, days: int = 30) -> DataFrame:
    return files.where(date_in_name(F.col(name)) < F.date_sub(today, days))


def to_upload(queue: DataFrame, existing: DataFrame, key: str, max_retries: int = 3) -> DataFrame:
    """Queued items that aren't stored yet and have tries left: running it again is harmless."""
    return queue.where(F.coalesce("retry_count", F.lit(0)) < max_retries).join(existing.select(key).distinct(), key, "left_anti")


def degradation(errors: DataFrame, max_failed: int = 3) -> DataFrame:
    """One row from (source, category, message): failed sources, errors by kind, whether to go on."""
    out = errors.agg(
        F.count_distinct(F.when(F.col("category") == "fatal", F.col("source"))).alias("failed_sources"), F.count_if(F.col("category") == "fatal").alias("n_fatal"),
        F.count_if(F.col("category") == "recoverable").alias("n_recoverable"), F.count_if(F.col("category") == "warning").alias("n_warning"),
    )
    return out.withColumn("go_on", F.col("failed_sources") < max_failed)


def dry_run(df: DataFrame) -> str:
    """What a write would run, without running it."""
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def preflight(spark: SparkSession, checks: dict[str, Callable[[SparkSession], bool]], fatal: frozenset[str] = frozenset()) -> DataFrame:
    """check_name, passed, severity; a check that raises has failed."""
    rows = []
    for name, test in checks.items():
        try:
            passed = bool(test(spark))
        except Exception:  # the check's failure is its result
            passed = False
        rows.append((name, passed, "ok" if passed else "fatal" if name in fatal else "warning"))
    return spark.createDataFrame(rows, "check_name string, passed boolean, severity string")


class Deadline:
    """A time budget with a part of it reserved for the last stage."""

    def __init__(self, seconds: float, reserve: float = 0.0, clock: Callable[[], float] = time.monotonic):
        self.seconds, self.reserve, self.clock, self.began = seconds, reserve, clock, clock()

    @property
    def left(self) -> float:
        return max(0.0, self.seconds - (self.clock() - self.began))

    def allows(self, last_stage: bool = False) -> bool:
        return self.left > (0 if last_stage else self.reserve)

    def is_near(self, share: float = 0.8) -> bool:
        return self.clock() - self.began >= share * self.seconds


def save_state(spark: SparkSession, path: str, run_id: str, stage: str, counts: dict[str, int]) -> None:
    """Append one row: states are kept, the last one of a run holds."""
    spark.createDataFrame([(run_id, stage, counts)], "run_id string, stage string, counts map<string,long>").withColumn("saved_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


def last_state(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("run_id") == run_id).agg(F.max_by(F.struct("stage", "counts", "saved_at"), "saved_at").alias("s")).where("s is not null").select("s.*")


def fresh_start(spark: SparkSession, paths: list[str]) -> list[str]:
    """Clear the tables of a run's state; the paths that were there."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = []
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        store = target.getFileSystem(conf)
        if store.exists(target):
            store.delete(target, True)
            gone.append(path)
    return gone


def memory_status(spark: SparkSession, warn: float = 0.75, critical: float = 0.875) -> DataFrame:
    """executor, limit_mb, used_mb, level: what Spark's own memory manager says, a row an executor."""
    status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus()
    rows, each = [], status.iterator()
    while each.hasNext():
        pair = each.next()
        limit, free = int(pair._2()._1()), int(pair._2()._2())
        share = (limit - free) / limit if limit else 0.0
        rows.append((pair._1(), limit >> 20, (limit - free) >> 20, "critical" if share >= critical else "warning" if share >= warn else "ok"))
    return spark.createDataFrame(rows, "executor string, limit_mb long, used_mb long, level string")
