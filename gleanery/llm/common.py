"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
#: Only the runs that differ from a single space, so that most matches are skipped.
_UNEVEN_WHITE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where it is unset, a temporary folder is made and set, but only for a local master: on a
    cluster a machine-local folder would lose data.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    found = context.getCheckpointDir()
    if not found:
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="gleanery-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a table of this run in the shared folder, below one folder for the application,
    which can be removed when the application has ended."""
    return f"{shared_dir(spark)}/gleanery-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write df as a table in the shared folder and read it again: this cuts its lineage, and a
    lost executor costs a read of files instead of a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Keys that hold more than one of so many parts of all rows count as heavy, so there are no more of them than that.
HEAVY = 4096


def heavy_keys(counts: DataFrame, key: str, n: str, total: int, least: int = 1000) -> DataFrame:
    """(key, deals) of the keys with more than 1 / HEAVY of `total` rows, and more than `least`:
    at most HEAVY rows, as their counts add up to the total. deals: the parts to deal their rows out to."""
    share = max(least, -(-total // HEAVY))
    return counts.where(F.col(n) > share).select(key, F.ceil(F.col(n) / share).cast("int").alias("deals"))


def spread_join(rows: DataFrame, entries: DataFrame, key: str, heavy: DataFrame, by: Column, how: str = "inner") -> DataFrame:
    """rows joined to entries on `key`, where entries has one row a key. The rows of a heavy key are
    dealt out by the hash `by`, and its entry goes to each part; the broadcast has at most HEAVY rows."""
    heavy = F.broadcast(heavy.select(F.col(key), F.col("deals").alias("gleanery__deals")))
    rows = rows.join(heavy, key, "left").withColumn("gleanery__deal", F.coalesce(F.pmod(by, F.col("gleanery__deals")), F.lit(0)).cast("int")).drop("gleanery__deals")
    entries = entries.join(heavy, key, "left").withColumn("gleanery__deal", F.explode(F.sequence(F.lit(0), F.coalesce("gleanery__deals", F.lit(1)) - 1))).drop("gleanery__deals")
    return rows.join(entries.hint("merge"), [key, "gleanery__deal"], how).drop("gleanery__deal")


def text_key(text: Column) -> Column:
    """A hash that tells rows of one id, or of none, apart: rows equal in id and text are one document."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def whole_row(columns: list[str]) -> Column:
    """A row's columns as text, by which equal rows can be put in order."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table. A table of fewer files or row groups than the session has cores is dealt
    out to all of them, as the operators' work on a row is far more than moving it; larger tables
    are read as they lie."""
    docs = read(spark, sf_dir, "documents")
    cores = spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


def squeeze(text: Column) -> Column:
    """Text with every run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _UNEVEN_WHITE, " ")


def n_words(text: Column) -> Column:
    """The number of maximal runs without ASCII white space; null counts as empty."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.regexp_replace(trimmed, r"[\x20\x09-\x0D]+", "")).cast("long")
