"""Rolling rates over run history, caps, numbering and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.config import HistorySettings


def rolling_acceptance(runs: DataFrame, key: str, run: str, s: HistorySettings = HistorySettings()) -> DataFrame:
    """runs (key, run, candidates, approved) with rate, rolling_rate over the last runs (rows, not
    days), and lifetime totals."""
    by_run = Window.partitionBy(key).orderBy(run)
    last = by_run.rowsBetween(-(s.window_runs - 1), 0)
    ever = by_run.rowsBetween(Window.unboundedPreceding, 0)

    def rate(a: Column, c: Column) -> Column:
        return F.round(F.coalesce(F.try_divide(a.cast("double"), c.cast("double")), F.lit(0.0)), 4)

    return runs.select(
        key, run, "candidates", "approved", rate(F.col("approved"), F.col("candidates")).alias("rate"), rate(F.sum("approved").over(last), F.sum("candidates").over(last)).alias("rolling_rate"),
        F.sum("candidates").over(ever).alias("total_candidates"), F.sum("approved").over(ever).alias("total_approved"),
    )


def recommendation(rate: Column, s: HistorySettings = HistorySettings()) -> Column:
    return F.when(rate >= s.increase, "increase").when(rate >= s.maintain, "maintain").when(rate >= s.reduce, "reduce").otherwise("consider_removing")


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key: an aggregation, so no key is sorted in one task."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("row")).select(key, "row.*")


def capped(df: DataFrame, key: str, order: list[Column], cap: Column) -> DataFrame:
    """At most `cap` rows of each key, in order."""
    return df.withColumn("position", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("position") <= cap)


def landscape_first(width: Column, height: Column, *ties: str) -> list[Column]:
    """Landscape before portrait, then by area, largest first."""
    landscape = (width >= height) & (width > 0) & (height > 0)
    return [F.when(landscape, 0).otherwise(1), (width * height).desc(), *[F.col(t) for t in ties]]


def batches(df: DataFrame, order: list[str], size: int, key: str | None = None) -> DataFrame:
    """Batch numbers of `size` rows. With a key, rows are numbered within it, which scales; without
    one, within the whole table."""
    over = Window.partitionBy(key).orderBy(*order) if key else Window.orderBy(*order)
    return df.withColumn("batch", F.floor((F.row_number().over(over) - 1) / size).cast("long"))


def next_run(names: DataFrame, name: str, base: Column, extension: str = ".json.gz") -> DataFrame:
    """names (base, name) -> base, next_name: base, then base-2, base-3 and so on."""
    rest = F.substring(F.col(name), F.length(base) + 1, F.length(F.col(name)))
    ext = extension.replace(".", r"\.")
    number = F.when(rest == extension, F.lit(1)).otherwise(F.try_to_number(F.nullif(F.regexp_extract(rest, rf"^-(\d+){ext}$", 1), F.lit("")), F.lit("999999999")).cast("int"))
    runs = names.groupBy(base.alias("base")).agg(F.coalesce(F.max(number), F.lit(0)).alias("runs"))
    following = F.when(F.col("runs") == 0, F.concat("base", F.lit(extension))).otherwise(F.concat("base", F.lit("-"), (F.col("runs") + 1).cast("string"), F.lit(extension)))
    return runs.select("base", following.alias("next_name"))


def expired(df: DataFrame, key: str, order: str, keep: int, parts: int = 256) -> DataFrame:
    """All but the newest `keep` rows of each key. No key is sorted in one task: each of `parts`
    parts of a key gives its newest, and the cut is found among these."""
    part = F.pmod(F.xxhash64(order), F.lit(parts))
    newest = df.select(key, order, part.alias("gleanery__part"))
    newest = newest.withColumn("gleanery__k", F.row_number().over(Window.partitionBy(key, "gleanery__part").orderBy(F.desc(order)))).where(F.col("gleanery__k") <= keep)
    cut = newest.withColumn("gleanery__k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where(F.col("gleanery__k") == keep)
    cut = cut.select(F.col(key).alias("gleanery__key"), F.col(order).alias("gleanery__cut"))
    return df.join(cut, F.col(key).eqNullSafe(F.col("gleanery__key"))).where(F.col(order) < F.col("gleanery__cut")).select(*df.columns)
