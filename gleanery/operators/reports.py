"""Funnels, histograms, source performance and collection statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(F.coalesce(F.try_divide(part * 100.0, whole.cast("double")), F.lit(0.0)), places)


def histogram(df: DataFrame, value: Column, low: float, high: float, bins: int = 10) -> DataFrame:
    """bin, label, n for equal half-open bins, the last one closed; values out of range are
    dropped, null values too. Bins without values have 0."""
    width = (high - low) / bins
    in_range = df.select(value.cast("double").alias("v")).where((F.col("v") >= low) & (F.col("v") <= high))
    counts = in_range.groupBy(F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    label = F.format_string("%.2f-%.2f", F.lit(low) + F.col("bin") * width, F.lit(low) + (F.col("bin") + 1) * width)
    return axis.join(counts, "bin", "left").select("bin", label.alias("label"), F.coalesce("n", F.lit(0)).alias("n"))


def collapse_source(source: Column, prefix: str = "reddit") -> Column:
    return F.when(F.startswith(source, F.lit(f"{prefix}_")), F.lit(prefix)).otherwise(source)


def source_counts(candidates: DataFrame, approved: DataFrame, key: str) -> DataFrame:
    """key, candidates, approved over the keys of either side."""
    a = candidates.groupBy(key).agg(F.count("*").alias("candidates"))
    b = approved.groupBy(key).agg(F.count("*").alias("approved"))
    return a.join(b, key, "full_outer").select(key, F.coalesce("candidates", F.lit(0)).alias("candidates"), F.coalesce("approved", F.lit(0)).alias("approved"))


def performance_band(rate: Column) -> Column:
    """By percentages of approval."""
    return F.when(rate >= 30, "high").when(rate >= 10, "good").when(rate >= 5, "low").otherwise("poor")


def run_report(df: DataFrame, approved: Column, tracked: Column, score: Column) -> DataFrame:
    """One row: totals, rejections, what no counter tracks, score summary, approval rate."""
    counts = df.agg(
        F.count("*").alias("total"), F.count_if(approved).alias("approved"), F.count_if(tracked).alias("tracked"),
        F.round(F.avg(F.when(approved, score)), 4).alias("avg_score"), F.round(F.min(F.when(approved, score)), 4).alias("min_score"), F.round(F.max(F.when(approved, score)), 4).alias("max_score"),
    )
    rejected = F.greatest(F.col("total") - F.col("approved"), F.lit(0))
    return counts.withColumn("rejected", rejected).withColumn("unaccounted", F.greatest(F.col("rejected") - F.col("tracked"), F.lit(0))).withColumn("approval_pct", percent(F.col("approved"), F.col("total")))


def distribution(df: DataFrame, category: Column) -> DataFrame:
    """category, n, share_pct; null and empty categories as unknown."""
    known = F.coalesce(F.nullif(category.cast("string"), F.lit("")), F.lit("unknown"))
    counts = df.groupBy(known.alias("category")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("category", "n", percent(F.col("n"), F.col("total")).alias("share_pct"))  # total: one row


def collection_statistics(df: DataFrame, when: Column) -> DataFrame:
    stats = df.agg(F.count("*").alias("n"), F.min(when).alias("oldest"), F.max(when).alias("newest"))
    span = F.datediff("newest", "oldest").cast("long")
    return stats.select("n", F.date_format("oldest", "yyyy-MM-dd").alias("oldest"), F.date_format("newest", "yyyy-MM-dd").alias("newest"), span.alias("span_days"), F.round(F.col("n") / F.greatest(span, F.lit(1)), 4).alias("per_day"))


def regressions(now: DataFrame, baseline: DataFrame, key: str, value: str, limit: float = 0.20) -> DataFrame:
    """Stages of both runs, with the change and whether it's a regression (over the limit)."""
    b = baseline.select(key, F.col(value).alias("baseline"))
    out = now.select(key, F.col(value).alias("current")).join(b, key)
    change = F.try_divide(F.col("current") - F.col("baseline"), F.col("baseline"))
    return out.withColumn("change_pct", F.round(change * 100, 4)).withColumn("regression", change > limit)


def stage_totals(stages: DataFrame, stage: str, ms: str) -> DataFrame:
    """stage, ms, share_pct, is_bottleneck: the stage that takes longest, ties by name."""
    total = stages.agg(F.sum(ms).alias("total"), F.max(F.struct(F.col(ms), F.col(stage))).alias("worst"))
    out = stages.crossJoin(F.broadcast(total))  # one row
    return out.select(stage, F.round(ms, 4).alias(ms), percent(F.col(ms), F.col("total")).alias("share_pct"), (F.col(stage) == F.col("worst")[stage]).alias("is_bottleneck"))
