"""Source-weighted quality scores, tiers and score summaries."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.config import ScoreSettings


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def normalise_aesthetic(raw: Column) -> Column:
    """1..10 to 0..1."""
    return (clamp(raw, 1.0, 10.0) - 1.0) / 9.0


def binary_softmax(positive: Column, negative: Column, temperature: float) -> Column:
    """The first share of a softmax over two similarities."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(positive - negative) / F.lit(temperature)))


def tier(raw: Column) -> Column:
    return F.when(raw >= 6.5, "premium").when(raw >= 5.5, "standard").when(raw >= 4.0, "acceptable").otherwise("low")


def weighted_score(source: Column, aesthetic: Column, technical: Column, suitability: Column, s: ScoreSettings) -> Column:
    """Weights by lower-case source. The table is a handful of literals, so they are folded into
    the expression: no join."""

    def weight(k: int) -> Column:
        out = F.when(F.lit(False), F.lit(0.0))
        for name, w in s.weights.items():
            out = out.when(F.lower(source) == name, F.lit(w[k]))
        return out.otherwise(F.lit(s.default_weights[k]))

    return aesthetic * weight(0) + technical * weight(1) + suitability * weight(2)


def binary_share(positive: Column, negative: Column, temperature: float = 0.1, default: float = 0.75) -> Column:
    """binary_softmax, or the default where a similarity is missing."""
    return F.coalesce(binary_softmax(positive, negative, temperature), F.lit(default))


def with_fallbacks(aesthetic: Column, raw: Column, technical: Column, suitability: Column, source: Column, s: ScoreSettings, failed: Column | None = None) -> Column:
    """Struct (aesthetic, raw, technical, suitability, final, tier, confidence) of rows that models may
    not have scored (null). Without any: a final score of .61, standard, no confidence. Without the
    aesthetic one: .61 and 5.5. Without the others: .5 each. A row that failed keeps its aesthetic
    score, or its final one if that is higher, and has no confidence."""
    none = aesthetic.isNull() & technical.isNull() & suitability.isNull()
    a, r, t, u = F.coalesce(aesthetic, F.lit(0.61)), F.coalesce(raw, F.lit(5.5)), F.coalesce(technical, F.lit(0.5)), F.coalesce(suitability, F.lit(0.5))
    final = F.when(none, F.lit(0.61)).otherwise(weighted_score(source, a, t, u, s))
    sure = F.when(none, F.lit(0.0)).otherwise(confidence([a, t, u]))
    if failed is not None:
        final, sure = F.when(failed, F.greatest(F.coalesce(aesthetic, F.lit(0.0)), F.lit(0.0))).otherwise(final), F.when(failed, F.lit(0.0)).otherwise(sure)
    return F.struct(a.alias("aesthetic"), r.alias("raw"), t.alias("technical"), u.alias("suitability"), final.alias("final"), F.when(none, F.lit("standard")).otherwise(tier(r)).alias("tier"), sure.alias("confidence"))


def confidence(scores: list[Column]) -> Column:
    """1 minus the population deviation of the scores of a row."""
    n = len(scores)
    mean = sum(scores[1:], scores[0]) / n
    square = sum(((x - mean) * (x - mean) for x in scores[1:]), (scores[0] - mean) * (scores[0] - mean)) / n
    return F.lit(1.0) - F.sqrt(square)


def detected_threshold(scores: DataFrame, column: str, threshold: float) -> DataFrame:
    """One row: n, n_missing, n_out_of_range, n_below, scale, threshold. Scores of at most 1 all
    over are on the 0..1 scale, and the threshold is rescaled to it."""
    top = F.max(column)
    stats = scores.agg(top.alias("top"), F.count("*").alias("n"))
    scale = F.when(F.col("top") <= 1.0, 1.0).otherwise(10.0)
    stats = stats.select("n", scale.alias("scale"), F.when(F.col("top") <= 1.0, F.lit((threshold - 1) / 9)).otherwise(F.lit(threshold)).alias("threshold"))
    value = F.col(column)
    checked = scores.crossJoin(F.broadcast(stats))  # one row
    low = F.when(F.col("scale") == 1.0, 0.0).otherwise(1.0)
    return checked.groupBy("n", "scale", "threshold").agg(
        F.count_if(value.isNull()).alias("n_missing"), F.count_if((value < low) | (value > F.col("scale"))).alias("n_out_of_range"), F.count_if(value < F.col("threshold")).alias("n_below"), F.avg(value).alias("mean"),
    )


