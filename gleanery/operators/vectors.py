"""Vector functions: quantising, cosine, zero-shot labels.

Labels are a small vocabulary of unit vectors, read as one array of bounded size. An item's scores
are an array in its row, and labels are chosen by array functions: nothing is shuffled.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def doubles(vector: Column) -> Column:
    return F.transform(vector, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null where a norm is next to nothing."""
    n = norm(a) * norm(b)
    return F.when(n > 1e-8, dot(a, b) / n)


def quantize_int8(vector: Column) -> Column:
    """Clip 127x to [-128, 127], then cut to whole numbers toward zero."""
    return F.transform(vector, lambda x: F.greatest(F.lit(-128.0), F.least(F.lit(127.0), x.cast("double") * 127.0)).cast("tinyint"))


def _packed(vectors: pd.Series) -> pd.Series:
    return vectors.map(lambda v: None if v is None else base64.b64encode(struct.pack(f"{len(v)}b", *v)).decode())


def pack_base64(vector: Column) -> Column:
    """Base64 of the signed bytes of quantised vectors."""
    return F.pandas_udf(_packed, "string")(vector)


def centroids(items: DataFrame, label: str, vector: str) -> DataFrame:
    """label, centroid: the mean vector of each label, dimension by dimension with partial
    aggregation."""
    parts = items.select(F.col(label).alias("label"), F.posexplode(doubles(F.col(vector))).alias("dim", "x"))
    means = parts.groupBy("label", "dim").agg(F.avg("x").alias("m"))
    return means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda s: s["m"]).alias("centroid"))


def prompt_vectors(spark: SparkSession, vocabulary: dict[str, str], encode: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """(label, centroid, place): the vectors that a text encoder gives for a vocabulary's prompts, made
    once. A vocabulary is a small table of the code."""
    vectors = encode(list(vocabulary.values()))
    return spark.createDataFrame([(label, [float(x) for x in v], k) for k, (label, v) in enumerate(zip(vocabulary, vectors, strict=True))], "label string, centroid array<double>, place int")


def with_scores(items: DataFrame, vocabulary: DataFrame, vector: str, vocabulary_size: int = 4096) -> DataFrame:
    """items with `scores`: an array of (place, label, score), the cosine of the item's vector and each
    label's, by place; null scores where a vector is next to nothing.

    The vocabulary is checked to have at most vocabulary_size labels before it is broadcast as one
    row; an item's labels stay in its row, so nothing is shuffled."""
    found = vocabulary.limit(vocabulary_size + 1).count()
    if found > vocabulary_size:
        raise ValueError(f"the vocabulary has more than {vocabulary_size} labels")
    if "place" not in vocabulary.columns:
        vocabulary = vocabulary.withColumn("place", F.lit(0))
    unit = F.transform("centroid", lambda x: x / norm(F.col("centroid")))
    words = vocabulary.withColumn("unit", F.when(norm(F.col("centroid")) > 1e-8, unit)).agg(F.array_sort(F.collect_list(F.struct("place", "label", "unit"))).alias("gleanery__words"))
    rows = items.crossJoin(F.broadcast(words)).withColumn("gleanery__v", doubles(F.col(vector))).withColumn("gleanery__n", norm(F.col("gleanery__v")))
    scores = F.transform("gleanery__words", lambda w: F.struct(w["place"].alias("place"), w["label"].alias("label"), F.when(F.col("gleanery__n") > 1e-8, dot(F.col("gleanery__v"), w["unit"]) / F.col("gleanery__n")).alias("score")))
    return rows.withColumn("scores", scores).drop("gleanery__words", "gleanery__v", "gleanery__n")


def label_scores(items: DataFrame, vocabulary: DataFrame, id_col: str, vector: str, vocabulary_size: int = 4096) -> DataFrame:
    """id, label, score (cosine): a row for each item and label of the vocabulary."""
    return with_scores(items.select(id_col, vector), vocabulary, vector, vocabulary_size).select(id_col, F.inline("scores")).drop("place")


def _best(scored: Column, k: int) -> Column:
    """The k best of an array of (place, label, score), as (label, score); ties by place, then label."""
    ordered = F.array_sort(F.transform(scored, lambda s: F.struct((-s["score"]).alias("down"), s["place"].alias("place"), s["label"].alias("label"))))
    return F.transform(F.slice(ordered, 1, k), lambda s: F.struct(s["label"].alias("label"), (-s["down"]).alias("score")))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _with(scored: Column, change: Callable[[Column], Column]) -> Column:
    return F.transform(scored, lambda s: F.struct(s["place"].alias("place"), s["label"].alias("label"), change(s).alias("score")))


def _known(scored: Column) -> Column:
    return F.filter(scored, lambda s: s["score"].isNotNull())


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it's used."""
    return F.get(F.transform(F.array(value), use), 0)


def single_label(scored: Column, scale: float = 100.0, k: int = 2) -> Column:
    """The k best labels by a softmax over an item's scaled scores; none without scores."""

    def shares(grown: Column) -> Column:
        return _let(_sum(F.transform(grown, lambda s: s["score"])), lambda total: _best(_with(grown, lambda s: s["score"] / total), k))

    def softmax(known: Column) -> Column:
        top = F.array_max(F.transform(known, lambda s: s["score"]))
        return _let(top, lambda top: _let(_with(known, lambda s: F.exp(F.lit(scale) * (s["score"] - top))), shares))

    return _let(_known(scored), softmax)


def multi_label(scored: Column, penalties: dict[str, float] | None = None, k: int = 3) -> Column:
    """Scores times their label's penalty: those from the mean plus half a population deviation on,
    and from three quarters of the best on; where that leaves none, all. Of these the k best."""
    known = _known(scored)
    if penalties:
        factors = F.create_map(*[F.lit(x) for pair in penalties.items() for x in pair])
        known = _with(known, lambda s: s["score"] * F.coalesce(F.try_element_at(factors, s["label"]), F.lit(1.0)))

    def cut(known: Column, mean: Column) -> Column:
        return mean + 0.5 * F.sqrt(_sum(F.transform(known, lambda s: (s["score"] - mean) * (s["score"] - mean))) / F.greatest(F.size(known), F.lit(1)))

    def near_best(above: Column) -> Column:
        return _let(F.array_max(F.transform(above, lambda s: s["score"])), lambda best: F.filter(above, lambda s: s["score"] >= 0.75 * best))

    def choose(known: Column) -> Column:
        mean = _sum(F.transform(known, lambda s: s["score"])) / F.greatest(F.size(known), F.lit(1))
        above = _let(mean, lambda mean: _let(cut(known, mean), lambda least: F.filter(known, lambda s: s["score"] >= least)))
        return _let(above, lambda above: _best(F.when(F.size(above) > 0, near_best(above)).otherwise(known), k))

    return _let(known, choose)


def above_threshold(scored: Column, threshold: float = 0.25, k: int = 2) -> Column:
    """The k best labels of those from a cosine on."""
    return _best(F.filter(scored, lambda s: s["score"] >= threshold), k)


def classify(scored: Column, method: str, **rest) -> Column:
    """The labels of an item by the method `single`, `multi` or `threshold`."""
    methods = {"single": single_label, "multi": multi_label, "threshold": above_threshold}
    if method not in methods:
        raise ValueError(f"no method {method}: one of {', '.join(methods)}")
    return methods[method](scored, **rest)


def category_of(scored: Column, scale: float = 100.0) -> Column:
    """Struct (category, subcategories, confidence): the best of a vocabulary, and the next one from a
    share of .1 on; general, none and 0 without scores."""

    def parts(best: Column) -> Column:
        more = F.transform(F.filter(F.slice(best, 2, 1), lambda s: s["score"] > 0.1), lambda s: s["label"])
        first = F.get(best, 0)
        return F.struct(F.coalesce(first["label"], F.lit("general")).alias("category"), more.alias("subcategories"), F.coalesce(first["score"], F.lit(0.0)).alias("confidence"))

    return _let(single_label(scored, scale, 2), parts)


def tags_of(scored: Column, penalties: dict[str, float], k: int = 3) -> Column:
    """Labels of moods or styles."""
    return F.transform(multi_label(scored, penalties, k), lambda s: s["label"])


def composition_of(scored: Column, scale: float = 100.0) -> Column:
    """The best composition; balanced without scores."""
    return F.coalesce(F.get(single_label(scored, scale, 1), 0)["label"], F.lit("balanced"))
