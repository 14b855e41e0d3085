"""Mixing sources to target weights by entropy balancing.

Each document gets a rate r >= 0, the one closest to 1 in relative entropy among all that give
every source its target number of words and none more than `most`. The dual of that problem is
convex and smooth; its solution tilts exponentially: r = min(most, exp(lambda * size / scale)),
one lambda for each source. Newton iterations solve for the lambdas: each is one aggregation over
the sizes of all documents, counted by source and size, so its work is distributed and doesn't
grow with the number of documents of a size. A bracket keeps a step that would leave it inside. Some
iterations make a job, and its outcome, a row for each source, is written.

Rates are rounded to copies so that words, not documents, come out right: from the largest size
down, the documents of a source and size together get the whole number of copies that brings the
words taken so far closest to what the rates ask for. Within them, a hash of the id decides which
get the extra copy. The words taken from a source so miss its target by less than half its
smallest documents that have a fractional rate. A source's sizes are rounded in one group, which
has a row for each different size.

Targets: sources in code point order, null last, weigh 5, 2, 1, repeating, and share all words by
weight; none gets more than `most` times its own words, and the excess is shared again.

Defined results: a null text counts as empty; documents without words have rate 1 and take
nothing; a null source is a source; rows that repeat an id are documents of their own; an empty
table gives an empty result; other columns are ignored. Reruns agree: lambdas are rounded to nine
places, beyond which the order of sums could show.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.llm.common import stored, text_key

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
FAR = 1e6  # lambdas lie within
BLOCK = 2_000  # rows ranked together
STEPS = 4  # Newton iterations of a job


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, size) -> source, sid, source_size, target, scale. One row for each source; the
    windows over all of them order as many rows as there are sources."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size").cast("double") * F.col("size")).alias("square"))
    sources = sources.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") - 1) % len(weights) + 1))
    # Full sources come first in the order of what a unit of weight holds.
    fill = Window.orderBy((F.col("source_size") / F.col("weight")), "sid")
    above, all_ = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    full = F.coalesce(F.sum("source_size").over(above), F.lit(0)) * F.lit(most)
    level = (F.sum("source_size").over(all_) - full) / (F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(above), F.lit(0.0)))
    sources = sources.withColumn("level", level).withColumn("full", F.col("source_size") * most <= F.col("weight") * F.col("level"))
    rest = F.min(F.when(~F.col("full"), F.struct((F.col("source_size") / F.col("weight")).alias("k"), F.col("sid"), F.col("level")))).over(all_)["level"]
    target = F.when(F.col("full"), F.col("source_size") * F.lit(most)).otherwise(F.col("weight") * rest)
    scale = F.when(F.col("source_size") > 0, F.col("square") / F.col("source_size")).otherwise(F.lit(1.0))
    return sources.select("source", "sid", "source_size", target.cast("double").alias("target"), F.when(scale > 0, scale).otherwise(1.0).alias("scale"))


def _rate(most: float):
    return F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(math.log(most))))


def solve(classes: DataFrame, sources: DataFrame, most: float = MOST, rounds: int = 80, close: float = 1e-9) -> DataFrame:
    """sid, lam, scale: Newton on the dual. classes: (sid, size, n)."""
    full = F.col("target") >= F.col("source_size") * F.lit(most) * (1 - 1e-12)
    state = stored(sources.select("sid", "target", "scale", full.alias("full"), F.lit(0.0).alias("lam"), F.lit(-FAR).alias("low"), F.lit(FAR).alias("high")), "dual")

    def newton(state: DataFrame) -> DataFrame:
        words = F.col("n") * F.col("size")
        free = F.col("lam") * F.col("size") / F.col("scale") < math.log(most)
        at = classes.join(state.select("sid", "lam", "scale"), "sid").groupBy("sid").agg(F.sum(words * _rate(most)).alias("f"), F.sum(F.when(free, words * _rate(most) * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope"))
        miss = F.col("f") - F.col("target")
        step = state.join(at, "sid")
        step = step.withColumn("low", F.when(miss < 0, F.col("lam")).otherwise(F.col("low"))).withColumn("high", F.when(miss > 0, F.col("lam")).otherwise(F.col("high")))
        tried = F.when(F.col("slope") > 0, F.col("lam") - miss / F.col("slope"))
        inside = F.coalesce((tried > F.col("low")) & (tried < F.col("high")), F.lit(False))
        done = F.col("full") | (F.abs(miss) <= F.greatest(F.col("target"), F.lit(1.0)) * close)
        moved = F.when(done, F.col("lam")).when(inside, tried).otherwise((F.col("low") + F.col("high")) / 2)
        return step.select("sid", "target", "scale", "full", moved.alias("lam"), "low", "high", done.alias("done"))

    for _ in range(0, rounds, STEPS):
        step = state
        for _ in range(STEPS):
            step = newton(step)
        state = stored(step, "dual")
        if not state.where(~F.col("done")).limit(1).count():
            break
    lam = F.when(F.col("full"), F.lit(FAR * FAR)).otherwise(F.round("lam", 9))
    return state.select("sid", lam.alias("lam"), "scale")


def _whole_copies(most: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The copies of each size of one source: as many rows as it has different sizes."""
        pdf = pdf.sort_values("size", ascending=False)
        behind, copies = 0.0, []
        for size, n, rate in zip(pdf["size"].tolist(), pdf["n"].tolist(), pdf["rate"].tolist(), strict=True):
            low, high = n * math.floor(rate), min(n * math.ceil(rate), int(n * most))
            behind += n * rate * size
            k = int(min(max(round(behind / size), low), high)) if size else n
            behind -= k * size
            copies.append(k)
        return pd.DataFrame({"sid": pdf["sid"].to_numpy(), "size": pdf["size"].to_numpy(), "n": pdf["n"].to_numpy(), "copies": np.array(copies, np.int64)})

    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: float = MOST, tie: Column | None = None) -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken; turn, a hash of id and text, by
    which rows of a source and size are put in order; and tie, the column given, which comes next."""
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    turn = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_key(F.col(text_col)))
    tie = F.lit(0).cast("long") if tie is None else tie
    sizes = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.alias("size"), turn.alias("turn"), tie.alias("tie")), "sizes")
    sources = stored(source_targets(sizes, weights, most), "sources")
    counted = sizes.groupBy("source", "size").agg(F.count("*").alias("n"))
    classes = stored(counted.join(sources.select(F.col("source").alias("s"), "sid"), F.col("source").eqNullSafe(F.col("s"))).select("sid", "size", "n"), "size-classes")
    lambdas = solve(classes, sources, most)
    rated = classes.join(lambdas, "sid").select("sid", "size", "n", F.when(F.col("size") == 0, 1.0).otherwise(_rate(most)).alias("rate"))
    whole = stored(rated.groupBy("sid").applyInPandas(_whole_copies(most), "sid int, size long, n long, copies long"), "copies")

    rows = sizes.join(sources.select(F.col("source").alias("s"), "sid", "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.join(whole, ["sid", "size"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    rows = rows.withColumn("block", F.floor((F.col("turn") / 2.0**64 + 0.5) * blocks).cast("long"))
    counts = rows.groupBy("sid", "size", "block").agg(F.count("*").alias("m"))
    earlier = Window.partitionBy("sid", "size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("sid", "size", "block", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("sid", "size", "block").orderBy("turn", "doc_id", "tie")) - 1
    rows = rows.withColumn("rank", rank).join(starts, ["sid", "size", "block"])
    copies = F.floor(F.col("copies") / F.col("n")) + F.when(F.col("before") + F.col("rank") < F.col("copies") % F.col("n"), 1).otherwise(0)
    rows = rows.withColumn("copies", copies.cast("long"))
    return rows.select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "turn", "tie")


def _row_hash(docs: DataFrame) -> Column:
    """A hash of a whole row; maps, which have no hash, as JSON."""
    columns = [F.col(f"`{c}`") if "map<" not in kind and kind != "variant" else F.to_json(F.struct(F.col(f"`{c}`"))) for c, kind in docs.dtypes]
    return F.xxhash64(*columns, *[F.col(f"`{c}`").isNull() for c in docs.columns])


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mix: each row as many times as it has copies, with its columns. Rows that
    share an id, or have none, each have copies of their own; of rows equal in all columns, the
    copies are added up."""
    mixed = mix(docs, id_col, text_col, source_col, tie=_row_hash(docs))
    taken = mixed.groupBy("doc_id", "tie").agg(F.sum("copies").alias("gleanery__copies"), F.count("*").alias("gleanery__rows")).where("gleanery__copies > 0")
    taken = stored(taken.withColumnsRenamed({"doc_id": "gleanery__id", "tie": "gleanery__tie"}), "taken")
    keyed = docs.withColumn("gleanery__key", _row_hash(docs))
    rows = keyed.join(taken, keyed[id_col].eqNullSafe(taken["gleanery__id"]) & (keyed["gleanery__key"] == taken["gleanery__tie"]))
    out = rows.where("gleanery__rows = 1").select(*[keyed[c] for c in docs.columns], "gleanery__copies")
    if taken.where("gleanery__rows > 1").limit(1).count():
        whole = F.struct(*[keyed[c] for c in docs.columns]).alias("gleanery__row")
        again = rows.where("gleanery__rows > 1").select("gleanery__id", "gleanery__tie", "gleanery__copies", whole)
        again = again.groupBy("gleanery__id", "gleanery__tie").agg(F.first("gleanery__row").alias("gleanery__row"), F.first("gleanery__copies").alias("gleanery__copies"))
        out = out.unionByName(again.select("gleanery__row.*", "gleanery__copies"))
    return out.withColumn("gleanery__k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("gleanery__copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])
