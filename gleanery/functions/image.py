"""Image measures. Scalars are column functions; kernels over pixels are Arrow UDFs on numpy, one
call for a batch of images, each given as a flat row-major array of values."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def hue(a: Column, b: Column) -> Column:
    """The angle of a LAB colour's a and b, in whole degrees from 0 to 359."""
    return F.pmod(F.degrees(F.atan2(b, a)).cast("int"), F.lit(360))


def exact_mean(value: Column) -> Column:
    """The mean of a group, the same in whatever order its rows come: values of up to 12 decimals are
    added as decimals, without rounding. A group with others has the mean of doubles."""
    decimal = value.try_cast("decimal(28,12)")
    other = value.isNotNull() & ~F.coalesce(decimal.cast("double") == value, F.lit(False))
    return F.when(F.count_if(other) == 0, F.sum(decimal).cast("double") / F.nullif(F.count(value), F.lit(0))).otherwise(F.avg(value))


def is_dark(mean: Column, deviation: Column) -> Column:
    return (mean < 60) & (deviation > 20)


def diversity(distances: Column) -> Column:
    """Mean distance over 100, at most 1."""
    return F.least(F.avg(distances) / 100.0, F.lit(1.0))


def pairwise_mean(points: Column) -> Column:
    """The mean distance of all pairs of a few points (arrays of coordinates)."""
    n = F.size(points)
    sums = F.aggregate(
        F.sequence(F.lit(0), n - 1), F.lit(0.0),
        lambda s, i: s + F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda t, j: t + F.when(j > i, F.sqrt(F.aggregate(F.zip_with(F.get(points, i), F.get(points, j), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda u, d: u + d))).otherwise(0.0)),
    )
    return sums / (n * (n - 1) / 2)


def centroid(grid: Column, width: int) -> Column:
    """Struct (x, y) in 0..1: the weighted centre of a row-major grid."""
    total = F.aggregate(grid, F.lit(0.0), lambda s, m: s + m) + 1e-6
    indexed = F.transform(grid, lambda m, i: F.struct((m * (i % width)).alias("x"), (m * F.floor(i / width)).alias("y")))
    x = F.aggregate(indexed, F.lit(0.0), lambda s, p: s + p["x"]) / total / width
    y = F.aggregate(indexed, F.lit(0.0), lambda s, p: s + p["y"]) / total / (F.size(grid) / width)
    return F.struct(x.alias("x"), y.alias("y"))


def symmetry(grid: Column, width: int, compat: bool = False) -> Column:
    """exp(-mse / 1000) between a row-major grid and its mirror image. With compat, differences
    and squares wrap at 256 as unsigned bytes do."""
    mirror = F.transform(grid, lambda _, i: F.get(grid, (F.floor(i / width) * width + width - 1 - i % width).cast("int")))

    def square(x: Column, y: Column) -> Column:
        if compat:
            d = F.pmod((x - y).cast("long"), F.lit(256))
            return F.pmod(d * d, F.lit(256)).cast("double")
        return (x - y) * (x - y)

    mse = F.aggregate(F.zip_with(grid, mirror, square), F.lit(0.0), lambda s, d: s + d) / F.size(grid)
    return F.exp(-mse / 1000.0)


def complexity(edge_ratio: Column) -> Column:
    return F.when(edge_ratio < 0.05, "minimal").when(edge_ratio < 0.15, "low").when(edge_ratio < 0.30, "medium").otherwise("high")


def composition(symmetric: Column, thirds: Column, lines: Column) -> Column:
    return F.when(symmetric > 0.7, "symmetrical").when(thirds > 0.1, "rule_of_thirds").when(lines > 3, "leading_lines").otherwise("centered")


def contrast_score(deviation: Column) -> Column:
    """Rises to 1 between 20 and 40, stays to 80, then falls by a hundredth a unit."""
    return F.when(deviation < 20, deviation / 20 * 0.5).when(deviation < 40, 0.5 + (deviation - 20) / 40).when(deviation <= 80, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - (deviation - 80) / 100))


def brightness_score(brightness: Column) -> Column:
    """A plateau from .4 to .7, falling to 0 at 0 and 1."""
    return F.greatest(F.lit(0.0), F.when(brightness.between(0.4, 0.7), F.lit(1.0)).when(brightness < 0.4, brightness / 0.4).otherwise((1 - brightness) / 0.3))


def visual_interest(deviation: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (deviation - 20) / 50))


def bar_rows(pixels: np.ndarray, least: int = 35, most: int = 70, share: float = 0.85, dark: int = 40, step: float = 25.0) -> int:
    """Rows of a dark bar at the bottom of a height x width x 3 image, 0 if there is none: from 35
    to 70 trailing rows of which 85 % of pixels are dark in all channels, with a step to the row above."""
    height = len(pixels)
    rows = (pixels < dark).all(axis=2).mean(axis=1) >= share
    light = np.flatnonzero(~rows)
    size = height - 1 - int(light[-1]) if len(light) else height
    if not least <= size <= min(most, max(least, min(80, height // 10))) or size >= height:
        return 0
    above, strip = pixels[height - size - 1].mean(), pixels[height - size :].mean()
    return size if above - strip >= step else 0


def _bars(pixels: pd.Series, width: pd.Series) -> pd.Series:
    return pd.Series([bar_rows(np.asarray(p, np.float64).reshape(-1, int(w), 3)) for p, w in zip(pixels, width, strict=True)], dtype="int32")


def detect_bar(pixels: Column, width: Column) -> Column:
    """Rows of the dark bar of images given as flat arrays of three values a pixel."""
    return F.pandas_udf(_bars, "int")(pixels, width)


def crop_bar(pixels: np.ndarray) -> np.ndarray:
    """The image without its dark bar."""
    rows = bar_rows(pixels)
    return pixels[: len(pixels) - rows] if rows else pixels


def colour_cast(red: Column, green: Column, blue: Column) -> Column:
    """1 less the largest deviation of a channel's mean from the mean of all, over 50."""
    mean = (red + green + blue) / 3
    worst = F.greatest(F.abs(red - mean), F.abs(green - mean), F.abs(blue - mean))
    return 1 - F.greatest(F.lit(0.0), F.least(F.lit(1.0), worst / 50))


def harmony(hues: Column) -> Column:
    """Pairs of hues on the circle: 1 for complementary ones (over 150 degrees apart), .5 for close
    ones (under 45), over 5, at most 1."""
    n = F.size(hues)

    def score(i: Column, j: Column) -> Column:
        apart = F.abs(F.get(hues, i) - F.get(hues, j))
        d = F.when(apart > 180, 360 - apart).otherwise(apart)
        return F.when(j <= i, 0.0).when(d > 150, 1.0).when(d < 45, 0.5).otherwise(0.0)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda s, i: s + F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda t, j: t + score(i, j)))
    return F.least(total / 5, F.lit(1.0))


def composite(visual: Column, layout: Column, beauty: Column, fitness: Column) -> Column:
    """The older fixed-weight score."""
    return visual * 0.4 + layout * 0.3 + beauty * 0.2 + fitness * 0.1


def pixel_sample(pixels: np.ndarray, n: int = 10_000, seed: int = 42) -> np.ndarray:
    """At most n pixels, the same ones for the same image."""
    flat = pixels.reshape(-1, pixels.shape[-1])
    return flat if len(flat) <= n else flat[np.sort(np.random.default_rng(seed).choice(len(flat), n, replace=False))]
