"""Models as pluggable extractors: loaded once in a worker, run over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vector sizes by model.
DIMENSIONS = {"mobilenet_v4": 1280, "efficientnet_v2": 1280, "siglip": 1152, "dinov3": 1024}


def extract(items: DataFrame, load: Callable[[], Callable[[list], np.ndarray]], key: str, content: str, model: str) -> DataFrame:
    """key, model, vector. `load` runs once for each task and gives a function from a batch of
    contents to a matrix; a batch that fails gives null vectors, so that it is tried again."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        infer = load()
        for frame in frames:
            try:
                vectors = [v.astype(np.float32) for v in infer(frame[content].tolist())]
            except Exception:  # a null vector says that it's still to do
                vectors = [None] * len(frame)
            yield pd.DataFrame({key: frame[key], "model": model, "vector": vectors})

    kind = dict(items.dtypes)[key]
    return items.select(key, content).mapInPandas(run, f"{key} {kind}, model string, vector array<float>")


def to_do(items: DataFrame, done: DataFrame, key: str, models: list[str]) -> DataFrame:
    """(key, model) pairs without a vector yet: all models less those done, so a run resumes."""
    every = items.select(key, F.explode(F.array(*map(F.lit, models))).alias("model"))
    return every.join(done.where("vector is not null").select(key, "model").distinct(), [key, "model"], "left_anti")


def is_complete(models: list[Column]) -> Column:
    out = F.lit(True)
    for m in models:
        out = out & m.isNotNull()
    return out
