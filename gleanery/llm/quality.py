"""Quality classifier by Bradley-Terry pairwise ranking.

Labelled documents give preference pairs: one of quality 1 is preferred to one of quality 0. A
linear score over features of the whole text is learned by logistic loss on the feature
differences of pairs, and the score that a document must reach is a quantile of the training
scores: the share of quality-0 labels. Scores are mapped to (0, 1) so that this quantile is 0.3.

Every labelled row that may be learned from is: its features are stored, dealt to blocks, and the
loss, its gradient and its curvature are summed over all blocks for each Newton step; the moments of
the features and the quantile come from all of them as well. The driver gathers a row of fixed
size a block and pass, at most MAX_BLOCKS. Only a caller that gives `sample` has fewer rows learned from. Everything
else is done per document. Labels, language, source and id are no inputs of a score.

Defined results: a null text counts as empty and has a score like any other; labels that are null
are ignored, and of contradicting labels for an id the majority holds, a draw being 0; with labels
of one class only, or none, every score is 0.5; of several texts with a labelled id the least is learned from; a null id counts as an empty string for the
held-out rule; repeated rows are scored alike; an empty table gives an empty result; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import stored

N_FEATURES = 22
CUT = 0.3  # the score of the quantile
BLOCK_ROWS, MAX_BLOCKS = 20_000, 256
ROUNDS = 4  # partners that each row of the larger class has in its block
PENALTY = 1e-4
PASSES = 12
BINS = 4096
CHUNK = 4096


def features(text: str | None) -> np.ndarray:
    """Surface statistics of a whole text."""
    data = (text or "").encode()
    out = np.zeros(N_FEATURES)
    if not data:
        return out
    n = len(data)
    hist = np.zeros(256)
    for low in range(0, n, 1 << 20):
        hist += np.bincount(np.frombuffer(data[low : low + (1 << 20)], np.uint8), minlength=256)
    share = hist / n
    words = data.split()
    count = max(1, len(words))
    lines = data.split(b"\n")
    distinct = set(words)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
    upper = share[65:91].sum()
    lower = share[97:123].sum()
    many = share[128:].sum()
    symbols = share[[33, *range(35, 39), 42, 43, 47, *range(60, 65), *range(91, 97), *range(123, 127)]].sum()
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    same = sum(map(bytes.__eq__, words, words[1:]))
    out[:] = (
        np.log1p(n),
        np.log1p(count),
        upper,
        lower,
        many,
        share[48:58].sum(),
        symbols,
        share[33],
        share[124],
        share[[35, 36, 37, 38, 42]].sum(),
        share[44] + share[46],
        share[46] * n / count,
        share[[9, 10, 13]].sum(),
        entropy,
        sizes.mean() / 10,
        sizes.std() / 10,
        min(sizes.max(), 200) / 100,
        len(distinct) / count,
        np.log(len(distinct) + 1) / np.log(count + 1),
        same / count,
        len(set(lines)) / len(lines),
        np.log1p(len(lines)) / 5,
    )
    return out


def expand(x: np.ndarray) -> np.ndarray:
    """Features with squares, and steps that let a linear score see unusual values on both sides."""
    return np.concatenate([x, np.square(np.clip(x, -6, 6)) / 6, np.tanh(3 * (x - 1.5)), np.tanh(3 * (x + 1.5))], axis=1)


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    quantile: float
    spread: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """In (0, 1); CUT at the quantile."""
        raw = expand(np.clip((x - self.mean) / self.scale, -8, 8)) @ self.weights
        z = np.clip((raw - self.quantile) / self.spread, -30, 30)
        return 1 / (1 + (1 - CUT) / CUT * np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, steps: int = 400, pairs: int = 4096, penalty: float = 1e-4, seed: int = 7) -> Ranker | None:
    """Adam on the Bradley-Terry loss: each step draws preference pairs of one better and one
    worse document. None if a class is missing."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return None
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = expand(np.clip((x - mean) / scale, -8, 8))
    rng = np.random.default_rng(seed)
    w, m, v = np.zeros(z.shape[1]), np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for step in range(1, steps + 1):
        diff = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
        miss = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
        grad = -(diff * miss[:, None]).mean(0) + penalty * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        rate = 0.05 * (1 - step / (steps + 1))
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    raw = z @ w
    quantile = score_quantile(raw, y, len(bad) / len(y))
    return Ranker(mean, scale, w, quantile, float(raw.std()) / 3 + 1e-9)


def score_quantile(raw: np.ndarray, y: np.ndarray, rate: float, slack: float = 0.02) -> float:
    """The score at a quantile within `slack` of the rate of quality 0: the one that tells the
    training labels apart best, and of equals the middle one."""
    order = np.argsort(raw, kind="stable")
    ranked, good = raw[order], y[order] == 1
    low, high = max(1, int((rate - slack) * len(y))), min(len(y) - 1, int((rate + slack) * len(y)) + 1)
    if high < low:
        return float(np.quantile(raw, rate))
    cuts = np.arange(low, high + 1)
    wrong = np.cumsum(good)[cuts - 1] + (~good).sum() - np.cumsum(~good)[cuts - 1]
    cut = int(np.median(cuts[wrong == wrong.min()]))
    return float((ranked[cut - 1] + ranked[cut]) / 2)


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return expand(np.clip((x - mean) / scale, -8, 8))


def _fold(table: DataFrame, blocks: int, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[np.ndarray]:
    """of(x, y) of each block of the stored rows (doc_id, y, x), in the order of blocks; a block's rows
    come in the order of their ids, so that sums don't depend on how the table is split."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).sort_by([("doc_id", "ascending")]).combine_chunks()
        x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, N_FEATURES)
        part = of(x, rows.column("y").to_numpy()).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "part"])

    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block")
    parts = table.select(block, "doc_id", "y", "x").groupBy("block").applyInArrow(run, "block int, part binary").collect()
    return [np.frombuffer(r.part) for r in sorted(parts, key=lambda r: r.block)]


def _moments(v: np.ndarray) -> np.ndarray:
    """Number, mean and squared deviations, by column."""
    mean = v.mean(0)
    return np.stack([np.full_like(mean, len(v)), mean, np.square(v - mean).sum(0)])


def _merged(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation from the moments of blocks."""
    n, mean, squares = parts[0]
    for m, other, more in parts[1:]:
        shift = other - mean
        squares = squares + more + shift**2 * n * m / (n + m)
        mean = mean + shift * m / (n + m)
        n = n + m
    return mean, np.sqrt(squares / n)


def _pair_sums(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Pairs, loss, gradient and curvature over a block's preference pairs: each row of the larger class
    meets ROUNDS of the other, and so each row of the smaller at least as many."""
    rng = np.random.default_rng(7)
    good, bad = rng.permutation(np.flatnonzero(y == 1)), rng.permutation(np.flatnonzero(y == 0))
    loss, grad, curve = 0.0, np.zeros(len(w)), np.zeros((len(w), len(w)))
    if not len(good) or not len(bad):
        return np.zeros(2 + len(w) + len(w) ** 2)
    most = max(len(good), len(bad))
    for turn in range(ROUNDS):
        for low in range(0, most, CHUNK):
            at = np.arange(low, min(most, low + CHUNK))
            diff = z[good[at % len(good)]] - z[bad[(at + turn * (min(len(good), len(bad)) // ROUNDS + 1)) % len(bad)]]
            margin = diff @ w
            miss = 1 / (1 + np.exp(np.clip(margin, -500, 500)))
            loss += np.logaddexp(0, -margin).sum()
            grad -= diff.T @ miss
            curve += (diff * (miss * (1 - miss))[:, None]).T @ diff
    return np.concatenate([[ROUNDS * most, loss], grad, curve.ravel()])


def fit_all(table: DataFrame) -> Ranker | None:
    """Newton steps on the Bradley-Terry loss over all stored rows (doc_id, y, x). None if a class is missing.

    Pairs are made within a block. There are so few blocks that each can be expected to hold at least 50
    rows of either class; a block without one adds no pairs."""
    parts = _fold(table, MAX_BLOCKS, lambda x, y: np.concatenate([[(y == 1).sum(), (y == 0).sum()], _moments(x).ravel()]))
    n_good, n_bad = (int(sum(p[k] for p in parts)) for k in (0, 1))
    if not n_good or not n_bad:
        return None
    n = n_good + n_bad
    mean, scale = _merged([p[2:].reshape(3, -1) for p in parts])
    scale = scale + 1e-9
    blocks = max(1, min(MAX_BLOCKS, -(-n // BLOCK_ROWS), min(n_good, n_bad) // 50))

    def loss_at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        total = np.sum(_fold(table, blocks, lambda x, y: _pair_sums(_standard(x, mean, scale), y, w)), axis=0)
        pairs, loss, grad, curve = max(total[0], 1), total[1], total[2 : 2 + len(w)], total[2 + len(w) :].reshape(len(w), -1)
        return loss / pairs + PENALTY / 2 * w @ w, grad / pairs + PENALTY * w, curve / pairs + PENALTY * np.eye(len(w))

    w = np.zeros(expand(mean[None]).shape[1])
    loss, grad, curve = loss_at(w)
    step = -np.linalg.solve(curve, grad)
    for _ in range(PASSES):
        found = loss_at(w + step)
        if found[0] > loss:
            step = step / 2
            continue
        w, gain, (loss, grad, curve) = w + step, loss - found[0], found
        if gain < 1e-3 * loss:
            break
        step = -np.linalg.solve(curve, grad)

    def raw(x: np.ndarray) -> np.ndarray:
        return _standard(x, mean, scale) @ w

    ends = _fold(table, blocks, lambda x, y: np.concatenate([_moments(raw(x)[:, None]).ravel(), [raw(x).min(), raw(x).max()]]))
    _, spread = _merged([p[:3, None] for p in ends])
    return Ranker(mean, scale, w, _binned_quantile(table, blocks, raw, min(p[3] for p in ends), max(p[4] for p in ends), n_bad / n), float(spread[0]) / 3 + 1e-9)


def _binned_quantile(table: DataFrame, blocks: int, raw: Callable[[np.ndarray], np.ndarray], low: float, high: float, rate: float, slack: float = 0.02) -> float:
    """`score_quantile` over all stored rows, at the edges of bins: of BINS over all scores first, then of
    BINS over those that hold the ranks allowed."""

    def counts(low: float, high: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        edges = np.linspace(low, high, BINS + 1)

        def of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            place = np.searchsorted(edges, raw(x), side="right")  # rows below edge k: places up to k
            return np.concatenate([np.bincount(place[y == c], minlength=BINS + 2) for c in (1, 0)])

        total = np.sum(_fold(table, blocks, of), axis=0)
        return edges, np.cumsum(total[: BINS + 2])[:-1], np.cumsum(total[BINS + 2 :])[:-1]

    edges, good, bad = counts(low, high + 1e-9 * (1 + abs(high)))
    n = good[-1] + bad[-1]
    least, most = max(1, int((rate - slack) * n)), min(n - 1, int((rate + slack) * n) + 1)
    below = good + bad
    edges, good, bad = counts(edges[max(0, int(np.searchsorted(below, least, side="left")) - 1)], edges[min(BINS, int(np.searchsorted(below, most, side="right")))])
    below, n_bad = good + bad, rate * n
    allowed = np.flatnonzero((below >= least) & (below <= most))
    if not len(allowed):
        return float(edges[np.abs(below - n_bad).argmin()])
    wrong = good[allowed] + n_bad - bad[allowed]
    best = allowed[wrong <= wrong.min() + 0.5]
    return float(edges[best[len(best) // 2]])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _with_features(rows: DataFrame, keep: list[str]) -> DataFrame:
    """rows (keep..., text) -> keep..., x array<double>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([features(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], x], [*keep, "x"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", x array<double>")


def train(docs: DataFrame, labels: DataFrame, sample: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> Ranker | None:
    """Learn from all labelled rows that aren't held out; with `sample`, from so many at most, chosen by
    a hash of the id and gathered (22 numbers a row)."""
    votes = labels.where("quality is not null").select(F.col(id_col).alias("doc_id"), "quality").where(~held_out(F.col("doc_id")))
    chosen = votes.groupBy("doc_id").agg((F.avg("quality") > 0.5).cast("int").alias("y"))
    if sample is not None:
        chosen = F.broadcast(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(chosen, "doc_id")
    rows = rows.groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # an id that repeats counts once
    measured = _with_features(rows.select("doc_id", "y", "text"), ["doc_id", "y"])
    if sample is None:
        return fit_all(stored(measured, "quality-features"))
    table = measured.toArrow().sort_by([("doc_id", "ascending")])
    if not table.num_rows:
        return None
    return fit(np.array(table.column("x").to_pylist()), table.column("y").to_numpy())


def score_documents(docs: DataFrame, ranker: Ranker | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """The kept columns, with `score` and `predicted`."""
    columns = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("gleanery__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([features(t.as_py()) for t in batch.column("gleanery__text")])
                scores = ranker.scores(x) if ranker else np.full(len(x), 0.5)
                kept = [batch.column(c) for c in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(scores), pa.array((scores >= CUT).astype(np.int32))], [*keep, "gleanery__score", "gleanery__predicted"])

    schema = columns.drop("gleanery__text").schema.add("gleanery__score", "double").add("gleanery__predicted", "integer")
    return columns.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    ranker = train(docs, labels, sample, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    scored = score_documents(rows, ranker, ["doc_id", "held_out"])
    return scored.withColumnsRenamed({"gleanery__score": "score", "gleanery__predicted": "predicted"})


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int | None = None) -> DataFrame:
    """The documents predicted to be of quality 1, with their columns."""
    ranker = train(docs, labels, sample, id_col, text_col)
    return score_documents(docs, ranker, docs.columns, text_col).where("gleanery__predicted = 1").select(*docs.columns)
