"""The ranking on held-out rows, and its edge cases."""

import zlib

import numpy as np
import pytest

from gleanery.llm import quality


def make(rng, good):
    words = ["".join(rng.choice(list("etaoinshr"), rng.integers(2, 9))) for _ in range(rng.integers(20, 200))]
    return " ".join(w.capitalize() + "." if k % 9 == 0 else w for k, w in enumerate(words)) if good else " ".join(f"{w}{rng.choice(['###', '&&&', '!!'])}" for w in words)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    return [(k, make(rng, k % 4 != 0), int(k % 4 != 0)) for k in range(400)]


def test_held_out_rows_are_told_apart(spark, rows):
    docs = spark.createDataFrame([(t, i, 9.0, "s") for i, t, _ in rows], "text string, doc_id long, score double, gleanery string").repartition(4)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(0, None, 0), (10_000, 1, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(out) == len(rows)
    for i, _, q in rows:
        assert out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= out[i].score <= 1 and out[i].predicted == int(out[i].score >= 0.3)
    assert np.mean([out[i].predicted == q for i, _, q in rows if out[i].held_out]) > 0.97
    again = {r.doc_id: r.score for r in quality.quality_scores(docs.repartition(2), labels).collect()}
    assert again == {i: r.score for i, r in out.items()}
    kept = quality.keep_quality(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.predicted}


def test_labels_of_held_out_rows_change_nothing(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    a = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    b = spark.createDataFrame([(i, 1 - q if held(i) else q) for i, _, q in rows], "doc_id long, quality int")
    scores = [{r.doc_id: r.score for r in quality.quality_scores(docs, x).collect()} for x in (a, b)]
    assert scores[0] == scores[1]


def test_edges(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "x" * 200_000), (3, "\x00 ퟿")], "doc_id long, text string")
    one_class = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    out = quality.quality_scores(docs, one_class).collect()
    assert len(out) == 5 and {(r.score, r.predicted) for r in out} == {(0.5, 1)}
    mixed = spark.createDataFrame([(k, k % 2) for k in range(1, 4)] + [(2, 1), (2, 0)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.quality_scores(docs, mixed).collect())
    assert quality.quality_scores(docs.limit(0), mixed).count() == 0


def test_score_is_cut_at_the_quantile():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, quality.N_FEATURES))
    y = (x[:, 3] > -1).astype(int)
    ranker = quality.fit(x, y)
    assert abs((ranker.scores(x) < quality.CUT).mean() - (y == 0).mean()) < 0.03


def test_a_labelled_id_that_repeats_counts_once(spark, rows):
    """What the driver gathers is bounded by the sample, however often an id repeats."""
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1, "copy of a labelled row")] * 500, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    gathered = []
    inner = quality.fit
    quality.fit = lambda x, y, **rest: gathered.append(len(x)) or inner(x, y, **rest)
    try:
        assert quality.train(docs, labels, sample=100) is not None
    finally:
        quality.fit = inner
    assert gathered[0] <= 100


def test_held_out_accuracy_on_the_tables(spark):
    from conftest import SF
    from pyspark.sql import functions as F

    from gleanery.llm.common import read

    labels = read(spark, SF, "labels")
    scored = quality.quality_scores(read(spark, SF, "documents"), labels).where("held_out").join(labels, "doc_id")
    right, n = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 5 and right >= 0.85


def test_every_labelled_row_is_learned_from(spark, rows, monkeypatch):
    """The counts of the rows folded, and a model that follows a label that no sample by size would spare."""
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    monkeypatch.setattr(quality, "fit", lambda *_, **__: pytest.fail("learned from a sample"))
    monkeypatch.setattr(quality, "BLOCK_ROWS", 100)
    seen = []
    inner = quality._fold
    monkeypatch.setattr(quality, "_fold", lambda table, *rest: seen.append(table.count()) or inner(table, *rest))
    assert quality.train(docs, labels) is not None
    assert set(seen) == {sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _, _ in rows)}


def test_sums_over_blocks_are_those_of_the_whole():
    rng = np.random.default_rng(3)
    x = rng.normal(5, 2, (1000, 4))
    mean, deviation = quality._merged([quality._moments(part) for part in (x[:10], x[10:400], x[400:])])
    assert np.allclose(mean, x.mean(0)) and np.allclose(deviation, x.std(0))
    z, y, w = rng.normal(size=(90, 3)), np.arange(90) % 3 == 0, rng.normal(size=3)
    n, loss, *grad = quality._pair_sums(z, y, w)[:5]
    step = 1e-6 * np.eye(3)
    slope = [(quality._pair_sums(z, y, w + s)[1] - loss) / 1e-6 for s in step]
    assert n == 240 and np.allclose(grad, slope, rtol=1e-3, atol=1e-3)
