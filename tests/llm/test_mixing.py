"""Mixing: targets by water-filling, words near them, and reruns that agree."""

from collections import defaultdict

import numpy as np
import pytest

from gleanery.llm import mixing


def targets(sizes, weights=(5.0, 2.0, 1.0), most=3.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + ([None] if None in sizes else [])
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    rest, left, out = set(names), float(sum(sizes.values())), {}
    while rest:
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] >= most * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        rest -= over
    return out


def corpus():
    rng = np.random.default_rng(3)
    rows = []
    for source, n in (("a", 30), ("b", 900), ("Ä", 5), ("c", 200), (None, 40), ("z", 1), ("\U0001f600", 60)):
        rows += [(source, "w " * int(rng.lognormal(4, 1)) + "end") for _ in range(n)]
    rows += [("c", None), ("c", ""), ("empty", " \t\n"), ("b", "long " * 40_000)]
    return [(k, s, t) for k, (s, t) in enumerate(rows)] + [(None, "a", "no id here"), (3, "a", "an id again")]


def test_contract(spark):
    rows = corpus()
    df = spark.createDataFrame([(t, i, s, 5) for i, s, t in rows], "text string, doc_id long, source string, size int").repartition(6)
    out = mixing.mix(df).collect()
    assert len(out) == len(rows)
    sizes, taken, target, least = defaultdict(int), defaultdict(int), {}, defaultdict(lambda: 10**9)
    for r in out:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
        if r["size"]:
            least[r.source] = min(least[r.source], r["size"])
    assert all(r.source_size == sizes[r.source] for r in out)
    want = targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9)
        if sum(r.source == s for r in out) > 20:
            assert abs(taken[s] - target[s]) <= max(0.01 * target[s], least[s])
    again = sorted(str((r.doc_id, r["size"], r.taken)) for r in mixing.mix(df.repartition(3)).collect())
    assert again == sorted(str((r.doc_id, r["size"], r.taken)) for r in out)


def test_rates_solve_the_dual(spark):
    rng = np.random.default_rng(0)
    classes = [(1, int(x), int(n)) for x, n in zip(rng.choice(5000, 60, replace=False) + 1, rng.integers(1, 50, 60), strict=True)]
    total = sum(x * n for _, x, n in classes)
    for part in (0.05, 0.7, 1.0, 2.2, 2.999, 3.0):
        scale = sum(x * x * n for _, x, n in classes) / total
        sources = spark.createDataFrame([("s", 1, total, part * total, scale)], "source string, sid int, source_size long, target double, scale double")
        row = mixing.solve(spark.createDataFrame(classes, "sid int, size long, n long"), sources).first()
        words = sum(n * x * min(3.0, np.exp(min(row.lam * x / row.scale, 50))) for _, x, n in classes)
        assert words == pytest.approx(part * total, rel=1e-6)


def test_take_mix(spark):
    rows = [(k, "a" if k % 10 else "b", f"word {k} " * (1 + k % 5)) for k in range(200)]
    df = spark.createDataFrame([(i, t, s, "x") for i, s, t in rows], "doc_id long, text string, source string, copies string")
    copies = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    out = mixing.take_mix(df)
    assert out.columns == df.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
    assert dict(got) == {i: c for i, c in copies.items() if c}
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.take_mix(df.limit(0)).count() == 0


def test_rows_without_an_id_and_repeated_ids_are_taken(spark):
    """Words out of the mix are the words that mix() says it takes, row by row."""
    rows = [(None, f"text number {k} " * (1 + k % 7), "none", {"k": k}) for k in range(40)]
    rows += [(k % 5, f"word {k} " * (1 + k % 9), "few", {"k": k}) for k in range(60)] + [(k, "same words here " * 3, "many", None) for k in range(100)] + [(77, "equal rows", "many", None)] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size map<string,int>").repartition(5)
    mixed = mixing.mix(df).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    out = mixing.take_mix(df)
    assert out.columns == df.columns
    words, times = defaultdict(int), defaultdict(int)
    for r in out.collect():
        words[r.source] += len(r.text.split())
        times[r.source, r.doc_id, r.text] += 1
    for r in mixed:
        assert words[r.source] == r["sum(taken)"] and abs(words[r.source] - r["max(target)"]) <= max(8, 0.02 * r["max(target)"])
    assert len({t for s, _, t in times if s == "none"}) > 20
    assert times["many", 77, "equal rows"] <= 90 and all(n <= 3 for (_, i, _), n in times.items() if i != 77)


def test_taken_against_brute_force(spark):
    """Rates by bisection, copies from the largest size down, and the extra copies by hash order."""
    rows = corpus()
    df = spark.createDataFrame([(t, i, s) for i, s, t in rows], "text string, doc_id long, source string").repartition(4)
    out = mixing.mix(df).collect()
    by_source = defaultdict(list)
    for r in out:
        by_source[r.source].append(r)
    for some in by_source.values():
        sizes = np.array([r["size"] for r in some])
        total, target = int(sizes.sum()), some[0].target
        low, high = -1e5, 1e5
        for _ in range(200):
            lam = (low + high) / 2
            with np.errstate(over="ignore"):
                f = (sizes * np.minimum(3.0, np.exp(np.minimum(lam * sizes / max(1, total), 50)))).sum()
            low, high = (lam, high) if f < target else (low, lam)
        if not total:
            continue
        full = target >= 3 * total * (1 - 1e-12)
        rates = {s: 3.0 if full else float(min(3.0, np.exp(min(lam * s / total, 50)))) for s in set(sizes.tolist()) if s}
        behind = 0.0
        for s in sorted(rates, reverse=True):
            group = [r for r in some if r["size"] == s]
            n, rate = len(group), rates[s]
            behind += n * rate * s
            k = int(min(max(round(behind / s), n * np.floor(rate + 1e-9)), min(n * np.ceil(rate - 1e-9), 3 * n)))
            behind -= k * s
            got = sum(r.copies for r in group)
            assert abs(got - k) <= 1, (s, n, rate, got, k)  # a tie of rounding may fall either way
            ordered = sorted(group, key=lambda r: (r.turn, r.doc_id is not None, r.doc_id or 0))
            assert [r.copies for r in ordered] == [got // n + (j < got % n) for j in range(n)]
