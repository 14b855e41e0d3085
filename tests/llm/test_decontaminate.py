"""Decontamination: recall against exhaustive edit distance, and no false hits."""

import numpy as np
import pyarrow as pa

from gleanery.llm import decontaminate as d


def words_of(rng, n):
    return ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(n)]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_is_exact_up_to_its_bound():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a, b = rng.integers(0, 4, rng.integers(0, 14)).tolist(), rng.integers(0, 4, rng.integers(0, 14)).tolist()
        want = levenshtein(a, b)
        for bound in (0, 2, 5, 20):
            assert d.edit_distance(a, b, bound) == min(want, bound + 1)


def test_words_fold_case_and_drop_signs():
    same = [d.words(t.encode())[0].tolist() for t in ("Don't stop, É-b", "DON  T\nstop é b".replace("é", "É"))]
    assert same[0] == same[1] and len(same[0]) == 5
    h = d.words(b"a b a")[0]
    assert h[0] == h[2] != h[1]


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        at = int(rng.integers(len(words)))
        kind = rng.integers(3)
        if kind == 0:
            words[at] = "edit"
        elif kind == 1:
            words.insert(at, "more")
        else:
            words.pop(at)
    return words


def test_recall_and_precision(spark):
    rng = np.random.default_rng(1)
    items = [words_of(rng, int(rng.integers(8, 60))) for _ in range(40)]
    rows, want = [], {}
    for k in range(400):
        body = words_of(rng, int(rng.integers(0, 200)))
        if k % 2:
            item = int(rng.integers(40))
            limit = d.allowed(len(items[item]), d.EDITS)
            leak = edited(rng, items[item], int(rng.integers(0, limit + 1)))
            at = int(rng.integers(len(body) + 1))
            body = body[:at] + leak + body[at:]
            n = len(items[item])
            best = min((levenshtein(body[s : s + n], items[item]) for s in range(max(0, at - n), min(len(body) - n, at + n) + 1)), default=999)
            if best <= limit:
                want[k, item] = best
        rows.append((k, " ".join(body)))
    docs = spark.createDataFrame([(t, i, 0) for i, t in rows], "text string, doc_id long, item_id int").repartition(6)
    bench = spark.createDataFrame([(k, " ".join(w).upper()) for k, w in enumerate(items)] + [(90, None), (91, ""), (92, "no no")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in d.find_leaks(docs, bench).collect()}
    assert set(got) <= set(want)
    assert got == want
    exact = {k for k, v in want.items() if v == 0}
    assert exact <= set(got)
    clean = d.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    left = {r.doc_id for r in clean.collect()}
    assert left == {i for i, _ in rows} - {i for i, _ in got}


def test_columns_of_distances_are_exact():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(3, 80)), rng.integers(0, 4, rng.integers(1, 90)).tolist()
        places = d.places_of(a)
        assert d.myers(places, len(a), b, False)[-1] == levenshtein(a.tolist(), b)
        assert d.myers(places, len(a), b[:20], True)[-1] == min(levenshtein(a.tolist(), b[:20][k:]) for k in range(len(b[:20]) + 1))


def test_no_leak_of_a_long_item_is_lost_at_the_edit_limit():
    rng = np.random.default_rng(6)
    for n in (20, 57, 100, 300):
        items = [words_of(rng, n) for _ in range(20)]
        index = d.Index([(k, " ".join(w)) for k, w in enumerate(items)], d.EDITS, 0.98)
        texts = []
        for item in items:
            leak = list(item)
            for at in rng.choice(n, d.allowed(n, d.EDITS), replace=False):
                leak[at] = "edit"
            texts.append(" ".join(words_of(rng, 30) + leak + words_of(rng, 30)))
        found = {(row, index.names[item][0]): distance for row, item, distance, *_ in d._leaks(index, pa.array(texts))}
        assert set(found) == {(k, k) for k in range(20)}
        assert all(v <= d.allowed(n, d.EDITS) for v in found.values())


def test_items_of_few_words_are_found():
    """From one word on; a fifth of the words may differ at every length."""
    rng = np.random.default_rng(9)
    vocabulary = words_of(rng, 12)
    items = [list(rng.choice(vocabulary, n)) for n in (1, 2, 3, 4, 5, 5, 6, 6, 7, 7) for _ in range(3)]
    index = d.Index([(k, " ".join(w)) for k, w in enumerate(items)], d.EDITS, 0.98)
    texts = [list(rng.choice(vocabulary, int(rng.integers(0, 40)))) for _ in range(150)]
    texts += [edited(rng, w, int(rng.integers(0, 2))) for w in items]
    found = {}
    for row, item, distance, n, *_ in d._leaks(index, pa.array([" ".join(t) for t in texts])):
        for name in index.names[item]:
            found[row, name] = distance
    want = {}
    for row, text in enumerate(texts):
        for k, item in enumerate(items):
            n = len(item)
            best = min((levenshtein(text[s : s + n], item) for s in range(len(text) - n + 1)), default=99)
            if best <= int(0.2 * n):
                want[row, k] = best
    assert found == want


def test_a_text_is_hashed_alike_in_pieces(monkeypatch):
    data = "some words, “quoted” – and «more» of them。 long".encode() * 500
    whole = d.words(data)
    monkeypatch.setattr(d, "CHUNK", 97)
    assert all((a == b).all() for a, b in zip(whole, d.words(data), strict=True))
    monkeypatch.undo()
    plain, typeset = (d.words(t.encode())[0].tolist() for t in ('say "this thing" - now... it is', "say “this thing” — now… it is"))
    assert plain == typeset


def test_edges(spark, monkeypatch):
    text = "the quick brown fox jumps over the lazy dog again and again"
    docs = spark.createDataFrame([(1, f"é é {text} end"), (None, text.upper()), (2, None), (3, ""), (4, "the quick brown fox"), (1, f"é é {text} end"), (5, "pad " * 50_000 + text)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, text), (8, text), (9, "quick brown fox"), (10, "x"), (11, "End")], "item_id long, text string")
    for words in (d.BLOCK_WORDS, 5):  # one block, many blocks
        monkeypatch.setattr(d, "BLOCK_WORDS", words)
        out = d.find_leaks(docs, bench).collect()
        assert sorted((str(r.doc_id), r.item_id) for r in out) == sorted([*((i, x) for i in ("1", "1", "5", "None") for x in (7, 8, 9)), ("4", 9), *((i, 11) for i in ("1", "1"))])
    row = next(r for r in out if r.doc_id == 1 and r.item_id == 7)
    assert (row.start, row.end, row.n_words, row.distance) == (4, 4 + len(text), 12, 0)
    assert row.n_words == 12
    assert sorted((str(r.doc_id), r.text) for r in d.decontaminate(docs, bench).collect()) == [("2", None), ("3", "")]
    assert d.find_leaks(docs.limit(0), bench).count() == 0 and d.decontaminate(docs.limit(0), bench).count() == 0 and d.find_leaks(docs, bench.limit(0)).count() == 0
