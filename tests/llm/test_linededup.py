"""Unit dedup against brute force, and removal with original offsets."""

import re
import time
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from gleanery.llm import linededup


def plain_units(text):
    """(start, end, normalised words, words with a letter or digit), character by character."""
    out, low = [], 0
    for k in range(len(text) + 1):
        at_end = k == len(text) or text[k] == "\n"
        if at_end or (text[k] in ".!?" and text[k + 1 : k + 2] == " "):
            high = k if at_end else k + 1
            a, b = low, high
            while a < b and text[a] in " \t\r\x0b\x0c":
                a += 1
            while b > a and text[b - 1] in " \t\r\x0b\x0c":
                b -= 1
            if a < b:
                words = re.findall(r"[^ \t\n\r\x0b\x0c]+", "".join(c.lower() if c.isascii() else c for c in text[a:b]))
                out.append((a, b, tuple(words), sum(any(c.isalnum() or not c.isascii() for c in w) for w in words)))
            low = k + 1 if at_end else high
    return out


def brute(rows, min_words):
    """Documents are pairs of id and text; the order of documents of one id is read off the result's."""
    seen = {}
    order = sorted({(i is None, i or 0, t or "", s, e, d, w, n) for i, t in rows for n, (s, e, d, w) in enumerate(plain_units(t or ""))})
    repeats = defaultdict(list)
    for none, i, t, s, e, d, w, n in order:
        first = seen.setdefault(d, (none, i, t, s))
        if first != (none, i, t, s):
            repeats[none, i, t].append((n, s, e, w, first))
    out = set()
    for (none, i, _), hits in repeats.items():
        runs, hits = [], sorted(hits)
        for h in hits:
            if runs and h[0] - runs[-1][-1][0] == 1:
                runs[-1].append(h)
            else:
                runs.append([h])
        for run in runs:
            if sum(h[3] for h in run) >= min_words:
                out.add((None if none else i, run[0][1], run[-1][2], len(run), sum(h[3] for h in run), None if run[0][4][0] else run[0][4][1], run[0][4][3]))
    return out


def rows_():
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(2, 7)))
    sentence = lambda: " ".join(word() for _ in range(rng.integers(3, 15))) + "."
    passage = "\n".join(" ".join(sentence() for _ in range(3)) for _ in range(3))
    rows = [(k, " ".join(sentence() for _ in range(6))) for k in range(20)]
    rows += [(100 + k, f"{sentence()}\n{passage}\n{sentence()} own {k}") for k in range(30)]
    rows += [(200, f"{word()} {word()} {passage} {sentence()}"), (201, passage.upper().replace(" ", "  ")), (202, None), (203, ""), (204, " \n\n "), (205, "Short. Short. Short."), (206, "long unit words " * 20_000), (207, "long unit words " * 20_000), (208, "é ü. " * 30)]
    return rows


def test_brute_force(spark):
    rows = rows_()
    df = spark.createDataFrame([(t, i, 1) for i, t in rows], "text string, doc_id long, start int").repartition(5)
    for least in (1, 20):
        out = linededup.repeated_passages(df, min_words=least).drop("text_key").collect()
        assert {tuple(r) for r in out} == brute(rows, least) and len(out) == len(brute(rows, least))
    flagged = {r.doc_id for r in linededup.repeated_passages(df).collect()}
    assert set(range(101, 130)) | {200, 201, 207} <= flagged and not flagged & set(range(21))


def test_removal_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, "Head.\nthis is a line that repeats here"), (2, "Top é.\nthis is a line that repeats here\nTail.")], "doc_id long, text string")
    passages = linededup.repeated_passages(df, min_words=5)
    out = {r.doc_id: (r.text, r.removed) for r in linededup.remove_passages(df, passages).collect()}
    assert out[1] == ("Head.\nthis is a line that repeats here", None)
    assert out[2][0] == "Top é.\n\nTail." and [tuple(s) for s in out[2][1]] == [(7, 39)]


def test_null_ids_rank_last_and_empty(spark):
    line = "this is a line that repeats here"
    df = spark.createDataFrame([(None, line), (5, line), (5, line)], "doc_id long, text string")
    assert [(r.doc_id, r.first_doc_id) for r in linededup.repeated_passages(df, min_words=5).collect()] == [(None, 5)]
    assert linededup.repeated_passages(df.where(F.lit(False))).count() == 0


def test_rows_of_one_id_or_none_are_documents_of_their_own(spark):
    line, other = "this is a line that repeats here", "and this is another line that repeats"
    rows = [(None, f"{line}\nalone a"), (None, f"short\n{line}\nalone b"), (7, f"one\n{other}"), (7, f"two words\n{other}"), (7, f"two words\n{other}")]
    df = spark.createDataFrame([(*r, "old", 1) for r in rows], "doc_id long, text string, removed string, start int").repartition(3)
    passages = linededup.repeated_passages(df, min_words=5)
    assert all(r.end <= len("two words\n" + other) for r in passages.collect()) and passages.count() == 2
    out = linededup.remove_passages(df, passages)
    assert out.columns == df.columns
    texts = [r.text for r in out.collect()]
    assert len(texts) == 5  # one text of each id keeps the line; copies of a document are treated alike
    assert sum(line in t for t in texts) == 1 and sum(other in t for t in texts) in (1, 2)
    assert sorted(t.split("\n")[0] for t in texts if t.split("\n")[0] in ("one", "two words")) == ["one", "two words", "two words"]


def test_a_very_common_line_is_dealt_out(spark, monkeypatch):
    from gleanery.llm import common

    rows = [(k, f"own line number {k} of this text\nthe very common line that all have") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    heavy = lambda counts, key, n, total: common.heavy_keys(counts, key, n, total, least=20)
    monkeypatch.setattr(linededup, "heavy_keys", heavy)
    assert {r.doc_id for r in linededup.repeated_passages(df, min_words=3).collect()} == set(range(1, 300))


def test_time_grows_with_the_length(spark):
    began = time.perf_counter()
    assert sum(1 for _ in linededup.units("a! " * 500_000)) == 500_000
    assert sum(1 for _ in linededup.units("word " * 1_000_000)) == 1
    assert time.perf_counter() - began < 15
