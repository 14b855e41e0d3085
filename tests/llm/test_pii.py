"""Base spans against the plain patterns; the random field against an undivided Viterbi."""

import hashlib
import random
import time
import re

import numpy as np
import pytest

from gleanery.llm import pii


def plain_spans(text):
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0:
            spans.append(("card", *m.span()))
    return spans + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@pytest.fixture(scope="module")
def field():
    return pii.train(pii.labelled_table(400), rounds=120)


def test_base_spans_on_random_texts():
    rng = random.Random(4)
    for alphabet in ("a1.@-+ 5(9%", "01 -", "0123456789.", "+1 ()-.", "ab@.", "é1@漢.a"):
        for _ in range(3000):
            t = "".join(rng.choices(alphabet, k=rng.randint(0, 50)))
            assert pii.base_spans(t) == plain_spans(t), t


def test_long_runs_are_not_quadratic():
    for t in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "@" * 100_000, "+1" * 100_000):
        pii.base_spans(t)


def test_held_out_accuracy(field):
    table = pii.labelled_table(300, seed=77)
    start, _, owner, numbers = pii.word_shapes([" ".join(w) for w, _ in table])
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    got = field.decode(numbers, first)
    gold = np.array([pii.LABELS.index(x) for _, labels in table for x in labels])
    assert (got == gold).mean() > 0.99 and (got == gold)[gold > 0].mean() > 0.96
    whole = np.concatenate([field._viterbi(field.emissions(numbers[owner == k])[None])[0] for k in range(len(table))])
    assert (whole == got).all()  # cutting the chain changes nothing


def test_added_spans(field):
    text = 'One token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" here. Call (555) 123-4567. Version 3. Mail a.b@c.org now'
    base, more = pii.base_spans(text), pii.field_spans([text], field)[0]
    spans = pii.all_spans(base, more)
    assert set(base) <= set(spans) and [text[a:b] for k, a, b in spans if k == "secret"] == ["f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda"]
    assert [text[a:b] for k, a, b in spans if k == "email"] == ["a.b@c.org"]
    assert not any(a < text.index("Version") + 10 < b for _, a, b in spans)


def test_query(spark):
    rows = [(1, None), (2, ""), (3, "é x.1@mail.example.com, +1 (017) 555-7713"), (3, "é x.1@mail.example.com, +1 (017) 555-7713"), (None, "1.2.3.4 256.1.1.1"), (4, "4111111111111111 4111 1111 1111 1112"), (5, "plain words " * 20_000), (6, " \n\t ")]
    df = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, spans string").repartition(3)
    out = pii.find_pii(df, pii.labelled_table(300)).collect()
    assert len(out) == len(rows)
    texts = {i: t or "" for i, t in rows}
    for r in out:
        base = plain_spans(texts[r.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS[:4]]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))
    assert pii.find_pii(df.limit(0), pii.labelled_table(50)).count() == 0


def test_spans_that_touch_none_in_time_that_grows_with_their_number():
    rng = random.Random(8)
    for _ in range(500):
        spans = [[("ip", a, a + rng.randint(1, 6)) for a in rng.sample(range(60), rng.randint(0, 8))] for _ in range(2)]
        want = [s for s in spans[1] if not any(a < s[2] and s[1] < b for _, a, b in spans[0])]
        assert sorted(pii.all_spans(*spans)) == sorted([*spans[0], *want])
    began = time.perf_counter()
    base, more = [("ip", 20 * k, 20 * k + 9) for k in range(20_000)], [("phone", 20 * k + (8 if k % 2 else 10), 20 * k + 15) for k in range(20_000)]
    assert len(pii.all_spans(base, more)) == 30_000
    assert time.perf_counter() - began < 3
