"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The random field labels the words of a text (runs without ASCII
white space) from their shapes and those of their neighbours; it's trained here, by the exact
log-likelihood, from a small labelled table of word sequences. Its spans are added where they
don't touch a base span.

Decoding runs in numpy over batches of texts. A word whose emission score favours "outside" by
more than any transition could give back is outside on the best path whatever its neighbours are;
so the chain falls apart at such words, and Viterbi runs over the stretches between them, many
stretches of a length at a time. This changes no result.

Defined results: a null text counts as empty and has no spans; repeated rows give equal rows; an
empty table gives an empty result; other columns are ignored. Offsets are code points, the end
exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret")
LABELS = ("outside", *KINDS)

Span = tuple[str, int, int]

# ---------------------------------------------------------------- base patterns

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """A match holds one @; its local part is the run before it, from the last match at most."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end:  # in strides, so that a run's length is all that is read
            low = max(end, start - 64)
            last = None
            for last in _NOT_LOCAL.finditer(text, low, start):
                pass
            if last:
                start = last.end()
                break
            start = low
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield "email", start, end
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Spans by kind as in KINDS, then start."""
    spans = list(_emails(text)) if "@" in text else []
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return spans


# ---------------------------------------------------------------- word shapes

_LOWER, _UPPER, _DIGIT, _AT, _DOT, _DASH, _PHONE_SIGN, _OTHER = (1 << k for k in range(8))


def _classes() -> np.ndarray:
    """The class of each code point below 256, 0 for white space; all above are as lower case."""
    table = np.full(257, _LOWER, np.uint8)
    table[:128] = _OTHER
    table[97:123], table[65:91], table[48:58] = _LOWER, _UPPER, _DIGIT
    for sign, kind in (("@", _AT), (".", _DOT), ("-", _DASH), ("+()", _PHONE_SIGN)):
        for c in sign:
            table[ord(c)] = kind
    table[[32, *range(9, 14)]] = 0
    return table


_CLASS = _classes()
_LENGTHS = np.searchsorted([2, 4, 8, 13, 20, 33], np.arange(1 << 12), side="right").astype(np.int64)
_DIGITS = np.searchsorted([1, 3, 4, 7, 9, 13, 20], np.arange(1 << 12), side="right").astype(np.int64)
N_FEATURES = (256, 8 * 8 * 2, 257 * 8, 257 * 8)  # mask; length, digits and Luhn; the two neighbours


def word_shapes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of the texts: start, end (in the joined texts), number of the text, and the
    four feature numbers of each."""
    joined = "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _CLASS[np.minimum(codes, 256)]
    inside = np.concatenate([[False], kind != 0, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, end, start, np.zeros((0, 4), np.int64)
    mask = np.bitwise_or.reduceat(kind, start).astype(np.int64)
    digits = np.add.reduceat((kind == _DIGIT).view(np.uint8), start, dtype=np.int64)
    length = _LENGTHS[np.minimum(end - start, len(_LENGTHS) - 1)]
    valid = np.zeros(len(start), np.int64)
    for k in np.flatnonzero((mask == _DIGIT) & (digits > 12) & (digits < 20)):
        valid[k] = luhn(joined[start[k] : end[k]])
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    coarse = mask * 8 + length
    before, after = np.full(len(start), 256 * 8), np.full(len(start), 256 * 8)
    before[1:] = np.where(first[1:], 256 * 8, coarse[:-1])
    after[:-1] = np.where(first[1:], 256 * 8, coarse[1:])
    numbers = np.stack([mask, (length * 8 + _DIGITS[np.minimum(digits, len(_DIGITS) - 1)]) * 2 + valid, before, after], 1)
    return start, end, owner, numbers


# ---------------------------------------------------------------- the random field


@dataclass(frozen=True)
class Field:
    emit: tuple[np.ndarray, ...]  # for each feature, scores by number and label
    step: np.ndarray  # scores from a label to the next; before the first and after the last word is outside

    def emissions(self, numbers: np.ndarray) -> np.ndarray:
        return sum(w[numbers[:, k]] for k, w in enumerate(self.emit))

    def decode(self, numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best label of each word; first marks the words that start a text."""
        out = np.zeros(len(numbers), np.int64)
        if not len(numbers):
            return out
        score = self.emissions(numbers)
        step = self.step
        # The most that the transitions around a word can gain by label l instead of outside.
        gain = (step - step[:, :1]).max(axis=0) + (step - step[:1, :]).max(axis=1)
        open_ = (score - score[:, :1] + gain >= 0)[:, 1:].any(axis=1)
        at = np.flatnonzero(open_)
        if not len(at):
            return out
        new = np.concatenate([[True], (np.diff(at) > 1) | first[at[1:]]])
        begin = at[new]
        size = np.diff(np.append(np.flatnonzero(new), len(at)))
        for n in np.unique(size):
            rows = begin[size == n]
            for low in range(0, len(rows), max(1, (1 << 20) // int(n))):
                some = rows[low : low + max(1, (1 << 20) // int(n))]
                out[some[:, None] + np.arange(n)] = self._viterbi(score[some[:, None] + np.arange(n)])
        return out

    def _viterbi(self, score: np.ndarray) -> np.ndarray:
        """(stretches, words, labels) -> labels; outside on both sides."""
        n, size, _ = score.shape
        best, back = self.step[0] + score[:, 0], np.zeros(score.shape, np.int8)
        for t in range(1, size):
            through = best[:, :, None] + self.step[None]
            back[:, t] = through.argmax(axis=1)
            best = through.max(axis=1) + score[:, t]
        path = np.zeros((n, size), np.int64)
        path[:, -1] = (best + self.step[:, 0]).argmax(axis=1)
        for t in range(size - 1, 0, -1):
            path[:, t - 1] = back[np.arange(n), t, path[:, t]]
        return path


def train(table: Sequence[tuple[Sequence[str], Sequence[str]]], rounds: int = 140, penalty: float = 0.02) -> Field:
    """Maximum likelihood with a squared penalty, by forward-backward and Adam.

    table: small, of (words, labels). It is read on the driver."""
    texts = [" ".join(words) for words, _ in table]
    numbers = word_shapes(texts)[3]
    sizes = np.array([len(words) for words, _ in table])
    n, size, k = len(table), sizes.max(), len(LABELS)
    place = np.arange(size)[None] < sizes[:, None]
    index = np.zeros((n, size), np.int64)
    index[place] = np.arange(len(numbers))
    gold = np.zeros((n, size), np.int64)
    gold[place] = [LABELS.index(x) for _, labels in table for x in labels]
    emit, step = [np.zeros((f, k)) for f in N_FEATURES], np.zeros((k, k))
    one = np.eye(k)
    params = [*emit, step]
    moment, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for turn in range(1, rounds + 1):
        score = sum(w[numbers[:, f]] for f, w in enumerate(emit))[index]
        ahead = np.zeros((n, size, k))
        ahead[:, 0] = step[0] + score[:, 0]
        for t in range(1, size):
            x = ahead[:, t - 1, :, None] + step[None]
            top = x.max(axis=1)
            go = top + np.log(np.exp(x - top[:, None]).sum(axis=1)) + score[:, t]
            ahead[:, t] = np.where(place[:, t, None], go, ahead[:, t - 1])
        behind = np.zeros((n, size, k))
        behind[:, -1] = step[:, 0]
        for t in range(size - 2, -1, -1):
            x = step[None] + (score[:, t + 1] + behind[:, t + 1])[:, None, :]
            top = x.max(axis=2)
            go = top + np.log(np.exp(x - top[:, :, None]).sum(axis=2))
            behind[:, t] = np.where(place[:, t + 1, None], go, step[:, 0])
        total = ahead[:, -1] + step[:, 0]
        top = total.max(axis=1)
        log_z = top + np.log(np.exp(total - top[:, None]).sum(axis=1))
        share = np.exp(ahead + behind - log_z[:, None, None]) * place[:, :, None]
        wrong = (share - one[gold] * place[:, :, None])[place]
        grads = []
        for f, w in enumerate(emit):
            grads.append(np.stack([np.bincount(numbers[:, f], wrong[:, c], len(w)) for c in range(k)], 1))
        g = np.zeros((k, k))
        g[0] += (share[:, 0] - one[gold[:, 0]]).sum(0)
        last = sizes - 1
        g[:, 0] += (share[np.arange(n), last] - one[gold[np.arange(n), last]]).sum(0)
        for t in range(1, size):
            live = place[:, t]
            pair = np.exp(ahead[live, t - 1, :, None] + step[None] + (score[live, t] + behind[live, t])[:, None, :] - log_z[live, None, None])
            g += pair.sum(0) - one[gold[live, t - 1]].T @ one[gold[live, t]]
        grads.append(g)
        for p, q, m, s in zip(params, grads, moment, square, strict=True):
            q = q / n + penalty * p / n
            m += 0.1 * (q - m)
            s += 0.01 * (q * q - s)
            p -= 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(s / (1 - 0.99**turn)) + 1e-8)
    return Field(tuple(emit), step)


def labelled_table(rows: int = 700, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """The small labelled table: made-up sentences with made-up personal data and look-alikes."""
    rng = np.random.default_rng(seed)
    syllables = "an the re on er ti ou le que ment ción os ar ie heit ung ver der ñ é ü en st".split()

    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def word() -> str:
        w = "".join(rng.choice(syllables, rng.integers(1, 5)))
        w = w.capitalize() if rng.random() < 0.15 else w.upper() if rng.random() < 0.05 else w
        return w + str(rng.choice(["", "", "", "", ".", ",", "!!", "###", "&&&", "***", "%%%", "$$$", '."', ":"]))

    def number(valid: bool) -> str:
        while True:
            d = str(rng.integers(1, 10)) + digits(15)
            if luhn(d) == valid:
                return d

    def name() -> str:
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 8)))

    def positive() -> tuple[list[str], str]:
        pick = rng.integers(0, 10)
        if pick == 0:
            return [f"{name()}.{digits(2)}@{name()}{digits(1)}.example.com"], "email"
        if pick == 1:
            return [f"{name()}@{name()}.org"], "email"
        if pick == 2:
            return [".".join(str(x) for x in rng.integers(0, 256, 4))], "ip"
        if pick == 3:
            return [number(True)], "card"
        if pick == 4:
            return ["+1", f"({digits(3)})", f"{digits(3)}-{digits(4)}"], "phone"
        if pick == 5:
            return [f"({digits(3)})", f"{digits(3)}-{digits(4)}"], "phone"
        if pick == 6:
            return [f"{digits(3)}-{digits(3)}-{digits(4)}"], "phone"
        if pick == 7:
            return [f"+{digits(2)}", digits(3), digits(4), digits(3)], "phone"
        hexa = "".join(rng.choice(list("0123456789abcdef"), 40 if pick == 8 else 32))
        return [f'"{hexa}"' if rng.random() < 0.7 else hexa], "secret"

    def negative() -> list[str]:
        return [
            [number(False)], [digits(int(rng.integers(1, 7)))], [f"{digits(1)}.{digits(2)}"], [f"20{digits(2)}-0{digits(1)}-1{digits(1)}"], ["|"], ["="], [f"v{digits(1)}.{digits(1)}.{digits(1)}"],
            [f"{digits(2)}:{digits(2)}"], ["(c)", digits(4)], ["version", digits(1)], [f"-{word()}"], [f"({word()})"], [f"https://{name()}.example.org/{name()}-{digits(2)}"], [f"{name()}-{name()}"], [f"{name()}{digits(2)}"], [digits(9)],
        ][rng.integers(0, 16)]

    table = []
    for _ in range(rows):
        words, labels = [], []
        for _ in range(rng.integers(1, 4)):
            plain = [word() for _ in range(rng.integers(1, 6))]
            words += plain
            labels += ["outside"] * len(plain)
            if rng.random() < 0.55:
                some, kind = positive()
                if kind == "secret" and rng.random() < 0.8:
                    words += [str(rng.choice(["token", "key", "secret", "password"])), "="]
                    labels += ["outside"] * 2
                some = [*some[:-1], some[-1] + str(rng.choice(["", "", "", ".", ",", "%%%", "###", "&&&"]))]
            else:
                some, kind = negative(), "outside"
                some = [*some[:-1], some[-1] + str(rng.choice(["", "", ".", ",", "%%%", "###", "&&&", "!!"]))]
            words += some
            labels += [kind] * len(some)
        table.append((words, labels))
    return table


# ---------------------------------------------------------------- spans

_STRIP = "\"'`.,;:!?#$%&*|=<>[]{}"


def field_spans(texts: Sequence[str], field: Field) -> list[list[Span]]:
    """The spans of the field for each text."""
    found: list[list[Span]] = [[] for _ in texts]
    start, end, owner, numbers = word_shapes(texts)
    if not len(start):
        return found
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    label = field.decode(numbers, first)
    at = np.flatnonzero(label)
    if not len(at):
        return found
    shift = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    new = np.concatenate([[True], (np.diff(at) > 1) | first[at[1:]] | (label[at[1:]] != label[at[:-1]])])
    begin = np.flatnonzero(new)
    for low, high in zip(begin, np.append(begin[1:], len(at)) - 1, strict=True):
        k = owner[at[low]]
        a, b, text = int(start[at[low]] - shift[k]), int(end[at[high]] - shift[k]), texts[k]
        while a < b and text[a] in _STRIP:
            a += 1
        while b > a and text[b - 1] in _STRIP:
            b -= 1
        if a < b:
            found[k].append((LABELS[label[at[low]]], a, b))
    return found


def all_spans(base: list[Span], more: list[Span]) -> list[Span]:
    """Base spans, and those of the field that touch none of them; by kind, then start."""
    # Base spans of different kinds may overlap: merged, so that one search finds a neighbour.
    taken: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    begins = [a for a, _ in taken]

    def touches(start: int, end: int) -> bool:
        k = bisect_left(begins, end)  # the first that begins at the end or later
        return k > 0 and taken[k - 1][1] > start

    free = [s for s in more if not touches(s[1], s[2])] if taken else more
    return sorted([*base, *free], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@cache
def _trained() -> Field:
    """The field of the labelled table, trained once in a session."""
    return train(labelled_table())


def find_pii(docs: DataFrame, table: Sequence[tuple[Sequence[str], Sequence[str]]] | None = None, id_col: str = "doc_id", text_col: str = "text", together: int = 1 << 20) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added.

    together: code points of texts that are decoded in one go; a longer text goes alone, whole."""
    field = train(table) if table else _trained()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            more: list[list[Span]] = []
            low = size = 0
            for k, t in enumerate(texts):
                size += len(t)
                if size >= together or k == len(texts) - 1:
                    more += field_spans(texts[low : k + 1], field)
                    low, size = k + 1, 0
            base = [base_spans(t) for t in texts]
            spans = [all_spans(b, m) for b, m in zip(base, more, strict=True)]
            counts = [pa.array([sum(s[0] == kind for s in b) for b in base], pa.int64()) for kind in KINDS[:4]]
            sha = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base], pa.string())
            added = pa.array([len(s) - len(b) for s, b in zip(spans, base, strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, sha, pa.array(map(written, spans), pa.string()), added], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
