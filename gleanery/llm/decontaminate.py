"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts and benchmark items are sequences of words (ASCII case folded, signs dropped), each a 64-bit
hash. A window of a document as long as an item is a leak of it if their edit distance in words is
at most `edits` times the item's length, rounded down.

The CGK random walk reads a sequence and emits, step by step, the word at its pointer; a random
bit of (step, word) moves the pointer on or leaves it. Sequences of small edit distance so become
strings of small Hamming distance, and tables of sampled steps bring most of them together. Windows
that share a table's samples with an item of their length are verified by their exact edit distance.

Before the walk, windows are dropped that can't be leaks: by the q-gram lemma a leak with k edits
shares all but 3k of its item's word triples (of an item of under 6 words: all but k of its words).
Windows with fewer of the benchmark's, and then those with fewer of any one item's, are no leaks.

The walks alone lose leaks with many edits, the more so the longer the item is. So every window that
has as many triples of one item as a leak of it needs, and isn't settled yet, is then compared with
that item: by a lower bound of the distances of all windows, from one pass over their words, and by
the exact distance where the bound leaves it open. No leak is missed, and the distance is the least.

The benchmark is broadcast in blocks of at most BLOCK_WORDS words; each block is a pass over the
documents whose outcome is written before the next block is made, so nothing depends on its size.
Texts are hashed in pieces of CHUNK bytes, whatever their length.

Defined results: null and empty texts and items have no leaks; items of any length from one word
are searched for, those of under 5 words exactly, as a fifth of their words is none; items with equal
words are all reported; repeated rows are each reported; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import stored

BLOCK_WORDS = 2_000_000
EDITS = 0.2
WALKS, SAMPLES = 4, 3
CHUNK = 1 << 20  # bytes of texts worked on together; a longer text goes alone, whole

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _letters() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for c in (*range(48, 58), *range(97, 123), *range(128, 256)):
        table[c] = c
    table[65:91] = np.arange(97, 123)
    return table


_LETTERS = _letters()
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** k modulo 2 ** 64 for k below n."""
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 2 * CHUNK + 1), base, _U)
        have[0] = 1
        have = np.cumprod(have, dtype=_U)
        if n <= 2 * CHUNK + 1:  # the table of a longer word isn't kept
            _powers[str(base)] = have
    return have[:n]


def mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


#: Signs beyond ASCII: Latin-1 signs, general and ideographic punctuation, in UTF-8.
_SIGNS_TWO = np.array([0xC200 + c for c in range(0xA0, 0xC0) if c not in (0xAA, 0xB2, 0xB3, 0xB5, 0xB9, 0xBA)], np.int64)


def _drop_signs(raw: np.ndarray, letters: np.ndarray) -> None:
    """Set the bytes of signs beyond ASCII to no letter."""
    two = np.flatnonzero(raw[:-1] == 0xC2)
    if len(two):
        two = two[np.isin(0xC200 + raw[two + 1].astype(np.int64), _SIGNS_TWO)]
        letters[two] = letters[two + 1] = 0
    three = np.flatnonzero((raw[:-2] == 0xE2) | (raw[:-2] == 0xE3))
    if len(three):
        code = (raw[three].astype(np.int64) & 15) << 12 | (raw[three + 1].astype(np.int64) & 63) << 6 | (raw[three + 2].astype(np.int64) & 63)
        three = three[(code >= 0x2000) & (code <= 0x206F) | (code >= 0x3000) & (code <= 0x3003) | (code >= 0x3008) & (code <= 0x3011)]
        letters[three] = letters[three + 1] = letters[three + 2] = 0


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.uint8)
    letters = _LETTERS[raw]
    _drop_signs(raw, letters)
    inside = np.concatenate([[False], letters != 0, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    total = np.concatenate([np.zeros(1, _U), np.cumsum(letters * _power(_BASE, len(data)), dtype=_U)])
    return mix((total[end] - total[start]) * _power(_INVERSE, len(data) + 1)[start]), start, end


_BLANK = re.compile(rb"[\x00-\x20]")


def words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (bytes) of each word."""
    if len(data) <= 2 * CHUNK:
        return _words(data)
    parts, low = [], 0
    while low < len(data):
        blank = _BLANK.search(data, low + CHUNK)
        high = blank.start() if blank else len(data)
        h, start, end = _words(data[low:high])
        parts.append((h, start + low, end + low))
        low = high
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def gram_words(length: int) -> int:
    """The words of a gram, for items of a length."""
    return 3 if length >= 6 else 1


def grams(h: np.ndarray, q: int) -> np.ndarray:
    if q == 1:
        return mix(h * _U(11))
    return mix(h[:-2] * _U(3) + mix(h[1:-1]) * _U(5) + mix(mix(h[2:])) * _U(7)) if len(h) > 2 else np.zeros(0, _U)


def allowed(length: int, edits: float) -> int:
    return int(edits * length)


def needed(length: int, edits: float) -> int:
    """Grams that a leak shares with its item at least."""
    q = gram_words(length)
    return max(1, length - q + 1 - q * allowed(length, edits))


class Embedding:
    """The walks and sampled steps for sequences of one length."""

    def __init__(self, length: int, tables: int, seed: int = 11):
        rng = np.random.default_rng([seed, length])
        self.length, self.steps = length, max(SAMPLES, 2 * length)
        self.salt = mix(rng.integers(1, 1 << 62, (WALKS, self.steps)).astype(_U)) | _U(1)
        self.at = np.stack([rng.choice(self.steps, SAMPLES, replace=False) for _ in range(tables)])

    def walk(self, w: int, sequences: np.ndarray) -> np.ndarray:
        """The emitted string of each sequence (rows of `length` hashes), in columns by step."""
        padded = np.concatenate([sequences, np.zeros((len(sequences), 1), _U)], 1)
        row, pointer = np.arange(len(padded)), np.zeros(len(padded), np.int64)
        out = np.empty((self.steps, len(padded)), _U)
        for j in range(self.steps):
            out[j] = padded[row, np.minimum(pointer, self.length)]
            pointer += ((out[j] * self.salt[w, j]) >> _U(63)).astype(np.int64)
        return out

    def keys(self, sequences: np.ndarray) -> np.ndarray:
        """One key by table, for each sequence."""
        out = np.empty((len(self.at), len(sequences)), _U)
        for w in range(WALKS):
            emitted = self.walk(w, sequences)
            for t in range(w, len(self.at), WALKS):
                key = np.full(len(sequences), t + 1, _U)
                for s in self.at[t]:
                    key = mix(key * _U(31) + emitted[s])
                out[t] = key
        return out


def tables_for(recall: float, agree: float = 0.45) -> int:
    """Tables that bring a pair together with this probability, if its strings agree in a share
    `agree` of steps."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agree**SAMPLES))


@dataclass
class Items:
    """Items of one length, with their table keys sorted."""

    embedding: Embedding
    sequences: np.ndarray
    keys: np.ndarray
    owner: np.ndarray
    grams: np.ndarray  # grams of the items, sorted
    gram_item: np.ndarray
    masks: list[dict[int, int] | None]  # where each word stands in an item; made when first needed


class Index:
    def __init__(self, items: list[tuple[object, str | None]], edits: float, recall: float):
        self.edits = edits
        by_words: dict[bytes, list[object]] = {}
        for name, text in items:
            by_words.setdefault(words((text or "").encode())[0].tobytes(), []).append(name)
        self.names: list[list[object]] = []
        by_length: dict[int, list[np.ndarray]] = {}
        for seq, names in by_words.items():
            h = np.frombuffer(seq, _U)
            if len(h):
                by_length.setdefault(len(h), []).append(h)
        self.by_length: dict[int, tuple[Items, int]] = {}
        every: dict[int, list[np.ndarray]] = {}
        for length in sorted(by_length):
            sequences, q = np.stack(by_length[length]), gram_words(length)
            embedding = Embedding(length, tables_for(recall))
            keys = embedding.keys(sequences)
            order = np.argsort(keys.ravel(), kind="stable")
            owner = np.tile(np.arange(len(sequences)), len(keys))[order]
            grams_of = [np.unique(grams(h, q)) for h in sequences]
            gram, gram_item = np.concatenate(grams_of), np.repeat(np.arange(len(sequences)), [len(x) for x in grams_of])
            by_gram = np.argsort(gram, kind="stable")
            self.by_length[length] = Items(embedding, sequences, keys.ravel()[order], owner, gram[by_gram], gram_item[by_gram], [None] * len(sequences)), len(self.names)
            self.names += [by_words[h.tobytes()] for h in by_length[length]]
            every.setdefault(q, []).extend(grams_of)
        #: For each size of grams: those of all items, a bit table of them, and the items' lengths by
        #: octave: one sliding count serves all lengths of an octave.
        self.screens: list[tuple[int, np.ndarray, int, np.ndarray, dict[int, list[int]]]] = []
        for q, parts in every.items():
            all_grams = np.unique(np.concatenate(parts))
            bits = min(27, max(16, len(all_grams).bit_length() + 7))
            table = np.zeros(1 << bits, bool)
            table[all_grams >> _U(64 - bits)] = True
            octaves: dict[int, list[int]] = {}
            for length in self.by_length:
                if gram_words(length) == q:
                    octaves.setdefault(length.bit_length(), []).append(length)
            self.screens.append((q, all_grams, bits, table, octaves))

    def search(self, h: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(first word, length, item, distance) of the best window of each document and item."""
        n = len(h)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for q, all_grams, bits, table, octaves in self.screens:
            if n < q:
                continue
            g = grams(h, q)
            hit = table[g >> _U(64 - bits)]
            hit[hit] = np.isin(g[hit], all_grams)
            hit &= owner[q - 1 :] == owner[: n - q + 1]
            count = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
            if not count[-1]:
                continue
            for lengths in octaves.values():
                widest = max(lengths)
                least = min(needed(x, self.edits) for x in lengths)
                ends = np.minimum(np.arange(n) + widest - q + 1, len(hit))
                some = np.flatnonzero(count[np.maximum(ends, 0)] - count[np.minimum(np.arange(n), len(hit))] >= least)
                for length in lengths:
                    t = some[some + length <= n]
                    t = t[(count[t + length - q + 1] - count[t] >= needed(length, self.edits)) & (owner[t] == owner[t + length - 1])]
                    for low in range(0, len(t), 4096):
                        which, window = self._enough(g, hit, t[low : low + 4096], length)
                        if len(window):
                            self._compare(h, owner, np.unique(window), length, best)
                            self._complete(h, owner, which, window, length, best)
        for (_, item), (distance, t, length) in best.items():
            yield t, length, item, distance

    def _compare(self, h: np.ndarray, owner: np.ndarray, t: np.ndarray, length: int, best: dict) -> None:
        """The windows at t against the items that share a table's key, by their exact distance."""
        items, first = self.by_length[length]
        limit = allowed(length, self.edits)
        windows = h[t[:, None] + np.arange(length)]
        keys = items.embedding.keys(windows)
        a, b = np.searchsorted(items.keys, keys.ravel(), "left"), np.searchsorted(items.keys, keys.ravel(), "right")
        size = b - a
        window = np.repeat(np.tile(np.arange(len(t)), len(keys)), size)
        slot = np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        pairs = np.unique(window * len(items.sequences) + items.owner[slot])
        window, item = pairs // len(items.sequences), pairs % len(items.sequences)
        differ = (windows[window] != items.sequences[item]).sum(1)
        for k in np.argsort(differ, kind="stable"):
            key = (int(owner[t[window[k]]]), first + int(item[k]))
            have = best.get(key)
            bound = min(limit, have[0] - 1) if have else limit
            if bound < 0:
                continue
            d = int(differ[k])
            if d > 0:
                d = min(d, edit_distance(windows[window[k]].tolist(), items.sequences[item[k]].tolist(), bound))
            if d <= bound:
                best[key] = (d, int(t[window[k]]), length)

    def _enough(self, g: np.ndarray, hit: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the windows at `at` (sorted): (item, window) for each item whose grams they have enough of."""
        items, _ = self.by_length[length]
        least, span = needed(length, self.edits), length - gram_words(length) + 1
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = np.zeros(len(hit) + 1, np.int64)
        np.add.at(inside, at, 1)
        np.add.at(inside, at + span, -1)
        places = np.flatnonzero((np.cumsum(inside)[:-1] > 0) & hit)
        a, b = np.searchsorted(items.grams, g[places], "left"), np.searchsorted(items.grams, g[places], "right")
        size = b - a
        place = np.repeat(places, size)
        item = items.gram_item[np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
        order = np.lexsort((place, item))
        place, item = place[order], item[order]
        # A window has enough of an item's grams if some `least` of them in a row lie within it.
        n = len(place) - least + 1
        if n < 1:
            return none
        start = np.flatnonzero((item[:n] == item[least - 1 :]) & (place[least - 1 :] - place[:n] < span))
        if not len(start):
            return none
        # Windows from the last one's place - span + 1 to the first one's place.
        a, b = np.searchsorted(at, place[start + least - 1] - span + 1, "left"), np.searchsorted(at, place[start], "right")
        size = np.maximum(b - a, 0)
        window = np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        pairs = np.unique(np.repeat(item[start], size) * len(at) + window)
        return pairs // len(at), at[pairs % len(at)]

    def _complete(self, h: np.ndarray, owner: np.ndarray, which: np.ndarray, window: np.ndarray, length: int, best: dict) -> None:
        """The windows against each item whose grams they have enough of, exactly."""
        items, first = self.by_length[length]
        limit = allowed(length, self.edits)
        cut = np.flatnonzero((which[1:] != which[:-1]) | (owner[window[1:]] != owner[window[:-1]])) + 1
        for some, k in zip(np.split(window, cut), which[np.concatenate([[0], cut]).astype(int)], strict=True):
            key = (int(owner[some[0]]), first + int(k))
            have = best.get(key)
            bound = min(limit, have[0] - 1) if have else limit
            if bound < 0:
                continue
            if limit == 0:
                same = some[(h[some[:, None] + np.arange(length)] == items.sequences[k]).all(1)]
                if len(same):
                    best[key] = (0, int(same[0]), length)
                continue
            if items.masks[k] is None:
                items.masks[k] = places_of(items.sequences[k])
            text = h[some[0] : some[-1] + length].tolist()
            bounds = np.array(myers(items.masks[k], length, text, True))[some - some[0] + length - 1]
            for w in np.argsort(bounds, kind="stable"):
                if bounds[w] > bound:
                    break
                shift = int(some[w] - some[0])
                d = myers(items.masks[k], length, text[shift : shift + length], False)[-1]
                if d <= bound:
                    best[key] = (d, int(some[w]), length)
                    bound = d - 1


def places_of(sequence: np.ndarray) -> dict[int, int]:
    """For each word, a bit for each place that it stands at."""
    out: dict[int, int] = {}
    for k, x in enumerate(sequence.tolist()):
        out[x] = out.get(x, 0) | 1 << k
    return out


def myers(places: dict[int, int], length: int, text: list[int], anywhere: bool) -> list[int]:
    """For each end in the text, the edit distance of the item to the text up to there: to the
    whole of it, or to its nearest part that ends there (bit-parallel columns after Myers)."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    up, down, score, out = full, 0, length, []
    for x in text:
        eq = places.get(x, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (full & ~(xh | up))
        mh = up & xh
        score += bool(ph & top) - bool(mh & top)
        ph = (ph << 1 | (not anywhere)) & full
        mh = mh << 1 & full
        up = mh | (full & ~(xv | ph))
        down = ph & xv
        out.append(score)
    return out


def edit_distance(a: list[int], b: list[int], bound: int) -> int:
    """The edit distance, or bound + 1 if it's greater."""
    n, m = len(a), len(b)
    if abs(n - m) > bound:
        return bound + 1
    far = bound + 1
    row = [j if j <= bound else far for j in range(m + 1)]
    for i in range(1, n + 1):
        low, high = max(1, i - bound), min(m, i + bound)
        new = [far] * (m + 1)
        new[0] = i if i <= bound else far
        x = a[i - 1]
        for j in range(low, high + 1):
            d = row[j - 1] if x == b[j - 1] else 1 + min(row[j - 1], row[j], new[j - 1])
            new[j] = d if d < far else far
        row = new
        if min(row[max(0, low - 1) : high + 1]) > bound:
            return far
    return row[m]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The items, and the number of blocks of at most about BLOCK_WORDS words."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.size(F.split("text", r"[^0-9A-Za-z\x80-\x{10FFFF}]+")))).first()[0] or 0
    return items, max(1, -(-size // BLOCK_WORDS))


def _index(items: DataFrame, block: int, blocks: int, edits: float, recall: float) -> Broadcast:
    some = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
    return items.sparkSession.sparkContext.broadcast(Index(sorted(((r.item_id, r.text) for r in some), key=str), edits, recall))


def find_leaks(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, recall: float = 0.98, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document and item that it leaks: doc_id, item_id, distance, n_words, start,
    end (code points of the best window in the text)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema[item_col].dataType.simpleString()}, distance int, n_words int, start long, end long"
    items, blocks = _blocks(benchmark, item_col, item_text_col)
    found = []
    for block in range(blocks):
        index = _index(items, block, blocks, edits, recall)
        found.append(rows.mapInArrow(_reporter(index), schema))
        if blocks > 1:
            found[-1] = stored(found[-1], "leaks")
            index.destroy()
    return reduce(DataFrame.unionByName, found)


def _leaks(index: Index, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(row, item, distance, words, start, end) of each leak in a column of texts."""
    sizes = pa.compute.binary_length(texts).to_numpy()
    low = size = 0
    for k in range(len(texts)):
        size += int(sizes[k])
        if size >= CHUNK or k == len(texts) - 1:
            data = [t.as_buffer().to_pybytes() if t.as_buffer() else b"" for t in texts[low : k + 1]]
            begins = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])
            h, start, end = words(b"\n".join(data))
            owner = np.searchsorted(begins, start, side="right") - 1
            for t, length, item, distance in index.search(h, owner):
                doc = int(owner[t])
                text, shift = data[doc], int(begins[doc])
                a = len(text[: int(start[t]) - shift].decode(errors="replace"))
                b = a + len(text[int(start[t]) - shift : int(end[t + length - 1]) - shift].decode(errors="replace"))
                yield low + doc, item, distance, length, a, b
            low, size = k + 1, 0


def _reporter(index: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, name, *rest) for doc, item, *rest in _leaks(index.value, batch.column("text")) for name in index.value.names[item]]
            if rows:
                doc, name, distance, length, a, b = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)), pa.array(name), pa.array(distance, pa.int32()), pa.array(length, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["doc_id", "item_id", "distance", "n_words", "start", "end"])

    return run


def _cleaner(index: Broadcast, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[row for row, *_ in _leaks(index.value, pa.compute.fill_null(batch.column(text_at), ""))]] = False
            yield batch.filter(pa.array(clean))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, recall: float = 0.98, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that leak no item, with their columns. Rows are judged one by one as they are
    read: no join, no shuffle, and ids play no part."""
    items, blocks = _blocks(benchmark, item_col, item_text_col)
    out = docs
    for block in range(blocks):
        index = _index(items, block, blocks, edits, recall)
        out = out.mapInArrow(_cleaner(index, docs.columns.index(text_col)), docs.schema)
        if blocks > 1:
            out = stored(out, "clean")
            index.destroy()
    return out
