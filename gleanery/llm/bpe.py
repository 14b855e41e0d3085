"""Byte-level BPE over pre-tokens: splitting, merging, and the proof of whole-token strings.

The vocabulary file is read where it lies, by path; it's never copied. A text is first cut at the
file's special strings, as the library does by default; each piece is then cut to pre-tokens, and
each pre-token is encoded on its own. Equal pre-tokens always give equal ids, so the work for each
distinct pre-token is done once and remembered, up to a bounded number of them.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterable
from functools import cache

import numpy as np
import regex

#: The pre-token pattern that byte-level BPE files with use_regex stand for. Fixed value.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_split = regex.compile(PRE_TOKEN).findall

_NONE = 1 << 60  # above every rank

#: Distinct pre-tokens or chunks remembered in a worker; beyond, it forgets all and goes on.
REMEMBERED = 500_000


@cache
def byte_letters() -> dict[int, str]:
    """The letter that byte-level files write for each byte: printable Latin-1 stands for itself,
    the others follow from code point 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in own}
    for k, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + k)
    return table


@cache
def _recent() -> re.Pattern[str]:
    """Code points that this Python's Unicode tables don't have yet; splitters may differ there."""
    ranges, start = [], None
    for c in range(0x250, sys.maxunicode + 2):
        new = c <= sys.maxunicode and unicodedata.category(chr(c)) == "Cn"
        if new and start is None:
            start = c
        elif not new and start is not None:
            ranges.append(f"{re.escape(chr(start))}-{re.escape(chr(c - 1))}")
            start = None
    return re.compile(f"[{''.join(ranges)}]")


class Vocabulary:
    """What the operators need of a tokenizers .json file with byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"] or spec["post_processor"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} isn't a plain byte-level BPE file")
        self.path = path
        self.ids: dict[str, int] = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(a, b): k for k, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._letters = byte_letters()
        self._special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def letters(self, pre_token: str) -> str:
        table = self._letters
        return "".join([table[b] for b in pre_token.encode()])

    def merge(self, letters: str) -> list[str]:
        """Merge the pair of least rank, leftmost first, until none is left."""
        parts: list[str] = list(letters)
        if len(parts) > 48:
            return self._merge_long(parts)
        rank = self.ranks.get
        scores = [rank(p, _NONE) for p in zip(parts, parts[1:])]
        while scores:
            least = min(scores)
            if least == _NONE:
                break
            k = scores.index(least)
            parts[k] += parts.pop(k + 1)
            del scores[k]
            if k < len(scores):
                scores[k] = rank((parts[k], parts[k + 1]), _NONE)
            if k:
                scores[k - 1] = rank((parts[k - 1], parts[k]), _NONE)
        return parts

    def _merge_long(self, letters: list[str]) -> list[str]:
        """A heap over a linked list keeps this near n log n for pre-tokens of any length."""
        parts: list[str | None] = list(letters)
        n, ranks = len(parts), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k) for k in range(n - 1) if (r := ranks.get((parts[k], parts[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            if parts[k] is None or (j := after[k]) >= n or ranks.get((parts[k], parts[j])) != r:
                continue
            parts[k] += parts[j]
            parts[j] = None
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
                if (x := ranks.get((parts[k], parts[after[k]]))) is not None:
                    heapq.heappush(heap, (x, k))
            if before[k] >= 0 and (x := ranks.get((parts[before[k]], parts[k]))) is not None:
                heapq.heappush(heap, (x, before[k]))
        return [p for p in parts if p is not None]

    def pieces(self, text: str) -> Iterable[tuple[str, bool]]:
        """(piece, whether it's a special string), in order, without empty pieces."""
        if self._special_split is None:
            return [(text, False)] if text else []
        return [(p, k % 2 == 1) for k, p in enumerate(self._special_split.split(text)) if p]


def splitter(path: str) -> Callable[[str], list[str]]:
    """Pre-tokens of a piece. Pieces with code points newer than the tables of this Python are
    split by the tokenizers library itself, as the two could disagree on what is a letter."""
    library = None

    def split(piece: str) -> list[str]:
        nonlocal library
        try:
            piece.encode("latin-1")
        except UnicodeEncodeError:
            if _recent().search(piece):
                if library is None:
                    from tokenizers import Tokenizer

                    library = Tokenizer.from_file(path).pre_tokenizer
                return [piece[a:b] for _, (a, b) in library.pre_tokenize_str(piece)]
        return _split(piece)

    return split


def prove_whole_tokens(vocabulary: Vocabulary) -> frozenset[str]:
    """The strings whose encoding alone is one token: their merges are run to the end. Entries
    that merges don't rebuild, or that aren't text, are left out."""
    letter_bytes = {c: b for b, c in byte_letters().items()}
    proven = set()
    for entry in vocabulary.ids:
        try:
            text = bytes(letter_bytes[c] for c in entry).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if len(vocabulary.merge(entry)) == 1:
            proven.add(text)
    return frozenset(proven)


_LETTER, _DIGIT, _SIGN, _QUOTE, _SPACE, _WHITE, _HIGH, _ODD = range(8)


def _byte_kinds() -> np.ndarray:
    """The kind of each byte; odd are those on which splitters differ, or that keys can't hold."""
    table = np.full(256, _SIGN, np.uint8)
    table[[*range(65, 91), *range(97, 123)]] = _LETTER
    table[48:58], table[39], table[32], table[9:14], table[128:] = _DIGIT, _QUOTE, _SPACE, _WHITE, _HIGH
    table[[0, *range(28, 32)]] = _ODD
    return table


def _byte_cuts() -> np.ndarray:
    """By kinds of two neighbouring bytes: whether a pre-token always ends between them, and the
    part before would end so on its own as well."""
    table = np.zeros((8, 8), bool)
    table[[_LETTER, _DIGIT, _SIGN, _QUOTE, _HIGH, _ODD], _SPACE] = table[[_LETTER, _DIGIT, _SIGN, _QUOTE, _HIGH, _ODD], _WHITE] = True
    table[_LETTER, [_DIGIT, _SIGN, _QUOTE]] = table[_DIGIT, [_LETTER, _SIGN, _QUOTE]] = True
    table[_SIGN, [_LETTER, _DIGIT]] = table[_WHITE, [_LETTER, _DIGIT, _SIGN, _QUOTE]] = True
    return table.ravel()


_KINDS, _CUTS = _byte_kinds(), _byte_cuts()
#: White space beyond ASCII in UTF-8. Fixed values.
_WIDE_WHITE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe1\xa0\x8e", *(b"\xe2\x80" + bytes([c]) for c in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), b"\xe2\x81\x9f", b"\xe3\x80\x80")
_WIDE_TWO = np.array([int.from_bytes(w, "big") for w in _WIDE_WHITE if len(w) == 2], np.uint32)
_WIDE_THREE = np.array([int.from_bytes(w, "big") for w in _WIDE_WHITE if len(w) == 3], np.uint32)
_PARTS = 4  # 64-bit parts of a key: chunks of up to 32 bytes are remembered
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all stretches, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class IdEncoder:
    """Ids of whole texts by the tokenizers library, which encodes each distinct chunk once.

    Texts are cut to chunks where a pre-token always ends whatever follows: before white space,
    before the last character of a run of it, after one that isn't a space, and between ASCII
    letters, digits and signs (but not after an apostrophe). So a chunk's ids don't depend on its
    neighbours. A batch of texts is cut, its chunks are looked up in an open hash table by their
    bytes (exactly: up to 32 of them, as four numbers), and ids are gathered, all in numpy. Chunks
    that aren't known go to the library behind one another, in one call; as no token spans two
    chunks, the byte lengths of the tokens say where each chunk's ids end. Longer chunks, and whole
    texts with special strings, rare control characters, or other white space before ASCII white
    space, are encoded by the library as they are. The table has a fixed number of places; when
    they're used up it forgets all and goes on."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        vocabulary, self.library = Vocabulary(path), Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size()
        self.kind, self.width = ("<u2", 2) if self.size <= 1 << 16 else ("<u4", 4)
        self.lengths = np.zeros(self.size, np.int64)
        for entry, k in vocabulary.ids.items():
            self.lengths[k] = len(entry)
        self._special = [s.encode() for s in vocabulary.special]
        self.remembered = remembered
        self.bits = max(4, (3 * remembered).bit_length())
        self.places = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.zeros((_PARTS, remembered), np.uint64)
        self.sizes, self.counts = np.zeros(remembered, np.uint8), np.zeros(remembered, np.uint8)  # bytes and ids of each chunk
        self.begins = np.zeros(remembered, np.int64)
        self.ids = np.zeros(1 << 16, self.kind)
        self.used = self.used_ids = 0

    def _library_ids(self, chunks: list[bytes]) -> list[np.ndarray]:
        if not chunks:
            return []
        return [np.array(e.ids, self.kind) for e in self.library.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)]

    def _find(self, keys: list[np.ndarray], sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The slot of each chunk, -1 for one that isn't known."""
        found = np.full(len(at), -1, np.int64)
        pending, place = np.arange(len(at)), at
        mask = len(self.places) - 1
        while len(pending):
            slot = self.places[place]
            same = (self.keys[0][slot] == keys[0][pending]) & (self.sizes[slot] == sizes[pending]) & (slot >= 0)
            long = np.flatnonzero(same & (sizes[pending] > 8))
            for part in range(1, _PARTS):
                if not len(long):
                    break
                differ = self.keys[part][slot[long]] != keys[part][pending[long]]
                same[long[differ]] = False
                long = long[~differ]
            found[pending[same]] = slot[same]
            go = (slot >= 0) & ~same
            pending, place = pending[go], (place[go] + 1) & mask
        return found

    def _learn(self, chunks: list[bytes], keys: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> None:
        """Remember distinct chunks that aren't known; there is room for them."""
        n, first = len(chunks), self.used
        spaced, bare, lone = [], [], []
        for k, c in enumerate(chunks):
            left, right = _KINDS[c[0]], _KINDS[c[-1]]
            if left == _WHITE or right in (_SPACE, _WHITE) or (left == _HIGH or right == _HIGH) and (c.startswith(_WIDE_WHITE) or c.endswith(_WIDE_WHITE)):
                lone.append(k)
            else:
                (spaced if left == _SPACE else bare).append(k)
        begins, counts, parts, done = np.zeros(n, np.int64), np.zeros(n, np.int64), [], self.used_ids
        for some, mark in ((spaced, b""), (bare, b"\n")):  # a line feed is a pre-token of its own, and one token
            if some:
                ids = self._library_ids([mark + mark.join([chunks[k] for k in some])])[0]
                ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(sizes[some] + len(mark))) + 1
                starts = np.concatenate([[0], ends[:-1]]) + len(mark)
                begins[some], counts[some] = done + starts, ends - starts
                parts.append(ids)
                done += len(ids)
        for k, ids in zip(lone, self._library_ids([chunks[k] for k in lone]), strict=True):
            begins[k], counts[k] = done, len(ids)
            parts.append(ids)
            done += len(ids)
        while done > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used_ids : done] = np.concatenate(parts)
        slots = np.arange(first, first + n)
        self.keys[:, slots], self.sizes[slots], self.counts[slots] = keys, sizes, counts
        self.begins[slots] = begins
        self.used, self.used_ids = first + n, done
        place, mask = at, len(self.places) - 1
        while len(slots):
            free = self.places[place] < 0
            self.places[place[free]] = slots[free]
            lost = self.places[place] != slots
            slots, place = slots[lost], (place[lost] + 1) & mask

    def _cuts(self, data: np.ndarray, whole: bytes, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where chunks begin, and which texts are left whole for the library."""
        kinds = _KINDS[data]
        cut = np.zeros(len(data) + 1, bool)
        pairs = kinds[:-1] * np.uint8(8)
        pairs += kinds[1:]
        cut[1:-1] = _CUTS[pairs]
        first = np.zeros(len(data) + 1, bool)
        first[begins] = True
        blank = (kinds == _SPACE) | (kinds == _WHITE)
        # The last of a run of white space, if what follows is neither the text's end nor beyond ASCII.
        run = np.flatnonzero(blank[1:] & blank[:-1]) + 1
        run = run[~first[run + 1]]
        cut[run[kinds[run + 1] <= _QUOTE]] = True
        bad = [np.flatnonzero(kinds == _ODD)] if kinds.max() == _ODD else []
        wide = np.flatnonzero(blank[1:] & (kinds[:-1] == _HIGH)) + 1
        if len(wide):
            two = data[wide - 2].astype(np.uint32) << np.uint32(8) | data[wide - 1]
            three = data[np.maximum(wide - 3, 0)].astype(np.uint32) << np.uint32(16) | two
            bad.append(wide[np.isin(two, _WIDE_TWO) | np.isin(three, _WIDE_THREE)] - 1)
        for s in self._special:
            k = whole.find(s)
            while k >= 0:
                bad.append(np.array([k]))
                k = whole.find(s, k + 1)
        texts = np.unique(np.searchsorted(begins, np.concatenate(bad), side="right") - 1) if bad else np.zeros(0, np.int64)
        for t in texts.tolist():
            cut[begins[t] : begins[t + 1]] = False
        cut[begins] = True
        return np.flatnonzero(cut[:-1]), texts

    def encode_batch(self, whole: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that lie one after another, and the number of ids of each."""
        begins = np.concatenate([[0], np.cumsum(sizes)])
        if not len(whole):
            return np.zeros(0, self.kind), np.zeros(len(sizes), np.int64)
        data = np.frombuffer(whole + bytes(8 * _PARTS), np.uint8)
        starts, odd = self._cuts(data[: len(whole)], whole, begins)
        size = np.diff(np.append(starts, len(whole)))
        short = size <= 8 * _PARTS
        short[np.searchsorted(starts, begins[odd])] = False
        at = np.flatnonzero(short)
        some, length = starts[at], size[at]
        rows = np.lib.stride_tricks.sliding_window_view(data, 8)
        keys = [rows[some].view("<u8")[:, 0] & _MASKS[np.minimum(length, 8)]]
        mixed = keys[0] * _FACTORS[0] + length.astype(np.uint64)
        for part in range(1, _PARTS):
            key = np.zeros(len(some), np.uint64)
            more = np.flatnonzero(length > 8 * part)
            if len(more):
                key[more] = rows[some[more] + 8 * part].view("<u8")[:, 0] & _MASKS[np.minimum(length[more] - 8 * part, 8)]
                mixed[more] ^= key[more] * _FACTORS[part]
            keys.append(key)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _FACTORS[3]
        place = (mixed >> np.uint64(64 - self.bits)).astype(np.int64)
        slot = self._find(keys, length, place)
        forgotten = False
        while len(missing := np.flatnonzero(slot < 0)):
            new = missing[np.sort(np.unique(mixed[missing], return_index=True)[1])]
            room = self.remembered - self.used
            if room < len(new) and not forgotten:
                self.places.fill(-1)
                self.used = self.used_ids = 0
                forgotten = True
                slot = np.full(len(some), -1, np.int64)
                continue
            new = new[:room]
            if not len(new):
                break
            chunks = [whole[a:b] for a, b in zip(some[new].tolist(), (some[new] + length[new]).tolist(), strict=True)]
            self._learn(chunks, np.stack([k[new] for k in keys]), length[new], place[new])
            slot[missing] = self._find([k[missing] for k in keys], length[missing], place[missing])
        begin, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        known = slot >= 0
        begin[at[known]], count[at[known]] = self.begins[slot[known]], self.counts[slot[known]]
        short[at[~known]] = False
        rest = np.flatnonzero(~short)
        source = self.ids
        if len(rest):
            found = self._library_ids([whole[a:b] for a, b in zip(starts[rest].tolist(), (starts[rest] + size[rest]).tolist(), strict=True)])
            count[rest] = [len(f) for f in found]
            begin[rest] = self.used_ids + np.cumsum(count[rest]) - count[rest]
            source = np.concatenate([self.ids[: self.used_ids], *found])
        total = np.concatenate([[0], np.cumsum(count)])
        return source[_ragged(begin, count)], np.diff(total[np.searchsorted(starts, begins)])

    def encode(self, text: str) -> bytes:
        data = text.encode()
        return self.encode_batch(data, np.array([len(data)]))[0].tobytes()


@cache
def id_encoder(path: str) -> IdEncoder:
    """One for each worker process, so that later tasks find the table filled: some 60 MB."""
    return IdEncoder(path)
