"""Byte-pair merges over many words at once, with NumPy.

A word's merges do not depend on its neighbours, so all new words of a batch are merged side by
side: each round finds every word's lowest-ranked pair and joins all its occurrences. That equals
merging one pair at a time because each merge makes a token of its own, so a pair that holds the
new token always ranks later.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import cache

import numpy as np
import regex
from tokenizers import Regex, normalizers, pre_tokenizers

NONE = np.iinfo(np.int32).max
_SLOTS, _SHIFT, _MIX = 1 << 19, 20, 0x9E3779B97F4A7C1 | 1
LONG_WORD = 400  # symbols; longer words are merged one by one with a heap

# The patterns by which the two tokenizers split texts.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?%L+| ?%N+| ?[^\s%L%N]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|%L+|%N|[^\s%L%N]+"
# Latin-1 texts take a fast pattern with explicit classes; all others the Unicode pattern.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(extra), extra + 1
    return [letters[b] for b in range(256)]


class Merger:
    """The merges of a tokenizer file; suffix marks a word's last symbol where the model has one."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, merges = model["vocab"], model["merges"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.n = 1 + max(max(vocab.values()), *self.special.values())
        letters = byte_letters()
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocab[a] * self.n + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        # most lookups end in one slot of a hash table; keys that lost their slot are found by bisection
        slot = ((self.keys * _MIX) >> _SHIFT) & (_SLOTS - 1)
        self.slot_keys, self.slot_ranks = np.full(_SLOTS, -1, np.int64), np.full(_SLOTS, NONE, np.int32)
        self.slot_keys[slot], self.slot_ranks[slot] = self.keys, self.ranks
        self.crowded = np.bincount(slot, minlength=_SLOTS) > 1
        self.joined = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        back = {c: b for b, c in enumerate(letters)}
        self.bytes_of = [b""] * self.n
        for t, i in vocab.items():
            self.bytes_of[i] = bytes(back[c] for c in t.removesuffix(self.suffix)) if self.suffix else bytes(back[c] for c in t)
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()

    def _rank(self, keys: np.ndarray) -> np.ndarray:
        slot = ((keys * _MIX) >> _SHIFT) & (_SLOTS - 1)
        out = np.where(self.slot_keys[slot] == keys, self.slot_ranks[slot], NONE)
        rest = np.flatnonzero(self.crowded[slot] & (out == NONE))
        if len(rest):
            at = np.searchsorted(self.keys, keys[rest])
            at[at == len(self.keys)] = 0
            out[rest] = np.where(self.keys[at] == keys[rest], self.ranks[at], NONE)
        return out

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word (non-empty bytes), as little-endian 32-bit integers."""
        out: list = [None] * len(words)
        some = [i for i, w in enumerate(words) if len(w) <= LONG_WORD]
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = self._merge_long(w)
        if not some:
            return out
        lengths = np.array([len(words[i]) for i in some])
        raw = np.frombuffer(b"".join([words[i] for i in some]), np.uint8)
        sym = self.first[raw]
        ends = np.cumsum(lengths) - 1
        sym[ends] = self.last[raw[ends]]
        word = np.repeat(np.arange(len(some)), lengths)
        done_sym, done_word = [], []
        rank = np.full(len(sym), NONE, np.int32)
        pair = np.flatnonzero(word[:-1] == word[1:])
        rank[pair] = self._rank(sym[pair] * self.n + sym[pair + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(sym)]))
            over = least == NONE
            done_sym.append(sym[over])
            done_word.append(word[over])
            hit = np.flatnonzero((rank == least) & ~over)
            if not len(hit):
                break
            # of overlapping pairs (a run of equal symbols) every second one is joined, from the left
            breaks = np.r_[True, np.diff(hit) != 1]
            position = np.arange(len(hit)) - np.maximum.accumulate(np.where(breaks, np.arange(len(hit)), 0))
            hit = hit[position % 2 == 0]
            sym[hit] = self.joined[rank[hit]]
            stay = ~over
            stay[hit + 1] = False
            at = (np.cumsum(stay) - 1)[hit]
            sym, word, rank = sym[stay], word[stay], rank[stay]
            # only the pairs beside a new symbol change
            near = np.concatenate([at, at[at > 0] - 1])
            rank[near] = NONE
            near = near[near + 1 < len(sym)]
            near = near[word[near] == word[near + 1]]
            rank[near] = self._rank(sym[near] * self.n + sym[near + 1])
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        ends = (4 * np.cumsum(np.bincount(word, minlength=len(some)))).tolist()
        raw, at = sym[order].astype("<u4").tobytes(), 0
        for i, end in zip(some, ends, strict=True):
            out[i], at = raw[at:end], end
        return out

    def _merge_long(self, w: bytes) -> bytes:
        raw = np.frombuffer(w, np.uint8)
        sym = self.first[raw].tolist()
        sym[-1] = int(self.last[raw[-1]])
        n = len(sym)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        rank_of, base = self.rank_of, self.n
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := rank_of.get(sym[i] * base + sym[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = right[i] if sym[i] == a else -1
            if j < 0 or sym[j] != b:
                continue
            sym[i], sym[j] = int(self.joined[r]), -1
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (q := rank_of.get(sym[i] * base + sym[k])) is not None:
                    heapq.heappush(heap, (q, i, sym[i], sym[k]))
            if (h := left[i]) >= 0 and (q := rank_of.get(sym[h] * base + sym[i])) is not None:
                heapq.heappush(heap, (q, h, sym[h], sym[i]))
        return np.array([s for s in sym if s >= 0], "<u4").tobytes()


@cache
def unknown_letters() -> str:
    """Characters that Python's Unicode tables don't know; regex's and the tokenizers library's may know some of them."""
    return "".join(c for c in map(chr, range(0x80, 0x40000)) if unicodedata.category(c) == "Cn")


@cache
def newer_letters() -> tuple[frozenset[str], frozenset[str]]:
    """Letters and numbers to regex that the tokenizers library's older Unicode tables don't know."""
    out = []
    for name in (r"\p{L}", r"\p{N}"):
        ours = set(regex.findall(name, unknown_letters()))
        theirs = {p for p, _ in pre_tokenizers.Split(Regex(name), "isolated").pre_tokenize_str("\0".join(sorted(ours)))}
        out.append(frozenset(ours - theirs))
    return out[0], out[1]


@cache
def newer_capitals() -> dict[int, str]:
    """Lower case, by the tokenizers library, of letters that Python doesn't know."""
    lower = normalizers.Lowercase()
    return {ord(c): low for c in unknown_letters() if (low := lower.normalize_str(c)) != c}


class WidePattern:
    """A splitting pattern with sets of letters (%L) and numbers (%N); the exact sets, slow ones, serve texts with newer letters only."""

    def __init__(self, pattern: str):
        self.pattern = pattern
        self.usual = regex.compile(pattern.replace("%L", r"\p{L}").replace("%N", r"\p{N}"))

    def findall(self, text: str) -> list[str]:
        letters, numbers = newer_letters()
        if letters.isdisjoint(text) and numbers.isdisjoint(text):
            return self.usual.findall(text)
        return _exact_pattern(self.pattern).findall(text)


@cache
def _exact_pattern(pattern: str):
    for mark, name, newer in zip(("%L", "%N"), (r"\p{L}", r"\p{N}"), newer_letters(), strict=True):
        pattern = pattern.replace(mark, f"[{name}--[{''.join(map(re.escape, sorted(newer)))}]]" if newer else name)
    return regex.compile("(?V1)" + pattern)


@cache
def _newer_capital():
    return re.compile("[" + "".join(map(re.escape, map(chr, newer_capitals()))) + "]") if newer_capitals() else re.compile("(?!)")


class ByteLevelSplitter:
    """Splits text into words as the byte-level pattern does."""

    wide = WidePattern(BYTE_PATTERN)
    narrow = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")

    def words(self, text: str) -> list[str]:
        return (self.narrow if text.isascii() or _latin(text) else self.wide).findall(text)


class LowerWordSplitter:
    """NFC, lower case, white space dropped, then split as the word pattern does."""

    wide = WidePattern(WORD_PATTERN)
    narrow = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")

    def words(self, text: str) -> list[str]:
        if text.isascii() or _latin(text):
            text = text.lower()
            return (self.narrow if text.isascii() or _latin(text) else self.wide).findall(text)
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        if _newer_capital().search(text):
            text = text.translate(newer_capitals())
        text = text.lower()
        return (self.narrow if _latin(text) else self.wide).findall(text)


class _Known(dict):
    """Notes what it was asked for in vain."""

    def __init__(self):
        self.new: set[str] = set()

    def __missing__(self, key: str) -> None:
        self.new.add(key)


class Encoder:
    """Encodes texts to ids as little-endian bytes; remembers words between batches, about most_bytes of them."""

    ENTRY_BYTES = 200  # of a word, its ids and their places in the table, besides what they hold

    def __init__(self, merger: Merger, splitter, ids_of_words, most_bytes: int):
        self.splitter, self.ids_of_words, self.most_bytes = splitter, ids_of_words, most_bytes
        self.special = list(merger.special)
        self.fixed = {t: np.array([i], "<u4").tobytes() for t, i in merger.special.items()}
        self.known, self.held = _Known(), 0

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.held > self.most_bytes:
            self.known, self.held = _Known(), 0
        plans = []
        for t in texts:
            parts = [(p, None) if p in self.fixed else (None, self.splitter.words(p)) for p in split_special(t, self.special)]
            plans.append([(p, w, list(map(self.known.__getitem__, w)) if w else w) for p, w in parts])
        if self.known.new:
            new = list(self.known.new)
            raw = [w.encode() for w in new]
            ids = self.ids_of_words(raw)
            self.known.update(zip(new, ids, strict=True))
            self.held += sum(map(len, raw)) + sum(map(len, ids)) + self.ENTRY_BYTES * len(new)
            self.known.new.clear()
        get, out = self.known.__getitem__, []
        for plan in plans:
            out.append(b"".join([self.fixed[p] if w is None else b"".join(map(get, w) if None in got else got) for p, w, got in plan]))
        return out


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def split_special(text: str, special: list[str]) -> list[str]:
    """The text cut at special tokens, which stay as items of their own."""
    if not any(s in text for s in special):
        return [text]
    return [x for x in re.split("(" + "|".join(map(re.escape, special)) + ")", text) if x]
