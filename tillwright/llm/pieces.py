r"""Pre-tokens of many texts at once, in numpy, and a table of their ids.

Two cuts are known, both as `tokenizers` files define them (contractions are
``'s 't 're 've 'm 'll 'd``):

* *spaced*: contractions, ``?\p{L}+``, ``?\p{N}+``, ``?[^\s\p{L}\p{N}]+``
  (``?`` an optional space before), ``\s+(?!\S)``, ``\s+``;
* *bare*: contractions, ``\p{L}+``, ``\p{N}``, ``[^\s\p{L}\p{N}]+``, white
  space dropped.

Characters are classed by a table over all code points that the library itself
fills (only its letters, digits and spaces are asked for), runs of a class are
found by comparing neighbours, and pre-tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

import numpy as np
from tokenizers import Regex, normalizers, pre_tokenizers

from . import textnum

SPACE, LETTER, NUMBER, OTHER = range(4)
#: Pre-tokens whose ids a table keeps; beyond, it starts anew.
TABLE_SIZE = 2_000_000


@functools.lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point, as the tokenizers library's own tables have it (Python's may be older or newer)."""
    of = np.full(0x110000, OTHER, np.uint8)
    known = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    every, at = "".join(map(chr, known)), np.array(known)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        found = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every)
        for _, (start, end) in found:
            of[at[start:end]] = kind
    return of


_NORMAL = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])


def folded(text: str) -> str:
    """NFC and lower case, by the library's tables; white space need not be unified, as it only separates words."""
    return text.lower() if text.isascii() else _NORMAL.normalize_str(text)


@functools.lru_cache(1)
def _values() -> np.ndarray:
    return textnum.mixed(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def cut(cp: np.ndarray, edges: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of texts that lie end to end; ``edges``: where texts start, and the end."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _classes()[cp]
    edge = np.zeros(n + 1, bool)
    edge[edges] = True
    new = np.ones(n, bool)
    new[1:] = kind[1:] != kind[:-1]
    new |= edge[:n]
    if spaced:
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:n])
        new[last] = True
        new[last[cp[last] == 0x20] + 1] = False
    else:
        new |= kind == NUMBER
    quote = np.flatnonzero(new[:-1] & (cp[:-1] == 0x27) & (kind[1:] == LETTER) & ~edge[1:n])
    if len(quote):
        one = cp[quote + 1]
        far = np.minimum(quote + 2, n - 1)
        two = np.where((quote + 2 < n) & ~edge[far], cp[far], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        size = np.where(short, 2, np.where(long, 3, 0))
        quote, size = quote[size > 0], size[size > 0]
        new[quote + 1] = False
        after = quote + size
        new[after[after < n]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    if not spaced:
        shown = kind[starts] != SPACE
        starts, ends = starts[shown], ends[shown]
    return starts, ends


class Table:
    """Ids of pre-tokens by their hash; new ones are encoded in batches by ``encode``."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], spaced: bool, most: int = TABLE_SIZE):
        self.encode_new, self.spaced, self.most = encode, spaced, most
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """``hashes`` are sorted, distinct and new."""
        ids, offsets = self.encode_new(words)
        at = np.searchsorted(self.hashes, hashes)
        first = len(self.offsets) - 1
        self.hashes = np.insert(self.hashes, at, hashes)
        self.rows = np.insert(self.rows, at, np.arange(first, first + len(hashes)))
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.offsets = np.concatenate([self.offsets, offsets[1:] + self.offsets[-1]])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, offsets of length n + 1)."""
        whole = "".join(texts)
        edges = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        cp = points(whole)
        starts, ends = cut(cp, edges, self.spaced)
        hashes = textnum.span_hashes(_values()[cp], starts, ends)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > self.most:
            self._forget()
        at = np.searchsorted(self.hashes, distinct)
        if len(self.hashes):
            at[at == len(self.hashes)] = 0
            fresh = self.hashes[at] != distinct
        else:
            fresh = np.ones(len(distinct), bool)
        if fresh.any():
            spans = zip(starts[first[fresh]].tolist(), ends[first[fresh]].tolist(), strict=True)
            self._learn(distinct[fresh], [whole[a:b] for a, b in spans])
        row = self.rows[np.searchsorted(self.hashes, distinct)][inverse] if len(distinct) else np.zeros(0, np.int64)
        begin, counts = self.offsets[row], self.offsets[row + 1] - self.offsets[row]
        total = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.arange(total[-1]) + np.repeat(begin - total[:-1], counts)]
        return ids, total[np.searchsorted(starts, edges)]


def encode_texts(texts: list[str], table: Table, control: dict[str, int], normal: Callable[[str], str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of whole texts: control strings have ids of their own, what lies between is normalised and encoded."""
    if not any(c in t for t in texts for c in control):
        return table.encode([normal(t) for t in texts])
    parts, owners, marks = [], [], []  # a mark: the control id that follows a part, or -1
    split = re.compile("|".join(re.escape(c) for c in sorted(control, key=len, reverse=True)))
    for k, text in enumerate(texts):
        at = 0
        for m in split.finditer(text):
            parts.append(normal(text[at : m.start()]))
            owners.append(k)
            marks.append(control[m[0]])
            at = m.end()
        parts.append(normal(text[at:]))
        owners.append(k)
        marks.append(-1)
    ids, offsets = table.encode(parts)
    marks_array = np.array(marks)
    after = offsets[1:][marks_array >= 0]
    ids = np.insert(ids, after, marks_array[marks_array >= 0])
    counts = np.diff(offsets) + (marks_array >= 0)
    return ids, np.concatenate([[0], np.cumsum(np.bincount(owners, counts, len(texts)).astype(np.int64))])
