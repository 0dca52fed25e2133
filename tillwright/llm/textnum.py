"""Words of many texts at once, in numpy: positions and 64-bit hashes from one byte buffer.

ASCII bytes never occur inside a multi-byte UTF-8 character, so word classes
that treat all non-ASCII characters alike can be read off the bytes.
"""

from __future__ import annotations

import functools

import numpy as np

#: Words `[^\x20\x09-\x0D]+`.
SPACED = np.array([not (b == 0x20 or 9 <= b <= 13) for b in range(256)])
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text (capitals count as their lower case).
ALNUM = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])
#: Bytes hashed in one piece; a single longer word is a piece of its own.
PIECE = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, xor, shift): spreads every input bit over the output."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        up, down = np.full(n, _ODD), np.full(n, inverse)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


@functools.lru_cache(1)
def _byte_values() -> np.ndarray:
    """A 64-bit value for each byte; A-Z have those of a-z."""
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    values[0x41:0x5B] = values[0x61:0x7B]
    return values


def _pieces(n: int, breaks: np.ndarray) -> list[tuple[int, int]]:
    """Cuts of n elements into about PIECE each, at places of ``breaks`` (sorted)."""
    out, start = [], 0
    while start < n:
        end = n
        if end - start > PIECE:
            k = int(np.searchsorted(breaks, start + PIECE, side="right"))
            if k and breaks[k - 1] > start:
                end = int(breaks[k - 1])
            elif k < len(breaks):
                end = int(breaks[k])
        out.append((start, end))
        start = end
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the spans (in order, not overlapping) of ``data``;
    ``values``: what each element of data stands for."""
    hashes = np.empty(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for a, b in _pieces(len(data), starts):
            i, j = np.searchsorted(starts, [a, b])
            up, down = _powers(1 << max(16, int(b - a).bit_length()))
            part = data[a:b] if values is None else values[data[a:b]]
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(part * up[: b - a], dtype=np.uint64, out=sums[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            hashes[i:j] = (sums[e] - sums[s]) * down[s]
        return mixed(hashes + (ends - starts).astype(np.uint64) * _ODD)


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, first): hash and byte span of each word, A-Z
    read as a-z; ``first[i]:first[i + 1]`` are the words of text i."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    inside = kind[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    edges = offsets[offsets < len(data)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[offsets > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    hashes = span_hashes(data, starts, ends, _byte_values())
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words; entry i starts at word i."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = mixed(out * _ODD + hashes[k : k + n])
    return out
