"""BPE encoding and decoding in batched numpy merge rounds.

The distinct words of a batch are found in numpy (``pieces.py``) and encoded
once each. Their symbols lie in one flat array, and each round looks up all neighbouring pairs by binary search over
the sorted pair keys of the merge table, takes the lowest rank of every word
and merges its occurrences from left to right. Words without a mergeable pair
leave the array. Texts are then gathered from the table of words, and decoded
by looking the ids up in the vocabulary.

The tokenizer is read from a ``tokenizers`` JSON file (BPE over byte-level
characters with word ends; text is normalised by NFC, white space, lower
case). Its file is never copied; its path is a parameter and must be the same
on every machine.

Defined results: null is an empty text, without ids, decoded as an empty
text; control strings of the tokenizer in a text become their ids, as the
tokenizer does by default; rows repeating a ``doc_id`` are encoded each from
its own text; other columns are kept, except those named like the new ones.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import appended, passes, with_arrays
from .pieces import Table, encode_texts, folded

_NEVER = np.iinfo(np.int64).max


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Merges:
    """The merge table: sorted pair keys, their ranks, and what they become."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        self.size = max(vocabulary.values()) + 1
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.becomes = np.array([vocabulary[a.removesuffix(suffix) + b if suffix else a + b] for a, b in pairs], np.int64)[order]
        characters = byte_characters()
        self.inner = np.array([vocabulary[c] for c in characters], np.int64)
        self.final = np.array([vocabulary[c + suffix] for c in characters], np.int64)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words end to end, offsets of length n + 1)."""
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols, word = self.inner[data], np.repeat(np.arange(len(words)), lengths)
        if len(symbols):
            ends = np.cumsum(lengths[lengths > 0]) - 1
            symbols[ends] = self.final[data[ends]]
        done = []
        while len(symbols):
            rank, at = self._ranks(symbols, word)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(word)))
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            finished = least == _NEVER
            if finished.any():
                done.append((word[finished], symbols[finished]))
                going = ~finished
                symbols, word, rank, at, least = symbols[going], word[going], rank[going], at[going], least[going]
                if not len(symbols):
                    break
            chosen = rank == least
            # Of overlapping occurrences (one symbol repeated) every second counts, from the left.
            place = np.flatnonzero(chosen)
            new = np.append(True, np.diff(place) > 1)
            run = np.cumsum(new) - 1
            place = place[(place - place[new][run]) % 2 == 0]
            symbols[place] = self.becomes[at[place]]
            stay = np.ones(len(symbols), bool)
            stay[place + 1] = False
            symbols, word = symbols[stay], word[stay]
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
        word, symbols = np.concatenate([w for w, _ in done]), np.concatenate([s for _, s in done])
        order = np.argsort(word, kind="stable")
        counts = np.bincount(word, minlength=len(words))
        return symbols[order], np.concatenate([[0], np.cumsum(counts)])

    def _ranks(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the pair that starts at each symbol (_NEVER if none), and its place in the table."""
        rank, at = np.full(len(symbols), _NEVER), np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            keys = symbols[:-1] * self.size + symbols[1:]
            found = np.searchsorted(self.keys, keys)
            found[found == len(self.keys)] = 0
            fits = (self.keys[found] == keys) & (word[1:] == word[:-1])
            rank[:-1] = np.where(fits, self.ranks[found], _NEVER)
            at[:-1] = found
        return rank, at


class Tokenizer:
    """Texts to ids and back, for tokenizer files of the kind named above."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        names = dict(model["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
        strings = [""] * (max(names.values()) + 1)
        for token, i in names.items():
            strings[i] = token
        self.strings = pa.array(strings, pa.string())
        self.control = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.table = Table(lambda words: self.merges.encode([w.encode() for w in words]), spaced=False)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, offsets of length n + 1)."""
        return encode_texts(texts, self.table, self.control, folded)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of runs of ids: their strings, joined by spaces, as the tokenizer file has no decoder."""
        tokens = self.strings.take(pa.array(ids))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), tokens), " ")


@functools.lru_cache(2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` (of the whole text) and ``decoded`` (the text of those ids)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for batch in passes(batches, "text"):
            ids, offsets = tok.encode([t or "" for t in batch.column("text").to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield with_arrays(batch, ids=lists, decoded=tok.decode(ids, offsets))

    return appended(docs, encode, "ids array<int>, decoded string")


def digests(frame: DataFrame) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256 to encoded documents."""
    return frame.withColumns(
        {
            "n_tokens": F.size("ids").cast("bigint"),
            "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256),
            "decoded_sha256": F.sha2(F.col("decoded"), 256),
        }
    )
