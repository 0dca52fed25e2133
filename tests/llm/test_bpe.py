"""BPE encoding, decoding and token files against the tokenizers library."""

import hashlib
import os
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwright.config import scratch_path
from tillwright.llm import bpe, tokenfile
from tillwright.llm.queries import vocabulary

os.environ["TOKENIZERS_PARALLELISM"] = "false"
tokenizers = pytest.importorskip("tokenizers")

PIECES = [
    *"abcdeDEst'' \n\t.,!?12<|>rvlmΣσςİıÉéeßſKǅ", "́", " ", " ", "　", "\x1c", "\x85", "​", "中文", "ああ", "😀", "_", "²", "½",
    "<|endoftext|>", "<|startoftext|>", "'ll", "'RE", " 's", "\r\n", "   ", "\n\n", " '",
]


def texts(seed, n=300):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(n)] + [
        "", None, " ", "\n", "a" * 5000, "ab" * 3000, "the cat " * 20000, "aaaa" * 7 + "b",
    ]


def test_word_bpe_equals_library(spark):
    path = vocabulary("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    rows = list(enumerate(texts(1))) + [(None, "null id"), (3, "repeated id"), (3, "repeated id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("clash"), "lang": F.lit("x")}).repartition(3)
    got = bpe.digests(bpe.encoded(docs, path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize(("make", "name"), [(bpe.Tokenizer, "word_bpe_49k.json"), (tokenfile._Library, "byte_bpe_50k.json")])
def test_every_code_point_as_the_library(make, name):
    """Each code point between letters, after a space and beside a digit and a sign; all at once and, where that differs, alone."""
    ours, library = make(vocabulary(name)), tokenizers.Tokenizer.from_file(vocabulary(name))
    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for k in range(0, len(points), 1 << 15):
        text = "\n".join(f"a{chr(i)}B1 {chr(i)}x!{chr(i)}" for i in points[k : k + (1 << 15)])
        if ours.encode([text])[0].tolist() != library.encode(text, add_special_tokens=False).ids:
            wrong = [hex(i) for i in points[k : k + (1 << 15)] if ours.encode([f"a{chr(i)}B1 {chr(i)}x!{chr(i)}"])[0].tolist() != library.encode(f"a{chr(i)}B1 {chr(i)}x!{chr(i)}", add_special_tokens=False).ids]
            raise AssertionError(wrong[:20])


def test_empty_table(spark):
    assert bpe.encoded(spark.createDataFrame([], "doc_id long, text string"), vocabulary("word_bpe_49k.json")).count() == 0


def test_small_word_tables_start_anew():
    tok = bpe.Tokenizer(vocabulary("word_bpe_49k.json"))
    tok.table.most = 5
    first = [tok.encode([t])[0].tolist() for t in ("one two three", "four five six seven", "one two three")]
    assert first[0] == first[2] == tokenizers.Tokenizer.from_file(vocabulary("word_bpe_49k.json")).encode("one two three", add_special_tokens=False).ids


@pytest.mark.parametrize("ids", [[], [0], [5, 5, 5, 70000, 5, 300] * 50, list(range(70_000)) * 2])
def test_blocks_round_trip(ids):
    counts = np.array([len(ids) // 2, len(ids) - len(ids) // 2])
    back, lengths, docs = tokenfile.unpack(tokenfile.pack(np.array(ids, np.int64), counts, [None, 7]))
    assert back.tolist() == ids and lengths.tolist() == counts.tolist() and docs == [None, 7]


@pytest.mark.parametrize("block_tokens", [1, 1 << 19])
def test_token_files_equal_library(spark, block_tokens):
    path = vocabulary("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    rows = [(d, t) for d, t in enumerate(texts(2, 120))] + [(3, "repeated id"), (3, "repeated id"), (-5, "negative")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"part": F.lit(1), "block": F.lit("clash")}).repartition(5)
    target = scratch_path(spark, "test-tokens")
    tokenfile.write(docs, path, target, block_tokens=block_tokens)
    got = sorted(map(tuple, tokenfile.read_index(spark, target).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted(d for d, _ in rows)
    at, by_id = 0, {}
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        by_id.setdefault(doc_id, []).append((len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    for doc_id, start, n, crc in got:
        assert start == at and (n, crc) in by_id[doc_id]
        by_id[doc_id].remove((n, crc))
        at += n


def test_token_files_null_ids_and_empty_table(spark):
    path = vocabulary("byte_bpe_50k.json")
    got = tokenfile.written_index(spark.createDataFrame([(None, None), (1, "a")], "doc_id long, text string"), path).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens) for r in got), key=lambda r: r[1]) == [(None, 0, 1), (1, 1, 2)]
    assert tokenfile.written_index(spark.createDataFrame([], "doc_id long, text string"), path).count() == 0
