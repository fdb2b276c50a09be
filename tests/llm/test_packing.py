from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rovelog.llm import packing as P

TEXTS = [
    (1, "Hello there, it's 2024!\n\n  Ünïcode 日本語 — and spaces   "), (1, "Hello there, it's 2024!\n\n  Ünïcode 日本語 — and spaces   "),
    (2, None), (3, ""), (None, "null id"), (4, "word " * 5000), (5, "a" * 30_000), (6, "x<|endoftext|>y"),
]


def test_ids_are_those_of_the_vocabulary_files_tokenizer():
    plain, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), P.encoder()
    for _, text in TEXTS:
        assert fast(text or "") == plain.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 2_000_000, "a word" + "\n" * 1_500_000 + "x<|endoftext|>y"])
def test_runs_of_blanks_have_the_ids_of_the_file(spark, text):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    rows = spark.createDataFrame([(1, "before"), (2, text), (3, "after")], "doc_id long, text string")
    pieces = sorted((r["doc_id"], r["start"], r["ids"]) for r in P.cut_pieces(rows).collect())
    assert b"".join(ids for name, _, ids in pieces if name == 2) == np.array(plain + [0], "<u4").tobytes()
    assert {name for name, *_ in pieces} == {1, 2, 3}


@pytest.mark.parametrize("tokens", [1, 2, 3, 1023, 1024, 1025, 2047, 5000])
def test_binary_lengths(tokens):
    found = P.binary_lengths(tokens)
    assert sum(found) == tokens and found == sorted(found, reverse=True)
    assert all(n <= 1024 and n & (n - 1) == 0 for n in found)
    assert len([n for n in found if n < 1024]) == bin(tokens % 1024).count("1")


def test_pieces_put_the_documents_together_again(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in TEXTS], "doc_id long, text string, sequence_id string")
    pieces = P.cut_pieces(docs).collect()
    encode = P.encoder()
    expected = sorted((i or 0, np.array(encode(t or "") + [0], "<u4").tobytes()) for i, t in TEXTS)
    whole, rest = [], sorted(pieces, key=lambda r: (r["doc_id"] or 0, r["start"]))
    for name in {r["doc_id"] for r in rest}:
        own = [r for r in rest if r["doc_id"] == name]
        copies = sum(r["start"] == 0 for r in own)
        whole += [(name or 0, b"".join(r["ids"] for r in own[::copies]))] * copies
    assert sorted(whole) == expected

    found = P.pack_digest(docs).collect()
    assert sorted((r["doc_id"] or 0, r["start"], r["ids_crc32"]) for r in found) == sorted(
        (r["doc_id"] or 0, r["start"], zlib.crc32(r["ids"])) for r in pieces
    )
    assert sorted(r["sequence_id"] for r in found) == list(range(len(found))) and {r["offset"] for r in found} == {0}
    by_number = [r["length"] for r in sorted(found, key=lambda r: r["sequence_id"])]
    assert by_number == sorted(by_number, reverse=True)


def test_no_documents(spark):
    assert P.pack_digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0
