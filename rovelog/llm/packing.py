"""Packing by powers of two: every document is cut into pieces of binary length.

A document of L tokens becomes L // 1024 pieces of 1024 and one piece for each bit of the rest,
longest first.  A piece is a sequence of its own; sequences of equal length are numbered one after
the other, so that a batch takes a run of numbers.  No sequence crosses documents, and none is
padded, because every length is a power of two.

Token ids are those of the vocabulary file.  They are computed with the same vocabulary in its
ranked form, which gives the same ids in less than a quarter of the time (measured in README.md,
checked in the tests).  Its pattern gives up on a run of about a million blanks; such texts are left to the
file itself.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rovelog.llm.common import ranked, small_batches, stored, table

MAX_TOKENS = 1024
#: The id that ends a document.
END_ID = 0
VOCABULARY = "byte_bpe_50k"
SPECIAL = {"<|endoftext|>": 50256}

PIECES = "_key {key}, start long, length long, ids binary, doc_tokens long"


def encoder(vocabulary: str = VOCABULARY):
    """Text to token ids; a special token's text gets its own id, as in the vocabulary file's tokenizer."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    whole: list[Tokenizer] = []

    def encode(text: str) -> list[int]:
        try:
            return own.encode(text, allowed_special="all")
        except ValueError:
            if not whole:
                whole.append(Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")))
            return whole[0].encode(text, add_special_tokens=False).ids

    return encode


def binary_lengths(tokens: int, longest: int = MAX_TOKENS) -> list[int]:
    """``tokens`` as whole pieces of ``longest`` and then falling powers of two."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cut_pieces(
    docs: DataFrame, text: str = "text", key: str = "doc_id", longest: int = MAX_TOKENS, vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row for each piece: ``key``, start, length, ids (little-endian unsigned 32-bit), doc_tokens.

    A null text counts as empty and gives one piece that holds the end id alone.  Every row of
    ``docs`` is cut by itself, so repeated rows give repeated pieces.  ``longest`` is a power of two.
    """
    small_batches(docs.sparkSession)
    key_type = dict(docs.dtypes)[key]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for name, body in zip(batch["_key"], batch["_text"]):
                ids = np.array(encode(body or "") + [END_ID], dtype="<u4").tobytes()
                total, at = len(ids) // 4, 0
                for length in binary_lengths(total, longest):
                    rows.append((name, at, length, ids[4 * at:4 * (at + length)], total))
                    at += length
            yield pd.DataFrame(rows, columns=["_key", "start", "length", "ids", "doc_tokens"])

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return rows.mapInPandas(cut, PIECES.format(key=key_type)).withColumnRenamed("_key", key)


def number_sequences(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds sequence_id, gapless over buckets of equal length (longest first), and offset, always 0.

    ``pieces`` is read several times; give a stored frame.
    """
    by_length = pieces.withColumn("_bucket_of", -F.col("length"))
    order = [F.col(key), F.col("start"), F.col("doc_tokens")]
    return ranked(by_length, "_bucket_of", order, "sequence_id").withColumn("offset", F.lit(0).cast("long")).drop("_bucket_of", "sequence_id_of")


def pack_digest(docs: DataFrame) -> DataFrame:
    """All pieces of ``docs`` with their sequence, the ids given as their crc32.

    A null or empty text is one piece, the end id.  Repeated rows have pieces of their own; pieces that
    agree in length, key, start and doc_tokens are numbered in any order.  Other columns are not read,
    whatever their names.  An empty table gives no rows.
    """
    pieces = cut_pieces(docs.select("doc_id", "text")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return number_sequences(stored(pieces)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op7_pack_powers_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_digest(table(spark, sf_dir, "documents"))
