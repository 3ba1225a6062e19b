"""Sequence packing by power-of-two decomposition.

A document of n tokens is cut into as many full pieces as fit and then the binary parts of the rest, largest
first. Every piece is a sequence of its own: its length is a power of two, so it needs no padding, and no
sequence crosses documents. Batches are made within a bucket of equal lengths.

Defined results: a null text counts as empty, and an empty one is the end id alone, a piece of length 1; equal
rows get equal pieces with sequences of their own; an empty table gives no pieces. Long texts are taken whole,
one at a time, so memory is bounded by one batch and the longest text. The ids are those of the tokenizer file
as it is: the literal of its added token, <|endoftext|>, is that token.
"""

from __future__ import annotations

import base64
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import slices

MAX_TOKENS, END_ID = 2048, 1
ADDED = {"<|endoftext|>": 50256}
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_encoders: dict[tuple[str, str], object] = {}


def public_vocabulary() -> tuple[str, str]:
    """(rank file, split pattern) of the public byte-level BPE of 50,257 ids: the ids of its ``byte_bpe_50k.json``, over three times as fast."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encoder(vocabulary: tuple[str, str]):
    """A function from a text to its ids; the file is read once in each worker."""
    if vocabulary not in _encoders:
        import tiktoken

        with open(vocabulary[0], "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        added = ADDED if vocabulary == public_vocabulary() else {}
        encoding = tiktoken.Encoding("packing", pat_str=vocabulary[1], mergeable_ranks=ranks, special_tokens=added)
        _encoders[vocabulary] = partial(encoding.encode, allowed_special="all")
    return _encoders[vocabulary]


def piece_lengths(n: int, max_tokens: int = MAX_TOKENS) -> list[int]:
    """Full pieces, then the powers of two of the rest in falling order; max_tokens is a power of two."""
    return [max_tokens] * (n // max_tokens) + [1 << k for k in range(max_tokens.bit_length() - 1, -1, -1) if (n % max_tokens) >> k & 1]


def token_pieces(docs: DataFrame, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, vocabulary: tuple[str, str] | None = None, with_ids: bool = True) -> DataFrame:
    """The pieces of every row of ``docs`` (doc_id, text) with their ids (``ids``, array<int>) if asked for."""
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    vocabulary = vocabulary or public_vocabulary()

    def cut(batches):
        encode = encoder(vocabulary)
        for b in slices(batches):
            cols: list[list] = [[] for _ in range(6)]
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.array([*encode(text or ""), end_id], "<u4")
                raw, start = ids.tobytes(), 0
                for n in piece_lengths(len(ids), max_tokens):
                    row = (doc_id, start, n, zlib.crc32(raw[4 * start : 4 * (start + n)]), len(ids), ids[start : start + n])
                    for c, v in zip(cols, row if with_ids else row[:5]):
                        c.append(v)
                    start += n
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]]
            if with_ids:
                flat = np.concatenate(cols[5]) if cols[5] else np.zeros(0, "<u4")
                arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(cols[2])]).astype(np.int32), pa.int32()), pa.array(flat.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(arrays)])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)


def pack_power_of_two(docs: DataFrame, with_ids: bool = False, **options) -> DataFrame:
    """``token_pieces`` placed: each piece at offset 0 of a sequence of its own, ``bucket`` its length. Sequence ids are unique, not
    dense: they hold the partition and the row in it, which needs no pass over the other partitions."""
    pieces = token_pieces(docs, with_ids=with_ids, **options)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "bucket": F.col("length").cast("int")})


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences on disk, a folder for each length: what a loader that batches equal lengths reads."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(path)
