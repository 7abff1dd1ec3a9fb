"""Packing by power-of-two decomposition.

A document's tokens (with an end token) are cut into pieces of 2048 and then by the binary digits of what is left, the
longest first. Each piece is a sequence of its own whose length is a power of two, so no sequence crosses documents and
none needs padding; a trainer draws batches from one bucket of equal lengths at a time. Nothing is shuffled: a
document's pieces are made where it is read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS, END = 2048, 1


@lru_cache(4)
def _encoders(tokenizer: str, ranks: str | None, pattern: str | None):
    """encode(texts) -> lists of ids, as tokenizers' encode(text, add_special_tokens=False) gives them.

    ranks: the same vocabulary for tiktoken, which takes a third of the time. The ids are equal: every token of the
    vocabulary has one merge, merges are ranked as ids are, and each token's bytes alone encode to it, so no other pair of
    tokens with its bytes ever stands side by side; and both cut texts into the same pieces and know the same special
    tokens (tests check all of this over the whole vocabulary and all code points). Where tiktoken's expression runs out
    of stack, on a run of very many spaces, it raises, and tokenizers takes the text."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokenizer)
    if not ranks:
        return lambda texts: [x.ids for x in slow.encode_batch_fast(texts, add_special_tokens=False)]
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = {t.content: k for k, t in slow.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens=special)

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all", disallowed_special=())
        except ValueError:
            return slow.encode(text, add_special_tokens=False).ids

    return lambda texts: [encode(t) for t in texts]


def pieces(n: int, longest: int = MAX_TOKENS) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    out = [(s, longest) for s in range(0, n - n % longest, longest)]
    at = n - n % longest
    for bit in range(longest.bit_length() - 2, -1, -1):
        if n % longest >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


def _cutter(tokenizer: str, ranks: str | None, pattern: str | None, longest: int, end: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoders(tokenizer, ranks, pattern)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):  # rows of a few MB
                to, size = at, 0
                while to < len(texts) and size < 2_000_000:
                    size += len(texts[to] or "")
                    to += 1
                row, start, length, total, data = [], [], [], [], []
                for i, tokens in zip(range(at, to), encode([t or "" for t in texts[at:to]]), strict=True):
                    raw = np.array([*tokens, end], dtype="<u4").tobytes()
                    n = len(tokens) + 1
                    for s, k in pieces(n, longest):
                        row.append(i)
                        start.append(s)
                        length.append(k)
                        total.append(n)
                        data.append(raw[4 * s : 4 * (s + k)])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(total, pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "start", "length", "doc_tokens", "token_bytes"])
                at = to

    return cut


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, longest: int = MAX_TOKENS, end: int = END) -> DataFrame:
    """doc_id, start, length, doc_tokens, token_bytes (little-endian unsigned 32-bit ids), bucket (log2 of length),
    sequence_id and offset (0) of each piece of docs (doc_id, text; other columns are ignored).

    A null text is empty: one piece with the end token. Every row is packed, repeated rows and rows without a doc_id
    too. sequence_id is unique, not dense."""
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(_cutter(tokenizer, ranks, pattern, longest, end), "doc_id long, start long, length long, doc_tokens long, token_bytes binary")
    return out.withColumns({"bucket": F.log2("length").cast("int"), "sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write packed sequences under path/bucket=k, one folder for each power of two: a trainer fills batches of
    (tokens of a batch) >> k sequences from one folder, all of one length. Each task writes what it has; no shuffle."""
    packed.write.partitionBy("bucket").parquet(path)
