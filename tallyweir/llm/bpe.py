"""BPE encoding that encodes chunks shared by documents once, and decoding.

Texts are cut where a rolling hash of their last 32 bytes says so, so equal passages are cut alike wherever they stand.
Chunks that occur twice or more are encoded once each and joined back to the texts that hold them; other texts are encoded
where they are read. A chunk ends anywhere, in the middle of a word too, so its ids near its ends are provisional: at each
join the run of text around it is encoded again, and widened until both its ends stand at white space. From there
on ids agree with those of the whole text exactly: no token, merge, normal form or special token of this kind of
tokenizer reaches over white space. Where the run gives the ids that stood there already, they stay; else it replaces them.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch
from .words import U64, text_blocks

#: Bytes of a chunk at least and at most; a cut every MASK + 1 bytes in between, on average.
SHORTEST, LONGEST, MASK = 256, 8192, U64(1023)
#: Bits of the map of shared chunks that is shipped to every task: 8 MB.
MAP_BITS = 1 << 26
#: Rows that a joined key may have in one task.
HOT_ROWS = 4096
#: Words that a worker remembers, each of at most so many bytes.
MEMORY, MEMORY_BYTES = 300_000, 64
SPACE = frozenset(b" \t\n\r\x0b\x0c")
#: How a vocabulary with word ends cuts texts into words, and how it marks their ends.
WORD_PARTS, END = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+", "</w>"
#: Printable characters up to U+024F but U+0130, in UTF-8.
LATIN = re.compile(rb"(?:[!-~]|\xc2[\xa1-\xbf]|[\xc3\xc5-\xc8][\x80-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc9[\x80-\x8f])+").fullmatch

_GEAR = np.random.Generator(np.random.PCG64(20260207)).integers(0, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)

_RECORD = pa.schema([("head", pa.binary()), ("head_ids", pa.binary()), ("middle_ids", pa.binary()), ("tail", pa.binary()), ("tail_ids", pa.binary()), ("solid", pa.bool_())])
_PARTS = [f.name for f in _RECORD]


def cut_candidates(data: np.ndarray) -> np.ndarray:
    """Bytes before which the rolling hash of the 32 bytes before them allows a cut. The hash (each step shifts by one bit
    and adds a random value) is built by doubling, for all places at once."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        h[k:] += h[:-k] << U64(k)
    return np.flatnonzero((h >> U64(32)) & MASK == 0) + 1


def chunk_bounds(candidates: list[int], data: bytes, start: int, end: int) -> list[int]:
    """start, the cuts, end of the text data[start:end]. Cuts stand between characters."""
    out, at = [start], start
    while end - at > SHORTEST:
        k = bisect_left(candidates, at + SHORTEST)
        cut = min(candidates[k] if k < len(candidates) else end, at + LONGEST)
        while cut < end and data[cut] & 0xC0 == 0x80:
            cut += 1
        if cut >= end:
            break
        out.append(at := cut)
    if end > start:
        out.append(end)
    return out


def chunked(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(row, chunks) of each text; a null or empty one has none."""
    for first, data, offsets in text_blocks(texts):
        candidates, raw = cut_candidates(data).tolist(), data.tobytes()
        for k in range(len(offsets) - 1):
            bounds = chunk_bounds(candidates, raw, int(offsets[k]), int(offsets[k + 1]))
            yield first + k, [raw[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def digest(data: bytes) -> bytes:
    return blake2b(data, digest_size=16).digest()


class _Known(dict):
    """word -> ids; short words are kept, and all given up when they are too many."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: bytes) -> bytes:
        ids = self.encoder.word(word)
        if len(word) <= MEMORY_BYTES:
            if len(self) >= MEMORY:
                self.clear()
            self[word] = ids
        return ids


def _byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others counted on from
    256."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def word_ranks(path: str) -> tuple[dict[bytes, int], list[int]] | None:
    """A vocabulary with word ends as ranks of byte strings, in which the byte 255 ends a word, and the id of each rank; null
    if it isn't lower case, cut at white space and byte-level, or if a token is made by two merges or merges don't rank as
    ids do. The pairs that end a word come first, then the merges in their order. Each token's bytes encode to it
    alone (a test holds this for the whole vocabulary), so no other pair with its bytes ever stands side by side."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    model = made["model"]
    kinds = [x["type"] for x in (made["normalizer"] or {}).get("normalizers", [])]
    split, *level = (made["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    if kinds != ["NFC", "Replace", "Lowercase"] or split.get("pattern") != {"Regex": WORD_PARTS} or [x["type"] for x in level] != ["ByteLevel"] or model.get("end_of_word_suffix") != END:
        return None
    byte = _byte_symbols()
    raw = lambda token: bytes(byte[c] for c in token.removesuffix(END)) + (b"\xff" if token.endswith(END) else b"")
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in merges]
    first = [t for t in model["vocab"] if len(t.removesuffix(END)) == 1]
    if ids != sorted(set(ids)) or len(ids) + len(first) != len(model["vocab"]):
        return None
    ranks = {bytes([b]): b for b in range(256)}
    for token in [*sorted(t for t in first if t.endswith(END)), *(a + b for a, b in merges)]:
        ranks[raw(token)] = len(ranks)
    back = [0] * len(ranks)
    for token, k in model["vocab"].items():
        back[ranks[raw(token)]] = k
    return ranks, back


class Encoder:
    """Ids of runs of text, as little-endian unsigned integers of two bytes where the vocabulary fits, else of four."""

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.known = _Known(self)
        self.parts = regex.compile(WORD_PARTS)
        fast = word_ranks(path)
        self.piece, self.back = (tiktoken.Encoding("words", pat_str=".", mergeable_ranks=fast[0], special_tokens={})._core_bpe.encode_single_piece, fast[1]) if fast else (None, [])

    def run(self, text: bytes) -> bytes:
        """Of any text, by tokenizers."""
        return array(self.code, self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()

    def word(self, text: bytes) -> bytes:
        """Of text without white space. Words of Latin letters, digits and marks are encoded by their ranks: in this range (without
        white space, and without the one letter that two make in lower case) lower case goes letter by letter and the normal form changes nothing."""
        if self.piece is None or b"<|" in text or not LATIN(text):
            return self.run(text)
        back = self.back
        return array(self.code, [back[k] for p in self.parts.findall(text.decode().lower()) for k in self.piece(p.encode() + b"\xff")]).tobytes()

    def words(self, text: bytes) -> bytes:
        """Ids of text that has white space, or nothing, at both ends: those of its words, one after the other."""
        return b"".join(map(self.known.__getitem__, text.split()))

    def wide(self, ids: bytes) -> bytes:
        """As unsigned integers of four bytes."""
        return ids if self.code == "I" else np.frombuffer(ids, "<u2").astype("<u4").tobytes()

    def chunk(self, text: bytes) -> tuple[bytes, bytes, bytes, bytes, bytes, bool]:
        """A chunk's record: its text up to the first and from the last white space, the ids of these and of what is
        between, as if the chunk stood alone; solid: it has no white space, and is all head."""
        head = b"" if text[0] in SPACE else text.split(None, 1)[0]
        if len(head) == len(text):
            return text, self.run(text), b"", b"", b"", True
        tail = b"" if text[-1] in SPACE else text.rsplit(None, 1)[-1]
        middle = text[len(head) : len(text) - len(tail)]
        return head, self.words(head), self.words(middle), tail, self.words(tail), False

    def joined(self, chunks: Iterable[tuple]) -> bytes:
        """Ids of the text whose chunks' records these are, in order."""
        out: list[bytes] = []
        around: list[bytes] = []
        alone: list[bytes] = []

        def repair() -> None:
            texts = [x for x in around if x]
            if len(texts) > 1:  # both ends of the run stand at white space or at the text's ends
                again = self.run(b"".join(texts))
                out.append(again if again != b"".join(alone) else b"".join(alone))
            else:
                out.extend(alone)
            around.clear()
            alone.clear()

        for head, head_ids, middle_ids, tail, tail_ids, solid in chunks:
            around.append(head)
            alone.append(head_ids)
            if solid:  # the run goes on through it
                continue
            repair()
            out.append(middle_ids)
            around.append(tail)
            alone.append(tail_ids)
        repair()
        return b"".join(out)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = b"".join(digest(c) for _, chunks in chunked(batch.column(0)) for c in chunks)
        halves = np.frombuffer(found, dtype="<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())], names=["d1", "d2"])


def _is_shared(digests: list[bytes], shared: np.ndarray) -> bool:
    at = np.frombuffer(b"".join(digests), dtype="<u8")[::2] & U64(8 * len(shared) - 1)
    return bool((shared[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8) & 1).any())


def _in_place(path: str, shared):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, bits = encoder(path), np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            rows, ids, size = [], [], 0
            for k, chunks in chunked(batch.column(1)):
                if not chunks or not _is_shared([digest(c) for c in chunks], bits):
                    rows.append(k)
                    ids.append(e.wide(e.joined(map(e.chunk, chunks))))
                    size += len(ids[-1])
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(ids, pa.binary())], names=["doc_id", "token_bytes"])
                    rows, ids, size = [], [], 0
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(ids, pa.binary())], names=["doc_id", "token_bytes"])

    return encode


_CHUNK_ROWS = "doc_id long, text_digest binary, place int, digest binary, chunk binary"


def _chunks_of_sharers(shared):
    """Rows of the chunks of texts that hold a chunk of the map. A task gives a chunk's bytes the first time it meets it (it
    remembers MEMORY digests), the doc_id with a text's first chunk."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, given = np.frombuffer(shared.value, dtype=np.uint8), set()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "text_digest", "place", "digest", "chunk"])

        for batch in batches:
            rows, size = [], 0
            for k, chunks in chunked(batch.column(1)):
                names = [digest(c) for c in chunks]
                if not chunks or not _is_shared(names, bits):
                    continue
                whole = digest(b"".join(names))
                for place, (name, chunk) in enumerate(zip(names, chunks, strict=True)):
                    new = name not in given
                    if new:
                        if len(given) > MEMORY:
                            given.clear()
                        given.add(name)
                        size += len(chunk)
                    rows.append((batch.column(0)[k].as_py() if not place else None, whole, place, name, chunk if new else None))
                if size > 4_000_000:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)

    return cut


def _records(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            columns = zip(*(e.chunk(c) for c in batch.column(1).to_pylist()), strict=True)
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(c, f.type) for c, f in zip(columns, _RECORD, strict=True))], names=["digest", "n", *_PARTS])

    return encode


def _joined(path: str):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for k in range(batch.num_rows):  # a text at a time: its records are Python objects only here
                chunks = batch.column(1)[k].as_py()
                chunks.sort(key=lambda c: c["place"])
                ids = e.joined(tuple(c[p] for p in _PARTS) for c in chunks)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), batch.column(2).slice(k, 1), pa.array([ids], pa.binary())], names=["text_digest", "n", "token_bytes"])

    return join


def _widened(path: str):
    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([e.wide(x.as_py()) for x in part.column(1)], pa.binary())], names=["doc_id", "token_bytes"])

    return widen


def spread_join(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """many joined with one (a row for each key, with n: how many rows of many have it). A key of more than HOT_ROWS rows is
    dealt to several tasks: its row of one is repeated, its rows of many are split by their hash."""
    parts = F.ceil(F.col("n") / HOT_ROWS).cast("int")
    hot = one.where(F.col("n") > HOT_ROWS).select(key, parts.alias("parts"))
    others = [c for c in many.columns if c != key]
    split = many.join(hot, key, "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64(*others), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    repeated = one.withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n")
    return split.join(repeated, [key, "salt"]).drop("salt")


def _shared_map(rows: DataFrame):
    """The map of chunks that occur twice or more, broadcast: MAP_BITS bits at any size of the input."""
    counts = rows.mapInArrow(_digests, "d1 long, d2 long").groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    words = counts.select(F.expr(f"int(shiftright(d1 & {MAP_BITS - 1}L, 6)) as word"), F.expr("shiftleft(1L, int(d1 & 63L)) as bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(MAP_BITS // 64, dtype="<i8")
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    return rows.sparkSession.sparkContext.broadcast(bits.tobytes())


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens and token_bytes (little-endian unsigned 32-bit ids) of each row of docs (doc_id, text; other columns
    are ignored): the ids that tokenizers gives the whole text with add_special_tokens=False.

    tokenizer: path of a vocabulary whose normal form and words don't reach over ASCII white space and that keeps none of it,
    as BPE with word ends. A null text is empty and has no ids. Every row is encoded, repeated ones and
    those without a doc_id too; an empty table has no rows.

    Three passes read the texts: chunks are counted by digest; texts without a shared chunk are encoded in place; chunks of
    the others are encoded once and meet their texts by two joins. Which texts hold shared chunks is
    told by a bit map of fixed size (MAP_BITS); where it is full, more texts than needed take the way of the
    shared ones, with the same result. A text with copies is put together once."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = _shared_map(rows.select("text"))
    alone = rows.mapInArrow(_in_place(tokenizer, shared), "doc_id long, token_bytes binary")
    chunks = scratch.cut(rows.mapInArrow(_chunks_of_sharers(shared), _CHUNK_ROWS), "zstd")
    places = chunks.groupBy("text_digest", "place", "digest").agg(F.count(F.lit(1)).alias("copies"))
    counted = places.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    texts = chunks.where("chunk is not null").groupBy("digest").agg(F.first("chunk").alias("chunk")).join(counted, "digest").select("digest", "chunk", "n")
    kinds = {"head": "binary", "head_ids": "binary", "middle_ids": "binary", "tail": "binary", "tail_ids": "binary", "solid": "boolean"}
    records = scratch.cut(texts.mapInArrow(_records(tokenizer), "digest binary, n long, " + ", ".join(f"{k} {v}" for k, v in kinds.items())), "zstd")
    found = spread_join(places, records, "digest")
    whole = found.groupBy("text_digest").agg(F.collect_list(F.struct("place", *_PARTS)).alias("chunks"), F.max("copies").alias("n"))
    whole = whole.mapInArrow(_joined(tokenizer), "text_digest binary, n long, token_bytes binary")
    holders = chunks.where("place = 0").select("doc_id", "text_digest", F.monotonically_increasing_id().alias("row"))
    met = spread_join(holders, whole, "text_digest").select("doc_id", "token_bytes").mapInArrow(_widened(tokenizer), "doc_id long, token_bytes binary")
    return alone.unionByName(met).select("doc_id", (F.octet_length("token_bytes") / 4).cast("long").alias("n_tokens"), "token_bytes")


def _decoder(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = encoder(path).tokenizer
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids = [np.frombuffer(x or b"", dtype="<u4").tolist() for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(t.decode_batch(ids, skip_special_tokens=False), pa.string())], names=["doc_id", "n_tokens", "token_bytes", "decoded"])

    return decode


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """encoded (doc_id, n_tokens, token_bytes) with decoded: what tokenizers' decode(ids, skip_special_tokens=False) gives. No
    ids are the empty text."""
    return encoded.select("doc_id", "n_tokens", "token_bytes").mapInArrow(_decoder(tokenizer), "doc_id long, n_tokens long, token_bytes binary, decoded string")
