"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

A window (10 consecutive item words; all words of a shorter item) is a pattern. A text is walked with a block of two
words: a shift table says how far the next possible end of a pattern is; where it says 0, the patterns whose last words
have the hash of the text's (their suffix bucket) are compared, by word hashes and then by their bytes. Words are numbers
in arrays, so the tables of 8 MB of items take less than 200 MB, and a Python worker keeps them for its later tasks. Items are
taken in blocks of bounded size, each shipped to the tasks when its pass begins and given up after it; one block is
the rule, and more only add passes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, by_plain_names, cut, ddl, private, quoted
from .words import U64, mix, text_blocks, word_hashes

WINDOW = 10
#: Bytes of item text in one block: what the driver holds at once.
BLOCK_BYTES = 8_000_000
#: Words of a suffix that choose a bucket.
SUFFIX = 5
#: A-Z to lower case, and every byte that is in no word to a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
IN_WORD = np.frombuffer(WORD_BYTES, dtype=np.uint8) != 32


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def _suffixes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that end at each word; of no meaning for the first n - 1."""
    total = np.zeros(len(words), np.uint64)
    for k in range(n):
        total[k:] += words[: len(words) - k] * (mix(np.array([k + 1], np.uint64))[0] | U64(1))
    return mix(total)


class Patterns:
    """Shift table and suffix buckets of the patterns of m words that start at starts in the items' words. Equal patterns
    are one, with the items that hold it."""

    def __init__(self, m: int, words: np.ndarray, starts: np.ndarray, item_of: np.ndarray):
        self.m, self.words = m, words
        self.block, self.width = min(2, m), min(SUFFIX, m)
        blocks = _suffixes(words, self.block)
        self.slots = U64((1 << max(16, min(24, int(8 * len(starts)).bit_length()))) - 1)
        shift = np.full(int(self.slots) + 1, max(1, m - self.block + 1), dtype=np.uint8)
        for end in range(self.block, m + 1):  # the last, with the smallest shift, stays
            shift[(blocks[starts + end - 1] & self.slots).astype(np.int64)] = m - end
        self.shift = shift
        whole, suffix = _suffixes(words, m)[starts + m - 1], _suffixes(words, self.width)[starts + m - 1]
        order = np.lexsort((item_of[starts], whole, suffix))
        starts, whole, suffix = starts[order], whole[order], suffix[order]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (whole[1:] != whole[:-1]) | (suffix[1:] != suffix[:-1])
        #: Of each pattern: where its equals lie in items, and the suffix's hash.
        self.first = np.append(np.flatnonzero(new), len(starts))
        self.items = item_of[starts]
        self.start, self.suffix = starts[new], suffix[new]

    def search(self, words: np.ndarray, bounds: list[int]) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of each place where the words' hashes are a pattern's, in texts whose words lie between
        bounds. Tables are asked for all texts at once; each text is walked by itself."""
        m = self.m
        if len(words) < m:
            return
        shift = self.shift[(_suffixes(words, self.block) & self.slots).astype(np.int64)]
        if m == 1:
            ends = np.flatnonzero(shift == 0)
        else:
            steps, found = shift.tobytes(), []
            for start, n in zip(bounds, bounds[1:], strict=False):
                at = start + m - 1
                while at < n:
                    step = steps[at]
                    if not step:
                        found.append(at)
                        step = 1
                    at += step
            ends = np.array(found, dtype=np.int64)
        if not len(ends):
            return
        wanted = _suffixes(words, self.width)[ends]
        low, high = np.searchsorted(self.suffix, wanted, "left"), np.searchsorted(self.suffix, wanted, "right")
        for k in np.flatnonzero(low < high):
            at = int(ends[k]) - m + 1
            for p in range(low[k], high[k]):
                if np.array_equal(words[at : at + m], self.words[self.start[p] : self.start[p] + m]):
                    yield at, p


class Tables:
    """All patterns of a block of items (id, text)."""

    def __init__(self, items: list[tuple[int | str, bytes]], window: int):
        self.ids = [k for k, _ in items]
        texts = pa.array([t for _, t in items], pa.binary())
        hashes, places, item_of, self.blocks, counts = [], [], [], [], []
        for first, data, offsets in text_blocks(texts):
            h, at, bounds = word_hashes(data, offsets, in_word=IN_WORD)
            hashes.append(h)
            places.append(at + sum(len(b) for b in self.blocks))
            counts.append(np.diff(bounds))
            self.blocks.append(data.tobytes())
        self.data = b"".join(self.blocks)
        del self.blocks
        words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.place = np.append(np.concatenate(places) if places else np.empty(0, np.int64), len(self.data)).astype(np.int64)
        count = np.concatenate(counts) if counts else np.empty(0, np.int64)
        item_of = np.repeat(np.arange(len(count), dtype=np.int32), count)
        left = np.repeat(np.cumsum(count), count) - np.arange(len(words))
        size = np.minimum(count, window)[item_of]
        self.patterns = [Patterns(int(m), words, np.flatnonzero((size == m) & (left >= m)), item_of) for m in np.unique(size)]

    def search(self, words: np.ndarray, place: np.ndarray, bounds: np.ndarray, data: bytes) -> dict[int, list[tuple[int, int, list]]]:
        """text -> (first word, word after the last, items) of each occurrence in texts whose words, between bounds, start at
        place in data."""
        out: dict[int, list] = {}
        place = np.append(place, len(data))
        for t in self.patterns:
            for at, p in t.search(words, bounds.tolist()):
                s, text = t.start[p], int(np.searchsorted(bounds, at, "right")) - 1
                if words_of(data[place[at] : place[at + t.m]])[: t.m] == words_of(self.data[self.place[s] : self.place[s + t.m]])[: t.m]:
                    first = at - int(bounds[text])
                    out.setdefault(text, []).append((first, first + t.m, [self.ids[k] for k in np.unique(t.items[t.first[p] : t.first[p + 1]])]))
        return out


_KEPT: dict[str, Tables] = {}


def _tables(name: str, items, window: int) -> Tables:
    """The tables of a block, which this worker keeps until it is asked for another block's."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = Tables(items.value, window)
    return _KEPT[name]


def _searcher(items, window: int, kind: pa.DataType, names: list[str], hits_only: bool = False):
    """For batches whose last column is a text: the others with n_words, spans and items, called names. items: a
    broadcast list of (item, text), whose ids are of this kind. hits_only leaves rows without a hit out."""
    block = uuid.uuid4().hex

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(block, items, window)
        for batch in batches:
            n_words, spans, found = [], [], []
            for _, data, offsets in text_blocks(batch.column(batch.num_columns - 1)):
                raw = data.tobytes()
                hashes, places, bounds = word_hashes(data, offsets, in_word=IN_WORD)
                hits = tables.search(hashes, places, bounds, raw)
                n_words += np.diff(bounds).tolist()
                for k in range(len(bounds) - 1):
                    seen, merged = {x for *_, which in hits.get(k, ()) for x in which}, []
                    for start, end in sorted((a, b) for a, b, _ in hits.get(k, ())):
                        if merged and start <= merged[-1][1]:
                            merged[-1][1] = max(end, merged[-1][1])
                        else:
                            merged.append([start, end])
                    spans.append([{"start": x, "end": y} for x, y in merged])
                    found.append(sorted(seen))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            out = pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n_words, pa.int64()), pa.array(spans, span), pa.array(found, pa.list_(kind))], names=[*batch.schema.names[:-1], *names])
            yield out.filter(pa.array([bool(x) for x in found], pa.bool_())) if hits_only else out

    return search


def _item_blocks(benchmark: DataFrame, block_bytes: int) -> tuple[list[DataFrame], bool]:
    """The items in parts whose texts have about block_bytes together, decided from their summed size; and whether
    their ids are whole numbers (else they are taken as strings)."""
    number = benchmark.schema["item_id"].dataType.typeName() in ("byte", "short", "integer", "long")
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long" if number else "string").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    n = max(1, -(-total // block_bytes))
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items for k in range(n)], number


def _search(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int, block_bytes: int) -> tuple[DataFrame, list[str]]:
    """The columns in keep of every row with n_words, spans and items, whose names (which no column of docs has) are
    given too."""
    sc = docs.sparkSession.sparkContext
    parts, number = _item_blocks(benchmark, block_bytes)
    raw, mark, key, *names = private(docs.columns, "raw", "mark", "key", "n_words", "spans", "items")
    kind, item = (pa.int64(), "long") if number else (pa.string(), "string")
    made = f"{names[0]} long, {names[1]} array<struct<start:long,end:long>>, {names[2]} array<{item}>"
    text = F.col("text").cast("string")
    ship = lambda part: sc.broadcast([(r.item_id, bytes(r.text)) for r in part.collect()])
    if len(parts) == 1:
        return docs.select(*map(quoted, keep), text.cast("binary").alias(raw)).mapInArrow(_searcher(ship(parts[0]), window, kind, names), f"{ddl(docs, keep)}, {made}"), names
    # what a text holds depends on the text alone: each further block gives the texts that it hits, by digest, and only
    # these few rows are grouped and joined back
    scratch, hits = Scratch(docs.sparkSession), None
    for part in parts[1:]:
        block = ship(part)
        one = docs.where("text is not null").select(F.md5(text).alias(key), text.cast("binary").alias(raw)).mapInArrow(_searcher(block, window, kind, names, True), f"{key} string, {made}")
        one = scratch.cut(one)
        block.unpersist()
        hits = one if hits is None else hits.unionByName(one)
    more_spans, more_items = private([*docs.columns, raw, mark, key, *names], "more_spans", "more_items")
    hits = cut(hits.groupBy(key).agg(F.flatten(F.collect_set(names[1])).alias(more_spans), F.array_distinct(F.flatten(F.collect_set(names[2]))).alias(more_items)))
    scratch.clear()
    first = docs.select(*map(quoted, keep), F.md5(text).alias(mark), text.cast("binary").alias(raw)).mapInArrow(_searcher(ship(parts[0]), window, kind, names), f"{ddl(docs, keep)}, {mark} string, {made}")
    both = first.join(hits, F.col(mark) == F.col(key), "left")
    spans = F.aggregate(F.array_sort(F.concat(names[1], F.coalesce(more_spans, F.slice(names[1], 1, 0)))), F.array().cast("array<struct<start:long,end:long>>"), _join_spans)
    items = F.array_sort(F.array_distinct(F.concat(names[2], F.coalesce(more_items, F.slice(names[2], 1, 0)))))
    return both.select(*map(quoted, keep), names[0], F.when(F.col(key).isNull(), F.col(names[1])).otherwise(spans).alias(names[1]), items.alias(names[2])), names


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The columns in keep (default doc_id; those with a new name are replaced) of each row of docs with n_words, n_hit,
    spans (start, end of hit words, joined where they meet) and item_ids (the items with an occurring window, ascending;
    longs, or strings if benchmark's ids aren't whole numbers).

    Null or empty texts have no words and no hits, and so has every text where the benchmark is empty; items without words, id or text have no windows; items with equal
    windows are all named. A benchmark of several blocks needs a pass over the texts for each; only texts with hits are
    shuffled then."""
    new = ["n_words", "n_hit", "spans", "item_ids"]
    keep = [c for c in keep or ["doc_id"] if c.lower() not in new]
    found, (words, spans, items) = _search(docs, benchmark, keep, window, block_bytes)
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(*map(quoted, keep), F.col(words).alias("n_words"), n_hit.alias("n_hit"), F.col(spans).alias("spans"), F.col(items).alias("item_ids"))


def _join_spans(acc, s):
    last = F.try_element_at(acc, F.lit(-1))
    meets = (F.size(acc) > 0) & (s["start"] <= last["end"])
    grown = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
    return F.when(meets, grown).otherwise(F.concat(acc, F.array(s)))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs (its columns, whatever their names) without the rows that hold a benchmark window."""

    def clean(d: DataFrame) -> DataFrame:
        found, (_, spans, _) = _search(d, benchmark, d.columns, window, block_bytes)
        return found.where(F.size(spans) == 0).select(*d.columns)

    return by_plain_names(docs, clean)
