"""Substring dedup on sliding sentence spans.

A text is split into sentences (after . ! ? followed by space, and at line breaks); what holds no word, such as an empty
line, belongs to the sentence before it, or at the start of a text to the first. Runs of at least two consecutive
sentences with MIN_WORDS words or more are hashed, and single sentences of SOLO_WORDS words: of the runs that start at a
sentence, and of those that end at it, the shortest, which together cover every longer one. Hashes of 128 bits are joined
over all documents, and the sentences of every run but the first (smallest doc_id, then text, then place) are removed.

Passages of PASSAGE words or more whose edges fall inside sentences are found by words. Of each PASSAGE words the SEED
words with the smallest hash are joined along with the runs; around seeds that occur twice, every PASSAGE words are hashed
and joined, and the words of all but the first are removed. Windows with fewer than EDGE words outside removed sentences
aren't asked again: so few words that agree beside a removed sentence may do so by chance, and stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, by_plain_names, cut, ddl, private, quoted
from .words import BASE, SPACED, U64, mix, powers, text_blocks, word_hashes

MIN_WORDS, SOLO_WORDS = 20, 40
PASSAGE, SEED, EDGE = 51, 25, 5
_END = np.zeros(256, bool)
_END[list(b".!?")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_INVERSE = U64(pow(int(BASE), -1, 2**64))


def _sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each sentence, and where each text's sentences start (a text without words has none)."""
    first = np.zeros(len(data), bool)
    first[1:] = (data[:-1] == 10) | (_END[data[:-1]] & _SPACE[data[1:]] & (data[1:] != 10))
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(first)
    if len(starts):
        starts = starts[np.logical_or.reduceat(SPACED[data], starts)]
    bounds = np.searchsorted(starts, offsets)
    starts[bounds[:-1][bounds[:-1] < bounds[1:]]] = offsets[:-1][bounds[:-1] < bounds[1:]]
    return starts, bounds


class _Words:
    """The words of a block of texts, and hashes of any run of them that don't depend on where it stands: a sum of
    word * BASE^place, moved back to place 0, in two independent halves."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words, self.at, self.heads = word_hashes(data, offsets)
        power = powers(len(self.words) + 1)
        self.back = powers(len(self.words) + 1, _INVERSE)
        self.totals = [np.concatenate([[U64(0)], np.cumsum(w * power[:-1], dtype=np.uint64)]) for w in (self.words, mix(self.words ^ BASE))]

    def half(self, a: np.ndarray, b: np.ndarray, k: int = 0) -> np.ndarray:
        return mix(mix((self.totals[k][b] - self.totals[k][a]) * self.back[a]) + (b - a).astype(np.uint64))

    def hashes(self, a: np.ndarray, b: np.ndarray, seeds: np.ndarray | bool = False) -> list[pa.Array]:
        """Both halves for the words from each place in a up to that in b, as signed columns. A seed's hash is never
        that of a run of the same words."""
        apart = np.where(seeds, BASE, U64(0))
        return [pa.array(mix(self.half(a, b, k) ^ apart).view(np.int64)) for k in (0, 1)]


def _seeds(of: _Words) -> np.ndarray:
    """Places of the SEED words with the smallest hash in any PASSAGE words of a text."""
    n = len(of.words)
    if n < PASSAGE:
        return np.empty(0, np.int64)
    at = np.arange(n - SEED + 1)
    first = np.arange(n - PASSAGE + 1)
    least = first + np.lib.stride_tricks.sliding_window_view(of.half(at, at + SEED), PASSAGE - SEED + 1).argmin(1)
    ends = of.heads[np.searchsorted(of.heads, first, side="right")]
    return np.unique(least[first + PASSAGE <= ends])


def _word_ranges(found: list[int], starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word, and word after the last, of sentence spans."""
    spans = np.array(found, np.int64)
    up = np.append(np.searchsorted(at, starts), len(at))
    return up[spans >> 32], up[spans & 0xFFFFFFFF]


def _covered(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in a range from a to b."""
    return np.cumsum(np.bincount(a, minlength=n + 1) - np.bincount(b, minlength=n + 1))[:n] > 0


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and place of every PASSAGE words that hold a seed, but for those that removed sentences cover."""
    for batch in batches:
        marks = batch.column(3).to_pylist()
        for row, data, offsets in text_blocks(batch.column(2)):
            starts, bounds = _sentences(data, offsets)
            of = _Words(data, offsets)
            if not len(of.words):
                continue
            places, texts = [], []
            for i in range(len(offsets) - 1):
                n = int(of.heads[i + 1] - of.heads[i])
                seeds = -1 - np.array([m for m in marks[row + i] if m < 0], np.int64)
                place = np.unique(seeds[:, None] + np.arange(SEED - PASSAGE, 1))
                place = place[(place >= 0) & (place <= n - PASSAGE)]
                if found := [m for m in marks[row + i] if m >= 0]:
                    a, b = _word_ranges(found, starts[bounds[i] : bounds[i + 1]], of.at[of.heads[i] : of.heads[i + 1]])
                    gone = np.concatenate([[0], np.cumsum(_covered(a, b, n))])
                    place = place[gone[place + PASSAGE] - gone[place] <= PASSAGE - EDGE]
                places.append(place)
                texts.append(np.full(len(place), i))
            place, of_text = np.concatenate(places), np.concatenate(texts)
            rows, at = pa.array(of_text + row), place + of.heads[of_text]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *of.hashes(at, at + PASSAGE), pa.array(place)], names=["doc_id", "digest", "h", "g", "place"])


def _runs(count: np.ndarray, lo: np.ndarray, hi: np.ndarray, min_words: int, solo_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First sentence, and sentence after the last, of each run, once; count: words of each sentence; lo, hi: where the
    sentences of its text start and end."""
    n = len(count)
    up, k = np.concatenate([[0], np.cumsum(count)]), np.arange(n)
    need = np.where(count >= solo_words, 1, 2)
    to = np.maximum(np.searchsorted(up, up[:-1] + min_words), k + need)
    since = np.minimum(np.searchsorted(up, up[1:] - min_words, side="right") - 1, k + 1 - need)
    forth, back = to <= hi, (up[1:] >= min_words) & (since >= lo)
    pairs = np.unique(np.concatenate([k[forth], since[back]]) * np.int64(n + 1) + np.concatenate([to[forth], k[back] + 1]))
    return pairs // (n + 1), pairs % (n + 1)


def _run_hashes(min_words: int, solo_words: int):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_blocks(batch.column(2)):
                starts, bounds = _sentences(data, offsets)
                of = _Words(data, offsets)
                if not len(starts) or not len(of.words):
                    continue
                count = np.bincount(np.searchsorted(starts, of.at, side="right") - 1, minlength=len(starts))
                up = np.concatenate([[0], np.cumsum(count)])  # words before each sentence
                text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                a, b = _runs(count, bounds[:-1][text], bounds[1:][text], min_words, solo_words)
                span = ((a - bounds[text[a]]) << 32) | (b - bounds[text[a]])
                # seeds are marked by a negative span: -1 - the place of the first word
                seed = _seeds(of)
                of_text = np.searchsorted(of.heads, seed, side="right") - 1
                rows = pa.array(np.concatenate([text[a], of_text]) + row)
                hashes = of.hashes(np.concatenate([up[a], seed]), np.concatenate([up[b], seed + SEED]), np.arange(len(a) + len(seed)) >= len(a))
                span = np.concatenate([span, -1 - (seed - of.heads[of_text])])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *hashes, pa.array(span)], names=["doc_id", "digest", "h", "g", "span"])

    return runs


def _remover(counts_named: list[str]):
    """For batches of other columns, text, spans and places (in this order): text without the sentences in spans and the
    passages at places, and three counts."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans, places = batch.column(batch.num_columns - 3), *(batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
            out, counts = texts.to_pylist(), np.zeros((len(texts), 3), np.int64)
            for row, data, offsets in text_blocks(texts):
                starts, bounds = _sentences(data, offsets)
                counts[row : row + len(offsets) - 1, 0] = np.diff(bounds)
                for i in range(len(offsets) - 1):
                    if not (spans[row + i] or places[row + i]):
                        continue
                    own = data[offsets[i] : offsets[i + 1]]
                    edge = np.append(starts[bounds[i] : bounds[i + 1]] - offsets[i], len(own))
                    _, at, _ = word_hashes(own, np.array([0, len(own)]))
                    found, place = np.array(spans[row + i] or [], np.int64), np.array(places[row + i] or [], np.int64)
                    a, b = _word_ranges(found, edge[:-1], at)
                    words = _covered(np.concatenate([a, place]), np.concatenate([b, place + PASSAGE]), len(at))
                    to = np.append(at, len(own))
                    gone = _covered(np.concatenate([edge[found >> 32], to[place]]), np.concatenate([edge[found & 0xFFFFFFFF], to[place + PASSAGE]]), len(own))
                    keep = "" if words.all() else own[~gone].tobytes().decode()
                    counts[row + i, 1:] = len(np.unique(np.searchsorted(edge, at[words], side="right"))), len(out[row + i]) - len(keep)
                    out[row + i] = keep
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(out, pa.string()), *(pa.array(counts[:, k]) for k in range(3))], names=[*batch.schema.names[:-2], *counts_named])

    return remove


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, solo_words: int = SOLO_WORDS) -> DataFrame:
    """doc_id, digest (of the text), spans and places of the texts with repeats: spans (first sentence << 32 | sentence
    after the last) of the runs, and places (first word) of the PASSAGE words, that are not the first of their kind.
    Rows without a doc_id or text have none."""
    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), "text")
    runs = rows.mapInArrow(_run_hashes(min_words, solo_words), "doc_id long, digest long, h long, g long, span long")

    scratch = Scratch(docs.sparkSession)

    def repeats(of: DataFrame, place: str) -> DataFrame:
        """The rows whose hash is there more than once, with the first of them (d0, g0, p0). Most hashes occur once: they
        are told by counts of one half alone, taken before the shuffle. What is joined is written first, so that both
        sides of a join are plain shuffles and AQE can split a run that very many documents share."""
        twice = scratch.cut(of.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
        again = scratch.cut(of.join(twice, "h"))
        first = again.groupBy("h", "g").agg(F.min(F.struct("doc_id", "digest", place)).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        first = scratch.cut(first.select("h", "g", F.col("first.doc_id").alias("d0"), F.col("first.digest").alias("g0"), F.col(f"first.{place}").alias("p0")))
        return again.join(first, ["h", "g"])

    other = "doc_id <> d0 or digest <> g0"
    marks = scratch.cut(repeats(runs, "span").where(f"span < 0 or {other} or span <> p0").groupBy("doc_id", "digest").agg(F.collect_set("span").alias("marks")))
    seeded = rows.join(marks.where(F.exists("marks", lambda m: m < 0)), ["doc_id", "digest"]).select("doc_id", "digest", "text", "marks")
    windows = scratch.cut(seeded.mapInArrow(_passages, "doc_id long, digest long, h long, g long, place long"))
    # a window that overlaps its first one is kept
    again = repeats(windows, "place").where(f"{other} or place >= p0 + {PASSAGE}")
    places = again.groupBy("doc_id", "digest").agg(F.collect_set("place").alias("places"))
    both = marks.join(places, ["doc_id", "digest"], "left").select("doc_id", "digest", F.filter("marks", lambda m: m >= 0).alias("spans"), "places")
    out = cut(both.where("size(spans) > 0 or places is not null"))
    scratch.clear()
    return out


NEW = ["n_sentences", "n_removed", "chars_removed"]


def _rewritten(docs: DataFrame, min_words: int, solo_words: int) -> tuple[DataFrame, list[str]]:
    """docs with text (and n_chars) rewritten and three counts, whose names are given too: none of docs' columns has
    them."""
    here, digest, at, places, *counts = private(docs.columns, "doc", "digest", "spans", "places", *NEW)
    found = repeated_spans(docs, min_words, solo_words).toDF(here, digest, at, places)
    joined = docs.join(found, (docs["doc_id"].cast("long") == F.col(here)) & (F.xxhash64(docs["text"]) == F.col(digest)), "left")
    other = [c for c in docs.columns if c.lower() != "text"]
    out = joined.select(*map(quoted, other), "text", at, places).mapInArrow(_remover(counts), f"{ddl(docs, other)}, text string, {', '.join(f'{c} long' for c in counts)}")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(counts[1]) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out, counts


def drop_repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, solo_words: int = SOLO_WORDS) -> DataFrame:
    """docs with text rewritten, and n_sentences, n_removed, chars_removed (long).

    n_removed counts the sentences removed whole or in part. A text keeps its bytes but for what is removed; no word
    left gives an empty text; a null text stays null with zero counts; a row without a doc_id is not changed. Rows with
    the same doc_id and text count as one (all keep a first passage); the order for "first" is doc_id, then the text's
    digest, then place. n_chars, if there is one, is set to the new length. Columns of docs with the new names are
    replaced."""
    out, counts = _rewritten(docs, min_words, solo_words)
    same = [c for c in docs.columns if c.lower() not in NEW]
    return out.select(*map(quoted, same), *(F.col(c).alias(n) for c, n in zip(counts, NEW, strict=True)))


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs (its columns, whatever their names) with text and n_chars rewritten as by drop_repeated_spans."""
    return by_plain_names(docs, lambda d: _rewritten(d, MIN_WORDS, SOLO_WORDS)[0].select(*d.columns))
