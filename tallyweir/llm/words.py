"""Words of many texts as 64-bit hashes, in whole-array numpy steps; used inside mapInArrow tasks.

A text's words are hashed from its UTF-8 bytes: a sum of per-byte random values times powers of an odd base, then
mixed. Texts are taken in blocks of a few MB, so that memory doesn't depend on the batch; one text is never divided.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = U64(0x9E3779B97F4A7C15)
BLOCK_BYTES = 2_000_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: True for bytes of words: everything but space and \t to \r.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64's constants)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = powers(1024)


def text_blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of texts of about BLOCK_BYTES; a null is an empty text."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1)
        to = min(to, len(texts))
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, in_word: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte) of each word and, for each text, where its words start (length: texts + 1)."""
    global _POWERS
    inside = in_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = inside[heads]  # a word ends with its text
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.empty(0, np.uint64), starts, bounds
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    if (longest := int(lengths.max())) > len(_POWERS):
        _POWERS = powers(2 * longest)
    value = BYTE_VALUES[LOWER[data[starts[0] :]] if lower else data[starts[0] :]] * _POWERS[place]
    value[~inside[starts[0] :]] = 0
    return mix(np.add.reduceat(value, starts - starts[0])), starts, bounds


def windows(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of width words within a text, and for each text where its runs start. A text with fewer words,
    but not none, has one run: all its words."""
    counts = np.diff(bounds)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(n)])
    if not len(words):
        return np.empty(0, np.uint64), starts
    factor = mix(np.arange(1, width + 1, dtype=np.uint64) * BASE) | U64(1)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    total = np.zeros(len(words), np.uint64)
    text = np.repeat(np.arange(len(counts)), counts)
    left = bounds[1:][text] - np.arange(len(words))  # words from here to the text's end
    for k in range(width):
        total += np.where(left > k, padded[k : k + len(words)] * factor[k], U64(0))
    wanted = np.where(counts[text] >= width, left >= width, left == counts[text])
    return mix(total + np.minimum(left, width).astype(np.uint64))[wanted], starts
