"""Near duplicates: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidate edges.

Texts are lower-cased (A-Z) and split at space and \\t to \\r; a document's set holds its distinct 5-word shingles, or
its whole word sequence if it is shorter. Documents with equal sets are one class. Classes that share a bucket of a
band are compared with the bucket's hub only, so a bucket of m classes gives m - 1 edges; each edge is confirmed on full
sets. Where members of a bucket are still in different components after that, the hub is set aside and the rest takes a
new hub (the member with most confirmed links), until the pairs still open are few enough for a plain join: links
between different texts aren't lost by the star shape, and no step emits all pairs of a large group.

A pair at the threshold (0.85) shares no bucket with a chance of about 7e-8 (28 bands of 5 rows); lower thresholds need
more bands (at 0.8 it is 1.5e-5 with 28, and 1.3e-7 with LOW_BANDS).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import Scratch, cut, private
from .words import BASE, U64, mix, text_blocks, windows, word_hashes

BANDS, LOW_BANDS, ROWS, SHINGLE = 28, 40, 5, 5


@lru_cache(1)
def _donors(bins: int) -> np.ndarray:
    """For each bin the order in which an empty one asks the others: as good as fresh uniform draws for each bin."""
    rng = np.random.Generator(np.random.PCG64(7))
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def signature(shingles: np.ndarray, bins: int) -> np.ndarray:
    """Minimum of each bin of one permutation (shingles: sorted, distinct); empty bins take a random full bin's."""
    edges = (np.arange(bins, dtype=np.uint64) * U64(2**64 // bins)).astype(np.uint64)
    at = np.searchsorted(shingles, edges)
    to = np.append(at[1:], len(shingles))
    full = at < to
    mins = shingles[np.minimum(at, len(shingles) - 1)]
    if not full.all():
        empty = np.flatnonzero(~full)
        order = _donors(bins)[empty]
        mins = mins.copy()
        mins[empty] = mins[order[np.arange(len(empty)), full[order].argmax(1)]]
    return mins


def _sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    for row, data, offsets in text_blocks(texts):
        words, _, bounds = word_hashes(data, offsets)
        hashes, at = windows(words, bounds, SHINGLE)
        for i in range(len(offsets) - 1):
            yield row + i, np.unique(hashes[at[i] : at[i + 1]])


def _sketch_of(bands: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = (mix(np.arange(1, bands * ROWS + 1, dtype=np.uint64) * BASE) | U64(1)).reshape(bands, ROWS)
        for batch in batches:
            n, digest, keys = [], [], []
            for _, s in _sets(batch.column(1)):
                n.append(len(s))
                digest.append((int(mix(s).sum(dtype=np.uint64)), int(mix(s ^ BASE).sum(dtype=np.uint64))))
                keys.append(mix((signature(s, bands * ROWS).reshape(bands, ROWS) * factor).sum(1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)) if len(s) else np.empty(0, np.uint64))
            flat = np.concatenate(keys) if keys else np.empty(0, np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)), pa.array(flat.view(np.int64)))
            d = np.array(digest, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]), lists], names=["doc_id", "n_shingles", "d1", "d2", "keys"])

    return sketch


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sets = batch.column(0), [s for _, s in _sets(batch.column(1))]
        at = 0
        while at < len(sets):  # rows of a few MB
            to, size = at, 0
            while to < len(sets) and size < 500_000:
                size += len(sets[to])
                to += 1
            part = sets[at:to]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(s) for s in part])]).astype(np.int32)), pa.array(np.concatenate(part).view(np.int64)))
            yield pa.RecordBatch.from_arrays([ids.slice(at, to - at), lists], names=["id", "shingles"])
            at = to


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets agree: 100 * intersection >= percent * union. One set travels with each pair."""
    a = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    both = a.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    return both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b").distinct()


def _links_of(percent: int):
    """Links between the members of two blocks (or within one), for applyInArrow; a spanning forest of them is enough."""

    def links(table: pa.Table) -> pa.Table:
        ids, part, side = (table[c].to_numpy() for c in ("id", "part", "side"))
        lists = table["shingles"].combine_chunks()
        flat, size = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(ids)), size)
        _, column, seen = np.unique(flat, return_inverse=True, return_counts=True)
        shared = seen[column] > 1  # a shingle of one set alone is in no intersection
        row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        right = side == side.max()
        left = side == side.min()
        common = np.zeros((len(ids), len(ids)), np.float32)
        for c in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            lo, hi = np.searchsorted(column, [c, c + 4096])
            cells = np.zeros((len(ids), 4096), np.float32)
            cells[row[lo:hi], column[lo:hi] - c] = 1
            common += cells @ cells.T
        union = size[:, None] + size[None, :] - common
        linked = (100 * common >= percent * union) & (part[:, None] != part[None, :]) & left[:, None] & right[None, :]
        root = {p: p for p in part.tolist()}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        out = []
        for i, j in zip(*np.nonzero(linked)):
            if (x := top(int(part[i]))) != (y := top(int(part[j]))):
                root[max(x, y)] = min(x, y)
                out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        found = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return links


def _between_blocks(open_: DataFrame, sets: DataFrame, percent: int, members: int = 256, shingles: int = 500_000) -> DataFrame:
    """Links (a, b) between members of a bucket in different parts, for buckets with many such pairs: a bucket is dealt
    into blocks of about that many members and shingles, and each two blocks meet in a task that compares whole sets
    and returns links only. The largest part's own blocks don't meet one another."""
    blocks = lambda m, s: F.greatest(F.ceil(m / members), F.ceil(s / shingles), F.lit(1)).cast("int")
    dealt = open_.withColumn("n0", blocks(F.col("main.c"), F.col("main.s"))).withColumn("n1", blocks(F.col("m") - F.col("main.c"), F.col("s") - F.col("main.s")))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    dealt = dealt.withColumn("block", F.when(F.col("part") == F.col("main.part"), deal("n0")).otherwise(F.col("n0") + deal("n1")))
    partner = F.explode(F.filter(F.sequence(F.lit(0), F.col("n0") + F.col("n1") - 1), lambda y: (y >= F.col("n0")) | (F.col("block") >= F.col("n0"))))
    met = dealt.select("key", "id", "part", "block", partner.alias("y")).select("key", F.least("block", "y").alias("x"), F.greatest("block", "y").alias("y"), "id", "part", F.col("block").alias("side"))
    return met.join(sets, "id").groupBy("key", "x", "y").applyInArrow(_links_of(percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85, slack: int = 4, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of docs (doc_id, text; other columns are ignored).

    kept is doc_id = component_id. Documents without words, and null texts, have an empty set and are linked with
    nothing; a row without a doc_id is linked with nothing, has no component and is kept. Rows that share a doc_id are
    one document (all kept or none). An empty table gives an empty table. slack: open pairs for each member up to which a
    bucket is small; it changes the plan, never the result."""
    sketch = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_sketch_of(bands), "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>"))
    # a class: the documents with one set; its smallest doc_id stands for it
    classes = cut(sketch.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("id"), F.first("keys").alias("keys")))
    scratch = Scratch(docs.sparkSession)
    buckets = classes.select("id", "n_shingles", F.explode("keys").alias("key"))
    hubs = buckets.groupBy("key").agg(F.min(F.struct("id", "n_shingles")).alias("hub"), F.count(F.lit(1)).alias("m")).where("m > 1")
    members = scratch.cut(buckets.join(hubs.select("key", "m", F.col("hub.id").alias("hub"), F.col("hub.n_shingles").alias("hub_n")), "key"))
    near = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))  # noqa: E731  sizes that far apart can't agree
    star = members.where("id <> hub").where(near(F.col("n_shingles"), F.col("hub_n"))).select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    tested = scratch.cut(star)
    wanted = members.select("id").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    one_each = classes.join(wanted, "id", "left_semi").select("id")
    sets = scratch.cut(texts.join(one_each, "id", "left_semi").mapInArrow(_full_sets, "id long, shingles array<long>")).where(F.size("shingles") > 0)
    links = scratch.cut(_confirm(tested, sets, percent))
    parts = cut(components(links))
    open_ = members.where("m > 2 and id <> hub").select("key", "id", "n_shingles")
    for step in ("second hub", "all"):
        # members of one bucket in different components; within a component nothing is left to ask
        placed = open_.join(parts, F.col("id") == F.col("node"), "left").select("key", "id", "n_shingles", F.coalesce("component", "id").alias("part"))
        by_part = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("c"), F.sum("n_shingles").alias("s"))
        pairs = (F.col("m") * F.col("m") - F.col("within")) / 2
        by_key = by_part.groupBy("key").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("within"), F.max(F.struct("c", "part", "s")).alias("main"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
        open_ = scratch.cut(placed.join(by_key.select("key", "m", "s", "main", (pairs <= slack * F.col("m")).alias("few")), "key"))
        if not (left := open_.groupBy("few").count().collect()):
            break
        if step == "second hub" and not all(r.few for r in left):
            degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
            ranked = open_.join(degree, "id", "left").select("key", "id", "n_shingles", "part", F.struct(-F.coalesce("degree", F.lit(0)), "id", "n_shingles", "part").alias("rank"))
            # written, so that the join's sides are both plain and AQE can split a bucket that is hot
            hub = scratch.cut(ranked.groupBy("key").agg(F.min("rank").alias("h")).select("key", F.col("h.id").alias("hub"), F.col("h.n_shingles").alias("hub_n"), F.col("h.part").alias("hub_part")))
            open_ = scratch.cut(open_.select("key", "id", "n_shingles", "part").join(hub, "key"))
            ask = open_.where("id <> hub and part <> hub_part").where(near(F.col("n_shingles"), F.col("hub_n"))).select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b"))
            ask = scratch.cut(ask.distinct().join(tested, ["a", "b"], "left_anti"))
            more = scratch.cut(_confirm(ask, sets, percent))
            open_ = open_.where("id <> hub").select("key", "id", "n_shingles")
        else:
            few = open_.where("few").select("key", "id", "n_shingles", "part")
            other = few.select("key", F.col("id").alias("b"), F.col("n_shingles").alias("bn"), F.col("part").alias("bp"))
            ask = few.join(other, "key").where("id < b and part <> bp").where(near(F.col("n_shingles"), F.col("bn"))).select(F.col("id").alias("a"), "b")
            ask = scratch.cut(ask.distinct().join(tested, ["a", "b"], "left_anti"))
            more = scratch.cut(_confirm(ask, sets, percent).union(_between_blocks(open_.where("not few"), sets, percent)))
        parts = cut(components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)))
    scratch.clear()
    rep = classes.join(parts, F.col("id") == F.col("node"), "left").select("d1", "d2", "n_shingles", F.col("id").alias("rep"), F.coalesce("component", "id").alias("part"))
    placed = sketch.select("doc_id", "n_shingles", "d1", "d2").join(rep, ["d1", "d2", "n_shingles"], "left")
    part = F.when(F.col("doc_id").isNotNull(), F.coalesce("part", "doc_id"))
    return placed.select("doc_id", "n_shingles", part.alias("component_id"), F.coalesce(F.col("doc_id") == part, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 85, bands: int = BANDS) -> DataFrame:
    """docs (its columns) without the documents of a near-duplicate group other than the one with the smallest doc_id.
    Rows without a doc_id stay; rows that share a doc_id are one document, and stay or go together."""
    (gone,) = private(docs.columns, "gone")
    verdict = near_duplicates(docs, percent, bands=bands).where("not kept").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(verdict, docs["doc_id"].cast("long") == F.col(gone), "left_anti")
