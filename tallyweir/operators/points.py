"""Searches over ordered rows that no task holds whole: running sums, the next point, and the rows that a chain of pointers
passes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import Scratch, cut

#: Rows of a chain that one group of a task follows.
BLOCK = 16_384


def same(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner", also: Column | None = None) -> DataFrame:
    """a joined with b on keys, in which nulls are equal; b's keys go. b must have other names for its other columns."""
    renamed = b.select(*(F.col(k).alias(f"_r_{k}") for k in keys), *(c for c in b.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return a.join(renamed, on if also is None else [*on, also], how).drop(*(f"_r_{k}" for k in keys))


def prefix_sums(rows: DataFrame, keys: list[str], values: dict[str, str], order: list[str], bucket: Column) -> DataFrame:
    """rows with the sum of each value (column -> name of its sum) over the rows of the same keys before it in order, in two
    phases: sums by bucket (which rises with order) give each bucket its offset, and only the rows of one bucket are ordered
    together. Null keys are a group; rows of equal order stand by their values."""
    rows = rows.withColumn("_bucket", bucket)
    by = [*keys, "_bucket"]
    sums = rows.groupBy(*by).agg(*(F.coalesce(F.sum(v), F.lit(0)).alias(f"_s_{n}") for v, n in values.items()))
    upto = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*by, *(F.coalesce(F.sum(f"_s_{n}").over(upto), F.lit(0)).alias(f"_o_{n}") for n in values.values()))
    within = Window.partitionBy(*by).orderBy(*order, *values).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumns({f"_l_{n}": F.coalesce(F.sum(v).over(within), F.lit(0)) for v, n in values.items()})
    out = same(local, offsets, by)
    return out.withColumns({n: F.col(f"_l_{n}") + F.col(f"_o_{n}") for n in values.values()}).drop("_bucket", *(f"_{x}_{n}" for n in values.values() for x in "lo"))


def numbered(rows: DataFrame, keys: list[str], order: list[str], scratch: Scratch) -> DataFrame:
    """rows with i (0, 1, ... in the order of a key; rows of equal order stand anyhow). Rows are dealt by ranges of (keys, order),
    numbered in each, and the ranges' counts are summed."""
    dealt = scratch.cut(rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys, *order, "_tie").withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*keys, "_range", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order, "_tie"))
    out = same(dealt.withColumn("_place", place), sizes, [*keys, "_range"])
    return out.withColumn("i", F.col("_before") + F.col("_place") - 1).drop("_range", "_place", "_before", "_tie")


def next_point(asked: DataFrame, at: Column, points: DataFrame, keys: list[str], place: Column, value: Column, found: str, scratch: Scratch, tie: Column | None = None) -> DataFrame:
    """asked with found: the value of the first of points (same keys; of equal places the one with the smallest tie) whose
    place is at or after `at`; null if there is none or `at` is null.

    Both are dealt by ranges of (keys, place) and put in order there; a range without a later point takes the first one of the
    ranges after it, of which a row each is known. So a key with most of the rows is many tasks."""
    tie = F.lit(0) if tie is None else tie
    one = points.where(place.isNotNull()).select(*keys, place.alias("_at"), F.lit(1).alias("_kind"), tie.cast("long").alias("_tie"), value.alias("_value"), F.lit(None).cast(asked.schema).alias("_row"))
    kind = one.schema["_value"].dataType
    two = asked.select(*keys, at.alias("_at"), F.lit(0).alias("_kind"), F.xxhash64(*asked.columns).alias("_tie"), F.lit(None).cast(kind).alias("_value"), F.struct(*asked.columns).alias("_row"))
    dealt = scratch.cut(one.unionByName(two).repartitionByRange(*keys, "_at", "_kind", "_tie").withColumn("_range", F.spark_partition_id()))
    firsts = dealt.groupBy(*keys, "_range").agg(F.min_by("_value", F.when(F.col("_kind") == 1, F.struct("_at", "_tie"))).alias("_first"))
    later = Window.partitionBy(*keys).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.withColumn("_after", F.last("_first", ignorenulls=True).over(later)).drop("_first")
    down = Window.partitionBy(*keys, "_range").orderBy(F.col("_at").desc(), F.col("_kind").desc(), F.col("_tie").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.withColumn("_here", F.last("_value", ignorenulls=True).over(down)).where("_kind = 0")
    out = same(out, firsts, [*keys, "_range"])
    value_found = F.when(F.col("_at").isNotNull(), F.coalesce("_here", "_after"))
    return out.select("_row.*", value_found.alias(found))


def _exits(table: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    """(local order, next as local place or what it is beyond the block, first i) of a block's rows (i, next)."""
    i, nxt = table["i"].to_numpy(), table["next"].fill_null(-1).to_numpy()
    order = np.argsort(i, kind="stable")
    return order, nxt[order], int(i[order[0]])


def chain(rows: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """keys and i of the rows that are passed from i = 0 on, going from each to its next. rows: keys, i (0, 1, ... without gaps
    in a key) and next (greater than i, or null at the end; past the last row is an end too).

    A key's rows are cut into blocks of BLOCK rows. In each, every row's way out of the block is found at once; between blocks
    only the rows that are entered from another block matter, and those that the chain enters are found by pointer doubling:
    so many joins as the number of blocks has binary digits. Then each block marks what is passed from its entry on."""
    block = lambda c: F.floor(F.col(c) / BLOCK)
    rows = scratch.cut(rows.select(*keys, F.col("i").cast("long"), F.col("next").cast("long")).withColumn("block", block("i")))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in keys)
    comma = ", " if keys else ""

    def ways_out(key: tuple, table: pa.Table) -> pa.Table:
        order, nxt, first = _exits(table)
        out, n = nxt.tolist(), len(nxt)
        for k in range(n - 1, -1, -1):
            if first <= out[k] < first + n:
                out[k] = out[out[k] - first]
        return pa.table({**{c: table[c].take(pa.array(order)) for c in keys}, "i": pa.array(np.arange(first, first + n)), "out": pa.array(out, pa.int64())})

    entered = rows.where(block("next") != F.col("block")).select(*keys, F.col("next").alias("i")).unionByName(rows.where("i = 0").select(*keys, "i")).distinct()
    jumps = rows.groupBy(*keys, "block").applyInArrow(ways_out, f"{kinds}{comma}i long, out long").where("out >= 0")
    jumps = scratch.cut(same(jumps, entered.withColumn("_e", F.lit(1)), [*keys, "i"]).drop("_e"))
    known = scratch.cut(rows.where("i = 0").select(*keys, "i"))
    while True:
        more = same(known, jumps, [*keys, "i"]).select(*keys, F.col("out").alias("i"))
        grown = scratch.cut(known.unionByName(more).distinct())
        if grown.count() == known.count():
            break
        known = grown
        jumps = scratch.cut(same(jumps, jumps.select(*keys, F.col("i").alias("out"), F.col("out").alias("_out")), [*keys, "out"]).select(*keys, "i", F.col("_out").alias("out")))

    def marked(key: tuple, table: pa.Table) -> pa.Table:
        order, nxt, first = _exits(table)
        entries = table["entry"].to_numpy(zero_copy_only=False)[order]
        passed = []
        for k in np.flatnonzero(entries):
            at = int(k) + first
            while first <= at < first + len(nxt):
                passed.append(at - first)
                at = int(nxt[at - first])
        return pa.table({**{c: table[c].take(pa.array(order[passed])) for c in keys}, "i": pa.array(np.array(passed, dtype=np.int64) + first)})

    with_entry = same(rows, known.withColumn("entry", F.lit(True)), [*keys, "i"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    return scratch.cut(with_entry.groupBy(*keys, "block").applyInArrow(marked, f"{kinds}{comma}i long"))


def _reach(tops: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """search(begin, want): for each question the first index from begin on whose top is at least want, or len(tops). Maxima of
    runs of 1, 2, 4, ... tops are kept, so a question takes so many steps as their number has binary digits, in any order of tops."""
    values, ranks = np.unique(tops, return_inverse=True)
    levels = [ranks.astype(np.int64)]
    while 2 ** len(levels) <= len(tops):
        below, half = levels[-1], 2 ** (len(levels) - 1)
        levels.append(np.maximum(below[:-half], below[half:]))

    def search(begin: np.ndarray, want: np.ndarray) -> np.ndarray:
        at, rank = begin.astype(np.int64), np.searchsorted(values, want)
        for k in range(len(levels) - 1, -1, -1):
            runs = levels[k]
            at = at + 2**k * ((at < len(runs)) & (runs[np.minimum(at, len(runs) - 1)] < rank))
        return at

    return search


def in_blocks(rows: DataFrame, by: list[str], size: int = 16_384) -> DataFrame:
    """by, place, top and block of rows without a null place or top, written: they are dealt by ranges of (by, place), and a range
    is cut into blocks of at most so many of a key. Searches that ask the same rows share them."""
    dealt = rows.where("place is not null and top is not null").select(*by, "place", "top").repartitionByRange(*by, "place")
    within = F.row_number().over(Window.partitionBy(*by, "_range").orderBy("place", "top")) - 1
    dealt = cut(dealt.withColumn("_range", F.spark_partition_id()))
    return dealt.withColumn("block", F.col("_range") * F.lit(2**32) + F.floor(within / size)).drop("_range")


def first_reached(asked: DataFrame, rows: DataFrame, by: list[str], share: int = 1_000_000, size: int = 16_384) -> DataFrame:
    """asked (by, x, y and others) with found: the place of the first of rows (by, place, top) in order of place with place >= x
    and top >= y; null if there is none, or x or y is null. Equal rows of asked are one. All are strings without NUL, compared by bytes.

    rows are in blocks, or made so (in_blocks); a question goes to the first block that may hold its answer and, where x is
    inside that one, to the next. A block's rows are held by the task that answers its questions, which pass in Arrow
    batches; a block that is asked more than share questions is copied, one copy for so many of them. asked is read twice, first to
    count these."""
    numbered = rows if "block" in rows.columns else in_blocks(rows, by, size)
    blocks = numbered.groupBy(*by, "block").agg(F.min("place").alias("low"), F.max("place").alias("high"), F.max("top").alias("top"))
    blocks = blocks.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("block", "low", "high", "top"))).alias("_blocks"))
    may = F.filter("_blocks", lambda b: (b["high"] >= F.col("x")) & (b["top"] >= F.col("y")))
    where = F.transform(F.when(F.get(may, 0)["low"] < F.col("x"), F.slice(may, 1, 2)).otherwise(F.slice(may, 1, 1)), lambda b: b["block"])
    names, other = asked.columns, [c for c in asked.columns if c not in (*by, "x", "y")]
    at = asked.join(blocks, by, "left").withColumn("block", F.explode_outer(where)).drop("_blocks")
    hot = at.where("block is not null").groupBy(*by, "block").agg(F.ceil(F.count(F.lit(1)) / share).alias("_copies")).where("_copies > 1")
    copies = F.when(F.col("block").isNull(), 1024).otherwise(F.coalesce("_copies", F.lit(1)))  # without a block a question meets no rows
    salt = F.pmod(F.xxhash64(*names), copies).cast("int")
    q = at.join(hot, [*by, "block"], "left").select(*by, "block", salt.alias("salt"), F.lit(1).alias("kind"), F.col("x").alias("place"), F.col("y").alias("top"), *other)
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)).cast("int") - 1))
    r = numbered.join(hot, [*by, "block"], "left").select(*by, "block", each.alias("salt"), F.lit(0).alias("kind"), "place", "top", *(F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in other))
    both = r.unionByName(q).repartition(*by, "block", "salt").sortWithinPartitions(*by, "block", "salt", "kind", "place")
    n = len(by)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, places, tops, held = None, [], [], None
        for batch in batches:
            heads = [batch.column(k) for k in range(n + 2)]
            codes = np.stack([c.dictionary_encode().indices.fill_null(-1).to_numpy() for c in heads])
            edges = np.flatnonzero(np.append(True, (codes[:, 1:] != codes[:, :-1]).any(0))) if batch.num_rows else []
            kinds = batch.column(n + 2).to_numpy()
            place, top = (batch.column(n + 3 + k).cast(pa.binary()) for k in range(2))
            out, at = [], np.flatnonzero(kinds)
            for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True):
                if (head := tuple(c[int(a)].as_py() for c in heads)) != group:
                    group, places, tops, held = head, [], [], None
                first = int(a + np.searchsorted(kinds[a:b], 1))  # a group's rows come before its questions
                if first > a:
                    places += place.slice(a, first - a).to_pylist()
                    tops += top.slice(a, first - a).to_pylist()
                    held = None
                if head[n] is None:  # no block holds an answer
                    out += [None] * (b - first)
                elif first < b:
                    held = held or (np.array(places), _reach(np.array(tops)))
                    begin = np.searchsorted(held[0], np.array(place.slice(first, b - first).to_pylist()))
                    found = held[1](begin, np.array(top.slice(first, b - first).to_pylist()))
                    out += [places[k] if k < len(places) else None for k in found]
            kept = [*range(n), *range(n + 3, batch.num_columns)]
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in kept), pa.array(out, pa.binary()).cast(pa.string())], names=[*by, "x", "y", *other, "found"])

    kinds = ", ".join(f"`{c}` {asked.schema[c].dataType.simpleString()}" for c in (*by, "x", "y", *other))
    answered = both.mapInArrow(answer, f"{kinds}, found string")
    return answered.groupBy(*names).agg(F.min("found").alias("found"))
