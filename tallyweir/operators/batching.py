"""Micro-batches of events: by count, bytes or time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.eid import eid_millis
from ..sources.shared import Scratch, cut
from .points import BLOCK, chain, next_point, prefix_sums, same
from .read import prefix_sum


def number_batches(events: DataFrame, count: int, keys: list[str] = ("queue",)) -> DataFrame:
    """events with batch: 0 for the first count of a key in eid order, and so on."""
    return prefix_sum(events.withColumn("_one", F.lit(1).cast("long")), list(keys), "_one", "_n").withColumn("batch", F.floor(F.col("_n") / count).cast("long")).drop("_n", "_one")


def merge_batches(numbered: DataFrame, keys: list[str] = ("queue",)) -> DataFrame:
    """One event per batch: the list of its events in order, the first's bot and source time, the last's eid and
    timestamp, units, and the correlation from first to last (end only for more than one event)."""
    first = lambda c: F.min_by(c, "eid").alias(c)
    out = numbered.groupBy(*keys, "batch").agg(
        F.sort_array(F.collect_list(F.struct("eid", "bot", "payload", "timestamp"))).alias("events"), first("bot"), first("event_source_timestamp"), F.max_by("timestamp", "eid").alias("timestamp"),
        F.min("eid").alias("start"), F.max("eid").alias("eid"), F.sum(F.coalesce("units", F.lit(1))).cast("long").alias("units"), F.count(F.lit(1)).alias("n"),
    )
    return out.withColumn("end", F.when(F.col("n") > 1, F.col("eid")))


def correlation(events: DataFrame, keys: list[str] = (), partial: Column | bool = False) -> DataFrame:
    """keys, source, start, end, partial_start, partial_end and units of each group of events (queue, eid, units): from its
    first event to its last (no end for a single one); units count 1 where they are null. A partial group has the
    partial names instead, and moves no checkpoint. Without keys all events are one group, and none at all is an error."""
    if not keys and events.isEmpty():
        raise ValueError("a correlation needs an event")
    rows = events.groupBy(*keys).agg(F.min_by("queue", "eid").alias("source"), F.min("eid").alias("_a"), F.max("eid").alias("_b"), F.count(F.lit(1)).alias("_n"), F.sum(F.coalesce("units", F.lit(1))).cast("long").alias("units"))
    is_partial = F.lit(partial) if isinstance(partial, bool) else partial
    end = F.when(F.col("_n") > 1, F.col("_b"))
    named = [F.when(~is_partial, F.col("_a")).alias("start"), F.when(~is_partial, end).alias("end"), F.when(is_partial, F.col("_a")).alias("partial_start"), F.when(is_partial, end).alias("partial_end")]
    return rows.select(*keys, "source", *named, "units")


def limit_batches(events: DataFrame, keys: list[str] = ("queue",), count: int | None = None, size: int | None = None, millis: int | None = None) -> DataFrame:
    """keys, eid and batch of events (eid, size): a batch closes once it has count events or size bytes (the crossing event is
    in), or before an event whose id is millis or more after its first one's; the first limit reached wins.

    A batch depends on all before it, but where a batch that began at some event would end depends on that event alone: it is
    the next point in the running sums. These are found for all events at once, and the batches that are real are those
    that the chain from a key's first event passes. So a queue is many tasks, and its batches go on over its days. Null keys are a
    group; a null size is 0; an id without a time is in no time limit; equal ids stand by size."""
    keys = list(keys)
    if not (count or size or millis):
        raise ValueError("a batch needs a limit")
    scratch = Scratch(events.sparkSession)
    rows = events.select(*keys, "eid", F.coalesce("size", F.lit(0)).cast("long").alias("_size"), F.lit(1).cast("long").alias("_one"))
    rows = prefix_sums(rows, keys, {"_one": "i", "_size": "_bytes"}, ["eid"], F.left("eid", F.lit(15))).drop("_one", "_size").withColumn("_ms", eid_millis(F.col("eid")))
    rows = scratch.cut(rows.withColumn("next", F.col("i") + count if count else F.lit(None).cast("long")))
    asked = rows
    for limit, place in ((size, "_bytes"), (millis, "_ms")):
        if limit:
            asked = next_point(asked, F.col(place) + limit, rows, keys, F.col(place), F.col("i"), "_next", scratch, F.col("i"))
            asked = asked.withColumn("next", F.least("next", "_next")).drop("_next")
    starts = chain(asked, keys, scratch).withColumn("_start", F.lit(1).cast("long"))
    rows = same(rows, starts, [*keys, "i"], "left").withColumn("_start", F.coalesce("_start", F.lit(0).cast("long")))
    numbered = prefix_sums(rows, keys, {"_start": "_before"}, ["i"], F.floor(F.col("i") / BLOCK))
    out = cut(numbered.select(*keys, "eid", (F.col("_before") + F.col("_start") - 1).cast("long").alias("batch")))
    scratch.clear()
    return out


def external(rows: DataFrame, fetch, column: str, result: str = "string", retries: int = 3, pause: float = 0.0) -> DataFrame:
    """rows with column from fetch(list of dicts) -> list of values, called once per Arrow batch with up to retries
    further tries (pause * 2 ** n seconds between them); order is kept."""
    import time

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n in range(retries + 1):
                try:
                    yield batch.assign(**{column: fetch(batch.to_dict("records"))})
                    break
                except Exception:
                    if n == retries:
                        raise
                    time.sleep(pause * 2**n)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), f"`{column}` {result}"])
    return rows.mapInPandas(call, schema)
