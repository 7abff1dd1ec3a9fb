"""Lookup joins, id translation, entity assembly, interval and as-of joins."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import Scratch, cut
from .points import first_reached, in_blocks, same


def lookup_join(events: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """events with joined_data: the row of dim with its key, null if there is none or the key is null. AQE picks a
    broadcast or a sorted join from the sizes it sees."""
    rows = dim.select(F.col(dim_key).alias("_k"), F.struct(*dim.columns).alias("joined_data"))
    return events.join(rows, F.col(key) == F.col("_k"), "left").drop("_k")


def key_fetch(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is listed, each once."""
    return rows.join(keys.select(key).distinct(), key, "left_semi")


def find_ids(changes: dict[str, DataFrame], mappings: dict[str, DataFrame | bool]) -> DataFrame:
    """Distinct root ids of changed rows: changes gives (id) by source; its mapping is True where the id is the root's
    already, else a table (id, root). Nulls are dropped."""
    made = []
    for name, ids in changes.items():
        how = mappings[name]
        made.append(ids.select(F.col("id").cast("long").alias("id")) if how is True else ids.join(how, "id").select(F.col("root").cast("long").alias("id")))
    return reduce(DataFrame.unionByName, made).where("id is not null").distinct()


def build_entities(roots: DataFrame, key: str, one: dict[str, tuple[DataFrame, str, Column]] | None = None, many: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """Root rows with nested children. one: name -> (table, its key, order; the last wins), a struct, whose fields are null if there is none; many:
    name -> (table, its key), a list, empty if there are none. Children are grouped before they are joined."""
    out = roots
    for name, (rows, fk, order) in (one or {}).items():
        child = rows.groupBy(F.col(fk).alias("_k")).agg(F.max_by(F.struct(*rows.columns), order).alias(name))
        empty = F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields))
        out = out.join(child, F.col(key) == F.col("_k"), "left").drop("_k").withColumn(name, F.coalesce(name, empty))
    for name, (rows, fk) in (many or {}).items():
        child = rows.groupBy(F.col(fk).alias("_k")).agg(F.sort_array(F.collect_list(F.struct(*rows.columns))).alias(name))
        out = out.join(child, F.col(key) == F.col("_k"), "left").drop("_k").withColumn(name, F.coalesce(name, F.array()))
    return out


def parent_join(events: DataFrame) -> DataFrame:
    """Each event with a parent: its eid, queue and lag, and the parent's timestamp."""
    parent = events.select(F.col("queue").alias("source"), F.col("eid").alias("start"), F.col("timestamp").alias("parent_timestamp"))
    return events.where("start is not null").join(parent, ["source", "start"]).select("queue", "eid", "source", "start", "parent_timestamp", (F.col("timestamp") - F.col("parent_timestamp")).alias("lag"))


def correlation_search(points: DataFrame, spans: DataFrame) -> DataFrame:
    """source, x, start, end, found: which spans (source, start, end, eid) hold each point (source, x): start <= x <= end,
    or start = x where there is no end. Null positions match nothing.

    Points and spans are dealt by ranges of (source, position) and swept in order in each; a span that is open where a range
    begins is given to that range too. So a source, or an hour of it, with most of the points is many tasks; a task holds the
    spans that are open where it stands, and time grows with rows and matches, not with their product."""
    scratch = Scratch(points.sparkSession)
    none = F.lit(None).cast("string")
    s = spans.where("start is not null").select("source", F.col("start").alias("at"), F.lit(0).alias("kind"), "start", "end", F.col("eid").alias("found"))
    p = points.where("x is not null").select("source", F.col("x").alias("at"), F.lit(1).alias("kind"), none.alias("start"), none.alias("end"), none.alias("found"))
    both = s.unionByName(p).withColumn("tie", F.monotonically_increasing_id())
    dealt = scratch.cut(both.repartitionByRange("source", "at", "kind", "tie").withColumn("range", F.spark_partition_id()))
    lows = dealt.groupBy("source", "range").agg(F.min("at").alias("low")).groupBy("source").agg(F.collect_list(F.struct("range", "low")).alias("ranges"))
    to = F.greatest(F.coalesce("end", "start"), F.col("start"))
    longer = same(dealt.where("kind = 0"), lows, ["source"])
    longer = longer.withColumn("next", F.explode(F.filter("ranges", lambda r: (r["range"] > F.col("range")) & (r["low"] <= to))))
    carried = longer.select("source", F.col("next.low").alias("at"), "kind", "start", "end", "found", F.col("next.range").alias("range"))
    every = dealt.drop("tie").unionByName(carried).select("source", "range", "at", "kind", "start", "end", "found")
    swept = every.repartition("source", "range").sortWithinPartitions("source", "range", "at", "kind")
    out = cut(swept.mapInArrow(_sweep, "source string, x string, start string, end string, found string"))
    scratch.clear()
    return out


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, opened = None, []
    for batch in batches:
        out = []
        for source, part, at, kind, start, end, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (source, part) != key:
                key, opened = (source, part), []
            if kind == 0:
                opened.append((start, end, found))
                continue
            opened = [s for s in opened if (s[1] or s[0]) >= at]
            out += [(source, at, *s) for s in opened]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["source", "x", "start", "end", "found"])


def checkpoint_blocks(stats: DataFrame) -> DataFrame:
    """Statistics (bot, queue, bucket, checkpoint) as checkpoint_asof searches them, written: for those that are asked more than once."""
    return in_blocks(stats.select("bot", "queue", F.col("bucket").alias("place"), F.col("checkpoint").alias("top")), ["bot", "queue"])


def checkpoint_asof(wanted: DataFrame, stats: DataFrame) -> DataFrame:
    """wanted (bot, queue, eid, bucket; other columns pass; equal rows are one) with found: the first stats bucket (bot,
    queue, bucket, checkpoint; or its checkpoint_blocks) at or after bucket whose checkpoint has reached eid; null if there is none,
    or eid or bucket is null.

    Every question goes to the part of its bot's statistics that may answer it, however often checkpoints were forced back."""
    rows = stats if "block" in stats.columns else checkpoint_blocks(stats)
    asked = wanted.withColumnsRenamed({"bucket": "x", "eid": "y"})
    return first_reached(asked, rows, ["bot", "queue"]).withColumnsRenamed({"x": "bucket", "y": "eid"})
