"""Ordered range reads of an event queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.eid import after, day_bounds, eid_millis
from ..sources.shared import cut
from .points import prefix_sums


def read_range(events: DataFrame, queue: str | list[str], start: str | None = None, end: str | None = None) -> DataFrame:
    """A queue's events (or several queues') with start < eid <= end (strictly after start, counting its record number)."""
    out = events.where(F.col("queue") == queue if isinstance(queue, str) else F.col("queue").isin(queue))
    if start:
        out = out.where(F.col("eid") > after(start))
    if end:
        out = out.where(F.col("eid") <= end)
    for bound in day_bounds(start, end) if "dt" in events.columns else []:
        out = out.where(bound)
    return out


def read_from_checkpoint(events: DataFrame, readers: DataFrame, checkpoints: DataFrame, queues: DataFrame, default_start: str) -> DataFrame:
    """Every event that each reader (bot, queue, start) has yet to read: after its explicit start, else its checkpoint,
    else default_start, up to the queue's max_eid. Adds reader. Readers with nothing to read are left out first, so a table stored by
    queue and day is read only in the queues of the others, and from the first day that one of them needs."""
    at = readers.join(checkpoints.select("bot", "queue", "checkpoint"), ["bot", "queue"], "left").join(queues, "queue")
    at = at.select(F.col("bot").alias("reader"), "queue", after(F.coalesce("start", "checkpoint", F.lit(default_start))).alias("_from"), "max_eid")
    at = cut(at).where("_from < max_eid")  # a written table, so that its rows can prune folders at run time
    if "dt" in events.columns:
        at = at.withColumn("_day", F.to_date(F.timestamp_millis(eid_millis(F.trim("_from")))))
        return events.join(at, (events["queue"] == at["queue"]) & (F.col("eid") > F.col("_from")) & (F.col("eid") <= F.col("max_eid")) & (F.col("_day").isNull() | (F.col("dt") >= F.col("_day")))).drop(at["queue"]).drop("_from", "max_eid", "_day")
    return events.join(at, "queue").where("eid > _from and eid <= max_eid").drop("_from", "max_eid")


def prefix_sum(events: DataFrame, keys: list[str], value: str, name: str = "before") -> DataFrame:
    """events with the sum of value over the rows of the same keys with a smaller eid, in two phases: sums by hour give
    each hour its offset, and only rows of one hour are ordered together (equal eids by value)."""
    return prefix_sums(events, keys, {value: name}, ["eid"], F.left("eid", F.lit(15)))


def read_limit(events: DataFrame, queue: str, limit: int, start: str | None = None) -> DataFrame:
    return read_range(events, queue, start).orderBy("eid").limit(limit)


def read_byte_budget(events: DataFrame, queue: str, size: int) -> DataFrame:
    """Events in order while the sizes before them sum to less than size: the one that crosses is in. Sums by hour tell
    the hour in which size is reached; nothing after it is read, and only its rows are ordered."""
    rows = read_range(events, queue)
    hour = F.left("eid", F.lit(15))
    upto = Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.groupBy(hour.alias("hour")).agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s"))  # a row for each hour
    crossed = sums.withColumn("upto", F.sum("s").over(upto)).where(F.col("upto") >= size).orderBy("hour").first()
    if crossed is None:
        return rows
    last = prefix_sum(rows.where(hour == crossed.hour), [], "size").where(F.col("before") < size - (crossed.upto - crossed.s)).drop("before")
    return rows.where(hour < crossed.hour).unionByName(last)


def first_then(first: DataFrame, live: DataFrame, until: str) -> DataFrame:
    """A snapshot or archive up to until, and the live queue after it."""
    return first.where(F.col("eid") <= until).unionByName(live.where(F.col("eid") > until))


def read_registered(events: DataFrame, queue: str, start: str, registered: dict[str, str | None]) -> DataFrame:
    """A queue read from start, by what its registry row says: from "z/" exactly and with a snapshot, the events of
    <queue>/_snapshot and then the live ones after snapshot_next; where archive_end is past start, those of
    <queue>/_archive up to it and then the live ones; else the live ones. All are queues of events, so each part
    reads only its own range."""
    part = lambda name, a, b=None: read_range(events, name, a, b).withColumn("queue", F.lit(queue))
    if start.strip() == "z/" and registered.get("snapshot_next"):
        return part(f"{queue}/_snapshot", None).unionByName(part(queue, registered["snapshot_next"]))
    if (end := registered.get("archive_end")) and end > start:
        return part(f"{queue}/_archive", start, end).unionByName(part(queue, end))
    return part(queue, start)


def table_scan(rows: DataFrame, key: str, low, high, count: int | None = None) -> DataFrame:
    """Rows with low <= key <= high, in key order; at most count of them."""
    out = rows.where(F.col(key).between(low, high)).orderBy(key)
    return out.limit(count) if count else out
