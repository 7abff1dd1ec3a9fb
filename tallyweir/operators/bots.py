"""Bots as tables: enrich (read, batch, process, write) and offload (read, map, batch, deliver), each with the
checkpoint that it leaves."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import batching, process, stats


class Worked(NamedTuple):
    """What a bot made of its events: the rows that it wrote or delivered, and where it stands afterwards."""

    output: DataFrame
    checkpoints: DataFrame
    #: What both are taken from, and how: who writes rows first has the source read once, and both from the same rows.
    rows: DataFrame | None = None
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None

    @staticmethod
    def of(rows: DataFrame, split: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> "Worked":
        return Worked(*split(rows), rows, split)


def _read(events: DataFrame, batch: int | None) -> DataFrame:
    """Events as they are, or as batches of so many consecutive ones of a queue (a column events holds them)."""
    if batch is None:
        return events.withColumn("end", F.lit(None).cast("string"))
    return batching.merge_batches(batching.number_batches(events, batch)).drop("start").withColumn("end", F.lit(None).cast("string"))


def enrich(events: DataFrame, bot: str, out_queue: str, transform: Callable[[DataFrame], tuple[Column, Column]], batch: int | None = None) -> Worked:
    """Events (queue, eid, bot, payload, timestamp, event_source_timestamp, units), or batches of them, processed into out_queue.
    transform(rows) gives the action and the payload of each row. A batch's correlation starts at its last eid."""
    rows = _read(events, batch)
    action, payload = transform(rows)
    made = process.process(rows, action, payload, bot, out_queue, keep=("timestamp", "end"))
    return Worked.of(made, lambda m: (m.where(F.col("action") == process.EMIT).drop("action", "eid", "timestamp", "end"), stats.checkpoint_from_correlations(m)))


def warehouse_run(events: DataFrame, bot: str, suffix: str, transform: Callable[[DataFrame], tuple[Column, Column]], batch: int | None = None) -> Worked:
    """Events processed into the warehouse's queue, dw.load and the suffix: read, process, write, checkpoint."""
    return enrich(events, bot, f"dw.load{suffix}", transform, batch)


def offload(events: DataFrame, bot: str, transform: Callable[[DataFrame], Column], batch: int = 1) -> Worked:
    """What an outside system gets of events: the payloads that transform(rows) gives (null drops the event), in JSON
    arrays of so many consecutive ones of a queue, or by themselves where batch is 1. What is dropped isn't batched and moves
    no checkpoint."""
    mapped = events.withColumn("payload", transform(events)).where("payload is not null")
    if batch == 1:
        rows = mapped.select("queue", "eid", F.col("payload").alias("delivery"), "units", "timestamp", "event_source_timestamp", F.lit(1).cast("long").alias("n"))
    else:
        b = batching.merge_batches(batching.number_batches(mapped, batch))
        body = F.concat(F.lit("["), F.array_join(F.transform("events", lambda e: e["payload"]), ","), F.lit("]"))
        rows = b.select("queue", "eid", body.alias("delivery"), "units", "timestamp", "event_source_timestamp", "n")
    return Worked.of(rows, lambda r: (r.select(F.lit(bot).alias("id"), "queue", "eid", "delivery", F.col("n").alias("records"), "event_source_timestamp"), stats.checkpoint_from_correlations(_seen(r, bot))))


def _seen(events: DataFrame, bot: str) -> DataFrame:
    return events.select(F.lit(bot).alias("id"), F.col("queue").alias("source"), F.col("eid").alias("start"), F.lit(None).cast("string").alias("end"), "units", "timestamp", "event_source_timestamp")


def load_entities(events: DataFrame, bot: str, out_queue: str, ids: Callable[[DataFrame], DataFrame], assemble: Callable[[DataFrame], DataFrame]) -> Worked:
    """Change events to entities: ids(events) gives the distinct root ids that they touch, assemble(ids) the entities as
    (id, payload); each becomes an event of out_queue, and the bot's checkpoint passes all events that were asked. On a stream a
    micro-batch is what is gathered before a load."""
    load = lambda e: assemble(ids(e)).select(F.lit(bot).alias("id"), F.lit(out_queue).alias("event"), F.col("id").cast("string").alias("entity"), "payload")
    return Worked.of(events, lambda e: (load(e), stats.checkpoint_from_correlations(_seen(e, bot))))


def latest(checkpoints: DataFrame) -> DataFrame:
    """Where each (bot, queue) stands after its checkpoints of several batches: the furthest position (one that is null
    moves nothing), all records, the oldest source time and the newest end."""
    return checkpoints.groupBy("bot", "queue").agg(
        F.max("checkpoint").alias("checkpoint"), F.sum("records").cast("long").alias("records"), F.min("source_timestamp").alias("source_timestamp"), F.max("ended_timestamp").alias("ended_timestamp"),
    )
