"""A bot's work dealt to instances by the hash of a key, under one upper bound, with one checkpoint in the end."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import clamp, partition_of
from ..sources.shared import cut
from . import stats
from .bots import Worked
from .points import same


def frozen(events: DataFrame) -> DataFrame:
    """queue and upto: the last id that each queue has now, written, so that every instance reads to the same one."""
    return cut(events.groupBy("queue").agg(F.max("eid").alias("upto")))


def fan_out_run(events: DataFrame, bot: str, n: int, handler: Callable[[pa.RecordBatch], pa.Array], kind: str = "string", key: str = "eid", bounds: DataFrame | None = None) -> Worked:
    """Events (queue, eid, units, timestamp, event_source_timestamp, ...) up to bounds (by default, what there is now) handled
    by n instances (1 to 20): each gets the events whose key falls to it, in order of (queue, eid), in Arrow batches, and gives a value
    of kind (a type) for each, null for none. Output: part, queue, eid and result. Checkpoints: an instance stands in a
    queue after the last event that it has handled, and the bot where the one that is least far stands; an instance
    without events says nothing. If one fails all fail, and nothing is written."""
    n = clamp(n)
    part = partition_of(F.col(key), n)
    rows = same(events.withColumn("part", part), frozen(events) if bounds is None else bounds, ["queue"]).where("eid <= upto").drop("upto")
    names, fields = rows.columns, rows.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = handler(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*names, "result"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"result {kind}"])
    done = cut(rows.repartitionById(n, "part").sortWithinPartitions("part", "queue", "eid").mapInArrow(work, schema))

    def split(d: DataFrame) -> tuple[DataFrame, DataFrame]:
        at = d.groupBy(F.col("part").alias("worker"), F.lit(bot).alias("bot"), "queue").agg(F.max("eid").alias("checkpoint"), F.count(F.lit(1)).alias("records"))
        read = stats.reduce_checkpoints(at.withColumns({"direction": F.lit("read"), "error": F.lit(None).cast("string")}))
        return d.where("result is not null").select("part", "queue", "eid", "result"), read

    return Worked.of(done, split)
