"""Checkpoint, stream and chunk statistics, and time rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.eid import utc_time
from ..sources.shared import cut


def checkpoint_from_correlations(processed: DataFrame) -> DataFrame:
    """bot, queue, checkpoint, records and times of each (id, source): where the bot has read to. Partial rows count and
    don't advance."""
    units = F.coalesce("units", F.lit(1))
    return processed.groupBy(F.col("id").alias("bot"), F.col("source").alias("queue")).agg(
        F.max(F.coalesce("end", "start")).alias("checkpoint"), F.sum(units).cast("long").alias("records"), F.min("event_source_timestamp").alias("source_timestamp"), F.max("timestamp").alias("ended_timestamp"),
    )


def stream_stats(events: DataFrame, *by: str) -> DataFrame:
    """Per group: last and first eid, units, oldest source time, started and ended (both the newest time), and the
    oldest time as first_timestamp."""
    return events.groupBy(*by).agg(
        F.max("eid").alias("eid"), F.min("eid").alias("start_eid"), F.sum(F.coalesce("units", F.lit(1))).cast("long").alias("units"), F.min("event_source_timestamp").alias("source_timestamp"),
        F.max("timestamp").alias("started_timestamp"), F.max("timestamp").alias("ended_timestamp"), F.min("timestamp").alias("first_timestamp"),
    )


def chunk_stats(events: DataFrame, chunk: list[str]) -> DataFrame:
    """Per chunk and bot: units, newest source time and time, last checkpoint, and units by source queue."""
    part = events.groupBy(*chunk, "bot", "source").agg(F.sum("units").cast("long").alias("u"), F.max("event_source_timestamp").alias("s"), F.max("timestamp").alias("t"), F.max("start").alias("c"))
    return part.groupBy(*chunk, "bot").agg(
        F.sum("u").cast("long").alias("units"), F.max("s").alias("source_timestamp"), F.max("t").alias("timestamp"), F.max("c").alias("checkpoint"),
        F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("source").isNotNull(), F.struct("source", "u"))))).alias("by_source"),
    )


def chunk_correlations(events: DataFrame, chunk: list[str]) -> DataFrame:
    """Per chunk and source queue: first start and last one, records, and the newest times."""
    return events.where("source is not null").groupBy(*chunk, "source").agg(
        F.min_by("start", "eid").alias("start"), F.max_by("start", "eid").alias("end"), F.sum(F.coalesce("units", F.lit(1))).cast("long").alias("records"),
        F.max("event_source_timestamp").alias("source_timestamp"), F.max("timestamp").alias("timestamp"),
    )


#: Of each grain its label's prefix, how much of yyyy-MM-dd HH:mm follows, and its length in minutes.
GRAINS = {"minute_1": ("minute_", 16, 1), "minute_5": ("minute_5_", 16, 5), "minute_15": ("minute_15_", 16, 15), "hour": ("hour_", 13, 60), "day": ("day_", 10, 1440), "week": ("week_", 10, 10_080)}
#: Minutes from the last Sunday before 1970 to its start: weeks start on Sunday.
_SUNDAY = 4 * 1440


def bucket_start(ms: Column, grain: str) -> Column:
    """Start (epoch ms) of the UTC bucket that an epoch-ms time is in."""
    step, shift = 60_000 * GRAINS[grain][2], 60_000 * _SUNDAY if grain == "week" else 0
    return ms - F.pmod(ms + shift, F.lit(step))


def bucket_label(ms: Column, grain: str) -> Column:
    prefix, length, _ = GRAINS[grain]
    return F.concat(F.lit(prefix), F.left(utc_time(bucket_start(ms, grain)).cast("string"), F.lit(length)))


def bucket_rollup(events: DataFrame, by: list[str], grains: list[str] = tuple(GRAINS)) -> DataFrame:
    """Per group and bucket of every grain: events, units and bytes. Events are summed by minute first; the coarser
    grains are made of those sums."""
    minute = events.groupBy(*by, (F.col("timestamp") - F.pmod("timestamp", F.lit(60_000))).alias("_m")).agg(F.count(F.lit(1)).alias("n"), F.sum("units").alias("u"), F.sum("size").alias("s"))
    labels = F.array(*(F.struct(F.lit(g).alias("grain"), bucket_label(F.col("_m"), g).alias("bucket")) for g in grains))
    return minute.withColumn("_b", F.explode(labels)).groupBy(*by, "_b.grain", "_b.bucket").agg(F.sum("n").cast("long").alias("n"), F.sum("u").cast("long").alias("units"), F.sum("s").cast("long").alias("bytes"))


def rolling_hour(events: DataFrame, by: list[str]) -> DataFrame:
    """Per group and quarter-hour bucket with events: events in it, and in the hour that ends with it."""
    quarter = events.groupBy(*by, (F.col("timestamp") - F.pmod("timestamp", F.lit(900_000))).alias("quarter")).agg(F.count(F.lit(1)).alias("n"))
    hour = Window.partitionBy(*by).orderBy("quarter").rangeBetween(-2_700_000, 0)
    return quarter.withColumn("hour_n", F.sum("n").over(hour))


#: Of each range the grain that it is summed from, and how many of them it holds.
RANGES = {"minute_5": ("minute_1", 5), "minute_15": ("minute_1", 15), "hour": ("minute_15", 4), "hour_6": ("hour", 6), "day": ("hour", 24), "week": ("hour", 168)}


def range_counts(events: DataFrame, by: list[str], ranges: list[str] = tuple(RANGES)) -> DataFrame:
    """Per group, range and grain bucket with events: bucket (epoch ms), events in it, and in the range that ends with it.
    Events are summed by minute first; what is put in order is a row for each bucket."""
    minute = cut(events.groupBy(*by, bucket_start(F.col("timestamp"), "minute_1").alias("_m")).agg(F.count(F.lit(1)).alias("n")))
    out = None
    for name in ranges:
        grain, count = RANGES[name]
        length = 60_000 * GRAINS[grain][2]
        bucket = minute.groupBy(*by, bucket_start(F.col("_m"), grain).alias("bucket")).agg(F.sum("n").cast("long").alias("n"))
        span = Window.partitionBy(*by).orderBy("bucket").rangeBetween(-length * (count - 1), 0)
        one = bucket.select(*by, F.lit(name).alias("range"), "bucket", "n", F.sum("n").over(span).alias("range_n"))
        out = one if out is None else out.unionByName(one)
    return out


def throughput(events: DataFrame, by: list[str], period_ms: int) -> DataFrame:
    """Per group and period: records, bytes, records a second over the span of the period's events, last eid."""
    span = (F.max("timestamp") - F.min("timestamp")) / 1000
    return events.groupBy(*by, (F.col("timestamp") - F.pmod("timestamp", F.lit(period_ms))).alias("period")).agg(
        F.sum(F.coalesce("units", F.lit(1))).cast("long").alias("records"), F.sum("size").cast("long").alias("bytes"), F.when(span > 0, F.sum(F.coalesce("units", F.lit(1))) / span).alias("rate"), F.max("eid").alias("eid"),
    )


def reduce_checkpoints(workers: DataFrame) -> DataFrame:
    """One checkpoint of rows (worker, error, bot, direction, queue, checkpoint, records): for reads the smallest
    checkpoint's row, for writes the first worker's. An error in any worker fails the whole."""
    reads = workers.where("direction = 'read'").groupBy("bot", "queue").agg(F.min(F.struct("checkpoint", "worker", "records")).alias("m")).select("bot", F.lit("read").alias("direction"), "queue", "m.checkpoint", "m.records")
    first = workers.agg(F.min("worker").alias("_w"), F.max("error").alias("_e"))
    writes = workers.where("direction = 'write'").join(F.broadcast(first), F.col("worker") == F.col("_w")).select("bot", "direction", "queue", "checkpoint", "records")
    checked = reads.unionByName(writes).join(F.broadcast(first.select("_e")))
    ok = F.when(F.col("_e").isNull(), F.col("checkpoint")).otherwise(F.raise_error(F.concat(F.lit("a worker failed: "), F.col("_e"))))
    return checked.withColumn("checkpoint", ok).drop("_e")
