"""Lineage: the bot-queue graph, and tracing events up and down through it."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.eid import eid_millis, utc_millis
from ..functions.refs import ref_id
from ..sources.shared import Scratch, cut
from .joins import checkpoint_asof, checkpoint_blocks
from .points import next_point, same
from .stats import bucket_label


def lineage_edges(bots: DataFrame) -> DataFrame:
    """Distinct (source, target, direction) of bots (id, read map, write map): queue to bot for reads, bot to queue for
    writes, with normalised references."""
    me = ref_id(F.col("id"), "bot")
    one = lambda c: bots.where(F.col(c).isNotNull()).select(me.alias("bot"), F.explode(F.map_keys(c)).alias("queue"))
    read = one("read").select(ref_id(F.col("queue")).alias("source"), F.col("bot").alias("target"), F.lit("read").alias("direction"))
    write = one("write").select(F.col("bot").alias("source"), ref_id(F.col("queue")).alias("target"), F.lit("write").alias("direction"))
    return read.unionByName(write).distinct()


def trace_upstream(roots: DataFrame, events: DataFrame, hops: int | None = None) -> DataFrame:
    """root, hop, queue, eid, bot and lag of each event from a root (queue, eid) up through its parents. A trace ends at
    an event without a parent, a parent that isn't there, or a bot that it has met; where hops are given
    and events are left after that many, it raises. All roots go up one hop at a time, by one join; each hop is written, so a lost executor costs one hop."""
    known = cut(events.select("queue", "eid", "bot", "source", "start", (F.col("timestamp") - F.col("event_source_timestamp")).alias("lag")))
    now = roots.select(F.col("eid").alias("root"), "queue", "eid").join(known, ["queue", "eid"])
    now = now.select("root", F.lit(0).alias("hop"), "queue", "eid", "bot", "lag", "source", "start", F.array("bot").alias("seen"))
    out = None
    for k in count(1):
        now = cut(now)
        if hops is not None and k > hops and not now.isEmpty():
            raise ValueError(f"a trace is longer than {hops} hops")
        part = now.select("root", "hop", "queue", "eid", "bot", "lag")
        out = part if out is None else out.unionByName(part)
        up = now.where("start is not null").select("root", "seen", F.col("source").alias("queue"), F.col("start").alias("eid"))
        if up.isEmpty():
            break
        now = up.join(known, ["queue", "eid"]).where(~F.array_contains("seen", F.col("bot")))
        now = now.select("root", F.lit(k).alias("hop"), "queue", "eid", "bot", "lag", "source", "start", F.array_append("seen", F.col("bot")).alias("seen"))
    return out


def trace_downstream(roots: DataFrame, reads: DataFrame, writes: DataFrame, hops: int | None = None) -> DataFrame:
    """root, depth, queue, bot, has_processed and lag of the bots downstream of each root (root, queue, eid,
    event_source_timestamp). reads: (bot, queue, checkpoint, source_timestamp); writes: (bot, queue). A bot has processed
    an event that its checkpoint is past; its lag is 0 then, else the time it is behind. Only processed bots are passed,
    and each queue is visited once for a root. Where hops are given and queues are left after that many, it raises.

    What a trace meets depends on the root's queue and on which checkpoints are past it, so roots between the same two
    checkpoints are one class: classes walk the graph, and roots are joined with what theirs has met."""
    scratch = Scratch(roots.sparkSession)
    marks = reads.where("checkpoint is not null").select("checkpoint").distinct()
    past = F.concat("eid", F.lit("\0"))  # a checkpoint at or after this is past the event
    rows = scratch.cut(next_point(roots.select("root", "eid", "event_source_timestamp", "queue"), past, marks, [], F.col("checkpoint"), F.col("checkpoint"), "mark", scratch))
    bots = cut(reads.select("bot", "queue", "checkpoint", "source_timestamp"))
    now = cut(rows.select(F.col("queue").alias("origin"), "mark", "queue").distinct())
    seen, walked = now, None
    for depth in count():
        if hops is not None and depth >= hops:
            raise ValueError(f"a trace is longer than {hops} hops")
        at = cut(now.join(bots, "queue").withColumn("has_processed", F.coalesce(F.col("checkpoint") >= F.col("mark"), F.lit(False))))
        part = at.select("origin", "mark", F.lit(depth).alias("depth"), "queue", "bot", "has_processed", "source_timestamp")
        walked = part if walked is None else walked.unionByName(part)
        down = at.where("has_processed").select("origin", "mark", "bot").join(writes.select("bot", "queue"), "bot").select("origin", "mark", "queue").distinct()
        now = cut(same(down, seen.withColumn("_s", F.lit(1)), ["origin", "mark", "queue"], "left").where("_s is null").drop("_s"))
        if now.isEmpty():
            break
        seen = seen.unionByName(now)
    starts = rows.select("root", "event_source_timestamp", F.col("queue").alias("origin"), "mark")
    out = same(starts, walked, ["origin", "mark"])
    lag = F.when(F.col("has_processed"), F.lit(0).cast("long")).otherwise(F.col("source_timestamp") - F.col("event_source_timestamp"))
    return out.select("root", "depth", "queue", "bot", "has_processed", lag.alias("lag"))


def _asof_time(asked: DataFrame, stats: dict[str, DataFrame], scratch: Scratch) -> DataFrame:
    """asked (bot, queue, eid, timestamp, ...) with begin: when the bot had read past eid, by the first hour from timestamp's
    on, and the first minute from that hour on, whose checkpoint has reached it; not before timestamp. Null if never."""
    hour = scratch.cut(checkpoint_asof(asked.withColumn("bucket", bucket_label(F.col("timestamp"), "hour")), stats["hour"]).where("found is not null"))
    minute = checkpoint_asof(hour.withColumn("bucket", F.concat(F.lit("minute_"), F.substr("found", F.lit(6)), F.lit(":00"))).drop("found"), stats["minute_1"]).where("found is not null")
    at = utc_millis(F.concat(F.substr("found", F.lit(8)), F.lit(":00")).cast("timestamp_ntz"))
    return minute.withColumn("begin", F.greatest(at, F.col("timestamp"))).drop("bucket", "found")


def trace_path(roots: DataFrame, events: DataFrame, stats: dict[str, DataFrame], hops: list[tuple[str, str]]) -> DataFrame:
    """root, hop, bot, queue, eid and lag of the events that follow each root (root, queue, eid, timestamp) through hops (bot,
    queue that it writes): of the bot's events in the minute from when it had read past the event before (to the
    second), the first whose correlation holds that event's id. events: queue, eid, timestamp, event_source_timestamp,
    source, start, end; stats: hour and minute_1 tables of (bot, queue, bucket, checkpoint). A hop that finds nothing ends
    its root's path. All roots go one hop at a time, joined by queue and minute."""
    now = roots.select("root", "queue", "eid", "timestamp")
    scratch, stats = Scratch(roots.sparkSession), {grain: checkpoint_blocks(rows) for grain, rows in stats.items()}
    out = None
    for hop, (bot, queue) in enumerate(hops, 1):
        asked = _asof_time(now.withColumn("bot", F.lit(bot)), stats, scratch)
        first = asked.withColumn("begin", F.col("begin") - F.pmod("begin", F.lit(1000)))
        minute = lambda ms: F.floor(ms / 60_000)
        points = first.select("root", F.col("queue").alias("source"), F.col("eid").alias("x"), "begin", F.explode(F.array_distinct(F.array(minute(F.col("begin")), minute(F.col("begin") + 60_000)))).alias("_m"))
        made = events.where(F.col("queue") == queue).withColumn("at", eid_millis(F.col("eid"))).withColumn("_m", minute(F.col("at")))
        holds = (F.col("start") == F.col("x")) | ((F.col("start") <= F.col("x")) & (F.col("x") <= F.col("end")))
        found = points.join(made, ["source", "_m"]).where(holds & F.col("at").between(F.col("begin"), F.col("begin") + 60_000))
        found = found.groupBy("root").agg(F.min(F.struct("eid", "timestamp", "event_source_timestamp")).alias("e"))
        now = cut(found.select("root", F.lit(queue).alias("queue"), "e.eid", "e.timestamp", (F.col("e.timestamp") - F.col("e.event_source_timestamp")).alias("lag")))
        scratch.clear()
        part = now.select("root", F.lit(hop).alias("hop"), F.lit(bot).alias("bot"), "queue", "eid", "lag")
        out = part if out is None else out.unionByName(part)
    return out
