"""Keyed state: upserts, write-once fields, checkpoints and backlog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.shared import Scratch, cut
from .points import BLOCK, chain, next_point, numbered, prefix_sums, same


def keyed_upsert(target: DataFrame, batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """target with each key of batch replaced by its last row (by seq), whole."""
    fields = [c for c in target.columns if c not in keys]
    last = batch.groupBy(*keys).agg(F.max_by(F.struct(*fields), seq).alias("_n"))
    return target.withColumn("_o", F.struct(*fields)).select(*keys, "_o").join(last, keys, "full_outer").withColumn("_v", F.coalesce("_n", "_o")).select(*keys, *(f"_v.{c}" for c in fields))


def _leaves(kind: StructType, at: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of the fields of a struct that are no structs."""
    return [x for f in kind.fields for x in (_leaves(f.dataType, (*at, f.name)) if isinstance(f.dataType, StructType) else [(*at, f.name)])]


def _grown(kind: StructType, values: dict[tuple[str, ...], Column], at: tuple[str, ...] = ()) -> list[Column]:
    """The fields of a struct from the values of its leaves; a struct without any value is null."""
    out = []
    for f in kind.fields:
        path = (*at, f.name)
        if isinstance(f.dataType, StructType):
            below = [v for p, v in values.items() if p[: len(path)] == path]
            out.append(F.when(F.coalesce(*(v.isNotNull().cast("int") * F.when(v.isNotNull(), 1) for v in below)).isNotNull(), F.struct(*_grown(f.dataType, values, path))).alias(f.name))
        else:
            out.append(values[path].alias(f.name))
    return out


def newest_leaves(batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Each key's rows as one: of every field, inside structs too, the newest value that isn't null. seq goes."""
    kind = StructType([f for f in batch.schema.fields if f.name not in (*keys, seq)])
    paths = _leaves(kind)
    leaf = lambda p: F.col(".".join(f"`{x}`" for x in p))
    new = batch.groupBy(*keys).agg(*(F.max_by(leaf(p), F.when(leaf(p).isNotNull(), F.col(seq))).alias(f"_{k}") for k, p in enumerate(paths)))
    return new.select(*keys, *_grown(kind, {p: F.col(f"_{k}") for k, p in enumerate(paths)}))


def merge_upsert(target: DataFrame, batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """target merged with each key's rows in batch, field by field and inside structs at any depth: the newest value
    that isn't null wins. Lists and maps are values. Newest values are taken before the shuffle, leaf by leaf, so a hot key
    is never held as rows."""
    kind = StructType([f for f in target.schema.fields if f.name not in keys])
    paths = _leaves(kind)
    leaf = lambda p: F.col(".".join(f"`{x}`" for x in p))
    new = batch.groupBy(*keys).agg(*(F.max_by(leaf(p), F.when(leaf(p).isNotNull(), F.col(seq))).alias(f"_{k}") for k, p in enumerate(paths)))
    values = {p: F.coalesce(F.col(f"_{k}"), leaf(p)) for k, p in enumerate(paths)}
    return target.join(new, keys, "full_outer").select(*keys, *_grown(kind, values))


def dedup_latest(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The row of each key with the greatest seq; partial maxima are taken before the shuffle."""
    fields = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*fields), seq).alias("_v")).select(*keys, "_v.*")


def write_once_update(target: DataFrame, updates: DataFrame, keys: list[str], once: list[str]) -> DataFrame:
    """target with updates (one row a key) applied: fields in once keep a value they have, others take the new one."""
    fields = [c for c in target.columns if c not in keys]
    new = updates.select(*keys, *(F.col(c).alias(f"_{c}") for c in fields if c in updates.columns))
    pick = lambda c: F.col(c) if c not in updates.columns else F.coalesce(c, f"_{c}") if c in once else F.coalesce(f"_{c}", c)
    return target.join(new, keys, "full_outer").select(*keys, *(pick(c).alias(c) for c in fields))


def advance_checkpoints(stored: DataFrame, proposals: DataFrame, order: str | None = None) -> DataFrame:
    """proposals (bot, direction, queue, expected, eid, force) against stored (bot, direction, queue, checkpoint):
    status applied, or stale where a read expects another checkpoint than the stored one; writes and forced proposals
    aren't compared, and without a stored one all pass. checkpoint is what holds afterwards; a null eid keeps expected.

    With order (a column of proposals, of whose equals the smaller eid comes first) a key may have several proposals, and each
    meets what those before it have left; order passes then. Without it a key has one."""
    if order is not None:
        return _in_turn(stored, proposals, order)
    j = proposals.join(stored.select("bot", "direction", "queue", F.col("checkpoint").alias("_old")), ["bot", "direction", "queue"], "left")
    ok = F.col("_old").isNull() | F.coalesce("force", F.lit(False)) | (F.col("direction") == "write") | F.col("expected").eqNullSafe(F.col("_old"))
    return j.select("bot", "direction", "queue", F.when(ok, "applied").otherwise("stale").alias("status"), F.when(ok, F.coalesce("eid", "expected")).otherwise(F.col("_old")).alias("checkpoint"))


def _in_turn(stored: DataFrame, proposals: DataFrame, order: str) -> DataFrame:
    """Proposals in turn. The one that follows an applied one is known from its own value alone: the first after it that
    expects this value, or isn't compared. So those that are applied are the chain that begins at what is stored."""
    keys = ["bot", "direction", "queue"]
    scratch = Scratch(proposals.sparkSession)
    value = F.coalesce("eid", "expected")
    free = F.coalesce("force", F.lit(False)) | (F.col("direction") == "write")
    new = proposals.select(*keys, F.col(order).alias("_order"), "expected", "eid", value.alias("value"), F.coalesce(free, F.lit(False)).alias("free"), F.lit(1).alias("_new"))
    old = same(new.select(*keys).distinct(), stored.select(*keys, F.col("checkpoint").alias("value")), keys, "left")
    kinds = {f.name: f.dataType for f in new.schema.fields}
    old = old.select(*keys, F.lit(None).cast(kinds["_order"]).alias("_order"), F.lit(None).cast("string").alias("expected"), F.lit(None).cast("string").alias("eid"), "value", F.lit(False).alias("free"), F.lit(0).alias("_new"))
    rows = numbered(old.unionByName(new), keys, ["_new", "_order", "eid", "expected"], scratch)
    rows = scratch.cut(rows.withColumn("next", F.when(F.col("value").isNull(), F.col("i") + 1)))  # nothing is stored: all pass
    later = rows.where("_new = 1")
    asked = next_point(rows, F.col("i") + 1, later.where("free"), keys, F.col("i"), F.col("i"), "_free", scratch)
    asked = asked.withColumn("_wanted", F.coalesce("value", F.lit("")))
    expecting = later.where("expected is not null").withColumn("_wanted", F.col("expected"))
    asked = next_point(asked, F.when(F.col("value").isNotNull(), F.col("i") + 1), expecting, [*keys, "_wanted"], F.col("i"), F.col("i"), "_match", scratch)
    applied = chain(asked.withColumn("next", F.coalesce("next", F.least("_free", "_match"))), keys, scratch).withColumn("_applied", F.lit(1).cast("long"))
    rows = same(rows, applied, [*keys, "i"], "left").withColumn("_applied", F.coalesce("_applied", F.lit(0).cast("long")))
    turns = prefix_sums(rows, keys, {"_applied": "_before"}, ["i"], F.floor(F.col("i") / BLOCK)).withColumn("_turn", F.col("_before") + F.col("_applied"))
    turns = scratch.cut(turns)
    held = turns.where("_applied = 1").select(*keys, "_turn", F.col("value").alias("checkpoint"))
    out = same(turns.where("_new = 1"), held, [*keys, "_turn"], "left")
    out = cut(out.select(*keys, F.col("_order").alias(order), "eid", F.when(F.col("_applied") == 1, "applied").otherwise("stale").alias("status"), "checkpoint"))
    scratch.clear()
    return out


def bot_backlog(events: DataFrame, reads: DataFrame) -> DataFrame:
    """Per reading (bot, queue): has_more (the queue is past its checkpoint, or it has none) and the events pending."""
    latest = events.groupBy("queue").agg(F.max("eid").alias("latest"))
    at = reads.join(latest, "queue", "left").select("bot", "queue", "checkpoint", "latest")
    # each event is counted at the bots behind it; a queue's events are first summed by hour, so the join is small
    by_hour = events.groupBy("queue", F.left("eid", F.lit(15)).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    edge = events.join(reads.where("checkpoint is not null").select(F.col("bot").alias("_bot"), "queue", "checkpoint"), "queue").where((F.left("eid", F.lit(15)) == F.left("checkpoint", F.lit(15))) & (F.col("eid") > F.col("checkpoint")))
    edge = edge.groupBy(F.col("_bot").alias("bot"), "queue").agg(F.count(F.lit(1)).alias("edge"))
    whole = at.join(by_hour, "queue").where(F.col("checkpoint").isNull() | (F.col("hour") > F.left("checkpoint", F.lit(15)))).groupBy("bot", "queue").agg(F.sum("n").alias("whole"))
    out = at.join(edge, ["bot", "queue"], "left").join(whole, ["bot", "queue"], "left")
    more = F.col("checkpoint").isNull() | F.coalesce(F.col("latest") > F.col("checkpoint"), F.lit(False))
    return out.select("bot", "queue", more.alias("has_more"), (F.coalesce("edge", F.lit(0)) + F.coalesce("whole", F.lit(0))).cast("long").alias("pending"))


def io_audit(rows: DataFrame, bot: Column, system: str, direction: str) -> DataFrame:
    """One audit row per bot for rows exchanged with an outside system: records, and the queue that gets {records:n}."""
    out = rows.groupBy(bot.alias("bot")).agg(F.count(F.lit(1)).alias("records"))
    return out.select("bot", F.lit(direction).alias("direction"), F.lit(f"system.{system}").alias("queue"), "records", F.to_json(F.struct("records")).alias("payload"))
