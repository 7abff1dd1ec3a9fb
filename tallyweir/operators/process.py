"""Event envelopes and the process step: emit, acknowledge only, or drop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.eid import build_eid
from ..sources.shared import Scratch
from .points import numbered

EMIT, ACK, DROP = "emit", "ack", "drop"
LARGE_BYTES, DEAD_BYTES, PREVIEW = 600_000, 3, 2000


def to_envelope(rows: DataFrame, bot: str, queue: str, now: Column | None = None) -> DataFrame:
    """rows (payload; optionally id, event, timestamp, event_source_timestamp, correlation) with every missing envelope
    field filled: one clock value for the whole batch."""
    now = F.unix_millis(F.current_timestamp()) if now is None else now
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None)
    at = F.coalesce(have("timestamp").cast("long"), now)
    return rows.withColumns({
        "id": F.coalesce(have("id").cast("string"), F.lit(bot)), "event": F.coalesce(have("event").cast("string"), F.lit(queue)),
        "timestamp": at, "event_source_timestamp": F.coalesce(have("event_source_timestamp").cast("long"), at),
    })


def assign_eids(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (queue, ms, ...) with eid: the id of their time, numbered from 0 in order within a queue's millisecond, however many
    rows that has. Rows of equal order stand anyhow."""
    scratch = Scratch(rows.sparkSession)
    out = numbered(rows, ["queue", "ms"], order, scratch)
    return out.withColumn("eid", build_eid(F.col("ms"), F.col("i"))).drop("i")


def process(events: DataFrame, action: Column, payload: Column, bot: str, out_queue: Column | str, keep: tuple[str, ...] = (), **options: Column) -> DataFrame:
    """id, event, payload, event_source_timestamp, source, start, units and action of each event that isn't dropped.

    action: EMIT, ACK (nothing is stored, the position counts) or DROP (nor that). options override event,
    event_source_timestamp, start or units; the columns in keep pass."""
    out = F.lit(out_queue) if isinstance(out_queue, str) else out_queue
    pick = lambda c, other: F.coalesce(options[c], other) if c in options else other
    return events.select(
        F.lit(bot).alias("id"), pick("event", out).alias("event"), F.when(action == EMIT, payload).alias("payload"), pick("event_source_timestamp", F.col("event_source_timestamp")).alias("event_source_timestamp"),
        F.col("queue").alias("source"), pick("start", F.col("eid")).alias("start"), pick("units", F.col("units")).cast("long").alias("units"), action.alias("action"), "eid", *keep,
    ).where(F.col("action") != DROP)


def action_of(result: Column, is_async: bool = False) -> Column:
    """A transform's result kind (object, true, false, undefined, string, number) to an action. The callback form drops
    whatever is falsy; the promise form drops only false, and acknowledges all else that isn't an object."""
    if is_async:
        return F.when(result == "object", EMIT).when(result == "false", DROP).otherwise(ACK)
    return F.when(result == "object", EMIT).when(result.isin("true", "string", "number"), ACK).otherwise(DROP)


def fan_out(events: DataFrame, results: Column, bot: str, out_queue: str) -> DataFrame:
    """An event's array of payloads as events: all but the last are partial (partial_start), the last carries start; an
    empty array acknowledges the event."""
    rows = events.withColumn("_r", results).select("*", F.posexplode_outer("_r").alias("_pos", "_payload"))
    last = F.col("_pos").isNull() | (F.col("_pos") == F.size("_r") - 1)
    return rows.select(
        F.lit(bot).alias("id"), F.lit(out_queue).alias("event"), F.col("_payload").alias("payload"), F.col("queue").alias("source"), F.when(~last, F.col("eid")).alias("partial_start"),
        F.when(last, F.col("eid")).alias("start"), F.lit(1).cast("long").alias("units"), F.coalesce("_pos", F.lit(0)).cast("long").alias("pos"), "timestamp", "event_source_timestamp",
    )


def route_by_size(events: DataFrame, json: Column, limit: int = LARGE_BYTES) -> DataFrame:
    """events with size (bytes of its JSON) and route: file for what is over limit, else inline."""
    return events.withColumn("json_size", F.octet_length(json).cast("long")).withColumn("route", F.when(F.col("json_size") > limit, "file").otherwise("inline"))


def dead_letter(events: DataFrame, json: Column, bot: str, chunk_bytes: int) -> DataFrame:
    """Events whose JSON is over three times the chunk size, as error records for bot.<id>.error."""
    size = F.octet_length(json).cast("long")
    limit = F.lit(DEAD_BYTES * chunk_bytes).cast("long")
    return events.where(size > limit).select("eid", F.lit(f"bot.{bot}.error").alias("event"), size.alias("size"), limit.alias("max_size"), F.lit("event is too large").alias("error"), F.substring(json, 1, PREVIEW).alias("preview"))


def violations(rows: DataFrame, key: str, rules: list[tuple[str, str, str, Column]]) -> DataFrame:
    """Long table of broken rules: (key, field, rule, level). rules: (field, rule, level, holds). Later rules of a field
    are skipped once its required rule fails."""
    required = {f: ok for f, r, _, ok in rules if r == "required"}
    made = []
    for field, rule, level, ok in rules:
        broken = ~F.coalesce(ok, F.lit(False))
        if rule != "required" and field in required:
            broken = broken & F.coalesce(required[field], F.lit(False))
        made.append(F.when(broken, F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"), F.lit(level).alias("level"))))
    return rows.select(key, F.explode(F.array_compact(F.array(*made))).alias("v")).select(key, "v.field", "v.rule", "v.level")


def json_type(text: Column, field: str) -> Column:
    """The type of a JSON text's field as a validator names it: number, string, boolean, object (a list or null too), or
    undefined where it isn't there."""
    made = F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), f"$.{field}", "variant"))
    kinds = F.when(made.startswith("OBJECT") | made.startswith("ARRAY"), "object").when(made == "STRING", "string").when(made == "BOOLEAN", "boolean").when(made == "VOID", "null")
    return F.when(made.isNull(), "undefined").otherwise(F.coalesce(kinds, F.lit("number")))


def present(kind: Column) -> Column:
    """Holds where a field has a value."""
    return ~kind.isin("undefined", "null")


def of_type(kind: Column, name: str, required: bool = False) -> Column:
    """Holds for a field of this type; one without a value is asked only where it is required."""
    return (F.when(kind == "null", "object").otherwise(kind) == name) | (F.lit(not required) & ~present(kind))


def not_of_type(kind: Column, name: str) -> Column:
    return F.when(kind == "null", "object").otherwise(kind) != name


def violation_counts(broken: DataFrame) -> DataFrame:
    """How many rows broke each rule: field, rule, level, n."""
    return broken.groupBy("field", "rule", "level").agg(F.count(F.lit(1)).alias("n"))
