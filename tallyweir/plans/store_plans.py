"""Queries over stored tables, section files, sinks, limited and timed streams, with the same in DuckDB's SQL."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.eid import build_eid, utc_millis
from ..functions.hashing import partition_of
from ..operators import bots, fanout, process, state
from ..sources import formats, keyed, large, sections, sinks
from ..sources.fixture import bus_events, bus_rows, checkpoints, from_events, sql, table
from ..sources.shared import new_path
from ..streaming import streams
from . import read_plans, stats_plans
from .read_plans import END, EVENT, START

_SECTIONED = "eid string, bot string, timestamp long, payload string, size long"
_MILLIS = 3_600_000


def _sections(spark, sf):
    path = new_path(spark, "sections")
    sections.write_sections(bus_rows(spark, sf).select(*EVENT), path, records=100)
    return path


def section_read(spark, sf):
    """A range of every queue from section files: only the sections that hold some of it are opened."""
    return sections.read_sections(spark, _sections(spark, sf), _SECTIONED, None, START + " ", END).select(*EVENT)


def section_index(spark, sf):
    """What the index of section files says, by queue: whether each file has ten sections at most, each follows the one before
    it, and sections and files hold as many events as they may."""
    i = sections.section_index(spark, _sections(spark, sf))
    w = Window.partitionBy("file").orderBy("section")
    follows = (F.col("gzip_offset") == F.coalesce(F.lag(F.col("gzip_offset") + F.col("gzip_size")).over(w), F.lit(0))) & (F.col("offset") == F.coalesce(F.lag(F.col("offset") + F.col("records")).over(w), F.lit(0)))
    return i.withColumn("follows", follows).groupBy("queue").agg(
        F.sum("records").alias("records"), F.min("start").alias("start"), F.max("end").alias("end"), F.min(F.col("section") < 10).alias("short_files"), F.min("follows").alias("follows"), F.max("records").alias("most"),
    )


def _stored(spark, sf, merge):
    """Customers, and the orders' updates in two batches with a compaction between them, the second batch twice."""
    old, new = stats_plans._customers(spark, sf), stats_plans._updates(spark, sf)
    t = keyed.KeyedTable(spark, new_path(spark, "keyed"), old.schema, ["c_custkey"], buckets=8, merge=merge)
    t.upsert(old.withColumn("seq", F.lit(0)), 0, "seq")
    low, high = new.agg(F.min("seq"), F.max("seq")).first()
    middle = ((low or 0) + (high or 0)) // 2
    t.upsert(new.where(F.col("seq") <= middle), 1, "seq")
    t.compact()
    for _ in range(2):
        t.upsert(new.where(F.col("seq") > middle), 2, "seq")
    return t.read()


def keyed_upsert_stored(spark, sf):
    return _stored(spark, sf, False)


def merge_upsert_stored(spark, sf):
    return _stored(spark, sf, True)


def keyed_upsert_stream(spark, sf):
    """The same table fed by a stream of orders, a batch for each micro-batch."""
    old = stats_plans._customers(spark, sf)
    t = keyed.KeyedTable(spark, new_path(spark, "keyed"), old.schema, ["c_custkey"], buckets=8)
    t.upsert(old.withColumn("seq", F.lit(0)), 0, "seq")
    stream = streams.deal_in_order(stats_plans._updates(spark, sf), "seq", 3)
    query = stream.writeStream.foreachBatch(lambda batch, number: t.upsert(batch, number + 1, "seq")).option("checkpointLocation", new_path(spark, "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    t.compact()
    return t.read()


def retrying_sink(spark, sf):
    """A store that takes an order's lines one after the other, one a try: what it took in each try."""
    path = new_path(spark, "sink")

    class InOrder(sinks.OutsideSink):
        @staticmethod
        def send(rows, number, task):
            bad = [k for k, r in enumerate(rows) if r["l_linenumber"] > number + 1]
            taken = [r for k, r in enumerate(rows) if r["l_linenumber"] <= number + 1]
            if taken:
                import zlib

                import pyarrow.parquet as pq

                fs, root = sections._at(path)
                fs.create_dir(f"{root}/held/try={number}", recursive=True)
                pq.write_table(pa.Table.from_pylist(taken), f"{root}/held/try={number}/{task}-{zlib.crc32(repr(rows).encode())}.parquet", filesystem=fs)
            return bad

    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("l_quantity"))
    sinks.send_all(rows.repartition(8, "l_orderkey"), InOrder, path, batch=10_000)
    held = spark.read.schema("l_orderkey long, l_linenumber long, l_quantity double, try int").parquet(f"{path}/held")
    return held.groupBy("try").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_orderkey", "l_linenumber").alias("rows"), F.sum("l_quantity").alias("quantity"))


def fanout_run(spark, sf):
    """All events by seven instances under one bound: what they gave by queue, and where the bot stands."""

    def handle(batch):
        k = batch.column(batch.schema.get_field_index("k"))
        return pc.if_else(pc.equal(pc.bit_wise_and(k, 1), 1), pc.multiply(k, 2), pa.scalar(None, pa.int64())).cast(pa.int64())

    done = fanout.fan_out_run(bus_events(spark, sf), "fan", 7, handle, "long")
    out = done.output.groupBy("queue").agg(F.count(F.lit(1)).alias("n"), F.sum("result").alias("total"), F.max("eid").alias("position")).select(F.lit("output").alias("kind"), "queue", "position", "n", "total")
    return out.unionByName(done.checkpoints.select(F.lit("checkpoint").alias("kind"), "queue", F.col("checkpoint").alias("position"), F.col("records").alias("n"), F.lit(0).cast("long").alias("total")))


def checkpoint_chain(spark, sf):
    """Each event proposes itself as its bot's checkpoint, expecting the one before it of those whose id 5 doesn't divide;
    the others expect what never is, and each eleventh is forced."""
    rows = bus_rows(spark, sf)
    good = F.col("event_id") % 5 != 0
    w = Window.partitionBy("bot", "queue").orderBy("eid").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(good, F.col("eid")), ignorenulls=True).over(w)
    ask = rows.select("bot", F.lit("read").alias("direction"), "queue", F.when(good, before).otherwise("z/2020").alias("expected"), "eid", (F.col("event_id") % 11 == 0).alias("force"), F.col("eid").alias("at"))
    stored = checkpoints(rows).where("bot <> 'bot_3'").withColumn("direction", F.lit("read"))
    return state.advance_checkpoints(stored, ask, "at").select("bot", "queue", "eid", "status", "checkpoint")


def large_events(spark, sf):
    """Documents as events: those whose JSON has more than 3000 bytes lie apart, and come back whole."""
    path = new_path(spark, "large")
    large.write_large(table(spark, sf, "documents").select("doc_id", "lang", F.col("text").alias("payload")), path, limit=3000)
    apart = spark.read.parquet(f"{path}/events").select("doc_id", F.col("body").isNotNull().alias("apart"), F.col("payload").isNull().alias("empty_row"))
    return large.read_large(spark, path).select("doc_id", "lang", F.sha2("payload", 256).alias("payload_sha256")).join(apart, "doc_id")


def stream_limited(spark, sf):
    """A stream of six micro-batches read by three runs: of two batches, of some records, and of what is left."""
    path = new_path(spark, "limited")
    events = table(spark, sf, "events")
    n = events.count()
    stream = streams.deal(events, 6)
    for limits in (streams.Limits(batches=2), streams.Limits(records=n // 6 + 1), streams.Limits()):
        streams.run_limited(stream, lambda b: from_events(b).select(*EVENT), path, limits)
    return spark.read.parquet(f"{path}/out").select(*EVENT)


def timed_batches_stream(spark, sf):
    """Batches of a stream by 12 events, 150 bytes or an hour, whichever comes first. What the watermark hasn't closed in the
    end is still open."""
    rows = streams.deal_in_order(table(spark, sf, "events"), "ts", 4)
    eid = build_eid(utc_millis(F.col("ts")), F.col("event_id")).alias("eid")
    return streams.timed_batches(rows.select(F.col("event_type").alias("queue"), eid, F.octet_length("props").cast("long").alias("size"), "ts"), 12, 150, _MILLIS)


def rule_counts(spark, sf):
    """A value that is of each kind in turn, by rules on its type, with counts of what broke them."""
    kinds = F.element_at(F.array(*map(F.lit, ['{"v":1}', '{"v":"a"}', '{"v":true}', '{"v":{"x":1}}', '{"v":[1]}', '{"v":null}', "{}"])), (F.col("event_id") % 7 + 1).cast("int"))
    rows = bus_rows(spark, sf).select("event_id", "queue", kinds.alias("payload"))
    v = process.json_type(F.col("payload"), "v")
    rules = [("v", "required", "error", process.present(v)), ("v", "ofType number", "warn", process.of_type(v, "number", True)), ("v", "notOfType string", "info", process.not_of_type(v, "string")), ("w", "ofType string", "error", process.of_type(process.json_type(F.col("payload"), "w"), "string"))]
    return process.violation_counts(process.violations(rows, "event_id", rules))


def dw_run(spark, sf):
    """Read, process, and send to the warehouse's queue; with the checkpoint."""
    rows = bus_events(spark, sf)
    worked = bots.warehouse_run(rows, "loader", "_views", lambda r: (process.action_of(read_plans._kind()), read_plans._doubled()))
    return read_plans._event_and_checkpoints(worked)


def csv_bars(spark, sf):
    """Texts in quotes with backslash escapes between bars, with spaces around values, \\N for null and empty lines."""
    d = table(spark, sf, "documents")
    text = F.concat(F.lit('"'), F.replace(F.replace(F.translate("text", "\n\r", "  "), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    line = F.concat_ws("|", F.concat(F.lit("  "), F.col("doc_id").cast("string"), F.lit(" ")), F.coalesce(text, F.lit("\\N")), F.concat(F.lit(" "), F.when(F.col("n_chars") < 500, "\\N").otherwise(F.col("source")), F.lit("  ")))
    path = new_path(spark, "bars")
    d.select(F.concat(line, F.lit("\n")).alias("value")).write.text(path)
    return formats.read_csv(spark, path, "doc_id long, text string, source string")


def append_by_key(spark, sf):
    """A batch dealt by the hash of its key: how many files hold each part, and its events."""
    rows = bus_rows(spark, sf).select(*EVENT, partition_of(F.col("eid"), 7).alias("part"))
    path = new_path(spark, "keys")
    formats.append_batch(rows, path, 0, F.col("part"))
    return spark.read.parquet(path).groupBy("part").agg(F.countDistinct(F.col("_metadata.file_path")).alias("files"), F.count(F.lit(1)).alias("n"), F.max("eid").alias("last_eid"))


QUERIES = {f.__name__: f for f in (section_read, section_index, keyed_upsert_stored, merge_upsert_stored, keyed_upsert_stream, retrying_sink, fanout_run, checkpoint_chain, large_events, stream_limited, timed_batches_stream, rule_counts, dw_run, csv_bars, append_by_key)}

_E = ", ".join(EVENT)
_PART = "abs(list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(eid, ''), lambda c: CAST(unicode(c) AS BIGINT))), lambda h, c: ((h * 31 + c + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648)) % 7"
SQL = {
    "section_read": sql(f"SELECT {_E} FROM rows_ WHERE eid > '{START} ' AND eid <= '{END}'"),
    "section_index": sql('SELECT queue, count(*) AS records, min(eid) AS start, max(eid) AS "end", true AS short_files, true AS follows, CAST(100 AS BIGINT) AS most FROM rows_ GROUP BY queue'),
    "keyed_upsert_stored": stats_plans.SQL["keyed_upsert"],
    "merge_upsert_stored": stats_plans.SQL["merge_upsert"],
    "keyed_upsert_stream": stats_plans.SQL["keyed_upsert"],
    "retrying_sink": "SELECT CAST(l_linenumber - 1 AS INTEGER) AS try, count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS rows, sum(CAST(l_quantity AS DOUBLE)) AS quantity FROM lineitem GROUP BY l_linenumber",
    "fanout_run": sql(f""", p AS (SELECT *, {_PART} AS part FROM rows_), w AS (SELECT queue, part, max(eid) AS c, count(*) AS n FROM p GROUP BY queue, part)
      SELECT 'output' AS kind, queue, max(eid) AS position, count(*) AS n, CAST(sum(2 * k) AS BIGINT) AS total FROM rows_ WHERE k % 2 = 1 GROUP BY queue
      UNION ALL SELECT 'checkpoint', queue, min(c), arg_min(n, c), 0 FROM w GROUP BY queue"""),
    "checkpoint_chain": sql(""", p AS (SELECT bot, queue, eid, event_id % 11 = 0 AS force, CASE WHEN event_id % 5 <> 0 THEN last_value(CASE WHEN event_id % 5 <> 0 THEN eid END IGNORE NULLS) OVER (PARTITION BY bot, queue ORDER BY eid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) ELSE 'z/2020' END AS expected,
        row_number() OVER (PARTITION BY bot, queue ORDER BY eid) AS r FROM rows_),
      x AS (SELECT * FROM (WITH RECURSIVE g AS (
        SELECT k.bot, k.queue, CAST(0 AS BIGINT) AS r, CAST(NULL AS VARCHAR) AS eid, '' AS status, c.checkpoint FROM (SELECT DISTINCT bot, queue FROM rows_) k LEFT JOIN cps c ON c.bot = k.bot AND c.queue = k.queue AND c.bot <> 'bot_3'
        UNION ALL SELECT p.bot, p.queue, p.r, p.eid, CASE WHEN checkpoint IS NULL OR force OR expected = checkpoint THEN 'applied' ELSE 'stale' END, CASE WHEN checkpoint IS NULL OR force OR expected = checkpoint THEN p.eid ELSE checkpoint END
        FROM g JOIN p ON p.bot = g.bot AND p.queue = g.queue AND p.r = g.r + 1) SELECT * FROM g))
      SELECT bot, queue, eid, status, checkpoint FROM x WHERE r > 0"""),
    "large_events": f"SELECT doc_id, lang, sha256(text) AS payload_sha256, text IS NOT NULL AND strlen(j) > 3000 AS apart, text IS NULL OR strlen(j) > 3000 AS empty_row FROM (SELECT doc_id, lang, text, {read_plans._JSON.replace(chr(39) + 'text' + chr(39) + ': text, ', '').replace('lang})', 'lang, ' + chr(39) + 'payload' + chr(39) + ': text})').replace('|text|', '|payload|')} AS j FROM documents)",
    "stream_limited": sql(f"SELECT {_E} FROM rows_"),
    "timed_batches_stream": sql(f""", o AS (SELECT queue, eid, size, timestamp, row_number() OVER (PARTITION BY queue ORDER BY eid) AS r FROM rows_)
    , f AS (SELECT * FROM (WITH RECURSIVE g AS (SELECT queue, eid, r, CAST(0 AS BIGINT) AS seq, CAST(1 AS BIGINT) AS n, CAST(size AS BIGINT) AS b, timestamp AS first FROM o WHERE r = 1
        UNION ALL SELECT o.queue, o.eid, o.r, CASE WHEN full_ THEN seq + 1 ELSE seq END, CASE WHEN full_ THEN 1 ELSE n + 1 END, CASE WHEN full_ THEN o.size ELSE b + o.size END, CASE WHEN full_ THEN o.timestamp ELSE first END
        FROM (SELECT g.*, g.n >= 12 OR g.b >= 150 OR o2.timestamp - g.first >= {_MILLIS} AS full_ FROM g JOIN o o2 ON o2.queue = g.queue AND o2.r = g.r + 1) g JOIN o ON o.queue = g.queue AND o.r = g.r + 1) SELECT * FROM g)),
    b AS (SELECT queue, seq, min(eid) AS start, max(eid) AS "end", max(n) AS n, max(b) AS bytes, min(first) AS first FROM f GROUP BY queue, seq)
    SELECT queue, seq, start, "end", n, bytes, CASE WHEN n >= 12 THEN 'count' WHEN bytes >= 150 THEN 'bytes' ELSE 'time' END AS closed FROM b WHERE n >= 12 OR bytes >= 150 OR first + {_MILLIS} <= (SELECT max(timestamp) - 60000 FROM rows_)"""),
    "rule_counts": sql("""SELECT field, rule, level, CAST(count(*) AS BIGINT) AS n FROM (
      SELECT 'v' AS field, 'required' AS rule, 'error' AS level FROM rows_ WHERE event_id % 7 IN (5, 6) UNION ALL SELECT 'v', 'ofType number', 'warn' FROM rows_ WHERE event_id % 7 BETWEEN 1 AND 4 UNION ALL SELECT 'v', 'notOfType string', 'info' FROM rows_ WHERE event_id % 7 = 1) GROUP BY ALL"""),
    "dw_run": sql(", d AS (" + read_plans._PROCESSED.format(event="'dw.load_views'", units="units", action="case when kind = 'object' then 'emit' when kind in ('true', 'string', 'number') then 'ack' else 'drop' end").replace("'doubler'", "'loader'").replace("action, eid", "action, eid, timestamp") + """) SELECT 'event' AS kind, id, event AS queue, payload, start AS position, units AS n, event_source_timestamp AS source_timestamp FROM d WHERE action = 'emit'
      UNION ALL SELECT 'checkpoint', id, source, NULL, max(start), CAST(sum(units) AS BIGINT), min(event_source_timestamp) FROM d GROUP BY id, source"""),
    "csv_bars": "SELECT doc_id, translate(text, chr(10) || chr(13), '  ') AS text, CASE WHEN n_chars >= 500 THEN source END AS source FROM documents",
    "append_by_key": sql(f"SELECT CAST({_PART} AS INTEGER) AS part, CAST(1 AS BIGINT) AS files, count(*) AS n, max(eid) AS last_eid FROM rows_ GROUP BY part"),
}
