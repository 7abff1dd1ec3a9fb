"""Queries over range reads and event envelopes, with the same in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import refs
from ..functions.eid import utc_millis
from ..operators import batching, bots, process, read, stats
from ..sources.fixture import bus_events, bus_rows, checkpoints, sql, table

START, END = "z/2024/01/05", "z/2024/01/20/12"
EVENT = ["eid", "queue", "bot", "timestamp", "payload", "size"]
_E = ", ".join(EVENT)


def flagship(spark, sf):
    """Envelope, ids, range read, projected payload and stream statistics by queue."""
    rows = read.read_range(bus_events(spark, sf), ["view", "purchase"], START, END)
    return stats.stream_stats(rows.withColumn("units", F.col("k")), "queue")


def read_range(spark, sf):
    return read.read_range(bus_rows(spark, sf), "view", START, END).select(*EVENT)


def read_from_checkpoint(spark, sf):
    rows = bus_rows(spark, sf)
    readers = rows.select("bot", "queue").distinct().withColumn("start", F.when(F.col("bot") == "bot_1", START))
    left = read.read_from_checkpoint(rows.drop("bot"), readers, checkpoints(rows), rows.groupBy("queue").agg(F.max("eid").alias("max_eid")), "z/2024/01/01")
    return left.groupBy("reader", "queue").agg(F.count(F.lit(1)).alias("n"), F.min("eid").alias("first_eid"), F.max("eid").alias("last_eid"), F.sum("size").alias("bytes"))


def read_limit(spark, sf):
    return read.read_limit(bus_rows(spark, sf), "click", 100, START).select(*EVENT)


def read_byte_budget(spark, sf):
    return read.read_byte_budget(bus_rows(spark, sf), "error", 2000).select(*EVENT)


def _parts(spark, sf):
    """Live queues, and beside each its snapshot (each user's last event up to END) and its archive (events up to END)."""
    rows = bus_rows(spark, sf)
    old = rows.where(F.col("eid") <= END)
    last = old.groupBy("queue", "user_id").agg(F.max_by(F.struct(*EVENT[:1], *EVENT[2:], "dt"), "eid").alias("e")).select(F.concat("queue", F.lit("/_snapshot")).alias("queue"), "e.*")
    kept = old.select(F.concat("queue", F.lit("/_archive")).alias("queue"), EVENT[0], *EVENT[2:], "dt")
    return rows.select(*EVENT, "dt").unionByName(last).unionByName(kept)


def snapshot_tail(spark, sf):
    """From the very start, of a queue with a snapshot."""
    return read.read_registered(_parts(spark, sf), "view", "z/", {"snapshot_next": END, "archive_end": END}).select(*EVENT)


def archive_tail(spark, sf):
    """From a day before the archive's end."""
    return read.read_registered(_parts(spark, sf), "click", START, {"snapshot_next": END, "archive_end": END}).select(*EVENT)


def normalize_refs(spark, sf):
    raw = F.expr("case user_id % 6 when 0 then event_type when 1 then concat('bot:', event_type) when 2 then concat('System:', event_type) when 3 then concat('e_', event_type) when 4 then concat('bot:bot.', event_type) else concat('queue:bot.', event_type, '.error') end")
    r = table(spark, sf, "events").select(raw.alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    q = refs.as_queue(F.col("raw"))
    return r.select("raw", "n", refs.ref_id(F.col("raw")).alias("ref"), q.alias("queue"), refs.as_queue(F.col("raw"), "sub").alias("sub"), refs.owner(q).alias("owner"))


def table_scan(spark, sf):
    """The middle half of the keys, at most 1000 rows."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return read.table_scan(orders, "o_orderkey", low + (high - low) // 4, high - (high - low) // 4, 1000) if low is not None else orders


def load_events(spark, sf):
    o = table(spark, sf, "orders").select(F.concat(F.lit('{"o":'), F.col("o_orderkey").cast("string"), F.lit("}")).alias("payload"), F.when(F.col("o_orderkey") % 2 == 0, "own").alias("id"), F.when(F.col("o_orderkey") % 3 == 0, F.lit(1700000000000)).alias("timestamp"), F.when(F.col("o_orderkey") % 5 == 0, F.lit(1600000000000)).alias("event_source_timestamp"))
    return process.to_envelope(o, "loader", "orders", F.lit(1710000000000).cast("long")).select("id", "event", "timestamp", "event_source_timestamp", "payload")


def dw_feed(spark, sf):
    o = table(spark, sf, "customer").select(F.concat(F.lit('{"c":'), F.col("c_custkey").cast("string"), F.lit("}")).alias("payload"))
    return process.to_envelope(o, "dw", "dw.load.customer", F.lit(1710000000000).cast("long")).select("id", "event", "timestamp", "event_source_timestamp", "payload")


def stamp_eids(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.col("event_type").alias("queue"), stats.bucket_start(utc_millis(F.col("ts")), "minute_1").alias("ms"))
    return process.assign_eids(rows, ["event_id"]).select("event_id", "queue", "eid")


def _json():
    return F.to_json(F.struct("doc_id", "text", "lang"))


def route_by_size(spark, sf):
    d = table(spark, sf, "documents")
    return process.route_by_size(d, _json(), 3000).select("doc_id", "json_size", "route")


def dead_letter(spark, sf):
    d = table(spark, sf, "documents").withColumn("eid", F.col("doc_id"))
    out = process.dead_letter(d, _json(), "loader", 3000)
    return out.select("eid", "event", "size", "max_size", "error", F.sha2("preview", 256).alias("preview_sha256"))


def route_queues(spark, sf):
    rows = bus_events(spark, sf)
    out = process.process(rows, F.lit(process.EMIT), F.col("payload"), "router", F.when(F.col("value") > 20, F.concat(F.lit("big_"), F.col("queue"))).otherwise("small"))
    return out.groupBy("event").agg(F.count(F.lit(1)).alias("n"), F.min("eid").alias("first_eid"), F.max("eid").alias("last_eid"))


def quality_rules(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    rules = [
        ("text", "required", "error", F.col("text").isNotNull() & (F.col("text") != "")), ("text", "match", "warn", F.col("text").rlike("[.!?]$")),
        ("lang", "in", "error", F.col("lang").isin("en", "de", "fr")), ("source", "match", "warn", F.col("source").rlike("^src1?[0-5]$")), ("n_chars", "assert", "info", F.col("n_chars") < 5000),
    ]
    return process.violations(d, "doc_id", rules)


def _kind():
    return F.expr("case when k % 7 = 0 then 'undefined' when k % 5 = 0 then 'true' when k % 11 = 0 then 'false' when k % 13 = 0 then 'string' else 'object' end")


def _doubled():
    return F.concat(F.lit('{"k2":'), (F.col("k") * 2).cast("string"), F.lit("}"))


def process_emit_ack_drop(spark, sf):
    return process.process(bus_events(spark, sf), process.action_of(_kind()), _doubled(), "doubler", "doubled")


def process_async_rules(spark, sf):
    other = F.when(F.col("k") % 4 == 0, F.concat(F.lit("alt_"), F.col("queue")))
    return process.process(bus_events(spark, sf), process.action_of(_kind(), True), _doubled(), "doubler", "doubled", event=other, units=F.when(F.col("k") % 3 == 0, F.lit(7)))


def _results():
    return F.transform(F.when(F.col("k") % 4 > 0, F.sequence(F.lit(1), (F.col("k") % 4).cast("int"))).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.lit('{"i":'), i.cast("string"), F.lit("}")))


def fanout_partial(spark, sf):
    return process.fan_out(bus_events(spark, sf), _results(), "fan", "fanned")


def process_with_summary(spark, sf):
    rows = bus_events(spark, sf)
    made = process.process(rows, process.action_of(_kind()), _doubled(), "doubler", "doubled").select("id", "event", "payload", "eid")
    total = rows.groupBy("queue").agg(F.sum("k").alias("s"), F.max("eid").alias("eid")).select(F.lit("doubler").alias("id"), F.concat(F.lit("sum_"), F.col("queue")).alias("event"), F.concat(F.lit('{"sum":'), F.col("s").cast("string"), F.lit("}")).alias("payload"), "eid")
    return made.unionByName(total)


def checkpoint_from_correlations(spark, sf):
    out = process.fan_out(bus_events(spark, sf), _results(), "fan", "fanned").withColumn("end", F.lit(None).cast("string"))
    return stats.checkpoint_from_correlations(out)


def batch_correlation(spark, sf):
    """Of batches of 10; every second one is partial."""
    b = batching.number_batches(bus_events(spark, sf), 10)
    return batching.correlation(b.drop("source", "start"), ["queue", "batch"], F.col("batch") % 2 == 1).drop("queue")


def batch_count(spark, sf):
    b = batching.merge_batches(batching.number_batches(bus_events(spark, sf), 25))
    joined = F.array_join(F.transform("events", lambda e: e["payload"]), "")
    return b.select("queue", "batch", "bot", "event_source_timestamp", "timestamp", "start", "eid", "units", F.sha2(joined, 256).alias("payloads_sha256"))


def _event_and_checkpoints(worked):
    """Both in one table: kind, id, queue, payload, position and n."""
    out = worked.output.select(F.lit("event").alias("kind"), "id", F.col("event").alias("queue"), "payload", F.col("start").alias("position"), F.col("units").alias("n"), F.col("event_source_timestamp").alias("source_timestamp"))
    return out.unionByName(_checkpoint_rows(worked.checkpoints))


def _checkpoint_rows(checkpoints):
    return checkpoints.select(F.lit("checkpoint").alias("kind"), F.col("bot").alias("id"), "queue", F.lit(None).cast("string").alias("payload"), F.col("checkpoint").alias("position"), F.col("records").alias("n"), "source_timestamp")


def _batch_sums(rows):
    """Sum of k over a batch's events; odd sums are acknowledged only."""
    s = F.aggregate("events", F.lit(0).cast("long"), lambda a, e: a + F.get_json_object(e["payload"], "$.k").cast("long"))
    return F.when(s % 2 == 0, process.EMIT).otherwise(process.ACK), F.concat(F.lit('{"sum":'), s.cast("string"), F.lit("}"))


def enrich(spark, sf):
    """Read, batch by 10, process, write; and the checkpoint it leaves."""
    return _event_and_checkpoints(bots.enrich(read.read_range(bus_events(spark, sf), "view", START), "enricher", "sums", _batch_sums, batch=10))


def _not_thirds(rows):
    return F.when(F.col("k") % 3 > 0, F.col("payload"))


def offload(spark, sf):
    """Read, map (falsy drops), batch by 20, and what an outside system gets per batch, with the checkpoint."""
    return _delivered(bots.offload(bus_events(spark, sf), "offloader", _not_thirds, batch=20))


def _delivered(worked):
    out = worked.output.select(F.lit("delivery").alias("kind"), "id", "queue", F.sha2("delivery", 256).alias("payload"), F.col("eid").alias("position"), F.col("records").alias("n"), F.col("event_source_timestamp").alias("source_timestamp"))
    return out.unionByName(_checkpoint_rows(worked.checkpoints))


QUERIES = {f.__name__: f for f in (flagship, read_range, read_from_checkpoint, read_limit, read_byte_budget, snapshot_tail, archive_tail, normalize_refs, table_scan, load_events, dw_feed, stamp_eids, route_by_size, dead_letter, route_queues, quality_rules, process_emit_ack_drop, process_async_rules, fanout_partial, process_with_summary, checkpoint_from_correlations, batch_correlation, batch_count, enrich, offload)}

_KIND = "case when k % 7 = 0 then 'undefined' when k % 5 = 0 then 'true' when k % 11 = 0 then 'false' when k % 13 = 0 then 'string' else 'object' end"
_PROCESSED = """SELECT 'doubler' AS id, {event} AS event, CASE WHEN action = 'emit' THEN '{{"k2":' || (k * 2) || '}}' END AS payload, event_source_timestamp, queue AS source, eid AS start, {units} AS units, action, eid
  FROM (SELECT *, {action} AS action FROM (SELECT *, """ + _KIND + """ AS kind FROM bus)) WHERE action <> 'drop'"""
_SYNC = _PROCESSED.format(event="'doubled'", units="units", action="case when kind = 'object' then 'emit' when kind in ('true', 'string', 'number') then 'ack' else 'drop' end")
_FANNED = """, fanned AS (SELECT 'fan' AS id, 'fanned' AS event, CASE WHEN n > 0 THEN '{"i":' || (pos + 1) || '}' END AS payload, queue AS source, CASE WHEN pos < n - 1 THEN eid END AS partial_start,
    CASE WHEN pos >= n - 1 THEN eid END AS start, CAST(1 AS BIGINT) AS units, CAST(pos AS BIGINT) AS pos, timestamp, event_source_timestamp
  FROM (SELECT *, k % 4 AS n, unnest(range(greatest(k % 4, 1))) AS pos FROM bus))"""
_NUMBERED = ", b AS (SELECT *, (row_number() OVER (PARTITION BY queue ORDER BY eid) - 1) // {n} AS batch FROM bus{where})"
_JSON = "regexp_replace(CAST(to_json({'doc_id': doc_id, 'text': text, 'lang': lang}) AS VARCHAR), '\"(doc_id|text|lang)\":null,?', '', 'g')"

SQL = {
    "flagship": sql(f"SELECT queue, max(eid) AS eid, min(eid) AS start_eid, CAST(sum(k) AS BIGINT) AS units, min(event_source_timestamp) AS source_timestamp, max(timestamp) AS started_timestamp, max(timestamp) AS ended_timestamp, min(timestamp) AS first_timestamp FROM bus WHERE queue IN ('view', 'purchase') AND eid > '{START} ' AND eid <= '{END}' GROUP BY queue"),
    "read_range": sql(f"SELECT {_E} FROM rows_ WHERE queue = 'view' AND eid > '{START} ' AND eid <= '{END}'"),
    "read_from_checkpoint": sql(f"""SELECT r.bot AS reader, queue, count(*) AS n, min(eid) AS first_eid, max(eid) AS last_eid, CAST(sum(size) AS BIGINT) AS bytes
      FROM rows_ JOIN (SELECT x.bot, x.queue, coalesce(CASE WHEN x.bot = 'bot_1' THEN '{START}' END, checkpoint, 'z/2024/01/01') || ' ' AS f FROM (SELECT DISTINCT bot, queue FROM rows_) x LEFT JOIN cps c ON x.bot = c.bot AND x.queue = c.queue) r USING (queue) WHERE eid > f GROUP BY r.bot, queue"""),
    "read_limit": sql(f"SELECT {_E} FROM rows_ WHERE queue = 'click' AND eid > '{START} ' ORDER BY eid LIMIT 100"),
    "read_byte_budget": sql(f"SELECT {_E} FROM (SELECT *, coalesce(sum(size) OVER (ORDER BY eid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM rows_ WHERE queue = 'error') WHERE b < 2000"),
    "snapshot_tail": sql(f"SELECT {_E} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY eid DESC) AS r FROM rows_ WHERE queue = 'view' AND eid <= '{END}') WHERE r = 1 UNION ALL SELECT {_E} FROM rows_ WHERE queue = 'view' AND eid > '{END} '"),
    "archive_tail": sql(f"SELECT {_E} FROM rows_ WHERE queue = 'click' AND eid > '{START} '"),
    "normalize_refs": """WITH r AS (SELECT case user_id % 6 when 0 then event_type when 1 then 'bot:' || event_type when 2 then 'System:' || event_type when 3 then 'e_' || event_type when 4 then 'bot:bot.' || event_type else 'queue:bot.' || event_type || '.error' end AS raw FROM events),
      t AS (SELECT raw, count(*) AS n, CASE WHEN regexp_matches(raw, '(?i)(system|queue|bot):') THEN lower(regexp_extract(raw, '(?i)(system|queue|bot):(.*)', 1)) ELSE 'queue' END AS kind, CASE WHEN regexp_matches(raw, '(?i)(system|queue|bot):') THEN regexp_extract(raw, '(?i)(system|queue|bot):(.*)', 2) ELSE regexp_replace(raw, '^[seb]_', '') END AS name FROM r GROUP BY raw),
      q AS (SELECT *, CASE WHEN kind = 'queue' THEN name ELSE kind || '.' || regexp_replace(name, '^' || kind || '\\.', '') END AS queue FROM t)
      SELECT raw, n, kind || ':' || name AS ref, queue, queue || '.sub' AS sub, CASE WHEN regexp_matches(queue, '^(bot|system)\\.') THEN regexp_extract(queue, '^(bot|system)\\.([^.]*)', 1) || ':' || regexp_extract(queue, '^(bot|system)\\.([^.]*)', 2) END AS owner FROM q""",
    "table_scan": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders, (SELECT min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders) WHERE o_orderkey BETWEEN a + (b - a) // 4 AND b - (b - a) // 4 ORDER BY o_orderkey LIMIT 1000",
    "load_events": """SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'own' ELSE 'loader' END AS id, 'orders' AS event, CASE WHEN o_orderkey % 3 = 0 THEN 1700000000000 ELSE 1710000000000 END AS timestamp,
      CASE WHEN o_orderkey % 5 = 0 THEN 1600000000000 WHEN o_orderkey % 3 = 0 THEN 1700000000000 ELSE 1710000000000 END AS event_source_timestamp, '{"o":' || o_orderkey || '}' AS payload FROM orders""",
    "dw_feed": """SELECT 'dw' AS id, 'dw.load.customer' AS event, 1710000000000 AS timestamp, 1710000000000 AS event_source_timestamp, '{"c":' || c_custkey || '}' AS payload FROM customer""",
    "stamp_eids": """SELECT event_id, queue, strftime(m, 'z/%Y/%m/%d/%H/%M/') || epoch_ms(m) || '-' || right('0000000' || (row_number() OVER (PARTITION BY queue, m ORDER BY event_id) - 1), 7) AS eid
      FROM (SELECT event_id, event_type AS queue, date_trunc('minute', ts) AS m FROM events)""",
    "route_by_size": f"SELECT doc_id, CAST(strlen(j) AS BIGINT) AS json_size, CASE WHEN strlen(j) > 3000 THEN 'file' ELSE 'inline' END AS route FROM (SELECT doc_id, {_JSON} AS j FROM documents)",
    "dead_letter": f"SELECT doc_id AS eid, 'bot.loader.error' AS event, CAST(strlen(j) AS BIGINT) AS size, CAST(9000 AS BIGINT) AS max_size, 'event is too large' AS error, sha256(substring(j, 1, 2000)) AS preview_sha256 FROM (SELECT doc_id, {_JSON} AS j FROM documents) WHERE strlen(j) > 9000",
    "route_queues": sql("SELECT event, count(*) AS n, min(eid) AS first_eid, max(eid) AS last_eid FROM (SELECT CASE WHEN value > 20 THEN 'big_' || queue ELSE 'small' END AS event, eid FROM bus) GROUP BY event"),
    "quality_rules": """WITH d AS (SELECT doc_id, text IS NOT NULL AND text <> '' AS has, regexp_matches(text, '[.!?]$') AS ends, lang IN ('en', 'de', 'fr') AS l, regexp_matches(source, '^src1?[0-5]$') AS s, n_chars < 5000 AS n FROM documents)
      SELECT doc_id, 'text' AS field, 'required' AS rule, 'error' AS level FROM d WHERE NOT has UNION ALL SELECT doc_id, 'text', 'match', 'warn' FROM d WHERE has AND NOT coalesce(ends, false)
      UNION ALL SELECT doc_id, 'lang', 'in', 'error' FROM d WHERE NOT coalesce(l, false) UNION ALL SELECT doc_id, 'source', 'match', 'warn' FROM d WHERE NOT coalesce(s, false) UNION ALL SELECT doc_id, 'n_chars', 'assert', 'info' FROM d WHERE NOT coalesce(n, false)""",
    "process_emit_ack_drop": sql(_SYNC),
    "process_async_rules": sql(_PROCESSED.format(event="CASE WHEN k % 4 = 0 THEN 'alt_' || queue ELSE 'doubled' END", units="CAST(CASE WHEN k % 3 = 0 THEN 7 ELSE units END AS BIGINT)", action="case when kind = 'object' then 'emit' when kind = 'false' then 'drop' else 'ack' end")),
    "fanout_partial": sql(_FANNED + " SELECT * FROM fanned"),
    "process_with_summary": sql(f"""SELECT id, event, payload, eid FROM ({_SYNC}) UNION ALL SELECT 'doubler', 'sum_' || queue, '{{"sum":' || CAST(sum(k) AS BIGINT) || '}}', max(eid) FROM bus GROUP BY queue"""),
    "checkpoint_from_correlations": sql(_FANNED + " SELECT id AS bot, source AS queue, max(start) AS checkpoint, CAST(sum(units) AS BIGINT) AS records, min(event_source_timestamp) AS source_timestamp, max(timestamp) AS ended_timestamp FROM fanned GROUP BY id, source"),
    "batch_correlation": sql(_NUMBERED.format(n=10, where="") + """, g AS (SELECT queue, batch, min(eid) AS a, CASE WHEN count(*) > 1 THEN max(eid) END AS b, CAST(sum(units) AS BIGINT) AS units FROM b GROUP BY queue, batch)
      SELECT batch, queue AS source, CASE WHEN batch % 2 = 0 THEN a END AS start, CASE WHEN batch % 2 = 0 THEN b END AS "end", CASE WHEN batch % 2 = 1 THEN a END AS partial_start, CASE WHEN batch % 2 = 1 THEN b END AS partial_end, units FROM g"""),
    "batch_count": sql(_NUMBERED.format(n=25, where="") + " SELECT queue, batch, arg_min(bot, eid) AS bot, arg_min(event_source_timestamp, eid) AS event_source_timestamp, arg_max(timestamp, eid) AS timestamp, min(eid) AS start, max(eid) AS eid, CAST(sum(units) AS BIGINT) AS units, sha256(string_agg(payload, '' ORDER BY eid)) AS payloads_sha256 FROM b GROUP BY queue, batch"),
    "enrich": sql(_NUMBERED.format(n=10, where=f" WHERE queue = 'view' AND eid > '{START} '") + """, g AS (SELECT queue, batch, CAST(sum(k) AS BIGINT) AS s, max(eid) AS eid, CAST(sum(units) AS BIGINT) AS units, arg_min(event_source_timestamp, eid) AS est FROM b GROUP BY queue, batch)
      SELECT 'event' AS kind, 'enricher' AS id, 'sums' AS queue, '{"sum":' || s || '}' AS payload, eid AS position, units AS n, est AS source_timestamp FROM g WHERE s % 2 = 0
      UNION ALL SELECT 'checkpoint', 'enricher', queue, NULL, max(eid), CAST(sum(units) AS BIGINT), min(est) FROM g GROUP BY queue"""),
    "offload": sql(_NUMBERED.format(n=20, where=" WHERE k % 3 > 0") + """, g AS (SELECT queue, batch, count(*) AS n, '[' || string_agg(payload, ',' ORDER BY eid) || ']' AS body, max(eid) AS eid, CAST(sum(units) AS BIGINT) AS units, arg_min(event_source_timestamp, eid) AS est FROM b GROUP BY queue, batch)
      SELECT 'delivery' AS kind, 'offloader' AS id, queue, sha256(body) AS payload, eid AS position, n, est AS source_timestamp FROM g
      UNION ALL SELECT 'checkpoint', 'offloader', queue, NULL, max(eid), CAST(sum(units) AS BIGINT), min(est) FROM g GROUP BY queue"""),
}
