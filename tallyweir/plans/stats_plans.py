"""Queries over statistics, joins, lineage and state, with the same in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.eid import build_eid
from ..functions.hashing import partition_of
from ..operators import batching, joins, lineage, state, stats
from ..sources.fixture import bus_events, bus_rows, checkpoints, sql, table
from ..sources.shared import cut

QUEUES = ["click", "error", "purchase", "signup", "view"]


def stream_stats(spark, sf):
    return stats.stream_stats(bus_events(spark, sf), "queue")


def stats_by_bot_queue(spark, sf):
    return stats.stream_stats(bus_events(spark, sf), "bot", "queue")


def chunk_stats(spark, sf):
    c = stats.chunk_stats(bus_events(spark, sf), ["queue", "dt"])
    pairs = F.array_join(F.transform(F.map_entries("by_source"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return c.withColumn("by_source", pairs).withColumn("dt", F.col("dt").cast("string"))


def chunk_correlations(spark, sf):
    return stats.chunk_correlations(bus_events(spark, sf), ["queue", "dt"]).withColumn("dt", F.col("dt").cast("string"))


def range_counts(spark, sf):
    return stats.range_counts(bus_rows(spark, sf), ["queue"])


def throughput(spark, sf):
    return stats.throughput(bus_rows(spark, sf), ["queue"], 3_600_000).withColumn("rate", F.round("rate", 6))


def bucket_rollup(spark, sf):
    return stats.bucket_rollup(bus_rows(spark, sf), ["bot"])


def rolling_hour(spark, sf):
    return stats.rolling_hour(bus_rows(spark, sf), ["queue"])


def reduce_checkpoints(spark, sf):
    rows = bus_rows(spark, sf).withColumn("worker", F.pmod("user_id", F.lit(7)))
    made = rows.groupBy("worker", "bot", "queue").agg(F.max("eid").alias("checkpoint"), F.count(F.lit(1)).alias("records"))
    both = made.withColumn("direction", F.explode(F.array(F.lit("read"), F.lit("write")))).withColumn("error", F.lit(None).cast("string"))
    return stats.reduce_checkpoints(both)


def hash_partition(spark, sf):
    n = 7
    return bus_rows(spark, sf).select("eid", partition_of(F.col("eid"), n).alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("eid").alias("first_eid"), F.max("eid").alias("last_eid"))


def batch_bytes(spark, sf):
    return batching.limit_batches(bus_rows(spark, sf), size=100)


def batch_time(spark, sf):
    return batching.limit_batches(bus_rows(spark, sf), count=10, millis=3_600_000)


def lookup_join(spark, sf):
    j = joins.lookup_join(table(spark, sf, "orders"), table(spark, sf, "customer"), "o_custkey", "c_custkey")
    return j.select("o_orderkey", "o_custkey", F.col("joined_data.c_name").alias("c_name"), F.col("joined_data.c_acctbal").alias("c_acctbal"))


def key_fetch(spark, sf):
    keys = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' and o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.key_fetch(table(spark, sf, "customer"), keys, "c_custkey")


def _changed(spark, sf):
    li = table(spark, sf, "lineitem")  # every line is a change of its order
    changes = {"orders": li.select(F.col("l_orderkey").alias("id")), "customer": table(spark, sf, "customer").where("c_acctbal < -500").select(F.col("c_custkey").alias("id")), "part": table(spark, sf, "part").where("p_size = 7").select(F.col("p_partkey").alias("id"))}
    maps = {"orders": True, "customer": table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("root")), "part": table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_orderkey").alias("root"))}
    return joins.find_ids(changes, maps)


def find_ids(spark, sf):
    return _changed(spark, sf)


def build_entities(spark, sf):
    c, o, n = (table(spark, sf, t) for t in ("customer", "orders", "nation"))
    e = joins.build_entities(c.select("c_custkey", "c_name", "c_nationkey"), "c_custkey", many={"orders": (o.select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey")})
    e = joins.build_entities(e, "c_nationkey", one={"nation": (n, "n_nationkey", F.col("n_nationkey"))})
    keys = F.array_join(F.transform("orders", lambda x: x["o_orderkey"].cast("string")), ",")
    return e.select("c_custkey", "c_name", F.col("nation.n_name").alias("nation"), F.size("orders").cast("long").alias("n_orders"), keys.alias("order_keys"))


def load_entities(spark, sf):
    """Changed rows to order ids, to assembled orders, to events of a queue."""
    from ..operators.process import to_envelope

    o = joins.key_fetch(table(spark, sf, "orders").withColumnRenamed("o_orderkey", "id"), _changed(spark, sf), "id")
    e = joins.build_entities(o.select("id", "o_custkey"), "id", many={"lines": (table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey")})
    body = F.concat(F.lit('{"order":'), F.col("id").cast("string"), F.lit(',"parts":['), F.array_join(F.transform("lines", lambda x: x["l_partkey"].cast("string")), ","), F.lit("]}"))
    return to_envelope(e.select(F.lit("entities").alias("id"), body.alias("payload")), "entities", "order_entities", F.lit(1710000000000).cast("long")).select("id", "event", "timestamp", "payload")


def parent_join(spark, sf):
    return joins.parent_join(bus_events(spark, sf))


def correlation_search(spark, sf):
    """Which batches of 10 of its queue hold each event."""
    rows = bus_rows(spark, sf)
    b = batching.number_batches(rows, 10).groupBy("queue", "batch").agg(F.min("eid").alias("start"), F.max("eid").alias("last"), F.count(F.lit(1)).alias("n"))
    spans = b.select(F.col("queue").alias("source"), "start", F.when(F.col("n") > 1, F.col("last")).alias("end"), F.concat(F.lit("b"), F.col("batch").cast("string")).alias("eid"))
    return joins.correlation_search(rows.select(F.col("queue").alias("source"), F.col("eid").alias("x")), spans)


def _bot_stats(rows, grain):
    return rows.groupBy("bot", "queue", stats.bucket_label(F.col("timestamp"), grain).alias("bucket")).agg(F.max("eid").alias("checkpoint"))


def checkpoint_asof(spark, sf):
    """When each bot had passed each event that another bot of its queue has: the hour, and the minute from it on."""
    rows = bus_rows(spark, sf)
    readers = rows.select("bot", "queue").distinct()
    want = rows.select(F.col("bot").alias("own"), "queue", "eid", stats.bucket_label(F.col("timestamp"), "hour").alias("bucket")).join(readers, "queue").where("bot <> own").drop("own")
    hours = cut(joins.checkpoint_asof(want, _bot_stats(rows, "hour"))).withColumnsRenamed({"bucket": "from", "found": "hour"})
    asked = hours.withColumn("bucket", F.concat(F.lit("minute_"), F.substr("hour", F.lit(6)), F.lit(":00")))  # null where there is no hour
    minutes = joins.checkpoint_asof(asked, _bot_stats(rows, "minute_1"))
    return minutes.select("bot", "queue", "eid", F.col("from").alias("bucket"), "hour", F.col("found").alias("minute"))


def _traced(spark, sf):
    return bus_events(spark, sf).withColumn("bot", F.concat(F.lit("bot_"), (F.col("event_id") % 7).cast("string")))


def lineage_edges(spark, sf):
    rows = bus_rows(spark, sf)
    r = rows.groupBy("bot").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("queue", "queue")))).alias("read"))
    w = rows.groupBy("bot").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct(F.concat(F.lit("queue:out_"), F.col("queue")).alias("q"), F.lit("x").alias("v"))))).alias("write"))
    return lineage.lineage_edges(r.join(w, "bot").withColumnRenamed("bot", "id"))


def trace_upstream(spark, sf):
    e = _traced(spark, sf)
    return lineage.trace_upstream(e.select("queue", "eid"), e)


def trace_downstream(spark, sf):
    rows = bus_events(spark, sf)
    cps = checkpoints(rows).where("(substring(bot, 5, 1) + length(queue)) % 2 = 0")
    names = F.array(*map(F.lit, QUEUES))
    writes = rows.select("bot").distinct().withColumn("queue", F.element_at(names, (F.substring("bot", 5, 1).cast("int") * 2 + 1) % 5 + 1))
    roots = rows.select(F.col("eid").alias("root"), "eid", "event_source_timestamp", "queue")
    return lineage.trace_downstream(roots, cps, writes)


def _worked(spark, sf):
    """Two steps that run each minute: reader writes a batch to stage_1 for each queue, minute and fifth of the users,
    joiner one to stage_2 for each minute; and where both stood at each minute and hour."""
    rows = bus_rows(spark, sf).select("queue", "eid", "timestamp", "event_id", (F.col("user_id") % 5).alias("part"))
    minute = stats.bucket_start(F.col("timestamp"), "minute_1")
    batch = lambda events, name, *by: events.groupBy(*by, minute.alias("m")).agg(F.max("timestamp").alias("timestamp"), F.min("timestamp").alias("event_source_timestamp"), F.min("eid").alias("start"), F.max("eid").alias("last"), F.count(F.lit(1)).alias("n"), F.max("event_id").alias("event_id")).withColumns({"eid": build_eid(F.col("timestamp"), F.col("event_id")), "end": F.when(F.col("n") > 1, F.col("last"))}).select(F.lit(name).alias("queue"), "eid", "timestamp", "event_source_timestamp", *(F.col(c).alias("source") for c in ("queue",)), "start", "end", "event_id")
    one = cut(batch(rows, "stage_1", "queue", "part"))
    two = batch(one, "stage_2", "queue")
    read = rows.select(F.lit("reader").alias("bot"), "queue", "eid", "timestamp").unionByName(one.select(F.lit("joiner").alias("bot"), "queue", "eid", "timestamp"))
    return rows, one.unionByName(two), {g: _bot_stats(read, g) for g in ("hour", "minute_1")}


def trace_path(spark, sf):
    """Every event through both steps."""
    rows, made, stood = _worked(spark, sf)
    return lineage.trace_path(rows.select(F.col("eid").alias("root"), "queue", "eid", "timestamp"), made, stood, [("reader", "stage_1"), ("joiner", "stage_2")])


def _updates(spark, sf):
    o = table(spark, sf, "orders")
    key = F.col("o_custkey") + F.when(F.col("o_orderkey") % 4 == 0, 1_000_000_000).otherwise(0)  # a quarter are of new customers
    return o.select(key.alias("c_custkey"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("c_name"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("c_acctbal"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("c_mktsegment"), F.col("o_orderkey").alias("seq"))


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def keyed_upsert(spark, sf):
    return state.keyed_upsert(_customers(spark, sf), _updates(spark, sf), ["c_custkey"], "seq")


def merge_upsert(spark, sf):
    """Rows with structs inside structs, merged leaf by leaf."""
    nest = lambda rows, *more: rows.select("c_custkey", "c_name", F.struct("c_acctbal", F.struct("c_mktsegment").alias("kind")).alias("account"), *more)
    merged = state.merge_upsert(nest(_customers(spark, sf)), nest(_updates(spark, sf), "seq"), ["c_custkey"], "seq")
    return merged.select("c_custkey", "c_name", "account.c_acctbal", "account.kind.c_mktsegment")


def dedup_latest(spark, sf):
    return state.dedup_latest(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus"), ["o_custkey"], "o_orderkey")


def write_once_update(spark, sf):
    last = state.dedup_latest(_updates(spark, sf), ["c_custkey"], "seq").drop("seq")
    return state.write_once_update(_customers(spark, sf), last, ["c_custkey"], ["c_name", "c_mktsegment"])


def io_audit(spark, sf):
    rows = bus_rows(spark, sf)
    return state.io_audit(rows, F.col("bot"), "warehouse", "write")


def advance_checkpoints(spark, sf):
    rows = bus_rows(spark, sf)
    stored = checkpoints(rows).where("bot <> 'bot_3'").withColumn("direction", F.lit("read"))
    new = rows.groupBy("bot", "queue").agg(F.max("eid").alias("eid")).join(stored.select("bot", "queue", "checkpoint"), ["bot", "queue"], "left")
    ask = new.select("bot", F.lit("read").alias("direction"), "queue", F.when(F.col("bot").isin("bot_1", "bot_2"), "z/2020").otherwise(F.col("checkpoint")).alias("expected"), F.when(F.col("bot") != "bot_4", F.col("eid")).alias("eid"), (F.col("bot") == "bot_2").alias("force"))
    return state.advance_checkpoints(stored, ask)


def bot_backlog(spark, sf):
    rows = bus_rows(spark, sf)
    reads = rows.select("bot", "queue").distinct().join(checkpoints(rows).where("bot <> 'bot_3'").select("bot", "queue", "checkpoint"), ["bot", "queue"], "left")
    return state.bot_backlog(rows, reads)


QUERIES = {f.__name__: f for f in (stream_stats, stats_by_bot_queue, chunk_stats, chunk_correlations, range_counts, throughput, bucket_rollup, rolling_hour, reduce_checkpoints, hash_partition, batch_bytes, batch_time, lookup_join, key_fetch, find_ids, build_entities, load_entities, parent_join, correlation_search, checkpoint_asof, lineage_edges, trace_upstream, trace_downstream, trace_path, keyed_upsert, merge_upsert, dedup_latest, write_once_update, io_audit, advance_checkpoints, bot_backlog)}

_STATS = "max(eid) AS eid, min(eid) AS start_eid, CAST(sum(units) AS BIGINT) AS units, min(event_source_timestamp) AS source_timestamp, max(timestamp) AS started_timestamp, max(timestamp) AS ended_timestamp, min(timestamp) AS first_timestamp"
_FOLD = """, o AS (SELECT queue, eid, size, timestamp, row_number() OVER (PARTITION BY queue ORDER BY eid) AS r FROM rows_)
, f AS (SELECT * FROM (WITH RECURSIVE g AS (
    SELECT queue, eid, r, CAST(0 AS BIGINT) AS batch, CAST(1 AS BIGINT) AS n, CAST(size AS BIGINT) AS b, timestamp AS first FROM o WHERE r = 1
    UNION ALL SELECT o.queue, o.eid, o.r, CASE WHEN {full} THEN batch + 1 ELSE batch END, CASE WHEN {full} THEN 1 ELSE n + 1 END, CASE WHEN {full} THEN o.size ELSE b + o.size END, CASE WHEN {full} THEN o.timestamp ELSE first END
    FROM g JOIN o ON g.queue = o.queue AND o.r = g.r + 1) SELECT * FROM g))
SELECT queue, eid, batch FROM f"""
_WEEK = "date_trunc('week', ts + INTERVAL 1 DAY) - INTERVAL 1 DAY"
_IDS = """SELECT DISTINCT l_orderkey AS id FROM lineitem UNION SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < -500
  UNION SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size = 7"""
_UPD = """u AS (SELECT o_custkey + CASE WHEN o_orderkey % 4 = 0 THEN 1000000000 ELSE 0 END AS c_custkey, 'order ' || o_orderkey AS c_name, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS c_acctbal, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS c_mktsegment, o_orderkey AS seq FROM orders),
  t AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer),
  last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) AS r FROM u) WHERE r = 1)"""
_TRACED = ", e AS (SELECT * REPLACE ('bot_' || (event_id % 7) AS bot) FROM bus)"

SQL = {
    "stream_stats": sql(f"SELECT queue, {_STATS} FROM bus GROUP BY queue"),
    "stats_by_bot_queue": sql(f"SELECT bot, queue, {_STATS} FROM bus GROUP BY bot, queue"),
    "chunk_stats": sql("""SELECT queue, CAST(dt AS VARCHAR) AS dt, bot, CAST(sum(u) AS BIGINT) AS units, max(s) AS source_timestamp, max(t) AS timestamp, max(c) AS checkpoint, coalesce(string_agg(source || '=' || CAST(u AS BIGINT), ',' ORDER BY source), '') AS by_source
      FROM (SELECT queue, dt, bot, source, sum(units) AS u, max(event_source_timestamp) AS s, max(timestamp) AS t, max(start) AS c FROM bus GROUP BY ALL) GROUP BY queue, dt, bot"""),
    "chunk_correlations": sql("SELECT queue, CAST(dt AS VARCHAR) AS dt, source, arg_min(start, eid) AS start, arg_max(start, eid) AS \"end\", CAST(sum(units) AS BIGINT) AS records, max(event_source_timestamp) AS source_timestamp, max(timestamp) AS timestamp FROM bus WHERE source IS NOT NULL GROUP BY queue, dt, source"),
    "range_counts": sql(" UNION ALL ".join(f"SELECT queue, '{name}' AS range, bucket, n, CAST(sum(n) OVER (PARTITION BY queue ORDER BY bucket RANGE BETWEEN {60_000 * stats.GRAINS[g][2] * (c - 1)} PRECEDING AND CURRENT ROW) AS BIGINT) AS range_n FROM (SELECT queue, timestamp - timestamp % {60_000 * stats.GRAINS[g][2]} AS bucket, count(*) AS n FROM rows_ GROUP BY 1, 2)" for name, (g, c) in stats.RANGES.items())),
    "throughput": sql("SELECT queue, timestamp - timestamp % 3600000 AS period, CAST(sum(units) AS BIGINT) AS records, CAST(sum(size) AS BIGINT) AS bytes, round(CASE WHEN max(timestamp) > min(timestamp) THEN sum(units) / ((max(timestamp) - min(timestamp)) / 1000) END, 6) AS rate, max(eid) AS eid FROM rows_ GROUP BY 1, 2"),
    "bucket_rollup": sql(f"""SELECT bot, grain, bucket, count(*) AS n, CAST(sum(units) AS BIGINT) AS units, CAST(sum(size) AS BIGINT) AS bytes FROM (
      SELECT *, 'minute_1' AS grain, 'minute_' || strftime(ts, '%Y-%m-%d %H:%M') AS bucket FROM rows_ UNION ALL SELECT *, 'minute_5', 'minute_5_' || strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M') FROM rows_
      UNION ALL SELECT *, 'minute_15', 'minute_15_' || strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M') FROM rows_ UNION ALL SELECT *, 'hour', 'hour_' || strftime(ts, '%Y-%m-%d %H') FROM rows_
      UNION ALL SELECT *, 'day', 'day_' || strftime(ts, '%Y-%m-%d') FROM rows_ UNION ALL SELECT *, 'week', 'week_' || strftime({_WEEK}, '%Y-%m-%d') FROM rows_) GROUP BY bot, grain, bucket"""),
    "rolling_hour": sql(", q AS (SELECT queue, timestamp - timestamp % 900000 AS quarter, count(*) AS n FROM rows_ GROUP BY 1, 2) SELECT queue, quarter, n, CAST(sum(n) OVER (PARTITION BY queue ORDER BY quarter RANGE BETWEEN 2700000 PRECEDING AND CURRENT ROW) AS BIGINT) AS hour_n FROM q"),
    "reduce_checkpoints": sql(""", w AS (SELECT user_id % 7 AS worker, bot, queue, max(eid) AS checkpoint, count(*) AS records FROM rows_ GROUP BY 1, 2, 3)
      SELECT bot, 'read' AS direction, queue, checkpoint, records FROM (SELECT *, row_number() OVER (PARTITION BY bot, queue ORDER BY checkpoint, worker) AS r FROM w) WHERE r = 1
      UNION ALL SELECT bot, 'write', queue, checkpoint, records FROM w WHERE worker = (SELECT min(worker) FROM w)"""),
    "hash_partition": sql("""SELECT CAST(part AS INTEGER) AS part, count(*) AS n, min(eid) AS first_eid, max(eid) AS last_eid FROM (
      SELECT eid, abs(list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(eid, ''), lambda c: CAST(unicode(c) AS BIGINT))), lambda h, c: ((h * 31 + c + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648)) % 7 AS part FROM rows_) GROUP BY part"""),
    "batch_bytes": sql(_FOLD.format(full="b >= 100")),
    "batch_time": sql(_FOLD.format(full="(n >= 10 OR o.timestamp - first >= 3600000)")),
    "lookup_join": "SELECT o_orderkey, o_custkey, c_name, c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
    "key_fetch": "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000)",
    "find_ids": _IDS,
    "build_entities": """SELECT c_custkey, c_name, n_name AS nation, count(o_orderkey) AS n_orders, coalesce(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey), '') AS order_keys
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""",
    "load_entities": f"""SELECT 'entities' AS id, 'order_entities' AS event, 1710000000000 AS timestamp, '{{"order":' || o_orderkey || ',"parts":[' || coalesce(string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey), '') || ']}}' AS payload
      FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey IN ({_IDS}) GROUP BY o_orderkey""",
    "parent_join": sql("SELECT c.queue, c.eid, c.source, c.start, p.timestamp AS parent_timestamp, c.timestamp - p.timestamp AS lag FROM bus c JOIN bus p ON c.source = p.queue AND c.start = p.eid"),
    "correlation_search": sql(""", p AS (SELECT *, (row_number() OVER (PARTITION BY queue ORDER BY eid) - 1) // 10 AS batch FROM rows_),
      s AS (SELECT queue, min(eid) AS start, CASE WHEN count(*) > 1 THEN max(eid) END AS "end", 'b' || batch AS found FROM p GROUP BY queue, batch)
      SELECT p.queue AS source, eid AS x, start, "end", found FROM p JOIN s ON p.queue = s.queue AND (start = eid OR (start <= eid AND eid <= "end"))"""),
    "checkpoint_asof": sql(""", h AS (SELECT bot, queue, 'hour_' || strftime(ts, '%Y-%m-%d %H') AS b, max(eid) AS checkpoint FROM rows_ GROUP BY ALL),
      m AS (SELECT bot, queue, 'minute_' || strftime(ts, '%Y-%m-%d %H:%M') AS b, max(eid) AS checkpoint FROM rows_ GROUP BY ALL),
      w AS (SELECT r.bot, e.queue, eid, 'hour_' || strftime(ts, '%Y-%m-%d %H') AS bucket FROM rows_ e JOIN (SELECT DISTINCT bot, queue FROM rows_) r ON r.queue = e.queue AND r.bot <> e.bot),
      wh AS (SELECT w.bot, w.queue, w.eid, w.bucket, min(b) AS hour FROM w LEFT JOIN h ON h.bot = w.bot AND h.queue = w.queue AND b >= bucket AND checkpoint >= eid GROUP BY ALL)
      SELECT wh.bot, wh.queue, wh.eid, bucket, hour, min(b) AS minute FROM wh LEFT JOIN m ON m.bot = wh.bot AND m.queue = wh.queue AND b >= 'minute_' || substr(hour, 6) || ':00' AND checkpoint >= eid GROUP BY ALL"""),
    "lineage_edges": sql("SELECT DISTINCT 'queue:' || queue AS source, 'bot:' || bot AS target, 'read' AS direction FROM (SELECT regexp_replace(bot, '^[seb]_', '') AS bot, queue FROM rows_) UNION ALL SELECT DISTINCT 'bot:' || bot, 'queue:out_' || queue, 'write' FROM rows_"),
    "trace_upstream": sql(_TRACED + """, t AS (SELECT * FROM (WITH RECURSIVE r AS (SELECT eid AS root, 0 AS hop, queue, eid, bot, timestamp - event_source_timestamp AS lag, source, start, [bot] AS seen FROM e
      UNION ALL SELECT root, hop + 1, e.queue, e.eid, e.bot, e.timestamp - e.event_source_timestamp, e.source, e.start, list_append(seen, e.bot) FROM r JOIN e ON r.source = e.queue AND r.start = e.eid WHERE NOT list_contains(seen, e.bot)) SELECT * FROM r))
      SELECT root, hop, queue, eid, bot, lag FROM t"""),
    "trace_downstream": sql(""", rd AS (SELECT * FROM cps WHERE (CAST(bot[5:5] AS INT) + length(queue)) % 2 = 0), wr AS (SELECT DISTINCT bot, ['click', 'error', 'purchase', 'signup', 'view'][(CAST(bot[5:5] AS INT) * 2 + 1) % 5 + 1] AS queue FROM rows_),
      walk AS (SELECT * FROM (WITH RECURSIVE d AS (SELECT eid AS root, 0 AS depth, queue, event_source_timestamp AS est, [queue] AS path FROM bus
        UNION ALL SELECT DISTINCT d.root, d.depth + 1, wr.queue, d.est, list_append(d.path, wr.queue) FROM d JOIN rd ON rd.queue = d.queue AND rd.checkpoint > d.root JOIN wr ON wr.bot = rd.bot WHERE NOT list_contains(d.path, wr.queue)) SELECT * FROM d)),
      first AS (SELECT root, queue, min(depth) AS depth, any_value(est) AS est FROM walk GROUP BY root, queue)
      SELECT root, depth, f.queue, bot, checkpoint > root AS has_processed, CASE WHEN checkpoint > root THEN 0 ELSE source_timestamp - est END AS lag FROM first f JOIN rd ON rd.queue = f.queue"""),
    "trace_path": sql(""", s1 AS (SELECT 'stage_1' AS queue, strftime(max(ts), 'z/%Y/%m/%d/%H/%M/') || max(timestamp) || '-' || right('0000000' || max(event_id), 7) AS eid, max(timestamp) AS timestamp, min(timestamp) AS est, queue AS source, min(eid) AS start, CASE WHEN count(*) > 1 THEN max(eid) END AS "end", max(event_id) AS event_id
        FROM rows_ GROUP BY rows_.queue, user_id % 5, timestamp // 60000),
      s2 AS (SELECT 'stage_2' AS queue, strftime(make_timestamp(max(timestamp) * 1000), 'z/%Y/%m/%d/%H/%M/') || max(timestamp) || '-' || right('0000000' || max(event_id), 7) AS eid, max(timestamp) AS timestamp, min(timestamp) AS est, 'stage_1' AS source, min(eid) AS start, CASE WHEN count(*) > 1 THEN max(eid) END AS "end" FROM s1 GROUP BY timestamp // 60000),
      cp AS (SELECT queue, timestamp // 60000 AS m, timestamp // 3600000 AS h, max(eid) AS c FROM (SELECT queue, eid, timestamp FROM rows_ UNION ALL SELECT queue, eid, timestamp FROM s1) GROUP BY ALL),
      hop1 AS (SELECT e.eid AS root, e.queue, e.eid, e.timestamp, (SELECT min(h) FROM cp WHERE cp.queue = e.queue AND h >= e.timestamp // 3600000 AND c >= e.eid) AS h FROM rows_ e),
      at1 AS (SELECT *, greatest(timestamp, 60000 * (SELECT min(m) FROM cp WHERE cp.queue = hop1.queue AND m >= hop1.h * 60 AND c >= hop1.eid)) // 1000 * 1000 AS b FROM hop1),
      f1 AS (SELECT root, arg_min(s.eid, s.eid) AS eid, arg_min(s.timestamp, s.eid) AS timestamp, arg_min(s.timestamp - est, s.eid) AS lag FROM at1 a JOIN s1 s ON s.source = a.queue AND s.timestamp BETWEEN b AND b + 60000 AND (s.start = a.eid OR (s.start <= a.eid AND a.eid <= s."end")) GROUP BY root),
      hop2 AS (SELECT root, eid, timestamp, (SELECT min(h) FROM cp WHERE queue = 'stage_1' AND h >= f1.timestamp // 3600000 AND c >= f1.eid) AS h FROM f1),
      at2 AS (SELECT *, greatest(timestamp, 60000 * (SELECT min(m) FROM cp WHERE queue = 'stage_1' AND m >= hop2.h * 60 AND c >= hop2.eid)) // 1000 * 1000 AS b FROM hop2),
      f2 AS (SELECT root, min(s.eid) AS eid, arg_min(s.timestamp - est, s.eid) AS lag FROM at2 a JOIN s2 s ON s.timestamp BETWEEN b AND b + 60000 AND (s.start = a.eid OR (s.start <= a.eid AND a.eid <= s."end")) GROUP BY root)
      SELECT root, 1 AS hop, 'reader' AS bot, 'stage_1' AS queue, eid, lag FROM f1 UNION ALL SELECT root, 2, 'joiner', 'stage_2', eid, lag FROM f2"""),
    "keyed_upsert": f"WITH {_UPD} SELECT c_custkey, CASE WHEN r IS NULL THEN t.c_name ELSE last.c_name END AS c_name, CASE WHEN r IS NULL THEN t.c_acctbal ELSE last.c_acctbal END AS c_acctbal, CASE WHEN r IS NULL THEN t.c_mktsegment ELSE last.c_mktsegment END AS c_mktsegment FROM t FULL JOIN last USING (c_custkey)",
    "merge_upsert": f"WITH {_UPD}, n AS (SELECT c_custkey, arg_max(c_name, seq) AS a, arg_max(c_acctbal, seq) FILTER (c_acctbal IS NOT NULL) AS b, arg_max(c_mktsegment, seq) FILTER (c_mktsegment IS NOT NULL) AS c FROM u GROUP BY 1) SELECT c_custkey, coalesce(a, c_name) AS c_name, coalesce(b, c_acctbal) AS c_acctbal, coalesce(c, c_mktsegment) AS c_mktsegment FROM t FULL JOIN n USING (c_custkey)",
    "dedup_latest": "SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r = 1",
    "write_once_update": f"WITH {_UPD} SELECT c_custkey, coalesce(t.c_name, last.c_name) AS c_name, coalesce(last.c_acctbal, t.c_acctbal) AS c_acctbal, coalesce(t.c_mktsegment, last.c_mktsegment) AS c_mktsegment FROM t FULL JOIN last USING (c_custkey)",
    "io_audit": sql("""SELECT bot, 'write' AS direction, 'system.warehouse' AS queue, count(*) AS records, '{"records":' || count(*) || '}' AS payload FROM rows_ GROUP BY bot"""),
    "advance_checkpoints": sql(""", s AS (SELECT * FROM cps WHERE bot <> 'bot_3'), n AS (SELECT bot, queue, max(eid) AS eid FROM rows_ GROUP BY 1, 2),
      p AS (SELECT n.bot, n.queue, checkpoint AS old, CASE WHEN n.bot IN ('bot_1', 'bot_2') THEN 'z/2020' ELSE checkpoint END AS expected, CASE WHEN n.bot <> 'bot_4' THEN eid END AS eid, n.bot = 'bot_2' AS force FROM n LEFT JOIN s ON n.bot = s.bot AND n.queue = s.queue)
      SELECT bot, 'read' AS direction, queue, CASE WHEN ok THEN 'applied' ELSE 'stale' END AS status, CASE WHEN ok THEN coalesce(eid, expected) ELSE old END AS checkpoint FROM (SELECT *, old IS NULL OR force OR expected IS NOT DISTINCT FROM old AS ok FROM p)"""),
    "bot_backlog": sql(""", r AS (SELECT x.bot, x.queue, checkpoint FROM (SELECT DISTINCT bot, queue FROM rows_) x LEFT JOIN cps c ON x.bot = c.bot AND x.queue = c.queue AND c.bot <> 'bot_3')
      SELECT r.bot, r.queue, checkpoint IS NULL OR max(eid) > checkpoint AS has_more, count(*) FILTER (checkpoint IS NULL OR eid > checkpoint) AS pending FROM r JOIN rows_ e ON e.queue = r.queue GROUP BY r.bot, r.queue, checkpoint"""),
}
