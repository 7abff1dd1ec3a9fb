"""Bus tables derived from the given tables, by expressions that SQL can repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.eid import build_eid, utc_millis
from .bus import stored_bus


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_events(events: DataFrame) -> DataFrame:
    """queue, eid, bot, timestamp, payload, size, units, dt, k and the columns of events, row by row."""
    ms = utc_millis(F.col("ts"))
    return events.select(
        "event_id", "user_id", "value", F.col("event_type").alias("queue"), F.concat(F.lit("bot_"), (F.col("user_id") % 5).cast("string")).alias("bot"), ms.alias("timestamp"),
        build_eid(ms, F.col("event_id")).alias("eid"), F.col("props").alias("payload"), F.octet_length("props").cast("long").alias("size"), F.lit(1).cast("long").alias("units"),
        F.to_date("ts").alias("dt"), F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


ROW = ["event_id", "user_id", "value", "queue", "bot", "timestamp", "eid", "payload", "size", "units", "dt", "k"]


def bus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bus_events(spark, sf_dir).select(*ROW)


def bus_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored bus table of the given events."""
    return stored_bus(spark, sf_dir, lambda: with_parents(from_events(table(spark, sf_dir, "events"))))


def with_parents(rows: DataFrame) -> DataFrame:
    """rows with event_source_timestamp and the parent (source, start): the same user's event before; a signup has none."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    linked = F.col("queue") != "signup"
    return rows.withColumns({
        "source": F.when(linked, F.lag("queue").over(w)), "start": F.when(linked, F.lag("eid").over(w)),
        "event_source_timestamp": F.coalesce(F.lag("timestamp").over(w), "timestamp"),
    })


def checkpoints(events: DataFrame) -> DataFrame:
    """Where each bot stands in each queue: after its last event whose id divides by 3."""
    return events.where("event_id % 3 = 0").groupBy("bot", "queue").agg(F.max("eid").alias("checkpoint"), F.count(F.lit(1)).alias("records"), F.min("timestamp").alias("source_timestamp"), F.max("timestamp").alias("ended_timestamp"))


#: The same in DuckDB's SQL.
BUS = """
rows_ AS (
  SELECT event_id, user_id, value, event_type AS queue, 'bot_' || (user_id % 5) AS bot, epoch_us(ts) // 1000 AS timestamp,
    strftime(ts, 'z/%Y/%m/%d/%H/%M/') || (epoch_us(ts) // 1000) || '-' || right('0000000' || event_id, 7) AS eid, props AS payload,
    CAST(strlen(props) AS BIGINT) AS size, CAST(1 AS BIGINT) AS units, CAST(ts AS DATE) AS dt, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
bus AS (
  SELECT *, CASE WHEN queue <> 'signup' THEN lag(queue) OVER w END AS source, CASE WHEN queue <> 'signup' THEN lag(eid) OVER w END AS start,
    coalesce(lag(timestamp) OVER w, timestamp) AS event_source_timestamp
  FROM rows_ WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
cps AS (
  SELECT bot, queue, max(eid) AS checkpoint, count(*) AS records, min(timestamp) AS source_timestamp, max(timestamp) AS ended_timestamp
  FROM rows_ WHERE event_id % 3 = 0 GROUP BY bot, queue)
"""


def sql(body: str) -> str:
    """A query over bus, rows_ and cps; body may go on with more CTEs after a leading comma."""
    body = body.strip()
    return f"WITH {BUS}{body}" if body.startswith(",") else f"WITH {BUS} {body}"
