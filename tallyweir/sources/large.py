"""Events whose JSON is too large for the table: their bodies lie apart, and the table has a pointer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.process import LARGE_BYTES, route_by_size


def write_large(events: DataFrame, path: str, payload: str = "payload", limit: int = LARGE_BYTES) -> None:
    """Write events under path: those whose JSON is over limit bytes without their payload but with body (its digest) and
    body_part, and each distinct large payload once, by part. A null payload is in no body."""
    routed = route_by_size(events, F.to_json(F.struct(*events.columns)), limit)
    away = (F.col("route") == "file") & F.col(payload).isNotNull()
    ref = F.when(away, F.sha2(F.col(payload).cast("string"), 256))
    rows = routed.withColumns({"body": ref, "body_part": F.left(ref, F.lit(2))}).drop("route", "json_size")
    rows.withColumn(payload, F.when(F.col("body").isNull(), F.col(payload))).write.mode("overwrite").parquet(f"{path}/events")
    bodies = rows.where("body is not null").groupBy("body_part", "body").agg(F.first(payload).alias("content"))
    bodies.write.mode("overwrite").partitionBy("body_part").parquet(f"{path}/bodies")


def read_large(spark: SparkSession, path: str, payload: str = "payload") -> DataFrame:
    """The events with their payloads. Only events with a pointer are joined, with the parts that they point to."""
    rows = spark.read.parquet(f"{path}/events")
    schema = f"body string, content {rows.schema[payload].dataType.simpleString()}, body_part string"
    names = [c for c in rows.columns if c not in ("body", "body_part")]
    apart = rows.where("body is not null").drop(payload).join(spark.read.schema(schema).parquet(f"{path}/bodies").withColumnRenamed("content", payload), ["body_part", "body"])
    return rows.where("body is null").select(*names).unionByName(apart.select(*names))
