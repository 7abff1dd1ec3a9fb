"""The stored bus table: events by queue and day, in order of their ids inside a file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .shared import exists, new_path

#: (application, name of the table) -> its folder and schema.
_STORED: dict[tuple[str, str], tuple[str, StructType]] = {}


def write_bus(events: DataFrame, path: str) -> None:
    """Write events (queue, dt, eid, ...) as folders of a queue and a day. Rows are dealt by ranges of (queue, day, id), so a hot
    day is many files, each with the ids of its own range, which its statistics tell a reader."""
    rows = events.repartitionByRange("queue", "dt", "eid").sortWithinPartitions("queue", "dt", "eid")
    rows.write.partitionBy("queue", "dt").parquet(path)


def read_bus(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored bus table: filters on queue and dt choose folders, filters on eid the row groups of files."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def stored_bus(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The bus table of this name, which is written the first time that an application asks for it."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _STORED or not exists(spark, f"{_STORED[key][0]}/_SUCCESS"):
        events, path = make(), new_path(spark, "bus")
        write_bus(events, path)
        _STORED[key] = (path, events.schema)
    return read_bus(spark, *_STORED[key])
