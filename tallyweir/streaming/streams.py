"""Streaming forms. Each runs with availableNow and gives the batch form's rows; outputs are written per batch id, so a
repeated batch overwrites itself."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..sources.formats import append_batch
from ..sources.shared import cut, new_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int = 8) -> DataFrame:
    """A table's file (or folder of files) as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{sf_dir}/{name}.parq*t")


def deal(rows: DataFrame, files: int = 4) -> DataFrame:
    """A table dealt into files, as a stream with one of them in each micro-batch."""
    path = new_path(rows.sparkSession, "dealt")
    rows.repartition(files).write.parquet(path)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _read_through(query: StreamingQuery, seconds: float | None) -> None:
    """Wait until the stream has been read. Where seconds are given and pass before that, it is stopped and raises."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"the stream was not read through after {seconds} seconds")


def deal_in_order(rows: DataFrame, by: str, files: int = 4) -> DataFrame:
    """A table dealt into files by ranges of a column, written one after the other, as a stream with one of them in each
    micro-batch."""
    spark, path = rows.sparkSession, new_path(rows.sparkSession, "dealt")
    ranged = cut(rows.repartitionByRange(files, by).withColumn("_file", F.spark_partition_id()))
    for k in range(files):
        ranged.where(F.col("_file") == k).drop("_file").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(path)


class Limits(NamedTuple):
    """What a run does at most; null: no limit. The micro-batch that reaches one is finished."""

    batches: int | None = None
    records: int | None = None
    seconds: float | None = None


class Progress(NamedTuple):
    batches: int
    records: int
    #: Whether the stream was read through; else a limit was reached, and the next run goes on from there.
    ended: bool


_LIMIT = "a limit of the run is reached"


def run_limited(stream: DataFrame, step: Callable[[DataFrame], DataFrame], path: str, limits: Limits) -> Progress:
    """step over micro-batches until a limit is reached, each written under its number in path/out. A later run on the same
    path goes on after the last one that was finished: where the stream stands is kept there. A batch that the
    limit stops has not begun, and one that was broken off is written over by its repeat, so each row is there once."""
    seen, began = [0, 0], time.monotonic()

    def sink(batch: DataFrame, number: int) -> None:
        over = [limits.batches is not None and seen[0] >= limits.batches, limits.records is not None and seen[1] >= limits.records, limits.seconds is not None and time.monotonic() - began >= limits.seconds]
        if any(over):
            raise RuntimeError(_LIMIT)
        told = Observation()
        append_batch(step(batch.observe(told, F.count(F.lit(1)).alias("n"))), f"{path}/out", number)
        seen[0], seen[1] = seen[0] + 1, seen[1] + told.get["n"]

    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException as e:
        if _LIMIT not in str(e):
            raise
        return Progress(*seen, False)
    return Progress(*seen, True)


def run_batches(stream: DataFrame, step: Callable[[DataFrame], DataFrame], on_batch: Callable[[int, DataFrame], None] | None = None, seconds: float | None = None) -> DataFrame:
    """step over each micro-batch, written under its batch id; the whole output when the stream has been read, however
    long that takes, or an error after seconds.
    on_batch(batch, output) is the checkpoint hook; it is called after the output is written."""
    spark = stream.sparkSession
    path = new_path(spark, "stream")
    schema = step(spark.createDataFrame([], stream.schema)).schema

    def sink(batch: DataFrame, number: int) -> None:
        append_batch(step(batch), f"{path}/out", number)
        if on_batch:
            on_batch(number, spark.read.schema(schema).parquet(f"{path}/out/batch={number}"))

    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    _read_through(query, seconds)
    return spark.read.schema(schema).parquet(f"{path}/out").drop("batch") if "batch" not in schema.names else spark.read.schema(schema).parquet(f"{path}/out")


BATCH = "queue string, seq long, start string, end string, n long, bytes long, closed string"


def limited_batches(count: int | None, size: int | None, millis: int | None) -> StatefulProcessor:
    """A processor that closes batches per queue once they have count events or size bytes (the crossing event is in), or
    before an event millis or more after the first one, or when the watermark has come that far. Its state is the open
    batch, in seven values, and is given up when that closes by time. The class is made here, so that it travels by value to
    workers that don't have this package."""

    class LimitedBatches(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.open = handle.getValueState("open", "seq long, n long, bytes long, first long, start string, last string")
            self.next = handle.getValueState("next", "seq long")

        def _close(self, key, batch, why) -> dict:
            if millis and batch[1]:
                self.handle.deleteTimer(batch[3] + millis)
            seq, n, size_, _, start, last = batch
            return {"queue": key[0], "seq": seq, "start": start, "end": last, "n": n, "bytes": size_, "closed": why}

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            empty = lambda seq: (seq, 0, 0, 0, "", "")
            batch = tuple(self.open.get()) if self.open.exists() else empty(self.next.get()[0] if self.next.exists() else 0)
            data, out, timed = pd.concat(list(rows)).sort_values("eid", kind="stable"), [], batch[3] if batch[1] else None
            for eid, s, at in zip(data["eid"], data["size"], data["at"], strict=True):
                if millis and batch[1] and at - batch[3] >= millis:
                    out.append(self._close(key, batch, "time"))
                    batch = empty(batch[0] + 1)
                seq, n, total, first, start, _ = batch
                batch = (seq, n + 1, total + int(s), first if n else int(at), start if n else eid, eid)
                if (count and batch[1] >= count) or (size and batch[2] >= size):
                    out.append(self._close(key, batch, "count" if count and batch[1] >= count else "bytes"))
                    batch = empty(batch[0] + 1)
            self.next.update((batch[0],))
            if batch[1]:
                self.open.update(batch)
                if millis and batch[3] != timed:
                    self.handle.registerTimer(batch[3] + millis)
            else:
                self.open.clear()
            yield pd.DataFrame(out, columns=["queue", "seq", "start", "end", "n", "bytes", "closed"])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            out = []
            if self.open.exists() and (batch := tuple(self.open.get()))[3] + millis <= expiredTimerInfo.getExpiryTimeInMs():
                seq, n, total, _, start, last = batch
                out = [{"queue": key[0], "seq": seq, "start": start, "end": last, "n": n, "bytes": total, "closed": "time"}]
                self.next.update((seq + 1,))
                self.open.clear()
            yield pd.DataFrame(out, columns=["queue", "seq", "start", "end", "n", "bytes", "closed"])

        def close(self) -> None:
            pass

    return LimitedBatches()


def timed_batches(stream: DataFrame, count: int | None = None, size: int | None = None, millis: int | None = None, delay: str = "1 minute", path: str | None = None, seconds: float | None = None) -> DataFrame:
    """queue, seq, start, end, n, bytes and closed (count, bytes or time: which limit came first) of the batches of a stream of
    events (queue, eid, size, ts) in eid order per queue. An event that comes when the watermark (the newest time seen in earlier
    micro-batches less delay) has reached its time is too late, and left out. A batch still open when the
    stream has been read stays in the state under path, and goes on with the next run. A queue's rows of one micro-batch are held
    by one task: the source's limits on a micro-batch bound it."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    path = path or new_path(spark, "stream")
    rows = stream.select("queue", "eid", F.coalesce("size", F.lit(0)).cast("long").alias("size"), F.col("ts").cast("timestamp").alias("ts"))
    rows = rows.withColumn("at", F.unix_millis("ts")).withWatermark("ts", delay)
    out = rows.groupBy("queue").transformWithStateInPandas(statefulProcessor=limited_batches(count, size, millis), outputStructType=BATCH, outputMode="Append", timeMode="EventTime")
    query = out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start()
    _read_through(query, seconds)
    return spark.read.schema(BATCH).parquet(f"{path}/out")


def byte_batches(limit: int) -> StatefulProcessor:
    """A processor that numbers batches per key by bytes, over micro-batches; its state is (batch, bytes so far). The
    class is made here, so that it travels by value to workers that don't have this package."""

    class ByteBatches(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.state = handle.getValueState("at", "batch long, bytes long")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            batch, size = self.state.get() if self.state.exists() else (0, 0)
            data = pd.concat(list(rows)).sort_values("eid", kind="stable")
            out = []
            for s in data["size"]:
                if size >= limit:
                    batch, size = batch + 1, 0
                size += int(s)
                out.append(batch)
            self.state.update((batch, size))
            yield pd.DataFrame({"queue": key[0], "eid": data["eid"].to_numpy(), "seq": out})

        def close(self) -> None:
            pass

    return ByteBatches()


def batch_stream(stream: DataFrame, limit: int, seconds: float | None = None) -> DataFrame:
    """queue, eid and seq (the byte batch) of a stream of events (queue, eid, size) in eid order per queue; the whole
    output, or an error after seconds."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)  # value states need it
    path = new_path(spark, "stream")
    out = stream.select("queue", "eid", "size").groupBy("queue").transformWithStateInPandas(statefulProcessor=byte_batches(limit), outputStructType="queue string, eid string, seq long", outputMode="Append", timeMode="None")
    query = out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start()
    _read_through(query, seconds)
    return spark.read.schema("queue string, eid string, seq long").parquet(f"{path}/out")
