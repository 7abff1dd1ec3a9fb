"""Bots over streams: each micro-batch's output and checkpoint are written under its batch id, so a batch that is
repeated overwrites both and changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bots import Worked, latest
from ..sources.formats import append_batch
from ..sources.shared import exists, new_path, remove
from .streams import _read_through

CHECKPOINT = "bot string, queue string, checkpoint string, records long, source_timestamp long, ended_timestamp long"
#: Called after each batch with its number, what went wrong (or None), and the batch's checkpoints (or None).
Hook = Callable[[int, "Exception | None", "DataFrame | None"], None]


class BotRun:
    """A bot's output and checkpoints under one folder."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or new_path(spark, "bot")
        self.schema = None

    def write(self, number: int, worked: Worked, hook: Hook | None = None) -> None:
        """One batch: output first, then the checkpoint; the hook sees what was written. If the output can't be
        written the hook gets the error, no checkpoint moves, and the error goes on. What both are taken from is written before
        them, so the source is read and the transform run once, and the checkpoint is that of the output's rows."""
        self.schema = worked.output.schema
        work = f"{self.path}/work/batch={number}"
        try:
            output, checkpoints = worked.output, worked.checkpoints
            if worked.rows is not None:
                worked.rows.write.mode("overwrite").parquet(work)
                output, checkpoints = worked.split(self.spark.read.schema(worked.rows.schema).parquet(work))
            append_batch(output, f"{self.path}/out", number)
        except Exception as e:
            if hook:
                hook(number, e, None)
            raise
        append_batch(checkpoints, f"{self.path}/checkpoints", number)
        remove(self.spark, work)
        if hook:
            hook(number, None, self.spark.read.schema(CHECKPOINT).parquet(f"{self.path}/checkpoints/batch={number}"))

    def output(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/out").select(*self.schema.names)

    def checkpoints(self) -> DataFrame:
        return latest(self.spark.read.schema(CHECKPOINT).parquet(f"{self.path}/checkpoints"))


def run_bot(stream: DataFrame, step: Callable[[DataFrame], Worked], hook: Hook | None = None, seconds: float | None = None, path: str | None = None) -> BotRun:
    """step over each micro-batch of a stream until it has been read, or an error after seconds."""
    run = BotRun(stream.sparkSession, path)
    run.schema = step(stream.sparkSession.createDataFrame([], stream.schema)).output.schema
    query = stream.writeStream.foreachBatch(lambda batch, number: run.write(number, step(batch), hook)).option("checkpointLocation", f"{run.path}/state").trigger(availableNow=True).start()
    _read_through(query, seconds)
    return run


class ManualCheckpoint:
    """Checkpoints that are kept back until flush(): add() notes what has been read, and a run that ends before it
    flushes reads that again. Numbers are taken from what is stored, so a later object on the same path goes on from there: what
    was noted and not flushed by an earlier one is dropped."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or new_path(spark, "manual")
        self.parts = self.flushed = self._flushed()

    def _flushed(self) -> int:
        """How many parts have been flushed: the largest number of a stored checkpoint."""
        if not exists(self.spark, f"{self.path}/checkpoints"):
            return 0
        return self.spark.read.schema(f"{CHECKPOINT}, batch int").parquet(f"{self.path}/checkpoints").agg(F.coalesce(F.max("batch"), F.lit(0))).first()[0]

    def add(self, checkpoints: DataFrame) -> None:
        append_batch(checkpoints, f"{self.path}/noted", self.parts)
        self.parts += 1

    def flush(self) -> None:
        """Commit all that was noted since the last flush, as one batch; nothing new commits nothing."""
        if self.parts > self.flushed:
            noted = self.spark.read.schema(f"{CHECKPOINT}, batch int").parquet(f"{self.path}/noted").where(f"batch >= {self.flushed} and batch < {self.parts}")
            append_batch(latest(noted), f"{self.path}/checkpoints", self.parts)
            self.flushed = self.parts

    def checkpoints(self) -> DataFrame:
        """Where the bot stands: what was flushed."""
        if not self.flushed:
            return self.spark.createDataFrame([], CHECKPOINT)
        return latest(self.spark.read.schema(CHECKPOINT).parquet(f"{self.path}/checkpoints"))
