"""Sinks to outside systems that take a part of what they are given: only the rows that failed are written again."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from .sections import _at


class Sent(WriterCommitMessage):
    """What a task tells the driver: how many rows went and failed, and the file that holds those that failed."""

    def __init__(self, sent: int, failed: int, file: str | None):
        self.sent, self.failed, self.file = sent, failed, file


class OutsideSink(DataSource):
    """format("outside"): sends rows in batches by send(rows, try, task) -> the places of those that failed. Subclass and set send.

    Options: path (a shared folder), number (of the try), batch (rows of a call), tries (in a task, for streams, with Fibonacci
    pauses of pause seconds and more). Rows that fail are written beside path by the task; commit leaves the numbers there. A
    lost task sends again, so send must take a repeat of a (try, task)."""

    send: Callable[[list[dict], int, int], list[int]]

    @classmethod
    def name(cls) -> str:
        return "outside"

    def writer(self, schema, overwrite: bool):
        return _Writer(self.options, type(self).send, schema)

    def streamWriter(self, schema, overwrite: bool):
        return _StreamWriter(self.options, type(self).send, schema)


class _Sender:
    def __init__(self, options, send, schema):
        self.path, self.number = options["path"], int(options.get("number", 0))
        self.batch, self.tries, self.pause = int(options.get("batch", 500)), int(options.get("tries", 1)), float(options.get("pause", 0.001))
        self.send = send

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        task, sent, failed, out, file = TaskContext.get().partitionId(), 0, 0, None, None
        fs, root = _at(self.path)
        for given in iterator:
            for at in range(0, given.num_rows, self.batch):
                part, pause, following = given.slice(at, self.batch), self.pause, self.pause
                for k in range(self.tries):
                    if k:
                        time.sleep(min(pause, 1.0))
                        pause, following = following, pause + following
                    bad = self.send(part.to_pylist(), self.number + k, task)
                    sent += part.num_rows - len(bad)
                    part = part.take(pa.array(sorted(bad), pa.int64()))
                    if not part.num_rows:
                        break
                if part.num_rows:
                    if out is None:
                        folder = f"{root}/failed/number={self.number}"
                        fs.create_dir(folder, recursive=True)
                        file = f"{folder}/part-{task:05d}.parquet"
                        out = pq.ParquetWriter(file, part.schema, filesystem=fs)
                    out.write_batch(part)
                    failed += part.num_rows
        if out:
            out.close()
        return Sent(sent, failed, file)

    def _commit(self, messages: list[Sent | None], number: int) -> None:
        fs, root = _at(self.path)
        fs.create_dir(f"{root}/commits", recursive=True)
        done = [m for m in messages if m]
        with fs.open_output_stream(f"{root}/commits/{number}.json", compression=None) as f:
            f.write(json.dumps({"sent": sum(m.sent for m in done), "failed": sum(m.failed for m in done)}).encode())

    def _abort(self, messages: list[Sent | None]) -> None:
        fs, _ = _at(self.path)
        for m in messages:
            if m and m.file and fs.get_file_info(m.file).is_file:
                fs.delete_file(m.file)


class _Writer(_Sender, DataSourceArrowWriter):
    def commit(self, messages):
        self._commit(messages, self.number)

    def abort(self, messages):
        self._abort(messages)


class _StreamWriter(_Sender, DataSourceStreamArrowWriter):
    """A micro-batch whose rows still fail after the tries of their tasks fails, and is sent again when the stream goes on."""

    def commit(self, messages, batchId):
        if any(m and m.failed for m in messages):
            raise RuntimeError(f"{sum(m.failed for m in messages if m)} rows failed in batch {batchId}")
        self._commit(messages, batchId)

    def abort(self, messages, batchId):
        self._abort(messages)


def send_all(rows: DataFrame, sink: type[OutsideSink], path: str, tries: int = 10, batch: int = 500, delay: float = 0.001, most: float = 1.0) -> int:
    """Send rows to a sink, and then only those that failed, with Fibonacci pauses of delay seconds and more up to most. Gives the
    number of tries; raises when rows are left after all. path: a new shared folder, which keeps what failed in each try."""
    spark, pause, following = rows.sparkSession, delay, delay
    spark.dataSource.register(sink)
    schema = rows.schema
    for number in range(tries):
        rows.write.format(sink.name()).option("number", number).option("batch", batch).mode("append").save(path)
        told = json.loads(spark.read.text(f"{path}/commits/{number}.json").first().value)
        if not told["failed"]:
            return number + 1
        rows = spark.read.schema(schema).parquet(f"{path}/failed/number={number}")
        time.sleep(min(pause, most))
        pause, following = following, pause + following
    raise RuntimeError(f"{told['failed']} rows failed after {tries} tries")
