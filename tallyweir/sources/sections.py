"""Files of gzip sections: each section is a gzip member of its own, and an index beside the file says where it lies, so that a
reader of a range of ids opens only the sections that hold some of it."""

from __future__ import annotations

import gzip
import io
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Sections of a file, events and bytes of a section, at most.
SECTIONS, RECORDS, BYTES = 10, 10_000, 10_000_000
INDEX = "queue string, file string, section int, start string, end string, records long, offset long, size long, gzip_offset long, gzip_size long"


def _at(path: str):
    """(file system, path in it) of a path in the shared folder, for use inside tasks."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


class _Files(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class SectionFiles(DataSource):
    """format("sections"): writes rows (queue, eid, line), in the order in which a task gets them.

    A task writes its files under names of its own, and what a lost one has begun is written over by its repeat; a write that
    fails as a whole deletes its files. Options: path, records, sections, bytes."""

    @classmethod
    def name(cls) -> str:
        return "sections"

    def schema(self) -> str:
        return "queue string, eid string, line string"

    def writer(self, schema, overwrite: bool):
        return _SectionWriter(self.options)


class _SectionWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"]
        self.records, self.sections, self.bytes = (int(options.get(k, v)) for k, v in (("records", RECORDS), ("sections", SECTIONS), ("bytes", BYTES)))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Files:
        fs, root = _at(self.path)
        fs.create_dir(root, recursive=True)
        part, names = TaskContext.get().partitionId(), []
        out, name, index = None, "", []
        queue, ids, lines, size = None, [], [], 0

        def section() -> None:
            nonlocal out, name, ids, lines, size
            if not lines:
                return
            if out is None:
                name = f"part-{part:05d}-{len(names):05d}.gz"
                names.append(name)
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            body = "".join(x + "\n" for x in lines).encode()
            packed = gzip.compress(body, mtime=0)
            last = index[-1] if index else {"offset": 0, "records": 0, "gzip_offset": 0, "gzip_size": 0}
            index.append({
                "queue": queue, "file": name, "section": len(index), "start": ids[0], "end": ids[-1], "records": len(ids), "offset": last["offset"] + last["records"], "size": len(body),
                "gzip_offset": last["gzip_offset"] + last["gzip_size"], "gzip_size": len(packed),
            })
            out.write(packed)
            ids, lines, size = [], [], 0
            if len(index) == self.sections:
                close()

        def close() -> None:
            nonlocal out
            if out is None:
                return
            out.close()
            with fs.open_output_stream(f"{root}/{name}.index", compression=None) as f:
                f.write("".join(json.dumps(x) + "\n" for x in index).encode())
            out = None
            index.clear()

        for batch in iterator:
            for q, eid, line in zip(*(batch.column(c).to_pylist() for c in ("queue", "eid", "line")), strict=True):
                if q != queue:  # a file is of one queue
                    section()
                    close()
                    queue = q
                ids.append(eid)
                lines.append(line)
                size += len(line)
                if len(ids) == self.records or size >= self.bytes:
                    section()
        section()
        close()
        return _Files(names)

    def commit(self, messages: list[_Files | None]) -> None:
        fs, root = _at(self.path)
        fs.create_dir(root, recursive=True)
        fs.open_output_stream(f"{root}/_SUCCESS").close()

    def abort(self, messages: list[_Files | None]) -> None:
        fs, root = _at(self.path)
        for m in messages:
            for name in m.names if m else ():
                for file in (f"{root}/{name}", f"{root}/{name}.index"):
                    if fs.get_file_info(file).is_file:
                        fs.delete_file(file)


def write_sections(events: DataFrame, path: str, records: int = RECORDS, sections: int = SECTIONS) -> None:
    """Write events (queue, eid, ...) as JSON lines in gzip sections under path, in order of (queue, eid). Rows are dealt by ranges
    of it, so a hot queue is many files."""
    events.sparkSession.dataSource.register(SectionFiles)
    line = F.to_json(F.struct(*(c for c in events.columns if c != "queue")))
    rows = events.select("queue", "eid", line.alias("line")).repartitionByRange("queue", "eid").sortWithinPartitions("queue", "eid")
    rows.write.format("sections").option("records", records).option("sections", sections).mode("append").save(path)


def section_index(spark: SparkSession, path: str) -> DataFrame:
    """A row for each section: queue, file, section, start, end, records, offset (records of the file before it), size,
    gzip_offset and gzip_size (where its member lies in the file, in bytes)."""
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.index").json(path)


def read_sections(spark: SparkSession, path: str, schema: str, queue: str | None = None, after: str | None = None, upto: str | None = None) -> DataFrame:
    """queue, the columns of schema (eid among them), file and section of the events with after < eid <= upto of a queue (null:
    all). Only sections that hold such ids are opened, and of a file only their bytes are read: neighbours in one go."""
    hit = section_index(spark, path)
    for bound in ([F.col("queue") == queue] if queue else []) + ([F.col("end") > after] if after else []) + ([F.col("start") <= upto] if upto else []):
        hit = hit.where(bound)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _at(path)
        for batch in batches:
            for q, file, section, at, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with fs.open_input_file(f"{root}/{file}") as f:
                    body = f.read_at(n, at)
                found = [x.decode().removesuffix("\n") for x in gzip.GzipFile(fileobj=io.BytesIO(body))]
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(found), pa.string()), pa.array([file] * len(found), pa.string()), pa.array([section] * len(found), pa.int32()), pa.array(found, pa.string())], names=["queue", "file", "section", "line"])

    rows = hit.select("queue", "file", "section", "gzip_offset", "gzip_size").repartition("file", "section").mapInArrow(lines, "queue string, file string, section int, line string")
    out = rows.select("queue", F.from_json("line", schema).alias("e"), "file", "section").select("queue", "e.*", "file", "section")
    for bound in ([F.col("eid") > after] if after else []) + ([F.col("eid") <= upto] if upto else []):
        out = out.where(bound)
    return out
