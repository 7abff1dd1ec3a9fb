"""Files of events: JSON lines, CSV, gzip chunks, archives, manifests, and sources that are polled."""

from __future__ import annotations

import gzip
import io
import json
import time
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.eid import build_eid
from ..operators.batching import number_batches
from ..operators.process import to_envelope
from .shared import cut, new_path


def write_jsonl(rows: DataFrame, path: str | None = None, compression: str = "gzip") -> str:
    path = path or new_path(rows.sparkSession, "jsonl")
    rows.write.json(path, compression=compression)
    return path


def read_jsonl(spark: SparkSession, path: str, schema: str, skip_errors: bool = False) -> DataFrame:
    """JSON lines; blank lines are skipped. A bad line fails, or is skipped."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED" if skip_errors else "FAILFAST")


def write_csv(rows: DataFrame, path: str | None = None) -> str:
    """Comma-separated; a null is \\N and line breaks inside texts go. A text that says \\N itself gets one more backslash."""
    path = path or new_path(rows.sparkSession, "csv")
    kinds = dict(rows.dtypes)

    def flat(c: str) -> Column:
        text = F.replace(F.col(c), F.lit("\n"), F.lit(""))
        return F.when(text.contains("\\N"), F.regexp_replace(text, r"^([\x00-\x20]*\\*)(\\N[\x00-\x20]*)\z", r"$1\\$2")).otherwise(text)

    rows.select(*(F.coalesce(flat(c) if kinds[c] == "string" else F.col(c).cast("string"), F.lit("\\N")).alias(c) for c in rows.columns)).write.csv(path, sep=",", escape='"', lineSep="\n")
    return path


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = "|") -> DataFrame:
    """CSV as the bus reads it: bars, backslash escapes, \\N for null, spaces around values and empty lines ignored. With commas, what
    write_csv wrote, where a value without characters is an empty text."""
    spaces = {"ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True, "lineSep": "\n"}
    if sep != ",":
        return spark.read.schema(schema).csv(path, sep=sep, escape="\\", nullValue="\\N", **spaces)
    fields = StructType.fromDDL(schema)
    texts = StructType([StructField(f.name, StringType()) for f in fields])
    # Spark makes an empty value null, too. No value holds a line break, so with that as nullValue its nulls are the empty values alone.
    # Without charToEscapeQuoteEscaping a character 0 inside quotes is lost.
    read = spark.read.schema(texts).csv(path, sep=sep, escape='"', charToEscapeQuoteEscaping='"', nullValue="\n", **spaces)

    def value(f: StructField) -> Column:
        said = F.coalesce(F.col(f.name), F.lit(""))
        text = F.when(said.startswith("\\\\"), F.regexp_replace(said, r"^\\(\\+N)\z", "$1")).otherwise(said)
        return F.when(said != "\\N", text if f.dataType == StringType() else said.try_cast(f.dataType)).alias(f.name)

    return read.select(*map(value, fields))


def _leaf(raw: Column, kind: str) -> Column:
    return raw.try_cast("double") if kind == "Number" else F.when(~raw.rlike(r"^[{\[]"), raw) if kind == "IfString" else raw


def _wild(text: Column, steps: list[str], kind: str) -> Column:
    """The value at dotted steps of a JSON text; a * is every member, as a map from its name (or its place) to the value."""
    if "*" not in steps:
        return _leaf(F.get_json_object(text, "$" + "".join(f".{x}" for x in steps)) if steps else text, kind)
    at = steps.index("*")
    inner = F.get_json_object(text, "$" + "".join(f".{x}" for x in steps[:at])) if at else text
    members = F.when(inner.startswith("["), F.map_from_entries(F.transform(F.from_json(inner, "array<string>"), lambda x, i: F.struct(i.cast("string").alias("key"), x.alias("value"))))).otherwise(F.from_json(inner, "map<string,string>"))
    found = F.transform_values(members, lambda _, x: _wild(x, steps[at + 1 :], kind))
    return F.map_filter(found, lambda _, x: x.isNotNull())


def _pruned(paths: list[list[str]]) -> StructType:
    """A struct with these paths and nothing else, of texts."""
    out = StructType()
    for head in dict.fromkeys(p[0] for p in paths):
        below = [p[1:] for p in paths if p[0] == head and len(p) > 1]
        out = out.add(head, _pruned(below) if below else StringType())
    return out


def project_payload(events: DataFrame, payload: str, fields: dict[str, str]) -> DataFrame:
    """events with a column for each dotted path: Number (double), Eid or String (text), Raw (unparsed text as
    name_raw), IfString (null for what starts with { or [). A path with a * gives a map of all that it reaches, from the
    members' names (places in a list) to values; what isn't there is left out. Plain paths are parsed once, by a schema that has nothing
    else; two paths that give one name are an error."""
    name = lambda path, kind: path.replace(".", "_").replace("*", "all") + ("_raw" if kind == "Raw" else "")
    if len(named := [name(*f) for f in fields.items()]) > len(set(named)):
        raise ValueError(f"two paths have one name: {sorted(named)}")
    steps = {path: path.split(".") for path in fields}
    whole = lambda path: any(steps[path] == other[: len(steps[path])] and path != p for p, other in steps.items())
    plain = [p for p in fields if "*" not in steps[p] and not whole(p)]
    private = next(f"_json{k}" for k in range(len(events.columns) + 1) if f"_json{k}" not in events.columns)
    parsed = events.withColumn(private, F.from_json(payload, _pruned([steps[p] for p in plain]))) if plain else events
    out = {}
    for path, kind in fields.items():
        out[name(path, kind)] = _leaf(reduce(lambda c, x: c.getField(x), steps[path], F.col(private)), kind) if path in plain else _wild(F.col(payload), steps[path], kind)
    return parsed.withColumns(out).drop(private)


def custom_parse(lines: DataFrame, column: str, parser: Callable[[str], dict | None], schema: str) -> DataFrame:
    """Rows from parser(line) over whole batches; a line for which it gives None is dropped. schema: a DDL string."""
    names = StructType.fromDDL(schema).names

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([r for r in map(parser, batch[column]) if r is not None], columns=names)

    return lines.select(column).mapInPandas(parse, schema)


def make_chunks(events: DataFrame, keys: list[str], records: int = 1000, ids: str = "counted") -> DataFrame:
    """Stored chunks of events: the gzip JSON lines of up to records events of a key in eid order, with start, end,
    records and size. Events are numbered in two phases, so a hot key is many chunks in many tasks.

    ids: counted (from the chunk's start, by line), rebased (a line before each event that doesn't follow from the one before
    says its id) or own (an archive's: events carry their ids)."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.drop(columns="lines").assign(body=[gzip.compress("".join(x + "\n" for x in lines).encode(), mtime=0) for lines in b["lines"]], size=[sum(len(x.encode()) + 1 for x in lines) for lines in b["lines"]])

    line = F.to_json(F.struct(*(["eid"] if ids == "own" else []), F.col("bot").alias("id"), "timestamp", "payload"))
    numbered = number_batches(events, records, keys)
    grouped = numbered.groupBy(*keys, "batch").agg(F.sort_array(F.collect_list(F.struct("eid", line.alias("line")))).alias("x"), F.min("eid").alias("start"), F.max("eid").alias("end"), F.count(F.lit(1)).alias("records"))
    fields = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    lines = F.transform("x", lambda e: e["line"])
    if ids == "rebased":
        head, number = (lambda e: F.substring_index(e, "-", 1)), (lambda e: F.substring_index(e, "-", -1).cast("long"))
        follows = lambda e, i: (i == 0) | ((head(e) == head(F.get("x", i - 1)["eid"])) & (number(e) == number(F.get("x", i - 1)["eid"]) + 1))
        lines = F.flatten(F.transform("x", lambda e, i: F.when(follows(e["eid"], i), F.array(e["line"])).otherwise(F.array(F.concat(F.lit(_REBASE), F.to_json(F.struct(e["eid"].alias("eid")))), e["line"]))))
    rows = grouped.select(*keys, "batch", "start", "end", "records", lines.alias("lines"))
    return rows.mapInPandas(pack, ", ".join([*(f"{k} {fields[k]}" for k in keys), "batch long, start string, end string, records long, body binary, size long"]))


_REBASE = "__cmd:eid__"


def _chunk_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line of each chunk (queue, start, body, archive): queue, archive, head and number of the line's id,
    and the line. A re-basing line changes the head and begins to count anew, and is no row itself."""
    names = ["queue", "archive", "head", "number", "line"]
    for batch in batches:
        queues, starts, bodies, archives = (c.to_pylist() for c in batch.columns)
        for queue, start, body, archive in zip(queues, starts, bodies, archives, strict=True):
            head, _, first = (start or "").partition("-")
            heads, numbers, lines, at, size = [], [], [], int(first or 0), 0

            def rows(queue=queue, archive=archive) -> pa.RecordBatch:
                n = len(lines)
                return pa.RecordBatch.from_arrays([pa.array([queue] * n, pa.string()), pa.array([archive] * n, pa.bool_()), pa.array(heads, pa.string()), pa.array(numbers, pa.int64()), pa.array(lines, pa.string())], names=names)

            for raw in gzip.GzipFile(fileobj=io.BytesIO(body)):
                line = raw.decode().removesuffix("\n")  # a line of JSON may hold other line separators
                if line.startswith(_REBASE):
                    head, _, first = json.loads(line[len(_REBASE) :])["eid"].partition("-")
                    at = int(first or 0)
                    continue
                heads.append(head)
                numbers.append(at)
                lines.append(line)
                at, size = at + 1, size + len(line)
                if size > 8_000_000:
                    yield rows()
                    heads, numbers, lines, size = [], [], [], 0
            yield rows()


def explode_chunks(chunks: DataFrame) -> DataFrame:
    """queue, eid, id, timestamp and payload of the events in chunks (queue, start, body; archive: whether events keep their own
    ids): other ids are the chunk's first one counted on by line, from the last re-basing line on; lines that don't parse
    are dropped, their places counted. A chunk is inflated line by line."""
    archive = F.col("archive") if "archive" in chunks.columns else F.lit(False)
    rows = chunks.where("body is not null").select("queue", "start", "body", F.coalesce(archive, F.lit(False)).alias("archive")).mapInArrow(_chunk_lines, "queue string, archive boolean, head string, number long, line string")
    parsed = rows.withColumn("e", F.from_json("line", "eid string, id string, timestamp long, payload string")).where("e is not null and e.timestamp is not null")
    counted = F.concat("head", F.lit("-"), F.right(F.concat(F.lit("0000000"), F.col("number").cast("string")), F.lit(7)))
    return parsed.select("queue", F.when(F.col("archive"), F.col("e.eid")).otherwise(counted).alias("eid"), "e.id", "e.timestamp", "e.payload")


def write_archive(events: DataFrame, path: str | None = None) -> str:
    """Archive layout: q=<queue>/dt=<day>, gzip, sorted by eid inside a file. Rows are dealt by ranges of (queue, day, eid),
    so a hot queue's day is many files, each with a range of its ids."""
    path = path or new_path(events.sparkSession, "archive")
    rows = events.withColumn("q", F.col("queue")).repartitionByRange("q", "dt", "eid").sortWithinPartitions("q", "dt", "eid")
    rows.write.partitionBy("q", "dt").option("compression", "gzip").parquet(path)
    return path


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file of an archive of events (eid, bot, size, units, source, start, timestamp,
    event_source_timestamp): q, dt, file, start, end, records, size, gzip_size, offset and byte_offset (records and bytes in the
    files before it of its queue and day), stats (bot -> units, start, end, checkpoint) and correlations (source, start, end,
    records)."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("gzip_size"))
    of = ["q", "dt", "file"]
    units = F.sum(F.coalesce("units", F.lit(1))).cast("long")
    whole = rows.groupBy(*of).agg(F.min("eid").alias("start"), F.max("eid").alias("end"), F.count(F.lit(1)).alias("records"), F.sum("size").cast("long").alias("size"), F.max("gzip_size").alias("gzip_size"))
    bots = rows.groupBy(*of, "bot").agg(units.alias("units"), F.max("event_source_timestamp").alias("start"), F.max("timestamp").alias("end"), F.max_by(F.coalesce("start", "eid"), "eid").alias("checkpoint"))
    bots = bots.groupBy(*of).agg(F.map_from_entries(F.collect_list(F.struct("bot", F.struct("units", "start", "end", "checkpoint")))).alias("stats"))
    sources = rows.where("source is not null").groupBy(*of, "source").agg(F.min_by("start", "eid").alias("start"), F.max_by("start", "eid").alias("end"), units.alias("records"))
    sources = sources.groupBy(*of).agg(F.sort_array(F.collect_list(F.struct("source", "start", "end", "records"))).alias("correlations"))
    before = Window.partitionBy("q", "dt").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    out = whole.join(bots, of).join(sources, of, "left")
    return out.withColumns({"offset": F.coalesce(F.sum("records").over(before), F.lit(0)), "byte_offset": F.coalesce(F.sum("size").over(before), F.lit(0)), "correlations": F.coalesce("correlations", F.array())})


def append_batch(events: DataFrame, path: str, batch: int, key: Column | None = None, records_per_file: int = 0) -> None:
    """Append one batch, so that repeating it leaves the rows of the repeat and no others: its own folder is overwritten, and is
    there for a batch without rows too. key deals the rows to tasks, all rows of a key to one; records_per_file is the
    most that a file takes (0: no limit)."""
    rows = events if key is None else events.repartition(key)
    rows.write.option("maxRecordsPerFile", records_per_file).mode("overwrite").parquet(f"{path}/batch={batch}")


def put_events(spark: SparkSession, rows: list[dict], path: str, bot: str, queue: str, batch: int, now: int | None = None) -> DataFrame:
    """Put one event or a few (payload, and what of the envelope is known) into a queue's table as a batch: envelope, ids
    in the order of the list, append. Gives what was written."""
    fields = "payload string, id string, event string, timestamp long, event_source_timestamp long"
    names = [x.split()[0] for x in fields.split(",")]
    made = spark.createDataFrame([(*(r.get(n) for n in names), k) for k, r in enumerate(rows)], f"{fields}, place long")
    out = to_envelope(made, bot, queue, None if now is None else F.lit(now).cast("long"))
    number = F.row_number().over(Window.partitionBy("event", "timestamp").orderBy("place")) - 1
    out = cut(out.withColumn("eid", build_eid(F.col("timestamp"), number)).select(F.col("event").alias("queue"), "eid", F.col("id").alias("bot"), "timestamp", "event_source_timestamp", "payload"))
    append_batch(out, path, batch)
    return out


def poll_pages(fetch: Callable[[int], DataFrame], state: int, step: int, records: int | None = None, seconds: float | None = None, last: int | None = None) -> DataFrame | None:
    """Rows of fetch(state) for one state after the other until it gives none, or with last, over empty ranges too, until
    the state has reached last; or until records or seconds are reached. None if there are none at all. fetch gives the rows with state < position <= state + step; each page is written before
    the state moves, so a lost executor costs one page and a later run goes on from the last state."""
    out, n, began = None, 0, time.monotonic()
    while (last is None or state < last) and (records is None or n < records) and (seconds is None or time.monotonic() - began < seconds):
        page = cut(fetch(state))
        if not (got := page.count()) and last is None:
            break
        if got:
            out = page if out is None else out.unionByName(page)
        n, state = n + got, state + step
    return out


class PolledRange(InputPartition):
    def __init__(self, after: int, last: int, most: int):
        self.after, self.last, self.most = after, last, most


def polled(poll: Callable[[int, int, int], list[tuple]], after: int, last: int, most: int, seconds: float | None = None, page: int = 1000) -> Iterator[tuple]:
    """Rows of poll(state, last, most) -> the next rows (position, ...), at most so many, with state < position <= last,
    page after page: the state is the last position, so gaps in the positions cost nothing. It ends when there are no
    more, or at most rows, or after so many seconds."""
    began, n = time.monotonic(), 0
    while n < most and (seconds is None or time.monotonic() - began < seconds):
        rows = poll(after, last, min(page, most - n))
        if not rows:
            return
        yield from rows
        n, after = n + len(rows), rows[-1][0]


class PollingSource(DataSource):
    """format("polling"): calls a poll function with a state until it gives nothing, in a batch or a stream.

    Options: last (the largest position), ranges (of positions that a batch polls at once), records (at most, from the first
    position on: the batch is one range then), seconds (for each range), page (rows of a call and of a micro-batch). Subclass and
    set poll and fields for other systems. A lost task polls its own range again."""

    poll: Callable[[int, int, int], list[tuple]] = staticmethod(lambda after, last, most: [(k, json.dumps({"n": k * k})) for k in range(after + 1, min(last, after + most) + 1)])
    fields = "position long, payload string"

    @classmethod
    def name(cls) -> str:
        return "polling"

    def schema(self) -> str:
        return type(self).fields

    def reader(self, schema) -> DataSourceReader:
        return _PollingReader(self.options, type(self).poll)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _PollingStream(self.options, type(self).poll)


class _PollingReader(DataSourceReader):
    def __init__(self, options, poll):
        self.last, self.records = int(options.get("last", 0)), int(options.get("records", 2**62))
        self.ranges = 1 if "records" in options else max(1, int(options.get("ranges", 8)))
        self.seconds = float(options["seconds"]) if "seconds" in options else None
        self.page, self.poll = int(options.get("page", 1000)), poll

    def partitions(self):
        step = max(1, -(-(self.last + 1) // self.ranges))
        return [PolledRange(a - 1, min(a + step - 1, self.last), self.records) for a in range(0, self.last + 1, step)]

    def read(self, partition):
        yield from polled(self.poll, partition.after, partition.last, partition.most, self.seconds, self.page)


class _PollingStream(SimpleDataSourceStreamReader):
    """Each micro-batch is the next page; the offset is the state."""

    def __init__(self, options, poll):
        self.last, self.page, self.poll = int(options.get("last", 2**62)), int(options.get("page", 1000)), poll

    def initialOffset(self) -> dict:
        return {"position": -1}

    def read(self, start: dict):
        rows = self.poll(start["position"], self.last, self.page)
        return iter(rows), {"position": rows[-1][0] if rows else start["position"]}

    def readBetweenOffsets(self, start: dict, end: dict):
        return polled(self.poll, start["position"], end["position"], 2**62, None, self.page)
