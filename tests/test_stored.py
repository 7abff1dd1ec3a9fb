"""Stored tables, section files, sinks, runs with limits, and what must not be lost on the way."""

import gzip
import json
import random
import shutil
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tallyweir.functions import hashing
from tallyweir.operators import batching, fanout, points, process, read, state
from tallyweir.sources import bus, fixture, formats, keyed, large, sections, sinks
from tallyweir.sources.shared import Scratch
from tallyweir.streaming import streams
from tallyweir.streaming.bots import ManualCheckpoint, run_bot

ROOT = Path(__file__).resolve().parent.parent


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# the stored bus table

def test_range_reads_choose_folders_and_row_groups(spark):
    rows = read.read_range(fixture.bus_rows(spark, SF), "view", "z/2024/01/05", "z/2024/01/20/12")
    plan = plan_of(rows)
    at = plan[plan.index("PartitionFilters") :]
    assert "queue" in at.split("PushedFilters")[0] and "dt" in at.split("PushedFilters")[0]
    pushed = at[at.index("PushedFilters") :].split("]")[0]
    assert "GreaterThan(eid" in pushed and "LessThanOrEqual(eid" in pushed


def test_reads_by_registry_prune_queues_at_run_time(spark):
    rows = fixture.bus_rows(spark, SF)
    readers = spark.createDataFrame([("r", "view", "z/2024/01/10"), ("s", "error", "z/2099")], "bot string, queue string, start string")
    none = spark.createDataFrame([], "bot string, queue string, checkpoint string")
    got = read.read_from_checkpoint(rows, readers, none, rows.groupBy("queue").agg(F.max("eid").alias("max_eid")), "z/2024")
    assert "dynamicpruning" in plan_of(got).lower()
    want = rows.where("queue = 'view' and eid > 'z/2024/01/10 '")
    assert got.count() == want.count() > 0 and got.select("reader").distinct().collect() == [("r",)]


def test_bus_table_keeps_every_row(spark, tmp_path):
    rows = spark.createDataFrame([(None, "z/2", 1), ("a/b", "z/1", 2), ("a/b", "z/1", 2), ("x", "z/3", None)], "queue string, eid string, k int").withColumn("dt", F.lit("2024-01-02").cast("date"))
    bus.write_bus(rows, f"{tmp_path}/bus")
    back = bus.read_bus(spark, f"{tmp_path}/bus", rows.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


# chunks

def chunk(lines, start="z/1-0000005", queue="q"):
    return (queue, start, gzip.compress("".join(x + "\n" for x in lines).encode()))


def test_other_line_separators_are_text(spark):
    text = ["a\u2028b", "c\u0085d\u2029", "e", "\x1c\x0b", "f"]
    lines = [json.dumps({"id": "b", "timestamp": k, "payload": t}, ensure_ascii=False).replace("\\u001c", "\x1c") for k, t in enumerate(text)]
    got = formats.explode_chunks(spark.createDataFrame([chunk(lines)], "queue string, start string, body binary")).orderBy("timestamp").collect()
    assert [(r.eid[-1], r.payload) for r in got if r.timestamp != 3] == [("5", text[0]), ("6", text[1]), ("7", "e"), ("9", "f")]


def test_chunks_rebase_their_ids(spark):
    line = lambda k, **more: json.dumps({"id": "b", "timestamp": k, "payload": "x", **more})
    body = [line(0), "not json", line(1), '__cmd:eid__{"eid":"z/7-0000100"}', line(2), line(3)]
    rows = [(*chunk(body), False), (*chunk([line(4, eid="z/9-0000042"), line(5, eid="z/9-0000001")]), True), ("q", "z/1-0000000", None, None), (*chunk([]), None)]
    got = formats.explode_chunks(spark.createDataFrame(rows, "queue string, start string, body binary, archive boolean")).orderBy("timestamp").collect()
    assert [r.eid for r in got] == ["z/1-0000005", "z/1-0000007", "z/7-0000100", "z/7-0000101", "z/9-0000042", "z/9-0000001"]


# nothing is lost

def test_null_keys_are_numbered(spark):
    e = spark.createDataFrame([(None, "z/1", 3), ("a", "z/2", 4), (None, "z/3", 5)], "queue string, eid string, size long")
    assert sorted((r.eid, r.before) for r in read.prefix_sum(e, ["queue"], "size").collect()) == [("z/1", 0), ("z/2", 0), ("z/3", 3)]
    assert batching.number_batches(e, 1).count() == 3


def test_a_micro_batch_may_drop_everything(spark):
    rows = spark.createDataFrame([("q", f"z/{k}", "p", 1, k, k) for k in range(4)], "queue string, eid string, payload string, units long, timestamp long, event_source_timestamp long")
    from tallyweir.operators import bots

    told = []
    drop = lambda b: bots.enrich(b, "b", "out", lambda r: (F.when(F.col("eid") == "z/3", process.EMIT).otherwise(process.DROP), F.lit("x")))
    run = run_bot(streams.deal_in_order(rows, "eid", 4), drop, lambda n, error, c: told.append((n, error, c.count())))
    assert sorted(told) == [(0, None, 0), (1, None, 0), (2, None, 0), (3, None, 1)] and run.output().count() == 1
    assert streams.run_batches(streams.deal(rows, 2), lambda b: b.where("false"), lambda n, out: told.append(out.count())).count() == 0


def test_an_empty_repeat_leaves_nothing(spark, tmp_path):
    rows = spark.range(2)
    for batch, df in ((0, rows), (1, rows), (0, rows.where("id > 9"))):
        formats.append_batch(df, f"{tmp_path}/t", batch)
    assert spark.read.schema("id long, batch int").parquet(f"{tmp_path}/t").groupBy("batch").count().collect() == [(1, 2)]


def test_the_rest_works_without_the_training_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    (copy / "tallyweir" / "llm" / "__pycache__").mkdir(parents=True)  # what deleting may leave
    code = "import __spark_entry__ as e; n = e.queries(); assert 'read_range' in n and 'pipeline' not in n and not any(k.startswith('op1') for k in n); assert set(e.oracle_sql()) <= set(n)"
    for gone in ((), ("corpus_pipeline.py",)):
        for name in gone:
            (copy / name).unlink()
        subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={"PATH": "/usr/bin:/bin"})


# section files

def test_only_hit_sections_are_read(spark, tmp_path):
    rows = spark.range(5000).selectExpr("concat('q', id % 2) as queue", "concat('z/', lpad(id, 6, '0')) as eid", "repeat(cast(id as string), 20) as payload")
    path = f"{tmp_path}/s"
    sections.write_sections(rows, path, records=50, sections=4)
    index = sections.section_index(spark, path).collect()
    assert max(i.section for i in index) == 3 and all(i.records <= 50 for i in index) and sum(i.records for i in index) == 5000
    for f in {i.file for i in index}:
        mine = sorted((i for i in index if i.file == f), key=lambda i: i.section)
        assert [i.gzip_offset for i in mine] == [sum(j.gzip_size for j in mine[:k]) for k in range(len(mine))]
        assert sum(i.gzip_size for i in mine) == Path(path, f).stat().st_size and len({i.queue for i in mine}) == 1
        assert sum(len(x) for x in gzip.decompress(Path(path, f).read_bytes()).splitlines(True)) == sum(i.size for i in mine)  # plain gzip to others
    got = sections.read_sections(spark, path, "eid string, payload string", "q1", "z/001000", "z/001111")
    back = got.collect()
    assert sorted((r.queue, r.eid) for r in back) == [("q1", f"z/{k:06d}") for k in range(1001, 1112, 2)] and back[0].payload
    opened = {(r.file, r.section) for r in back}
    assert len(opened) <= 3 and sum(i.gzip_size for i in index if (i.file, i.section) in opened) < sum(i.gzip_size for i in index) / 20
    assert sections.read_sections(spark, path, "eid string, payload string").count() == 5000


# the keyed table

SCHEMA = "k long, x string, y struct<a:long,b:string>"


def table_of(spark, path, **more):
    return keyed.KeyedTable(spark, f"{path}/t", SCHEMA, ["k"], buckets=4, **more)


def batch_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA + ", seq long")


def test_keyed_batches(spark, tmp_path):
    t = table_of(spark, tmp_path)
    assert t.read().count() == 0
    t.upsert(batch_of(spark, [(k, "old", (k, "o"), 0) for k in range(20)]), 0, "seq")
    t.upsert(batch_of(spark, [(1, "first", None, 1), (1, None, (9, None), 2), (None, "n", None, 1)]), 1, "seq")
    t.upsert(batch_of(spark, [(2, "again", None, 1)]), 1, "seq")  # taken already
    rows = {r.k: (r.x, r.y and tuple(r.y)) for r in t.read().collect()}
    assert len(rows) == 21 and rows[1] == (None, (9, None)) and rows[2] == ("old", (2, "o")) and rows[None] == ("n", None)
    before = t.version()["base"]
    t.compact()
    assert before == {} and {r.k: (r.x, r.y and tuple(r.y)) for r in t.read().collect()} == rows
    base = t.version()["base"]
    t.upsert(batch_of(spark, [(1, "late", None, 0)]), 2, "seq")
    t.upsert(batch_of(spark, [(1, "x", None, 0)]), 1, "seq")
    t.compact()
    changed = {b for b, v in t.version()["base"].items() if base.get(b) != v}
    assert len(changed) == 1  # the other buckets are where they were
    t.clean()
    assert t.read().where("k = 1").first().x == "late" and t.read().count() == 21
    assert len(list(Path(tmp_path, "t", "base").glob("v=*/bucket=*"))) == len(t.version()["base"])


def test_keyed_merge_and_a_broken_batch(spark, tmp_path):
    t = table_of(spark, tmp_path, merge=True)
    t.upsert(batch_of(spark, [(1, "a", (1, "p"), 0), (2, "b", None, 0)]), 0, "seq")
    boom = F.when(F.col("k") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("x"))
    with pytest.raises(Exception, match="boom"):
        t.upsert(batch_of(spark, [(1, "z", None, 1), (2, "z", None, 1)]).withColumn("x", boom), 1, "seq")
    assert sorted((r.k, r.x) for r in t.read().collect()) == [(1, "a"), (2, "b")]
    t.upsert(batch_of(spark, [(1, None, (None, "q"), 1), (1, "c", (7, None), 2), (3, "n", None, 1)]), 1, "seq")
    assert sorted((r.k, r.x, r.y and tuple(r.y)) for r in t.read().collect()) == [(1, "c", (7, "q")), (2, "b", None), (3, "n", None)]


def test_large_payloads_come_back(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 500), (4, "x" * 500), (5, "short"), (None, "y" * 900)], "id long, payload string")
    large.write_large(rows, f"{tmp_path}/l", limit=100)
    assert sorted(map(str, large.read_large(spark, f"{tmp_path}/l").collect())) == sorted(map(str, rows.collect()))
    kept = spark.read.parquet(f"{tmp_path}/l/events")
    assert kept.where("payload is not null").count() == 2 and spark.read.parquet(f"{tmp_path}/l/bodies").count() == 2


# sinks

def sink_of(log: str):
    """Takes a row in the try whose number its id leaves modulo 3, and notes what it was asked."""

    class Flaky(sinks.OutsideSink):
        @staticmethod
        def send(rows, number, task):
            with open(log, "a") as f:
                f.write("".join(f"{number} {r['id']}\n" for r in rows))
            return [k for k, r in enumerate(rows) if r["id"] % 3 > number]

    return Flaky


def test_only_failed_rows_are_sent_again(spark, tmp_path):
    assert sinks.send_all(spark.range(60).repartition(3), sink_of(f"{tmp_path}/log"), f"{tmp_path}/s", batch=7) == 3
    asked = [tuple(map(int, x.split())) for x in Path(tmp_path, "log").read_text().splitlines()]
    assert sorted(asked) == sorted((n, k) for k in range(60) for n in range(k % 3 + 1))
    with pytest.raises(RuntimeError, match="20 rows failed after 2 tries"):
        sinks.send_all(spark.range(60), sink_of(f"{tmp_path}/log2"), f"{tmp_path}/s2", tries=2)


def test_sink_takes_a_stream(spark, tmp_path):
    sink = sink_of(f"{tmp_path}/log")
    spark.dataSource.register(sink)
    stream = streams.deal(spark.range(30).withColumnRenamed("id", "id"), 2)
    query = stream.writeStream.format("outside").option("path", f"{tmp_path}/s").option("tries", 3).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    told = [json.loads(p.read_text()) for p in Path(tmp_path, "s", "commits").glob("*.json")]
    assert sum(t["sent"] for t in told) == 30 and not any(t["failed"] for t in told)


# checkpoints

def test_proposals_in_turn(spark):
    old = spark.createDataFrame([("b", "read", "q", "e1"), (None, "read", "q", "e1")], "bot string, direction string, queue string, checkpoint string")
    ask = "bot string, direction string, queue string, expected string, eid string, force boolean, at long"
    rows = [("b", "read", "q", "e1", "e2", False, 1), ("b", "read", "q", "e1", "e3", False, 2), ("b", "read", "q", "e2", "e4", None, 3), ("b", "read", "q", "x", "e5", True, 4), ("b", "read", "q", "e5", None, False, 5)]
    rows += [("b", "write", "q", "no", "w1", False, 1), ("b", "write", "q", "no", "w2", False, 2), ("c", "read", "q", "any", "c1", False, 1), ("c", "read", "q", "any", "c2", False, 2), (None, "read", "q", "e1", "n2", False, 1)]
    got = {(r.bot, r.direction, r.at): (r.status, r.checkpoint) for r in state.advance_checkpoints(old, spark.createDataFrame(rows, ask), "at").collect()}
    assert [got["b", "read", k] for k in range(1, 6)] == [("applied", "e2"), ("stale", "e2"), ("applied", "e4"), ("applied", "e5"), ("applied", "e5")]
    assert [got["b", "write", k] for k in (1, 2)] == [("applied", "w1"), ("applied", "w2")]
    assert [got["c", "read", k] for k in (1, 2)] == [("applied", "c1"), ("stale", "c1")] and got[None, "read", 1] == ("applied", "n2")


def test_proposals_against_one_after_the_other(spark, monkeypatch):
    monkeypatch.setattr(points, "BLOCK", 8)
    monkeypatch.setattr(state, "BLOCK", 8)
    r = random.Random(1)
    rows = [(f"b{r.randrange(2)}", "read", "q", f"e{r.randrange(5)}", r.choice([None, *(f"e{k}" for k in range(5))]), r.random() < 0.05, k) for k in range(200)]
    old = spark.createDataFrame([("b0", "read", "q", "e0")], "bot string, direction string, queue string, checkpoint string")
    got = state.advance_checkpoints(old, spark.createDataFrame(rows, "bot string, direction string, queue string, expected string, eid string, force boolean, at long"), "at")
    held, want = {"b0": "e0"}, []
    for b, _, _, expected, eid, force, at in rows:
        ok = b not in held or force or held[b] == expected
        held[b] = (eid or expected) if ok else held[b]
        want.append((at, "applied" if ok else "stale", held[b]))
    assert sorted((x.at, x.status, x.checkpoint) for x in got.collect()) == want


def test_manual_checkpoints_go_on_in_a_new_process(spark):
    row = lambda at: spark.createDataFrame([("b", "q", at, 1, 1, 1)], "bot string, queue string, checkpoint string, records long, source_timestamp long, ended_timestamp long")
    first = ManualCheckpoint(spark)
    first.add(row("z/1"))
    first.flush()
    first.add(row("z/9"))  # never flushed
    second = ManualCheckpoint(spark, first.path)
    second.add(row("z/2"))
    second.flush()
    assert [(r.checkpoint, r.records) for r in second.checkpoints().collect()] == [("z/2", 2)]


def test_the_source_is_read_once_a_micro_batch(spark):
    from tallyweir.operators import bots

    read_rows = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([("q", f"z/{k}", "p", 1, k, k) for k in range(40)], "queue string, eid string, payload string, units long, timestamp long, event_source_timestamp long")

    def counted(batches):
        for b in batches:
            read_rows.add(b.num_rows)
            yield b

    step = lambda b: bots.enrich(b.mapInArrow(counted, b.schema), "b", "out", lambda r: (F.when(F.rand() < 0.5, process.EMIT).otherwise(process.DROP), F.lit("x")))
    run = run_bot(streams.deal(rows, 3), step)
    assert read_rows.value == 40
    assert run.checkpoints().first().records == run.output().count()  # of the same rows, though chance decided


# runs

def test_limited_runs_give_each_row_once(spark, tmp_path):
    stream = streams.deal(spark.range(60), 6)
    told = [streams.run_limited(stream, lambda b: b, f"{tmp_path}/r", x) for x in (streams.Limits(batches=2), streams.Limits(records=1), streams.Limits(seconds=0.0), streams.Limits())]
    assert [(p.batches, p.ended) for p in told] == [(2, False), (1, False), (0, False), (3, True)] and sum(p.records for p in told) == 60
    assert spark.read.parquet(f"{tmp_path}/r/out").selectExpr("count(*)", "count(distinct id)").first()[:] == (60, 60)


def test_batches_close_by_whichever_limit_comes_first(spark):
    at = [0, 1, 2, 3, 10, 11, 100, 101, 102, 103, 104, 300]
    rows = spark.createDataFrame([("q", f"z/{k:03d}", 5 if k < 8 else 60, s) for k, s in enumerate(at)], "queue string, eid string, size long, s long").selectExpr("queue", "eid", "size", "timestamp_seconds(1700000000 + s) as ts")
    got = streams.timed_batches(streams.deal_in_order(rows, "ts", 4), count=4, size=100, millis=20_000).orderBy("seq").collect()
    # the third batch is full by count and by bytes at once; the fourth is closed by the watermark, the last one is open
    assert [(r.seq, r.n, r.bytes, r.closed) for r in got] == [(0, 4, 20, "count"), (1, 2, 10, "time"), (2, 4, 130, "count"), (3, 1, 60, "time")]


def test_fan_out_takes_all_under_one_bound_or_fails(spark):
    rows = spark.createDataFrame([("q", f"z/{k:03d}", 1, k, k, k) for k in range(50)] + [(None, "z/900", 1, 1, 1, 1)], "queue string, eid string, units long, timestamp long, event_source_timestamp long, k long")
    bounds = spark.createDataFrame([("q", "z/039"), (None, "z/900")], "queue string, upto string")
    double = lambda b: pa.array([None if x % 2 else 2 * x for x in b.column(5).to_pylist()], pa.int64())
    done = fanout.fan_out_run(rows, "bot", 4, double, "long", bounds=bounds)
    parts = {r.eid: r.part for r in rows.select("eid", hashing.partition_of(F.col("eid"), 4).alias("part")).collect()}
    assert sorted((r.eid, r.part, r.result) for r in done.output.collect()) == [(f"z/{k:03d}", parts[f"z/{k:03d}"], 2 * k) for k in range(0, 40, 2)]
    stood = {}
    for k in range(40):
        stood[parts[f"z/{k:03d}"]] = f"z/{k:03d}"
    assert {r.queue: r.checkpoint for r in done.checkpoints.collect()} == {"q": min(stood.values()), None: "z/900"}

    def broken(b):
        raise ValueError("instance failed")

    with pytest.raises(Exception, match="instance failed"):
        fanout.fan_out_run(rows, "bot", 4, broken, "long")


# points

def test_next_points(spark):
    r = random.Random(8)
    pts = [(r.choice(["a", "a", "b", None]), r.randrange(40), k) for k in range(60)]
    asked = [(r.choice(["a", "b", None, "c"]), r.choice([None, *range(45)]), k) for k in range(200)]
    p, a = spark.createDataFrame(pts, "key string, at long, v long"), spark.createDataFrame(asked, "key string, want long, id long")
    got = points.next_point(a, F.col("want"), p, ["key"], F.col("at"), F.col("v"), "found", Scratch(spark), F.col("v")).collect()
    for x in got:
        later = [(t, v) for k, t, v in pts if k == x.key and x.want is not None and t >= x.want]
        assert x.found == (min(later)[1] if later else None)
    assert len(got) == 200


# small things

def test_hash_of_any_text(spark):
    def plain(s):
        h, raw = 0, s.encode("utf-16-le")
        for k in range(0, len(raw), 2):
            h = (h * 31 + int.from_bytes(raw[k : k + 2], "little")) & 0xFFFFFFFF
        return h - (1 << 32) if h >> 31 else h

    texts = ["", "hello", "😀x", "é" * 5000, None, "a"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", hashing.string_hash("t").alias("h"), hashing.key_hash(F.array("t", F.lit("b")), "array<string>").alias("two")).collect()
    assert [r.h for r in got] == [None if t is None else plain(t) for t in texts] and got[1].two == plain("hello") + plain("b")


def test_projection_parses_what_is_asked(spark):
    rows = spark.createDataFrame([('{"a":{"b":"1.5","c":{"x":1}},"d":[1],"e":true}',), ("not json",), (None,)], "p string")
    got = formats.project_payload(rows, "p", {"a.b": "Number", "a.c": "IfString", "d": "String", "e": "String", "a": "Raw", "z.y": "String"}).collect()
    assert got[0][1:] == (1.5, None, "[1]", "true", '{"b":"1.5","c":{"x":1}}', None) and got[1][1:] == got[2][1:] == (None,) * 6
    with pytest.raises(ValueError, match="one name"):
        formats.project_payload(rows, "p", {"a.b": "String", "a_b": "String"})


def test_parser_schemas_may_hold_commas(spark):
    rows = spark.createDataFrame([("1.25",)], "line string")
    from decimal import Decimal

    assert formats.custom_parse(rows, "line", lambda x: {"a": Decimal(x), "b": [1]}, "a decimal(10,2), b array<int>").first()[:] == (Decimal("1.25"), [1])


def test_types_of_fields(spark):
    texts = ['{"v":1}', '{"v":1.5e3}', '{"v":"1"}', '{"v":false}', '{"v":{}}', '{"v":[]}', '{"v":null}', "{}", "no", None]
    got = spark.createDataFrame([(t,) for t in texts], "p string").select(process.json_type(F.col("p"), "v")).collect()
    assert [r[0] for r in got] == ["number", "number", "string", "boolean", "object", "object", "null", "undefined", "undefined", "undefined"]
