"""Literal cases for the operators."""

import inspect
import random
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweir.functions import eid, hashing, refs
from tallyweir.operators import batching, bots, joins, lineage, points, process, read, state, stats
from tallyweir.plans import format_plans, stats_plans
from tallyweir.sources import formats
from tallyweir.streaming import streams
from tallyweir.streaming.bots import BotRun, ManualCheckpoint, run_bot

MS = 1648149254205


def one(spark, *columns):
    return spark.range(1).select(*(c.alias(f"c{k}") for k, c in enumerate(columns))).first()


def test_event_ids(spark):
    ms = F.lit(MS)
    want = {
        "year": "z/2022", "month": "z/2022/03", "day": "z/2022/03/24", "hour": "z/2022/03/24/19", "minute": "z/2022/03/24/19/14",
        "second": "z/2022/03/24/19/14/1648149254000", "millisecond": f"z/2022/03/24/19/14/{MS}", "whatever": f"z/2022/03/24/19/14/{MS}",
    }
    assert list(one(spark, *(eid.build_eid(ms, None, g) for g in want))) == list(want.values())
    assert one(spark, eid.build_eid(ms, F.lit(12)))[0] == f"z/2022/03/24/19/14/{MS}-0000012"
    got = one(spark, *(eid.eid_millis(F.lit(x)) for x in (f"z/2022/03/24/19/14/{MS}-0000012", "z/2022/03/24/19/14", "z/2022", "x/2022", "")))
    assert list(got) == [MS, 1648149240000, 1640995200000, None, None]
    assert one(spark, eid.previous_eid(F.lit("z/12")), eid.previous_eid(F.lit("z/10")), F.lit("z/1-0000000") > eid.after("z/1"))[:] == ("z/11", "z/1 ", True)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_ids_and_buckets_are_utc_in_any_session(spark, zone):
    """Also for wall-clock times that the session's zone skips or has twice."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for ms, text in ((MS, "2022-03-24 19:14"), (1710037800000, "2024-03-10 02:30"), (1730611800000, "2024-11-03 05:30"), (-1, "1969-12-31 23:59")):
            want = f"z/{text.replace('-', '/').replace(' ', '/').replace(':', '/')}/{ms}"
            row = one(spark, eid.build_eid(F.lit(ms)), eid.eid_millis(eid.build_eid(F.lit(ms), None, "minute")), stats.bucket_label(F.lit(ms), "hour"), stats.bucket_label(F.lit(ms), "day"))
            assert list(row) == [want, ms - ms % 60_000, f"hour_{text[:13]}", f"day_{text[:10]}"]
        assert one(spark, stats.bucket_label(F.lit(MS), "week"), eid.utc_millis(F.lit("2024-03-10 02:30:00.0019").cast("timestamp_ntz")))[:] == ("week_2022-03-20", 1710037800001)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_references(spark):
    cases = {"x": ("queue:x", "x"), "e_x": ("queue:x", "x"), "bot:x": ("bot:x", "bot.x"), "bot:bot.x": ("bot:bot.x", "bot.x"), "System:y": ("system:y", "system.y")}
    got = one(spark, *(c for x in cases for c in (refs.ref_id(F.lit(x)), refs.as_queue(F.lit(x)))))
    assert list(got) == [y for x in cases.values() for y in x]
    assert list(one(spark, refs.owner(F.lit("bot.a.error")), refs.owner(F.lit("plain")))) == ["bot:a", None]


def test_hash(spark):
    assert one(spark, hashing.string_hash(F.lit("hello")), hashing.string_hash(F.lit("")))[:] == (99162322, 0)
    assert one(spark, hashing.string_hash(F.lit("\U0001f600")), hashing.string_hash(F.lit("é")))[:] == (1772899, 233)
    assert one(spark, hashing.key_hash(F.lit(-7), "bigint"), hashing.key_hash(F.array(F.lit("a"), F.lit("b")), "array<string>"), hashing.key_hash(F.array(F.lit(3), F.lit(4)), "array<int>"))[:] == (-7, 97 + 98, 7)
    assert one(spark, hashing.partition_of(F.lit(-9), 7, "bigint"))[0] == 2
    assert 0 <= one(spark, hashing.partition_of(F.lit("z/2024/01/01/00/00/1704067207179-0000000"), 50))[0] < 20


def events(spark, n=12, size=75):
    return spark.createDataFrame([("q", f"z/2022/03/16/20/02/1647460979244-{k:07d}", "b", 1000 * k, 1000 * k - 5, f'{{"data":{k}}}', 1, size) for k in range(n)], "queue string, eid string, bot string, timestamp long, event_source_timestamp long, payload string, units long, size long")


def test_range_is_after_start(spark):
    e = events(spark)
    assert read.read_range(e, "q", "z/2022/03/16/20/02/1647460979244").count() == 12  # record 0 comes after its bare time
    assert read.read_range(e, "q", "z/2022/03/16/20/02/1647460979244-0000003").count() == 8
    assert read.read_range(e, "q", None, "z/2022/03/16/20/02/1647460979244-0000003").count() == 4


def test_byte_budget_takes_the_crossing_event(spark):
    assert read.read_byte_budget(events(spark, 60), "q", 2000).count() == 27


@pytest.mark.parametrize(("kind", "sync", "promise"), [("object", "emit", "emit"), ("true", "ack", "ack"), ("undefined", "drop", "ack"), ("false", "drop", "drop"), ("string", "ack", "ack"), ("number", "ack", "ack")])
def test_actions(spark, kind, sync, promise):
    assert list(one(spark, process.action_of(F.lit(kind)), process.action_of(F.lit(kind), True))) == [sync, promise]


def test_fan_out_and_checkpoint(spark):
    two = F.array(F.lit("{}"), F.lit("{}"))
    out = process.fan_out(events(spark, 2), two, "b", "out")
    assert [(r.partial_start is None, r.start is None) for r in out.orderBy("pos", F.coalesce("start", "partial_start")).collect()] == [(False, True)] * 2 + [(True, False)] * 2
    c = stats.checkpoint_from_correlations(out.withColumn("end", F.lit(None).cast("string"))).first()
    assert (c.records, c.checkpoint[-1]) == (4, "1")  # partial rows count
    assert process.fan_out(events(spark, 1), F.array().cast("array<string>"), "b", "out").first().payload is None


def test_stream_stats(spark):
    s = stats.stream_stats(events(spark, 5)).first()
    assert (s.units, s.source_timestamp, s.started_timestamp, s.ended_timestamp, s.first_timestamp) == (5, -5, 4000, 4000, 0)


def folded(rows, count=None, size=None, millis=None):
    """(queue, eid) -> batch of rows (queue, eid, size, ms), one after the other."""
    want = {}
    for q in {r[0] for r in rows}:
        batch, n, b, first = 0, 0, 0, None
        for _, eid_, s, ms in sorted((r for r in rows if r[0] == q), key=lambda r: (r[1], r[2] or 0)):
            if n and ((count and n >= count) or (size and b >= size) or (millis and ms - first >= millis)):
                batch, n, b = batch + 1, 0, 0
            first = ms if not n else first
            n, b = n + 1, b + (s or 0)
            want[q, eid_] = batch
    return want


@pytest.mark.parametrize("limits", [{"count": 9, "size": 40}, {"size": 30}, {"size": 1000, "millis": 9_000_000}, {"millis": 500}, {"count": 1}, {"size": 10**9}])
def test_batches_are_those_of_a_fold(spark, limits, monkeypatch):
    """Over hours, several blocks of a chain, null keys and sizes, sizes of 0, and batches longer than a block."""
    monkeypatch.setattr(points, "BLOCK", 16)
    monkeypatch.setattr(batching, "BLOCK", 16)
    r = random.Random(6)
    rows = []
    for q, n in (("a", 160), ("b", 1), (None, 90), ("c", 33)):
        ms = MS
        for i in range(n):
            ms += r.choice([0, 10, 700, 100_000, 4_000_000])
            rows.append((q, f"z/{time.strftime('%Y/%m/%d/%H/%M', time.gmtime(ms / 1000))}/{ms}-{i:07d}", r.choice([None, 0, 0, 3, 11, 25]), ms))
    e = spark.createDataFrame([x[:3] for x in rows], "queue string, eid string, size long").repartition(5)
    got = batching.limit_batches(e, ["queue"], **limits).collect()
    assert {(x.queue, x.eid): x.batch for x in got} == folded(rows, **limits) and len(got) == len(rows)


def test_batches(spark):
    e = events(spark, 7)
    b = batching.merge_batches(batching.number_batches(e, 3)).orderBy("batch").collect()
    assert [(len(x.events), x.units, x.end is None) for x in b] == [(3, 3, False), (3, 3, False), (1, 1, True)]
    by = [r.batch for r in batching.limit_batches(e, ["queue"], size=150).orderBy("eid").collect()]
    assert by == [0, 0, 1, 1, 2, 2, 3]
    assert [r.batch for r in batching.limit_batches(e, ["queue"], count=2, millis=10**9).orderBy("eid").collect()] == [0, 0, 1, 1, 2, 2, 3]
    with pytest.raises(ValueError, match="needs a limit"):
        batching.limit_batches(e)


def test_reduce_checkpoints(spark):
    rows = [(k, None, "b", d, "q", f"z/{9 - k}", k) for k in range(7) for d in ("read", "write")]
    schema = "worker int, error string, bot string, direction string, queue string, checkpoint string, records int"
    got = {r.direction: (r.checkpoint, r.records) for r in stats.reduce_checkpoints(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"read": ("z/3", 6), "write": ("z/9", 0)}
    with pytest.raises(Exception, match="a worker failed"):
        stats.reduce_checkpoints(spark.createDataFrame([*rows, (7, "boom", "b", "read", "q", "z/1", 1)], schema)).collect()


def test_compare_and_set(spark):
    old = spark.createDataFrame([("b", "read", "q", "z/1"), ("b", "write", "q", "z/1")], "bot string, direction string, queue string, checkpoint string")
    ask = "bot string, direction string, queue string, expected string, eid string, force boolean"
    cases = [(("b", "read", "q", "z/1", "z/2", False), ("applied", "z/2")), (("b", "read", "q", "z/0", "z/2", False), ("stale", "z/1")), (("b", "read", "q", "z/0", "z/2", True), ("applied", "z/2")), (("b", "write", "q", "z/0", "z/2", False), ("applied", "z/2")), (("c", "read", "q", "z/0", None, False), ("applied", "z/0"))]
    for proposal, want in cases:
        r = state.advance_checkpoints(old, spark.createDataFrame([proposal], ask)).first()
        assert (r.status, r.checkpoint) == want


def test_upserts(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k long, x string, y double")
    u = spark.createDataFrame([(2, "c", None, 1), (2, None, 5.0, 2), (3, "d", None, 1)], "k long, x string, y double, seq long")
    assert sorted(map(tuple, state.keyed_upsert(t, u, ["k"], "seq").collect()), key=str) == [(1, "a", 1.0), (2, None, 5.0), (3, "d", None)]
    assert sorted(map(tuple, state.merge_upsert(t, u, ["k"], "seq").collect()), key=str) == [(1, "a", 1.0), (2, "c", 5.0), (3, "d", None)]


def test_trace_stops_at_a_known_bot(spark):
    rows = [("a", "z/1", "b1", None, None), ("b", "z/2", "b2", "a", "z/1"), ("a", "z/3", "b1", "b", "z/2"), ("c", "z/4", "b3", "a", "z/3")]
    e = spark.createDataFrame(rows, "queue string, eid string, bot string, source string, start string").withColumns({"timestamp": F.lit(7), "event_source_timestamp": F.lit(5)})
    got = lineage.trace_upstream(e.where("eid = 'z/4'").select("queue", "eid"), e).orderBy("hop").collect()
    assert [(r.eid, r.lag) for r in got] == [("z/4", 2), ("z/3", 2), ("z/2", 2)]  # z/1 is b1's again


def test_find_ids_and_entities(spark):
    ids = spark.createDataFrame([(1,), (None,)], "id long")
    got = joins.find_ids({"a": ids, "b": spark.createDataFrame([(7,)], "id long")}, {"a": True, "b": spark.createDataFrame([(7, 1), (7, 2)], "id long, root long")})
    assert sorted(r.id for r in got.collect()) == [1, 2]
    e = joins.build_entities(spark.createDataFrame([(1,), (2,)], "k long"), "k", many={"kids": (spark.createDataFrame([(1, 5)], "k long, v long"), "k")})
    assert sorted((r.k, len(r.kids)) for r in e.collect()) == [(1, 1), (2, 0)]


def _shop(spark, path):
    """Orders 1 to 4 with lines of any date or none, 5 and 6 without; customer 50 is in debt."""
    shipped = [(1, "1995-01-02"), (2, "1998-06-30"), (3, None), (4, "2001-11-04"), (4, "2001-11-04")]
    tables = {
        "lineitem": spark.createDataFrame([(k, 10 * k + n, n, d) for n, (k, d) in enumerate(shipped)], "l_orderkey long, l_partkey long, l_linenumber int, d string").withColumn("l_shipdate", F.col("d").cast("timestamp_ntz")).drop("d"),
        "orders": spark.createDataFrame([(k, 10 * k) for k in range(1, 7)], "o_orderkey long, o_custkey long"),
        "customer": spark.createDataFrame([(10 * k, -600.0 if k == 5 else 0.0) for k in range(1, 7)], "c_custkey long, c_acctbal double"),
        "part": spark.createDataFrame([(43, 7), (44, 8)], "p_partkey long, p_size int"),
    }
    con = duckdb.connect()
    for name, rows in tables.items():
        rows.write.parquet(f"{path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'")
    return con


def test_ids_of_lines_of_any_date(spark, tmp_path):
    con = _shop(spark, tmp_path)
    got = sorted(r.id for r in stats_plans.find_ids(spark, str(tmp_path)).collect())
    assert got == [1, 2, 3, 4, 5] == sorted(k for (k,) in con.execute(stats_plans.SQL["find_ids"]).fetchall())


def test_entities_of_lines_of_any_date(spark, tmp_path):
    con = _shop(spark, tmp_path)
    got = sorted(tuple(r) for r in stats_plans.load_entities(spark, str(tmp_path)).collect())
    parts = {1: "10", 2: "21", 3: "32", 4: "43,44", 5: ""}
    assert got == [("entities", "order_entities", 1710000000000, f'{{"order":{k},"parts":[{p}]}}') for k, p in parts.items()]
    assert got == sorted(con.execute(stats_plans.SQL["load_entities"]).fetchall())


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a":1}\n\nnot json\n{"a":2}\n')
    assert sorted(r.a for r in formats.read_jsonl(spark, str(tmp_path), "a long", True).where("a is not null").collect()) == [1, 2]
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        formats.read_jsonl(spark, str(tmp_path), "a long").collect()


def test_csv_of_any_text(spark, tmp_path):
    text = [None, "", " ", "\n", "\x00", "\\N", " \\N\t", "\\\n\\N", "\\", '"', '""', ' "a" , b ', 'a\x00"b', "a\x00,b", "a\r\nb\r", "\u2028a\u00a0", "x" * 1_048_570 + '",' * 9]
    label = [None, "", " ", "\\N", " a ", "a\nb", "\r", "\x00", 'a,"b', "+%25"]
    texts = [(k, t, "en", "web", 499 if k % 2 else 500) for k, t in enumerate(text)]
    labels = [(100 + k, "a", x, label[-k], None if k % 3 == 2 else 9) for k, x in enumerate(label)]
    spark.createDataFrame(texts + labels, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = sorted(tuple(r) for r in format_plans.csv_roundtrip(spark, str(tmp_path)).collect())
    assert got == sorted(con.execute(format_plans.SQL["csv_roundtrip"]).fetchall())
    assert [r[1] for r in got[:8]] == [None, "", "", "", "", "\\N", "\\N", "\\\\N"]


def test_rules_skip_after_required(spark):
    d = spark.createDataFrame([(1, None), (2, "ab")], "k long, x string")
    rules = [("x", "required", "error", F.col("x").isNotNull()), ("x", "match", "warn", F.col("x").rlike("^z"))]
    assert sorted((r.k, r.rule) for r in process.violations(d, "k", rules).collect()) == [(1, "required"), (2, "match")]


def test_polling_stops_at_empty_and_at_its_cap(spark):
    rows = spark.range(25).withColumnRenamed("id", "p")
    fetch = lambda at: rows.where((F.col("p") > at) & (F.col("p") <= at + 10))
    assert formats.poll_pages(fetch, -1, 10).count() == 25
    assert formats.poll_pages(fetch, -1, 10, records=15).count() == 20
    assert formats.poll_pages(fetch, 99, 10) is None
    spark.dataSource.register(formats.PollingSource)
    assert spark.read.format("polling").option("last", 2499).option("records", 1234).load().agg(F.max("position"), F.count(F.lit(1))).first()[:] == (1233, 1234)
    assert spark.read.format("polling").option("last", 2499).option("ranges", 3).load().agg(F.sum("position")).first()[0] == 2500 * 2499 // 2


def test_streams_give_all_rows_or_an_error(spark, tmp_path):
    """Three micro-batches; a run limit that is reached gives no partial rows."""
    spark.range(30).selectExpr("'q' as queue", "lpad(id, 4, '0') as eid", "10 as size").repartition(3).write.parquet(f"{tmp_path}/t.parquet")
    stream = lambda: streams.stream_table(spark, str(tmp_path), "t", files_per_batch=1)
    slow = lambda number, out: time.sleep(3)
    assert streams.run_batches(stream(), lambda b: b, slow).count() == 30
    with pytest.raises(TimeoutError):
        streams.run_batches(stream(), lambda b: b, slow, seconds=2)
    with pytest.raises(TimeoutError):
        streams.batch_stream(stream(), 100, seconds=0.01)
    assert all(inspect.signature(f).parameters["seconds"].default is None for f in (streams.run_batches, streams.batch_stream))


def test_polling_goes_on_over_a_gap(spark, tmp_path):
    from tallyweir.plans import format_plans

    spark.range(10).selectExpr("if(id < 5, id, id + 1000000) as o_orderkey", "id as o_custkey", "1.0 as o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    assert format_plans.polling_source(spark, str(tmp_path)).count() == 10


def test_long_traces_are_whole_or_an_error(spark):
    n = 35
    e = spark.createDataFrame([(f"q{k}", f"z/{k}", f"b{k}", f"q{k - 1}" if k else None, f"z/{k - 1}" if k else None, 7, 5) for k in range(n)], "queue string, eid string, bot string, source string, start string, timestamp long, event_source_timestamp long").coalesce(1)
    root = e.where(f"queue = 'q{n - 1}'").select("queue", "eid")
    assert lineage.trace_upstream(root, e).count() == n
    with pytest.raises(ValueError):
        lineage.trace_upstream(root, e, hops=3)
    reads = spark.createDataFrame([(f"b{k}", f"q{k}", "z/9", 7) for k in range(n)], "bot string, queue string, checkpoint string, source_timestamp long").coalesce(1)
    writes = spark.createDataFrame([(f"b{k}", f"q{k + 1}") for k in range(n)], "bot string, queue string").coalesce(1)
    start = spark.createDataFrame([("z/1", "z/1", 5, "q0")], "root string, eid string, event_source_timestamp long, queue string")
    assert lineage.trace_downstream(start, reads, writes).count() == n
    with pytest.raises(ValueError):
        lineage.trace_downstream(start, reads, writes, hops=3)


def acked(rows):
    return bots.enrich(rows, "b", "out", lambda r: (F.when(F.col("timestamp") % 2000 == 0, "emit").otherwise("ack"), F.col("payload")))


def test_a_repeated_batch_changes_nothing(spark):
    run, seen = BotRun(spark), []
    for number, rows in ((0, events(spark, 4)), (1, events(spark, 9)), (1, events(spark, 9)), (0, events(spark, 4))):
        run.write(number, acked(rows), lambda n, error, checkpoints: seen.append((n, error, checkpoints.first().checkpoint[-1])))
    assert run.output().count() == 2 + 5
    assert [(r.checkpoint[-1], r.records) for r in run.checkpoints().collect()] == [("8", 13)]
    assert seen == [(0, None, "3"), (1, None, "8"), (1, None, "8"), (0, None, "3")]


def test_a_failed_batch_moves_no_checkpoint(spark):
    run, seen = BotRun(spark), []
    run.write(0, acked(events(spark, 3)))
    worked = acked(events(spark, 9))
    with pytest.raises(Exception, match="boom"):
        run.write(1, bots.Worked(worked.output.withColumn("payload", F.raise_error(F.lit("boom"))), worked.checkpoints), lambda n, error, checkpoints: seen.append((n, error is not None, checkpoints)))
    assert seen == [(1, True, None)] and run.checkpoints().first().checkpoint[-1] == "2"


def test_bots_over_several_micro_batches(spark):
    numbers = []
    run = run_bot(streams.deal(events(spark, 40), 4), acked, lambda n, error, checkpoints: numbers.append(n))
    assert len(set(numbers)) == 4 and run.output().count() == 20
    assert [(r.checkpoint[-2:], r.records) for r in run.checkpoints().collect()] == [("39", 40)]


def test_offload_drops_and_batches(spark):
    kept = lambda rows: F.when(F.col("timestamp") < 5000, F.col("payload"))
    one, three = (bots.offload(events(spark, 12), "b", kept, n) for n in (1, 3))
    assert [r.delivery for r in one.output.orderBy("eid").collect()] == [f'{{"data":{k}}}' for k in range(5)]
    assert [(r.delivery, r.records) for r in three.output.orderBy("eid").collect()] == [('[{"data":0},{"data":1},{"data":2}]', 3), ('[{"data":3},{"data":4}]', 2)]
    assert one.checkpoints.first().checkpoint[-1] == three.checkpoints.first().checkpoint[-1] == "4"


def test_manual_checkpoint_waits_for_flush(spark):
    manual = ManualCheckpoint(spark)
    manual.flush()
    manual.add(acked(events(spark, 3)).checkpoints)
    assert manual.checkpoints().count() == 0
    manual.flush()
    manual.flush()
    manual.add(acked(events(spark, 9)).checkpoints)
    assert [(r.checkpoint[-1], r.records) for r in manual.checkpoints().collect()] == [("2", 3)]
    manual.flush()
    assert [(r.checkpoint[-1], r.records) for r in manual.checkpoints().collect()] == [("8", 12)]


def test_interval_join_against_all_pairs(spark):
    """Spans that overlap, hold one another, cross hours or have no end; points at their edges, twice and elsewhere."""
    r = random.Random(1)
    at = lambda m: f"z/2024/01/{1 + m // 1440:02d}/{m // 60 % 24:02d}/{m % 60:02d}/{1704067200000 + 60000 * m}-0000000"
    spans = []
    for k in range(60):
        a = r.randrange(3000)
        spans.append((r.choice("ab"), at(a), None if k % 7 == 0 else at(a + r.choice([0, 1, 5, 200, 1500])), f"s{k}"))
    points = [(r.choice("abc"), at(r.randrange(4000))) for _ in range(150)] + [(s, x) for s, x, _, _ in spans] * 2 + [(s, y) for s, _, y, _ in spans if y] + [("a", None)]
    got = joins.correlation_search(spark.createDataFrame(points, "source string, x string"), spark.createDataFrame(spans, "source string, start string, end string, eid string"))
    want = [(q, x, a, b, f) for q, x in points if x for s, a, b, f in spans if q == s and (x == a or (b is not None and a <= x <= b))]
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_asof_against_a_scan_also_where_checkpoints_fall(spark):
    r = random.Random(2)
    at = lambda m: f"z/2024/01/{1 + m // 1440:02d}/{m // 60 % 24:02d}/{m % 60:02d}/{1704067200000 + 60000 * m}-0000000"
    label = lambda h: f"hour_2024-01-{1 + h // 24:02d} {h % 24:02d}"
    rows, wanted = [], []
    for bot in "xyz":
        mark = 0
        for h in sorted(r.sample(range(72), 40)):
            mark = max(0, mark - 900) if r.random() < 0.08 else max(mark, 60 * h - r.randrange(300))
            rows.append((bot, "q", label(h), at(mark)))
    wanted = [(bot, "q", at(m), label(min(71, m // 60 + r.choice([0, 0, 1, 5])))) for bot in "xyzw" for m in r.sample(range(4500), 80)]
    got = {(x.bot, x.eid, x.bucket): x.found for x in joins.checkpoint_asof(spark.createDataFrame(wanted, "bot string, queue string, eid string, bucket string"), spark.createDataFrame(rows, "bot string, queue string, bucket string, checkpoint string")).collect()}
    want = {(b, e, k): min((x for o, _, x, c in rows if o == b and x >= k and c >= e), default=None) for b, _, e, k in wanted}
    assert got == want and None in want.values() and len(set(want.values())) > 20
    asked = spark.createDataFrame(wanted, "bot string, queue string, y string, x string")
    reached = points.first_reached(asked, spark.createDataFrame(rows, "bot string, queue string, place string, top string"), ["bot", "queue"], share=5, size=7)
    assert {(x.bot, x.y, x.x): x.found for x in reached.collect()} == want


def test_reach_against_a_scan():
    r = random.Random(5)
    for n in (1, 2, 3, 7, 64, 100):
        tops = np.array([b"%03d" % r.randrange(120) for _ in range(n)])
        begin, want = np.array([r.randrange(n + 1) for _ in range(300)]), np.array([b"%03d" % r.randrange(125) for _ in range(300)])
        scan = [next((k for k in range(b, n) if tops[k] >= w), n) for b, w in zip(begin, want, strict=True)]
        assert points._reach(tops)(begin, want).tolist() == scan


def test_asof_of_a_bot_that_is_rewound_a_thousand_times(spark):
    r = random.Random(6)
    rows, mark = [], 0
    for m in range(6000):
        mark = mark - 40 if m % 6 == 5 else mark + r.randrange(24) if m < 5000 or m > 5400 else mark  # it stands still for a while
        rows.append(("b", "q", f"{m:06d}", f"{max(mark, 0):06d}"))
    rows += [(None, "q", "000001", "000009"), ("b", "q", None, "999999"), ("b", "q", "000003", None), *rows[10:20]]
    wanted = [("b", "q", f"{r.randrange(18000):06d}", f"{r.randrange(6200):06d}") for _ in range(400)]
    wanted += [("b", "q", None, "000000"), ("b", "q", "000000", None), (None, "q", "000001", "000000"), ("c", "q", "000001", "000000"), wanted[0]]
    schema = "bot string, queue string, {} string, {} string"
    asked, told = spark.createDataFrame(wanted, schema.format("eid", "bucket")), joins.checkpoint_blocks(spark.createDataFrame(rows, schema.format("bucket", "checkpoint")))
    got = joins.checkpoint_asof(asked, told).collect()
    scan = lambda b, e, k: min((x for o, _, x, c in rows if b and o == b and x and c and e and k and x >= k and c >= e), default=None)
    assert {(x.bot, x.eid, x.bucket): x.found for x in got} == {(b, e, k): scan(b, e, k) for b, _, e, k in wanted}
    assert len(got) == len(set(wanted)) and sum(x.found is None for x in got) < 300
    few = points.first_reached(asked.withColumnsRenamed({"eid": "y", "bucket": "x"}), told.drop("block"), ["bot", "queue"], share=3, size=50)
    assert {(x.bot, x.y, x.x): x.found for x in few.collect()} == {(x.bot, x.eid, x.bucket): x.found for x in got}


def test_reads_choose_by_registry(spark):
    row = lambda q, n: (q, f"z/2024/01/0{n}/00/00/{n}", n)
    e = spark.createDataFrame([row("q", n) for n in range(3, 7)] + [row("q/_snapshot", n) for n in (1, 2)] + [row("q/_archive", n) for n in (1, 2, 3)], "queue string, eid string, n int")
    known = {"snapshot_next": "z/2024/01/04", "archive_end": "z/2024/01/03/00/00/3"}
    got = lambda start, r: sorted(x.n for x in read.read_registered(e, "q", start, r).collect())
    assert got("z/", known) == got("z/ ", known) == [1, 2, 4, 5, 6]
    assert got("z/2024/01/02", known) == [2, 3, 4, 5, 6]
    assert got("z/2024/01/05", known) == [5, 6]
    assert got("z/", {}) == [3, 4, 5, 6]


def test_byte_budget_edges(spark):
    rows = [("q", f"z/2024/01/01/{h:02d}/00/{h}-{k:07d}", (h * 7 + k) % 5) for h in range(6) for k in range(9)]
    e = spark.createDataFrame(rows, "queue string, eid string, size long")
    for size in (0, 1, 17, 18, 40, 90, 10**6):
        want, before = [], 0
        for _, eid_, s in sorted(rows, key=lambda r: r[1]):
            if before < size:
                want.append(eid_)
            before += s
        assert sorted(r.eid for r in read.read_byte_budget(e, "q", size).collect()) == want
    assert read.read_byte_budget(e, "none", 10).count() == 0


def test_a_hot_day_is_many_archive_files(spark, tmp_path):
    e = spark.range(4000).selectExpr("'q' as queue", "lpad(id, 6, '0') as eid", "date'2024-01-01' as dt").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one file
    try:
        formats.write_archive(e, f"{tmp_path}/x")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(f"{tmp_path}/x").groupBy(F.input_file_name()).agg(F.min("eid").alias("a"), F.max("eid").alias("b"), F.count(F.lit(1)).alias("n")).orderBy("a").collect()
    assert len(files) > 1 and sum(f.n for f in files) == 4000 and all(x.b < y.a for x, y in zip(files, files[1:]))


def test_polling_by_state_goes_on_over_gaps(spark, tmp_path):
    """200 rows with a gap of 50,000 positions, in a batch of several ranges and as a stream of pages."""

    class Gappy(formats.PollingSource):
        fields = "position long, name string"

        @classmethod
        def name(cls):
            return "gappy"

        @staticmethod
        def poll(after, last, most):
            there = [*range(100), *range(50_000, 50_100)]
            return [(k, f"n{k}") for k in there if after < k <= last][:most]

    spark.dataSource.register(Gappy)
    want = sum(range(100)) + sum(range(50_000, 50_100))
    for ranges in (1, 7):
        assert spark.read.format("gappy").option("last", 60_000).option("ranges", ranges).option("page", 30).load().agg(F.count(F.lit(1)), F.sum("position")).first()[:] == (200, want)
    query = spark.readStream.format("gappy").option("last", 60_000).option("page", 70).load().writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").start()
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{tmp_path}/out").agg(F.count(F.lit(1)), F.sum("position")).first()[:] == (200, want)


def test_polling_ends_at_its_caps():
    forever = lambda after, last, most: [(after + 1 + k,) for k in range(most)]
    assert len(list(formats.polled(forever, -1, 10**9, 2500))) == 2500
    slow = lambda after, last, most: time.sleep(0.05) or [(after + 1,)]
    assert 1 <= len(list(formats.polled(slow, -1, 10**9, 10**9, seconds=0.3))) <= 7


def test_put_one_and_many(spark, tmp_path):
    path = f"{tmp_path}/q"
    formats.put_events(spark, [{"payload": "{}"}], path, "b", "q", 0, now=MS)
    for _ in range(2):  # repeated, it changes nothing
        formats.put_events(spark, [{"payload": '{"a":1}', "timestamp": MS + 1}, {"payload": '{"a":2}', "timestamp": MS + 1}, {"payload": '{"a":3}', "event": "other", "id": "own"}], path, "b", "q", 1, now=MS)
    got = [(r.queue, r.eid[-9:], r.bot, r.payload, r.event_source_timestamp - MS) for r in spark.read.parquet(path).orderBy("payload").collect()]
    assert got == [("q", "6-0000000", "b", '{"a":1}', 1), ("q", "6-0000001", "b", '{"a":2}', 1), ("other", "5-0000000", "own", '{"a":3}', 0), ("q", "5-0000000", "b", "{}", 0)]


def test_append_by_hash_key(spark, tmp_path):
    formats.append_batch(spark.range(100).withColumn("key", (F.col("id") % 3).cast("string")), f"{tmp_path}/k", 0, key=hashing.partition_of(F.col("key"), 3), records_per_file=20)
    rows = spark.read.parquet(f"{tmp_path}/k").select("key", F.input_file_name().alias("f"))
    assert rows.groupBy("f").count().agg(F.max("count"), F.sum("count")).first()[:] == (20, 100)
    assert rows.groupBy("key").agg(F.countDistinct(F.regexp_extract("f", "part-(\\d+)", 1)).alias("n")).agg(F.max("n")).first()[0] == 1


def test_wildcards(spark):
    bodies = ['{"a":{"x":{"n":1,"m":2},"y":{"m":3},"z":{"n":"q"}},"l":[{"s":"u"},{},{"s":"v"}]}', '{"a":{},"l":[]}', '{"a":5}', "broken", None]
    rows = spark.createDataFrame([(k, b) for k, b in enumerate(bodies)], "k int, b string")
    got = formats.project_payload(rows, "b", {"a.*.n": "Number", "l.*.s": "String", "a.*.*": "String"}).orderBy("k").collect()
    assert got[0].a_all_n == {"x": 1.0} and got[0].l_all_s == {"0": "u", "2": "v"}
    assert got[0].a_all_all["x"] == {"n": "1", "m": "2"}
    assert got[1].a_all_n == {} and all(not g.a_all_n for g in got[2:])


def test_deep_merge(spark):
    kind = "k long, v struct<a:int,b:struct<c:string,d:array<int>>>"
    t = spark.createDataFrame([(1, (1, ("x", [1]))), (2, (5, None)), (4, None)], kind)
    u = spark.createDataFrame([(1, (None, ("y", None)), 1), (1, (7, None), 2), (2, (None, (None, [3])), 1), (3, (None, ("z", None)), 1)], f"{kind}, seq long")
    got = {r.k: r.v and r.v.asDict(True) for r in state.merge_upsert(t, u, ["k"], "seq").collect()}
    assert got == {1: {"a": 7, "b": {"c": "y", "d": [1]}}, 2: {"a": 5, "b": {"c": None, "d": [3]}}, 3: {"a": None, "b": {"c": "z", "d": None}}, 4: None}


def test_correlations(spark):
    e = events(spark, 3)
    r = batching.correlation(e).first()
    assert (r.source, r.start[-1], r.end[-1], r.partial_start, r.units) == ("q", "0", "2", None, 3)
    r = batching.correlation(e.limit(1), partial=True).first()
    assert (r.start, r.end, r.partial_start[-1], r.partial_end) == (None, None, "0", None)
    with pytest.raises(ValueError):
        batching.correlation(e.limit(0))


def test_manifest_of_files(spark, tmp_path):
    rows = [("q", f"z/{k:03d}", "ab"[k % 2], 10, None if k == 3 else 2, "s" if k else None, f"z/{k - 1:03d}", k, k - 1) for k in range(10)]
    e = spark.createDataFrame(rows, "queue string, eid string, bot string, size long, units long, source string, start string, timestamp long, event_source_timestamp long").withColumn("dt", F.lit("2024-01-01").cast("date"))
    for part in (e.where("eid < 'z/004'"), e.where("eid >= 'z/004'")):
        part.withColumn("q", F.col("queue")).coalesce(1).write.mode("append").partitionBy("q", "dt").parquet(f"{tmp_path}/m")
    a, b = formats.manifest(spark, f"{tmp_path}/m").orderBy("start").collect()
    assert (a.start, a.end, a.records, a.size, a.offset, a.byte_offset) == ("z/000", "z/003", 4, 40, 0, 0)
    assert (b.start, b.end, b.records, b.size, b.offset, b.byte_offset) == ("z/004", "z/009", 6, 60, 4, 40)
    assert a.gzip_size > 0 and a.stats["b"].asDict() == {"units": 3, "start": 2, "end": 3, "checkpoint": "z/002"}
    assert [c.asDict() for c in b.correlations] == [{"source": "s", "start": "z/003", "end": "z/008", "records": 12}]


def test_ranges_end_with_their_bucket(spark):
    e = spark.createDataFrame([("q", 60_000 * m) for m in (0, 3, 4, 5, 9, 14, 400, 1500)], "queue string, timestamp long")
    got = {(r.range, r.bucket // 60_000): r.range_n for r in stats.range_counts(e, ["queue"]).collect()}
    assert got["minute_5", 4] == 3 and got["minute_5", 5] == 3 and got["minute_15", 14] == 6 and got["hour_6", 360] == 1 and got["day", 360] == 7 and got["day", 1500] == 2 and got["week", 1500] == 8


def test_paths_end_where_nothing_is_found(spark):
    eid_ = lambda ms: f"z/2022/03/24/19/{14 + (ms // 60_000):02d}/{MS // 60_000 * 60_000 + ms}-0000000"
    at = lambda ms: MS // 60_000 * 60_000 + ms
    made = [("out", eid_(m), at(m), at(m) - 5, "in", eid_(a), b and eid_(b)) for m, a, b in ((5000, 1000, 3000), (9000, 1000, 1500), (200_000, 6000, None))]
    roots = [(f"r{m}", "in", eid_(m), at(m)) for m in (1200, 2500, 6000, 7000)]
    stood = lambda grain: [("b", "in", f"{grain}", eid_(9000))]
    tables = {"hour": spark.createDataFrame(stood("hour_2022-03-24 19"), "bot string, queue string, bucket string, checkpoint string"), "minute_1": spark.createDataFrame(stood("minute_2022-03-24 19:14"), "bot string, queue string, bucket string, checkpoint string")}
    e = spark.createDataFrame(made, "queue string, eid string, timestamp long, event_source_timestamp long, source string, start string, end string")
    got = {r.root: (r.eid, r.lag) for r in lineage.trace_path(spark.createDataFrame(roots, "root string, queue string, eid string, timestamp long"), e, tables, [("b", "out")]).collect()}
    assert got == {"r1200": (eid_(5000), 5), "r2500": (eid_(5000), 5)}  # 6000's is more than a minute later, 7000 has none
