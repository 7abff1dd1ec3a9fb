"""The training-data operators against brute force, round trips and held-out labels, with edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SF, rows_of
from pyspark.sql import functions as F

from tallyweir.llm import chat, decontam, host_rules, langid, licenses, minhash, packing, queries, spans, warc, weak_labels
from tallyweir.llm.tables import table

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "stone river light window garden silver morning paper yellow market simple winter table music forest candle bridge letter ocean summer".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", "."]) for _ in range(n))


def docs_of(spark, texts, **more):
    rows = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC).withColumns({k: F.lit(v) for k, v in more.items()})


def odd_texts():
    """Null, empty, blank, one word, very long, repeated, and other white space."""
    return [None, "", " \n\t ", "word", "A b\tC\x0bd e f", prose(1, 60), prose(1, 60), prose(2, 40_000), "x" * 50_000, "é ß 漢字 😀 " * 5]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_as_sql(spark, duck, name):
    assert rows_of(queries.QUERIES[name](spark, SF).toPandas()) == rows_of(duck.execute(queries.ORACLE_SQL[name]).df())


# 1: chat

def brute_chat(turns):
    by = defaultdict(list)
    for c, t, r, x in turns:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, ts in by.items():
        ts.sort()
        said = "".join(x for _, _, r, x in ts if r == "assistant")
        out[c] = (len(ts), hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in ts).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_chat_reads_back(spark):
    r = random.Random(5)
    bits = ["</s>", "[INST]", "[/INST]", "[NEXT]", "<s>", "\\", "<", "[", "[\\INST]", "<\\\\/s>", "hi", "é", "\n", " ", "$1", "s>"]
    turns = [(c, t, r.choice(["user", "assistant", "assistant", "system", None, "[INST]"]), r.choice([None, "", "".join(r.choice(bits) for _ in range(9))])) for c in range(30) for t in range(r.choice([1, 3, 200]))]
    turns += [(50, None, "user", "a"), (50, 1, "assistant", "b"), (50, 1, "assistant", "b"), (None, 0, "user", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({"blocks": F.lit(1), "segments": F.lit(2), "formatted": F.lit("x")})
    got = {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in chat.digests(chat.format_chat(df)).collect()}
    assert got == brute_chat(turns)
    assert chat.format_chat(df.limit(0)).count() == 0


def test_chat_merges_adjacent_roles(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", "</s>")], "conv_id long, turn long, role string, text string")
    assert chat.format_chat(df).first().formatted == "<s>[INST]user[/INST]a</s><s>[INST]assistant[/INST]b[NEXT]<\\/s></s>"


def test_long_conversations_merge_over_chunks(spark):
    """One role over many chunks, and roles that change at the edges of chunks."""
    n = chat.CHUNK
    rows = [(1, t, "user", f"a{t}") for t in range(5 * n)] + [(2, t, "user" if t // n % 2 else "assistant", f"b{t}") for t in range(4 * n)] + [(3, t, "user" if t < n + 3 else "assistant", "c") for t in range(3 * n)] + [(4, 0, "user", "d")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    blocks = {r.conv_id: [(b.role, len(b.texts)) for b in r.blocks] for r in chat.blocks_of(df).collect()}
    assert blocks == {1: [("user", 5 * n)], 2: [("assistant", n), ("user", n)] * 2, 3: [("user", n + 3), ("assistant", 2 * n - 3)], 4: [("user", 1)]}
    got = {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in chat.digests(chat.format_chat(df)).collect()}
    assert got == brute_chat(rows)


# 2: near duplicates

def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: (len(s), top(i)) for i, s in sets}


def edited(text, seed, edits):
    r, w = random.Random(seed), text.split(" ")
    for _ in range(edits):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


def test_near_duplicates_brute_force(spark):
    texts = odd_texts() + ["Word", "a b c d e f g h i j k", "a b c d e f g h i j", "A B C D E"]
    for k in range(12):  # groups whose members are near the threshold, and linked through others only
        base = prose(100 + k, 60 + 40 * k)
        texts += [edited(base, 1000 * k + j, j % (3 + k // 2)) for j in range(14)]
    rows = list(enumerate(texts))
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, component_id long, keys string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == brute_components(rows)
    # the same result whatever way open pairs take
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, slack=0).collect()} == got
    kept = minhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in got.items() if i == c}


def test_near_duplicates_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == [(1, 1, True), (2, 1, False), (2, 1, False), (None, None, True)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


# 3: classifier

def test_classifier_held_out(spark):
    got = weak_labels.classify(table(spark, "/root/testdata/sf0.01", "documents")).toPandas().set_index("doc_id")
    labels = table(spark, "/root/testdata/sf0.01", "labels").toPandas().set_index("doc_id")
    j = got.join(labels, how="inner", lsuffix="_ours")
    assert (j.good == (j.quality == 1)).mean() > 0.97
    assert (j.toxic_ours == (j.toxic == 1)).mean() > 0.93
    assert j[(j.quality == 1) & (j.toxic == 0)].kept.mean() > 0.97


def test_classifier_edges(spark):
    df = docs_of(spark, odd_texts(), raw=1, good=2, quality_score=3)
    out = weak_labels.classify(df)
    assert out.count() == len(odd_texts()) and out.where("quality_score is null or toxic_score is null").count() == 0
    assert weak_labels.classify(df.limit(0)).count() == 0


def test_classifier_learns_insults_of_other_languages(spark):
    """Terms come from the labels of even documents; toxic texts without any English insult are judged on the odd ones."""
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    got = weak_labels.classify(docs, labels.where("doc_id % 2 = 0")).toPandas().set_index("doc_id")
    j = got.join(labels.where("doc_id % 2 = 1").toPandas().set_index("doc_id"), how="inner", lsuffix="_ours").join(docs.select("doc_id", "lang").toPandas().set_index("doc_id"))
    assert j[j.toxic == 1].toxic_ours.mean() > 0.85 and j[j.toxic == 0].toxic_ours.mean() < 0.005
    assert j[(j.toxic == 1) & j.lang.isin(["de", "fr"])].toxic_ours.mean() > 0.8


def test_labelled_terms_edges(spark):
    clean = [(i, f"{prose(i, 40)}") for i in range(60)]
    toxic = [(100 + i, f"{prose(100 + i, 20)} gribblewort gribblewort {prose(200 + i, 20)}") for i in range(24)]
    docs = spark.createDataFrame([*clean, *toxic, (None, "gribblewort"), (900, None), (901, "")], "doc_id long, text string")
    marks = [(i, 0) for i, _ in clean] + [(i, 1) for i, _ in toxic] + [(100, 0), (None, 1), (5, None), (900, 1), (901, 1), (5000, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    sizes = lambda *x: [len(t) for t in weak_labels.labelled_terms(*x)[0]]
    word = 1 + len(weak_labels.STEMS)  # the word and its beginnings
    assert sizes(docs, labels) == [word] * 3
    assert sizes(docs, None) == sizes(docs, labels.limit(0)) == sizes(docs.limit(0), labels) == [0] * 3
    got = weak_labels.classify(docs, labels)
    assert got.count() == docs.count() and got.where("toxic and doc_id < 100").count() == 0
    # a document isn't judged by its own label: with toxic labels in fold 0 only that fold has no terms
    fold = {r.doc_id: r.f for r in docs.select("doc_id", weak_labels.fold_of(F.col("doc_id")).alias("f")).collect()}
    one = spark.createDataFrame([(i, x) for i, x in marks if x != 1 or fold.get(i) == 0], "doc_id long, toxic int")
    assert sizes(docs, one) == [0, word, word]
    # copies of one toxic text are one text: their words aren't terms
    copies = spark.createDataFrame([*clean, *((100 + i, f"{prose(7777, 60)} unusual {'x' * i}") for i in range(60))], "doc_id long, text string")
    assert sizes(copies, spark.createDataFrame([(i, int(i >= 100)) for i in [*range(60), *range(100, 160)]], "doc_id long, toxic int")) == [0] * 3
    # a row that is repeated many times counts once
    again = docs.union(spark.createDataFrame([(0, "gribblewort gribblewort gribblewort")] + [(100, toxic[0][1])] * 400, docs.schema))
    assert sizes(again, labels) == [word] * 3


def brute_em(votes, labellers, kinds, rounds=300):
    """P(bad) of each document's votes, document by document."""
    spots = [[labellers.index(x) for x in kind] for kind in kinds]
    p = []
    for v in votes:
        seen = [sum(v[k] == weak_labels.BAD for k in kind) for kind in spots]
        row = [0.98 * 0.2 ** sum(seen)] + [0.02 / len(kinds) + x for x in seen]
        p.append([x / sum(row) for x in row])
    for _ in range(rounds):
        share, table = [], []
        for c in range(1 + len(kinds)):
            share.append((sum(q[c] for q in p) + 1) / (len(votes) + 1 + len(kinds)))
            n = [[1 + sum(q[c] for q, v in zip(p, votes) if v[k] == x) for x in (weak_labels.GOOD, weak_labels.BAD)] for k in range(len(labellers))]
            table.append([[a / (a + b), b / (a + b)] for a, b in n])
        new = []
        for v in votes:
            row = []
            for c, s in enumerate(share):
                for k, x in enumerate(v):
                    s *= 1 if x == weak_labels.NONE else table[c][k][x]
                row.append(s)
            new.append([x / sum(row) for x in row])
        done = max(abs(x - y) for q, r in zip(new, p) for x, y in zip(q, r)) < 1e-6
        p = new
        if done:
            break
    return [1 - q[0] for q in p]


def test_em_against_documents_one_by_one():
    r = random.Random(4)
    labellers, kinds = list("abcdef"), [["a", "b"], ["c", "d", "e"], ["f"]]
    votes = []
    for _ in range(150):
        bad = set(r.choice(kinds)) if r.random() < 0.3 else set()
        votes.append([weak_labels.NONE if r.random() < 0.1 else weak_labels.BAD if r.random() < (0.85 if x in bad else 0.03) else weak_labels.GOOD for x in labellers])
    counts = Counter(weak_labels._code(v) for v in votes)
    got, table = weak_labels.posteriors(dict(counts), labellers, kinds)
    for v, want in zip(votes, brute_em(votes, labellers, kinds), strict=True):
        assert got[weak_labels._code(v)] == pytest.approx(want, abs=1e-5)
    assert table[0, 0, 1] < 0.1 and table[0, 1, 1] > 0.7  # an accuracy that was estimated
    assert weak_labels.posteriors({}, labellers, kinds)[0] == {}


def test_em_finds_bad_patterns():
    counts = {0: 900, 1 + 3: 60, 9 + 27: 50, 1: 5}
    p, _ = weak_labels.posteriors(counts, list("abcd"), [["a", "b"], ["c", "d"]])
    assert p[0] < 0.1 and p[4] > 0.9 and p[36] > 0.9
    assert weak_labels.posteriors({**counts, 2 * (1 + 3 + 9 + 27): 5000}, list("abcd"), [["a", "b"], ["c", "d"]])[0][4] > 0.9  # thousands of silent texts


def test_classifier_against_plain_python(spark):
    """Votes, EM, training in the same order and scores, without Spark's steps; ids are null, repeated and unique."""
    import numpy as np

    bad = ["#### $$$$ %%%% " * 9, "BUY NOW!! CHEAP!! " * 12, "spam " * 60, "a | b | c\n" * 20, "idiot scum moron, the of and " * 8]
    texts = [prose(k, 60) + f". The end of {k} and to." for k in range(30)] + [f"{bad[k % 5]} {prose(50 + k, 5)}" for k in range(25)] + [None, "", prose(1, 60)] * 2
    df = spark.createDataFrame([(None if k % 9 == 0 else k % 40, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = sorted((r.quality_score, r.toxic_score) for r in weak_labels.classify(df, train_rows=10**6).collect())
    raws = [(t or "").encode() for t in texts]
    voted = [weak_labels.votes(x) for x in raws]
    p = [brute_em([v[k] for v in voted], names, kinds) for k, (names, kinds) in enumerate(((weak_labels.QUALITY_LABELLERS, weak_labels.QUALITY_KINDS), (weak_labels.TOXIC_LABELLERS, weak_labels.TOXIC_KINDS)))]
    target = {x: (p[0][k], p[1][k]) for k, x in enumerate(raws)}
    drawn = spark.createDataFrame([(x,) for x in sorted(set(raws))], "raw binary").select("raw", (F.xxhash64("raw").cast("double") / 2.0**64 + 0.5).alias("u"))
    order = drawn.select("raw", "u", F.pmod(F.xxhash64("u", F.lit(1)), F.lit(weak_labels.SHARDS)).alias("shard"))
    shards = defaultdict(list)
    # Spark deals the shards by the hash of their number
    for r in order.repartition(weak_labels.SHARDS, F.col("shard")).select("*", F.spark_partition_id().alias("at")).orderBy("u").collect():
        shards[r["at"]].append(bytes(r.raw))

    def vectors(x):
        words = np.unique(next(iter(weak_labels._fold_features(__import__("pyarrow").array([x], "binary"), weak_labels._NO_TERMS)))[1])
        _, _, bins, insults = weak_labels.votes(x)
        return weak_labels._vector(words, weak_labels._bin_features(bins)), weak_labels._vector(words, weak_labels._bin_features(insults, 101))

    total, sums = 0, [0, 0]
    for rows in shards.values():
        scorers = weak_labels.Scorer(), weak_labels.Scorer()
        for _ in range(weak_labels.EPOCHS):
            for x in rows:
                for s, v, y in zip(scorers, vectors(x), target[x], strict=True):
                    s.learn(*v, y)
        total += len(rows)
        sums = [a + len(rows) * s.weights() for a, s in zip(sums, scorers)]
    want = []
    for x in raws:
        q, t = (1 / (1 + np.exp(-(w / total)[at] @ v)) for w, (at, v) in zip(sums, vectors(x)))
        want.append((1 - q, t))
    for a, b in zip(got, sorted(want), strict=True):
        assert a == pytest.approx(b, abs=1e-3)


# 4: host rules

def brute_measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {k for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_measures(spark):
    texts = odd_texts() + ["a b c d e a b c d e f", "x x x x x x x", "l one\nl one\n\nl two\nl one", "# * | <b>", prose(9, 30) + " " + prose(9, 30)]
    df = docs_of(spark, texts, n_words=7, kept=1, host_rate=2)
    got = {r.doc_id: tuple(r[c] for c in host_rules.MEASURES) for r in host_rules.judge(df).collect()}
    assert got == {k: brute_measures(t) for k, t in enumerate(texts)}
    assert host_rules.judge(df.limit(0)).count() == 0
    assert host_rules.passing(df).columns == df.columns


@pytest.mark.parametrize("shipped", [0, 1000])
def test_hosts_joined_and_shipped_alike(spark, shipped):
    """Many hosts (a join) and few (a broadcast) give the same; repeated rows count each time."""
    rows = [(k, "too short" if k % 3 else prose(k, 30), "en", None if k % 7 == 0 else f"h{k % 5}", 1) for k in range(60)] * 2
    df = spark.createDataFrame(rows, DOC)
    want = sorted(map(tuple, host_rules.judge(df, keep=["doc_id"]).collect()))
    assert sorted(map(tuple, host_rules.judge(df, keep=["doc_id"], broadcast_hosts=shipped).collect())) == want and len(want) == 120


def test_a_bad_host_goes_and_small_hosts_are_shrunk(spark):
    good, bad = prose(3, 40), "too short"
    rows = [(k, bad if k % 10 else good, "en", "junk", 1) for k in range(200)] + [(1000 + k, bad if k % 10 == 0 else good, "en", f"h{k % 12}", 1) for k in range(600)] + [(5000, good, "en", None, 1), (5001, bad, "en", "lone", 1), (5002, good, "en", "lone", 1)]
    got = {r.doc_id: r.kept for r in host_rules.judge(spark.createDataFrame(rows, DOC)).collect()}
    assert not got[0] and got[1001] and got[5000] and got[5002] and not got[5001]


# 5: decontamination

def brute_hits(text, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        x = words(t)
        m = min(len(x), window)
        for i in range(len(x) - m + 1 if x else 0):
            for at in range(len(w) - m + 1):
                if w[at : at + m] == x[i : i + m]:
                    hit |= set(range(at, at + m))
                    found.add(item)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [10**6, 200])
def test_decontamination_brute_force(spark, block_bytes):
    items = [(1, prose(11, 25)), (2, prose(12, 9)), (3, "stone"), (4, None), (5, ""), (6, "river LIGHT"), (7, prose(11, 25)), (None, "garden"), (10, "Ünïcode wörds 漢字 here")]
    texts = odd_texts()[:7] + [prose(13, 50) + " " + prose(11, 25).upper() + "!", " ".join(prose(11, 25).split()[3:14]), prose(12, 9) + " end", "stone stone", "river light river-light", "x ünïcode wörds 漢字 here y", " ".join(prose(11, 25).split()[:9]), prose(14, 300)]
    df = docs_of(spark, [*texts, texts[8]], spans=1, items=2, n_words=3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r.item_ids)) for r in decontam.contamination(df, bench, block_bytes=block_bytes).collect()}
    assert got == {k: brute_hits(t, [x for x in items if x[0] is not None]) for k, t in enumerate([*texts, texts[8]])}


def test_decontamination_with_item_names(spark):
    bench = spark.createDataFrame([("b/2", prose(11, 12)), ("a-1", prose(11, 12)), ("c", prose(12, 12))], "item_id string, text string")
    for block_bytes in (10**6, 100):
        got = decontam.contamination(docs_of(spark, [prose(11, 12), "x"]), bench, block_bytes=block_bytes).orderBy("doc_id").collect()
        assert [list(r.item_ids) for r in got] == [["a-1", "b/2"], []]


def test_decontamination_edges(spark):
    df, bench = docs_of(spark, odd_texts()), spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(df, bench).where("n_hit = 0").count() == len(odd_texts())
    assert decontam.contamination(df.limit(0), bench).count() == 0
    assert decontam.drop_contaminated(df, bench).columns == df.columns


# 6: spans

def sentences(text):
    """Pieces of a text as the operator cuts it."""
    return [x for x in re.split(r"(?<=\n)|(?<=[.!?])(?=[\x20\x09\x0B-\x0D])", text) if x]


def brute_spans(rows, least=spans.MIN_WORDS):
    runs, parts = defaultdict(list), {}
    words = lambda s: re.findall(r"[^\x20\x09-\x0D]+", s.lower())
    for i, t in rows:
        parts[i] = s = sentences(t or "")
        n = [len(words(x)) for x in s]
        for a in range(len(s)):
            for b in range(a + 1, len(s) + 1):
                need = 1 if n[a] >= spans.SOLO_WORDS else 2
                if n[a] and b - a >= need and sum(n[a:b]) >= least:
                    runs[tuple(words(" ".join(s[a:b])))].append((i, a, b))
                    break
        for b in range(1, len(s) + 1):
            for a in range(b - 1, -1, -1):
                need = 1 if n[b - 1] >= spans.SOLO_WORDS else 2
                if n[b - 1] and b - a >= need and sum(n[a:b]) >= least:
                    runs[tuple(words(" ".join(s[a:b])))].append((i, a, b))
                    break
    gone = defaultdict(set)
    for found in runs.values():
        for i, a, b in sorted(set(found))[1:]:
            gone[i] |= set(range(a, b))
    return {i: "".join(x for k, x in enumerate(s) if k not in gone[i]) for i, s in parts.items()}


def test_spans_brute_force(spark):
    passage = " ".join(f"Passage {k} holds {prose(60 + k, 9).replace('.', '')}." for k in range(6))
    texts = [(k, (prose(200 + k, 40) + ". " + (passage + " " if k % 3 == 0 else "") + prose(300 + k, 30) + ".\n" + ("short line.\n" * (k % 4)))) for k in range(20)]
    texts += [(100 + k, t) for k, t in enumerate(odd_texts())] + [(200, texts[3][1])]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in texts], "doc_id long, text string, n_removed long, _spans string")
    out = spans.drop_repeated_spans(df)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {**brute_spans(texts), 100: None}
    assert sum("Passage 5" in (t or "") for t in got.values()) == 1
    assert got[200] == ""


def test_spans_edges(spark):
    text = prose(1, 80) + "."
    df = spark.createDataFrame([(None, text), (1, text), (1, text), (2, text)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text == text) for r in spans.drop_repeated_spans(df).collect()), key=str)
    assert got == [(1, True), (1, True), (2, False), (None, True)]
    assert spans.drop_repeated_spans(df.limit(0)).count() == 0


def test_spans_of_one_id_and_several_texts(spark):
    """Rows that share a doc_id and not their text are different texts: the first in order keeps the passage."""
    shared = " ".join(paragraphs(1, 30, 30))
    rows = [(7, f"{shared} Own a."), (7, f"{shared} Own b."), (8, f"{shared} Own c.")]
    got = spans.drop_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(7, 0), (7, 2), (8, 2)]


def test_spans_of_a_seeds_length_are_no_repeats(spark):
    """A run with as many words as a passage's seed is not taken for that seed."""
    texts = [" ".join(paragraphs(k, 12, 13, 12, 13, 12, 13, 12, 13, 12, 13)) for k in range(40)]
    assert spans.drop_repeated_spans(docs_of(spark, texts)).where("n_removed > 0").count() == 0


def paragraphs(seed, *sizes):
    """Texts of one sentence with that many words each, none of them like another."""
    return [" ".join(f"w{seed}x{k}x{j}" for j in range(n)) + "." for k, n in enumerate(sizes)]


@pytest.mark.parametrize("gap", ["\n\n", "\r\n", "\r\n\r\n", "\n \t\n\n"])
def test_spans_keep_unique_paragraphs_between_empty_lines(spark, gap):
    unique = [gap.join(paragraphs(k, 25, 30, 25, 39, 20)) for k in range(3)] + [gap + gap.join(paragraphs(3, 25, 30)) + gap]
    shared = paragraphs(9, 30, 12)
    texts = [*unique, gap.join([*paragraphs(5, 25), *shared, *paragraphs(6, 25)]), gap.join([*paragraphs(7, 25), *shared, *paragraphs(8, 25)]), gap + unique[0] + gap]
    got = {r.doc_id: r.text for r in spans.drop_repeated_spans(docs_of(spark, texts)).collect()}
    assert [got[k] for k in range(5)] == texts[:5]
    assert got[5] == gap.join([*paragraphs(7, 25), *paragraphs(8, 25)])
    assert got[6] == ""


def test_spans_remove_long_passages_that_start_and_end_inside_sentences(spark):
    """Shared words with unique ones before and after in the same sentence; only over 50 words they go."""
    run = lambda seed, n: [f"w{seed}x{j}" for j in range(n)]
    long, short, cut_up = run(1, 51), run(2, 50), run(3, 70)
    for j in range(9, 70, 9):
        cut_up[j] += "."  # whole sentences inside, which go by themselves; the edges around them go too
    around = lambda k, *parts: " ".join(w for j, part in enumerate(parts) for w in [*run(f"{k}u{j}", 30), *part]) + " " + " ".join(run(f"{k}e", 30)) + "."
    texts = [around(k, long, short, cut_up) for k in range(3)] + [around(7, run(4, 60), run(4, 60)), "again " * 300]
    got = {r.doc_id: r for r in spans.drop_repeated_spans(docs_of(spark, texts)).collect()}
    kept = {k: r.text.split() for k, r in got.items()}
    for k in range(1, 3):
        assert kept[k] == around(k, [], short, []).split()
    assert set(long) | set(cut_up) <= set(kept[0]) and set(short) <= set(kept[0])
    assert kept[3] == around(7, run(4, 60), []).split()
    assert len(kept[4]) == 51
    assert all(r.chars_removed == len(texts[k]) - len(r.text) and (r.n_removed > 0) == (r.chars_removed > 0) for k, r in got.items())


# 7: WARC

def test_warc_round_trip(spark):
    big = "<p>é" + "WARC/1.1\r\n\r\n 0\r\n\r\n" * 300
    htmls = [None, "", "a", big, big, big, "b" * 999, "b" * 999, "c" * 1000, "c" * 1000, "\r\n\r\n", "x" * 5000]
    rows = [(k, f"http://h/{k}\r\nX: y", h, "z") for k, h in enumerate(htmls)] + [(None, None, "d" * 2000, "z"), (-5, "", "d" * 2000, "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    got = {r.page_id: r for r in warc.round_trip(df, segment=700).collect()}
    assert len(got) == len(rows)
    for i, _, h, _ in rows:
        raw = (h or "").encode()
        top = max((j for j, _, x, _ in rows if j is not None and (x or "") == (h or "")), default=None) if len(raw) >= 1000 else i
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if i == top else ("revisit", top))
        assert got[i].payload == (raw if i == top else None)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_chunked_framing():
    for n in (0, 1, 4096, 10_000):
        body = bytes(range(256)) * (n // 256 + 1)
        assert warc.unchunked(warc.chunked(body[:n])) == body[:n]
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"4\r\nabc\r\n0\r\n\r\n")


def test_archives_are_read_piece_by_piece():
    """Members, headers and blocks that lie across the pieces; a file that is cut off is an error."""
    import gzip

    made = [(f"<urn:page:{k}:0>", bytes([k]) * (k * 37)) for k in range(30)]
    raw = b"".join(warc._record([("WARC-Record-ID", i)], b) + b"\r\n\r\n" for i, b in made)
    for file in (raw, gzip.compress(raw), b"".join(gzip.compress(raw[i : i + 501]) for i in range(0, len(raw), 501))):
        for step in (1, 7, 100, 1 << 20):
            assert [(h["warc-record-id"], b) for h, b in warc._records(warc._inflated(file, step))] == made
    for file in (raw[:-20], gzip.compress(raw)[:-30]):
        with pytest.raises(ValueError):
            list(warc._records(warc._inflated(file, 100)))


def test_missing_segments_are_an_error(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\n\r\nabc"
    (tmp_path / "part-0.warc").write_bytes(warc._record([("WARC-Type", "continuation"), ("WARC-Record-ID", "<urn:page:1:0:2>"), ("WARC-Segment-Origin-ID", "<urn:page:1:0>"), ("WARC-Segment-Number", 2), ("WARC-Segment-Total-Length", 99)], block) + b"\r\n\r\n")
    with pytest.raises(Exception, match="incomplete segments"):
        warc.read_archives(spark, str(tmp_path)).collect()


# 8: licences

def test_license_scan(spark):
    mit = [x for n, x, _ in licenses.TEMPLATES if n == "MIT"][0]
    texts = ["Intro.\nReleased under the MIT License.\nMore.", mit.upper(), "Released under the license.", *odd_texts(), "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0."]
    got = [(r.license_id, r.n_matches) for r in licenses.scan(docs_of(spark, texts, dice=1, license_id=2)).orderBy("doc_id").collect()]
    assert got[:2] == [("MIT", 1), ("MIT", 1)]
    assert got[2:-1] == [(None, 0)] * (len(texts) - 3)
    assert got[-1] == ("CC-BY-NC-4.0", 2)
    assert licenses.scan(docs_of(spark, texts).limit(0)).count() == 0


def test_license_inside_longer_units(spark):
    mit = max((x for n, x, _ in licenses.TEMPLATES if n == "MIT"), key=len)
    head, tail = prose(1, 60).replace(";", ""), prose(2, 60)
    texts = [f"{head}. Released under the MIT License. {tail}", f"{head}\n\nCopyright me\n\n{mit}\n\n{tail}", f"{head} {mit[:300]} {tail}", f"{head} the license and the software under copyright {tail}"]
    got = [r.license_id for r in licenses.scan(docs_of(spark, texts)).orderBy("doc_id").collect()]
    assert got == ["MIT", "MIT", None, None]


def test_license_anchors_lose_no_unit(spark):
    """Units around the threshold, with and without anchors, against plain Python over all templates."""
    t, r, units = licenses.THRESHOLD, random.Random(2), []
    for _, x, _ in licenses.TEMPLATES:
        w = re.sub(r"[\W_]+", " ", x.lower()).split()
        known = licenses.anchors(w, t)
        for share in (0.02, 0.05, 0.08, 0.1, 0.2, 0.3):
            units.append([r.choice(WORDS) if r.random() < share else v for v in w])
        units.append([v for v in w if v not in known])  # all anchors away
    pairs = lambda w: set(zip(w, w[1:]))
    words = [re.sub(r"[\W_]+", " ", x.lower()).split() for _, x, _ in licenses.TEMPLATES]
    made = [(pairs(w), *map(set, licenses.told_apart(name, w, must))) for (name, _, must), w in zip(licenses.TEMPLATES, words, strict=True)]
    want = [any(2 * len(pairs(u) & b) >= t * (len(pairs(u)) + len(b)) and yes <= set(u) and not no & set(u) for b, yes, no in made) for u in units]
    got = [r.n_matches > 0 for r in licenses.scan(docs_of(spark, [" ".join(u) for u in units])).orderBy("doc_id").collect()]
    assert got == want and 20 < sum(want) < len(want) - 20


def test_each_license_is_its_own(spark):
    """Every template, as it is and in capitals, is found under its own name, though relatives and versions differ by a word."""
    texts = [y for _, x, _ in licenses.TEMPLATES for y in (x, x.upper(), f"Some file.\n\n{x}\n\nMore words.")]
    got = [r.license_id for r in licenses.scan(docs_of(spark, texts)).orderBy("doc_id").collect()]
    assert got == [n for n, _, _ in licenses.TEMPLATES for _ in range(3)]
    others = ["This work is licensed under a Creative Commons Attribution 2.0 Generic License.", "Licensed under CC BY-NC-SA 3.0.", "This work is licensed under the GNU General Public License, version 1."]
    assert [r.license_id for r in licenses.scan(docs_of(spark, others)).orderBy("doc_id").collect()] == [None] * 3


def test_many_license_like_lines_take_time_by_their_number(spark):
    import time

    lines = [f"Permission to use copy modify and distribute the software number {k} for any purpose with notice" for k in range(8000)]
    took = []
    for n in (2000, 2000, 8000):  # the first run warms up
        began = time.perf_counter()
        assert licenses.scan(docs_of(spark, ["\n".join(lines[:n])])).first().n_matches == 0
        took.append(time.perf_counter() - began)
    assert took[2] < 8 * max(took[1], 0.5)


# 9: packing

def test_pieces():
    for n in (1, 2, 3, 2047, 2048, 2049, 5000):
        p = packing.pieces(n)
        assert [s for s, _ in p] == [sum(k for _, k in p[:i]) for i in range(len(p))] and sum(k for _, k in p) == n
        assert all(k & (k - 1) == 0 and k <= 2048 for _, k in p)


def test_packing_holds_every_id_once(spark):
    from tokenizers import Tokenizer

    files = queries.tokenizer_files()
    slow = Tokenizer.from_file(files["tokenizer"])
    texts = odd_texts() + ["end<|endoftext|>of text", "<|endoftext|>", " " * 9000, "a" * 30_000 + " b", "tab\t\x00  ½ ǅ"]
    out = packing.pack(docs_of(spark, texts, start=1, length=2), **files).withColumn("crc", F.crc32("token_bytes")).collect()
    ids = {k: [*slow.encode(t or "", add_special_tokens=False).ids, 1] for k, t in enumerate(texts)}
    back = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.doc_id, r.start)):
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == sum(map(len, back[r.doc_id])) and r.crc == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in piece))
        assert r.doc_tokens == len(ids[r.doc_id]) and r.length == 1 << r.bucket and r.offset == 0
        back[r.doc_id].append(piece)
    assert {k: sum(v, []) for k, v in back.items()} == ids
    assert len({r.sequence_id for r in out}) == len(out)
    assert packing.pack(docs_of(spark, texts).limit(0), **files).count() == 0


def test_both_encoders_are_one():
    """The proof that packing._encoders names: over the vocabulary, over all code points, special tokens, long runs."""
    import base64
    import json
    from pathlib import Path

    from tokenizers import Tokenizer

    files = queries.tokenizer_files()
    slow, model = Tokenizer.from_file(files["tokenizer"]), json.loads(Path(files["tokenizer"]).read_text())["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in merges]
    assert made == sorted(set(made)) and len(made) + 256 == len(model["vocab"])  # one merge a token, ranked as ids
    ranks = dict((base64.b64decode(a), int(b)) for a, b in map(bytes.split, Path(files["ranks"]).read_bytes().splitlines()))
    assert all([x.id for x in slow.model.tokenize(t)] == [k] for t, k in model["vocab"].items())
    to_bytes = {c: b for b, c in zip(ranks, [slow.id_to_token(k) for k in ranks.values()], strict=True)}
    single = {c: b[0] for c, b in to_bytes.items() if len(b) == 1}
    assert len(single) == 256 and all(bytes(single[c] for c in token) == b for token, b in to_bytes.items())
    fast, plain = packing._encoders(**{k: files[k] for k in ("tokenizer", "ranks", "pattern")}), packing._encoders(files["tokenizer"], None, None)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"{c}a{c}{c} {c}1 " for c in points[i : i + 4096]) for i in range(0, len(points), 4096)]
    texts += ["a<|endoftext|> b", " <|endoftext|>  <|endoftext|>", "<|endoftext|", "a" * 100_000, " " * 300_000, "\n" * 50_000 + "x", "é!" * 50_000, ""]
    assert fast(texts) == plain(texts)


def test_buckets_hold_one_length_each(spark, tmp_path):
    packed = packing.pack(docs_of(spark, odd_texts()), **queries.tokenizer_files())
    packing.write_buckets(packed, f"{tmp_path}/b")
    back = spark.read.parquet(f"{tmp_path}/b")
    assert back.count() == packed.count() and back.where("length <> shiftleft(1, bucket)").count() == 0


def test_repeated_rows_count_each(spark):
    """op4, op7 to op10 give each of equal rows its row."""
    three = docs_of(spark, [prose(1, 30)]).union(docs_of(spark, [prose(1, 30)])).union(docs_of(spark, [prose(1, 30)]))
    pages = spark.createDataFrame([(1, "http://a.fr/", "x" * 2000)] * 3, "page_id long, url string, html string")
    assert host_rules.judge(three).count() == 3 and licenses.scan(three).count() == 3
    assert [(r.record_type, r.payload_bytes) for r in warc.round_trip(pages).collect()] == [("response", 2000)] * 3
    packed = packing.pack(three, **queries.tokenizer_files()).collect()
    assert len({r.sequence_id for r in packed}) == len(packed) and len(packed) % 3 == 0
    assert langid.identify(three, pages).count() == 6


def test_packing_same_ids_as_tokenizers(spark):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(queries.tokenizer_files()["tokenizer"])
    docs = table(spark, SF, "documents")
    got = defaultdict(dict)
    for r in packing.pack(docs, **queries.tokenizer_files()).collect():
        got[r.doc_id][r.start] = r.token_bytes
    for r in docs.collect():
        want = b"".join(x.to_bytes(4, "little") for x in [*slow.encode(r.text, add_special_tokens=False).ids, 1])
        assert b"".join(b for _, b in sorted(got[r.doc_id].items())) == want


# 10: language

def test_language_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    shown = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    got = {r.doc_id: r.lang for r in langid.identify(shown, table(spark, SF, "pages").limit(0)).collect()}
    held = [(got[r.doc_id], r.lang) for r in docs.where("doc_id % 2 = 1").collect()]
    assert sum(a == b for a, b in held) / len(held) > 0.97


def test_language_evidence_without_text(spark):
    docs = table(spark, SF, "documents")
    pages = spark.createDataFrame([(1, "http://a.example.fr/x", "<html lang='fr'></html>"), (2, None, None), (3, "http://a.example.fr/y", "<html lang=fr>"), *((10 + k, f"http://b{k}.example.fr/fr/", f'<html lang="fr"><script>the and of</script><p>{r.text}</p>') for k, r in enumerate(docs.where("lang = 'fr'").collect()))], "page_id long, url string, html string")
    got = {r.page_id: r.lang for r in langid.identify(docs, pages).where("page_id is not null").collect()}
    assert got[1] == got[3] == "fr" and got[2] is not None and len(got) == pages.count()


def test_language_fusion_against_plain_python(spark):
    """Every sum, prior and agreement by loops over rows."""
    import math

    import numpy as np

    langs, r = ["aa", "bb", "cc"], random.Random(8)
    model = np.log(np.random.Generator(np.random.PCG64(3)).dirichlet(np.ones(langid.BUCKETS), 3)).astype(np.float32)
    hosts = ["x.site.aa", "y.site.aa", "z.other.bb", "lone", None]
    rows = [(k, h, r.choice([None, "aa", "bb", "long-code"]), None if h is None else h.split(".")[-1], r.choice(["", "é", prose(k, 3)])) for k in range(60) for h in [hosts[min(4, int(r.expovariate(0.7)))]]]
    df = spark.createDataFrame(rows, "k long, host string, declared string, suffix string, text string")
    got = {x.k: (x.lang, x.prob, x.text_lang) for x in langid.fuse(df, langs, model).collect()}
    import pyarrow as pa

    ll, n = [], len(langs)
    for *_, t in rows:
        code = next(iter(langid._trigrams(pa.array([t.encode()]))))[1] if t else np.empty(0, int)
        s = [float(model[c][code[code >= 0]].sum(dtype=float)) for c in range(n)]
        ll.append([(x - max(s)) / langid.TEMPER for x in s])
    p = [[math.exp(x) / sum(map(math.exp, row)) for x in row] for row in ll]
    total = lambda keep: [sum(q[c] for q, x in zip(p, rows) if keep(x)) for c in range(n)]
    smooth = lambda c, base: [(x + langid.KAPPA * b) / (sum(c) + langid.KAPPA) for x, b in zip(c, base)]
    every = total(lambda x: True)
    world = [(x + 1) / (sum(every) + n) for x in every]
    domain = lambda h: ".".join(h.split(".")[-2:])

    def agrees(at, value):
        if value is None:
            return [0.0] * n
        c = total(lambda x: x[at] == value)
        share = (sum(c) + 1) / (sum(every) + n)
        return [math.log((x + langid.KAPPA * share) / (a + langid.KAPPA) / share) for x, a in zip(c, every)]

    for k, (row, l, q) in enumerate(zip(rows, ll, p)):
        _, h, declared, suffix, _ = row
        if h is None:
            prior = world  # no host: nothing but the corpus
        else:
            base = smooth(total(lambda x: x[1] is not None and domain(x[1]) == domain(h)), world)
            prior = smooth([max(0.0, a - b) for a, b in zip(total(lambda x: x[1] == h), q)], base)
        log = [a + math.log(b) + c + d for a, b, c, d in zip(l, prior, agrees(2, declared), agrees(3, suffix))]
        assert got[k][0] == langs[log.index(max(log))] and got[k][2] == langs[l.index(max(l))]
        assert got[k][1] == pytest.approx(1 / sum(math.exp(x - max(log)) for x in log), rel=1e-6)


def test_language_sample_is_bounded_and_entities_are_letters(spark):
    texts = [(prose(1, 20), "en")] * 500 + [(prose(k, 20), "en") for k in range(2, 30)]
    labelled = spark.createDataFrame(texts, "text string, lang string")
    once = spark.createDataFrame(sorted(set(texts)), "text string, lang string")
    assert (langid.train(labelled, rows=10**6)[1] == langid.train(once, rows=10**6)[1]).all()
    page = spark.createDataFrame([(1, "http://a.de/", "<p>sch&ouml;n &amp; gr&#252;n</p>")], "page_id long, url string, html string")
    assert langid.page_evidence(page).first().text.split() == ["schön", "&", "grün"]


def test_language_edges(spark):
    df = docs_of(spark, odd_texts(), page_id=1, host="x", ll=2, p=3)
    pages = table(spark, SF, "pages").limit(0)
    assert langid.identify(df, pages).count() == len(odd_texts())
    assert langid.identify(df.limit(0), pages).count() == 0


# names

CLASHING = ["_id", "_digest", "_n", "_spans", "_places", "_gone", "_chars", "doc", "digest", "spans", "places", "gone", "_host", "host", "rate", "_m", "_w", "_h", "w", "l", "h", "o", "p", "_bytes", "raw", "mark", "key",
    "n_sentences", "n_removed", "chars_removed", "n_words", "n_hit", "items", "item_ids", "base_failed", "host_rate", "kept", "component_id", "n_shingles", "more_spans", "Marks", "d0", "g0"]


@pytest.mark.parametrize("block_bytes", [10**6, 200])
def test_stages_leave_columns_of_any_name_alone(spark, block_bytes):
    base = edited(prose(1, 80), 1, 0)
    texts = [None, "", base, edited(base, 2, 1), prose(2, 60) + ".", prose(3, 90) + ". " + prose(4, 40) + "."]
    df = docs_of(spark, texts).select("*", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in [*CLASHING, "odd name.with `ticks`"]))
    bench = spark.createDataFrame([(1, prose(2, 60)), (2, prose(70, 12)), (3, prose(71, 12))], "item_id long, text string")
    stages = [host_rules.passing, lambda d: minhash.drop_near_duplicates(d, percent=80), spans.without_repeats, lambda d: decontam.drop_contaminated(d, bench, block_bytes=block_bytes)]
    for stage in stages:
        out = stage(df)
        assert out.columns == df.columns
        for r in out.collect():
            assert all(v == f"{c}{r.doc_id}" for c, v in zip(df.columns[5:], r[5:], strict=True))
    df = df.select(*df.columns[:-1])
    for out in (host_rules.judge(df), spans.drop_repeated_spans(df), decontam.contamination(df, bench, df.columns, block_bytes=block_bytes)):
        assert len(out.columns) == len({c.lower() for c in out.columns}) and out.count() == len(texts)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from tallyweir.llm import tables

    class Context:
        master, getCheckpointDir = "spark://x:7077", staticmethod(lambda: None)

    class Session:
        sparkContext, conf = Context(), {"spark.checkpoint.dir": None}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        tables.shared_dir(Session())


# the pipeline

def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline

    filler = [prose(500 + k, 45) + "." for k in range(12)]
    bench = [(1, prose(900, 15))]
    passage = " ".join(prose(950 + k, 12).replace(".", "") + "." for k in range(5))
    texts = [*filler, filler[0], edited(prose(600, 150), 1, 0) + ".", edited(prose(600, 150), 2, 1) + ".", "too short", None, "spam " * 30, prose(700, 30) + ". " + passage, prose(701, 30) + ". " + passage, prose(702, 20) + ". " + bench[0][1] + "."]
    rows = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [(k, t) for k, t in enumerate(texts) if (m := brute_measures(t))[0] >= 10 and 100 * m[4] <= 20 * m[0]]
    comp = brute_components(left)
    left = [(k, t) for k, t in left if comp[k][1] == k]
    cleaned = brute_spans(left)
    left = [(k, cleaned[k]) for k, _ in left if not brute_hits(cleaned[k], bench)[1]]
    got = defaultdict(int)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] += r.length
    files = queries.tokenizer_files()
    encode = packing._encoders(files["tokenizer"], None, None)
    assert dict(got) == {k: len(encode([t])[0]) + 1 for k, t in left}
    assert len(left) < len(texts) - 4


def test_pipeline_drops_near_copies_from_80_percent(spark):
    """Texts with one or two planted edits: similarities from below 0.8 to above 0.85, in pairs that no third text links."""
    import corpus_pipeline

    texts, alike = [], []
    for k in range(24):
        base = prose(3000 + k, 60 + k).replace(".", "")
        texts += [base, edited(base, 3000 + k, 1 + k % 2)]
        a, b = map(shingles, texts[-2:])
        alike.append(len(a & b) / len(a | b))
    assert sum(0.8 <= x < 0.85 for x in alike) > 2 and min(alike) < 0.8 and max(alike) > 0.85
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs_of(spark, texts), SF).collect()}
    assert got == {2 * k for k in range(24)} | {2 * k + 1 for k, x in enumerate(alike) if x < 0.8}
