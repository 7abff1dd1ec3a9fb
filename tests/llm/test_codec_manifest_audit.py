"""BPE encoding against tokenizers, the Merkle manifest and the filter audit against plain Python, with edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyweir.llm import bpe, filter_audit, merkle, queries
from tallyweir.llm.tables import Scratch

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.word_tokenizer())
    t.no_truncation()
    t.no_padding()
    return t


# 11: BPE

BITS = ["don't", "we'll'll", "<|endoftext|>", "<|startoftext|", ">", "<|END", "é", "é", "́", "ΑΣ", "漢字", "😀", "🤷🏽‍♀️", "1234", "...", "_", "\x85", " ", " ", "\x1c", "​", " ", "\n", "\t", "\x0b", "\r\n", "İ", "ſ", "ﬁ", "Ⅷ", "가", "̸", "=", "ab", "Zürich", "\x00"]


def noise(seed: int, n: int, spaces: float) -> str:
    r = random.Random(seed)
    return "".join(r.choice(BITS) + (" " if r.random() < spaces else "") for _ in range(n))


def held(spark, texts, tokenizer, vocabulary):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"chunk": F.lit(1), "n_tokens": F.lit(2), "place": F.lit("x")})
    got = bpe.decode(bpe.encode(frame.repartition(3), vocabulary), vocabulary).collect()
    assert sorted(x.doc_id for x in got) == list(range(len(texts)))
    for x in got:
        ids = tokenizer.encode(texts[x.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(x.token_bytes, "<u4").tolist() == ids and x.n_tokens == len(ids)
        assert x.decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_ids_are_those_of_whole_texts(spark, tokenizer):
    shared = [noise(k, 900, 0.3) for k in range(4)]
    solid = "".join(random.Random(9).choice("abcdefgh") for _ in range(30_000))
    texts = [None, "", " ", "word", "x" * 40_000, "é" * 9_000, " " * 9_000, solid, solid[5:] + " " + solid]
    texts += [noise(100 + k, 800, k / 20) for k in range(20)]
    texts += [noise(200 + k, 30 + k, 0.2) + shared[k % 4] + noise(300 + k, 50, 0.2) + shared[(k + 1) % 4] for k in range(24)]
    texts += [shared[0]] * 7 + [solid] * 2
    held(spark, texts, tokenizer, queries.word_tokenizer())


def test_hot_chunks_and_texts_are_dealt(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "HOT_ROWS", 4)
    passage = noise(7, 1500, 0.3)
    texts = [passage] * 30 + [noise(k, 20, 0.3) + passage for k in range(30)]
    held(spark, texts, tokenizer, queries.word_tokenizer())


def test_full_map_gives_the_same(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "MAP_BITS", 64)
    held(spark, [noise(k, 400, 0.3) for k in range(12)] + [noise(3, 400, 0.3)], tokenizer, queries.word_tokenizer())


def test_chunks_of_shared_passages_are_equal():
    passage = noise(11, 6000, 0.3)
    texts = pa.array([noise(k, 40, 0.2) + passage + noise(k + 50, 40, 0.2) for k in range(5)])
    chunks = [set(c) for _, c in bpe.chunked(texts)]
    common = set.intersection(*chunks)
    assert sum(map(len, common)) > 0.7 * len(passage.encode())
    for (_, c), t in zip(bpe.chunked(texts), texts.to_pylist(), strict=True):
        assert b"".join(c) == t.encode() and all(x.decode() and len(x) <= bpe.LONGEST + 3 for x in c)


def test_shared_chunks_are_encoded_once(monkeypatch, tokenizer):
    """A join inside a word is repaired, and nothing but the run around it is encoded again."""
    e = bpe.Encoder(queries.word_tokenizer())
    text = b"the unbelievable light of morning and the garden"
    for cut in range(1, len(text)):
        asked = []
        records = [e.chunk(text[:cut]), e.chunk(text[cut:])]
        run = e.run
        monkeypatch.setattr(e, "run", lambda x, run=run: asked.append(x) or run(x))
        ids = np.frombuffer(e.wide(e.joined(records)), "<u4").tolist()
        monkeypatch.undo()
        assert ids == tokenizer.encode(text.decode(), add_special_tokens=False).ids
        assert all(b" " not in x for x in asked) and len(asked) <= 1


def test_words_by_ranks_are_those_of_tokenizers(tokenizer):
    """The proof that bpe.word_ranks names, over the vocabulary, and every character of the range beside letters, digits and
    marks."""
    ranks, back = bpe.word_ranks(queries.word_tokenizer())
    e = bpe.Encoder(queries.word_tokenizer())
    whole = {token: [back[k] for k in e.piece(token)] for token in ranks if back[ranks[token]] or token == b"!"}
    assert all(ids == [back[ranks[token]]] for token, ids in whole.items()) and len(set(back)) >= 49_406
    r = random.Random(4)
    alphabet = [chr(c) for c in range(0x21, 0x250)]
    words = [f"{c}a{c}{c}1{c}'s{c}" for c in alphabet] + ["".join(r.choice(alphabet[:94] if r.random() < 0.7 else alphabet) for _ in range(r.randint(1, 14))) for _ in range(20_000)]
    words += ["".join(r.choice("etaoinshrdlucmfw'sdltév") for _ in range(r.randint(1, 30))) for _ in range(20_000)]
    assert sum(bool(bpe.LATIN(w.encode())) for w in words) > 20_000
    for w, x in zip(words, tokenizer.encode_batch(words, add_special_tokens=False), strict=True):
        if " " not in w.replace("\xa0", " ").replace("\x85", " "):
            assert np.frombuffer(e.wide(e.word(w.encode())), "<u4").tolist() == x.ids, w


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOC)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert bpe.decode(bpe.encode(none, queries.word_tokenizer()), queries.word_tokenizer()).count() == 0
    assert merkle.manifest(none).count() == 0
    assert filter_audit.audit(none, labels).count() == 0


# 12: manifest

def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row) -> str:
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top node and each leaf's path."""
    paths: list[list[tuple[str, str]]] = [[] for _ in nodes]
    under = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + 8, len(nodes))) for a in range(0, len(nodes), 8)]
        for run in runs:
            for k in run:
                for x in under[k]:
                    paths[x].append(("".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k)))
        nodes, under = [h(*(nodes[k] for k in run)) for run in runs], [[x for k in run for x in under[k]] for run in runs]
    return nodes[0], paths


def brute_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    parts = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    for g in parts:
        by[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    tops = {g: climb([leaf_of(r) for r in by[g]]) for g in parts}
    root, above = climb([tops[g][0] for g in parts])
    out = []
    for p, g in enumerate(parts):
        for k, r in enumerate(by[g]):
            path = tops[g][1][k] + above[p]
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            acc = leaf_of((r[0], text, *r[2:]))
            for a, b in path:
                acc = h(a, acc, b)
            out.append((str(r[0]), leaf_of(r), tops[g][0], root, h(*(a + b for a, b in path)), acc, acc == root))
    return sorted(out)


@pytest.mark.parametrize("sizes", [[1], [1, 1], [8, 9, 1], [64, 65, 2, 3], [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 513]])
def test_manifest(spark, sizes):
    r = random.Random(len(sizes))
    names = [None, "", "é", "z", "en", "Z", "😀", "￿", "de", "fr", "e"]
    rows = []
    for g, n in zip(names, sizes, strict=False):
        for _ in range(n):
            k = len(rows) * 7919 % 100_003
            rows.append((k, r.choice([None, "", "Tall TREES É", "low", "x" * 3000]), g, r.choice([None, "", "s:1"]), r.choice([None, 0, 17])))
    if len(sizes) > 3:
        rows += [rows[0]] * 5 + [(None, "No Id", "en", None, 1)] * 3 + [(rows[3][0], "Other", *rows[3][2:])]
    df = spark.createDataFrame(rows, DOC).withColumns({c: F.lit("x") for c in ("leaf", "g", "node", "seen", "path", "run", "root")})
    got = merkle.manifest(df.repartition(5), seen=merkle.tampered(df))
    assert sorted((str(x.doc_id), x.leaf, x.subroot, x.root, x.proof_sha256, x.folded_root, x.verified) for x in got.collect()) == brute_manifest(rows)
    assert {x.verified for x in merkle.manifest(df).collect()} == {True}


def test_numbers_over_many_ranges(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, "=a").otherwise("=b").alias("g"), (F.col("id") * 37 % 501).alias("key"))
    got = merkle.numbered(df.repartition(9), ["key"], Scratch(spark)).collect()
    for g, n in (("=a", 4000), ("=b", 1000)):
        mine = sorted((x.i, x.key) for x in got if x.g == g)
        assert [i for i, _ in mine] == list(range(n)) and [k for _, k in mine] == sorted(k for _, k in mine) and {x.n for x in got if x.g == g} == {n}


# 13: audit

def brute_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    first: dict = {}
    for d, t, *_ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    by = defaultdict(list)
    for d, t, _, s, _ in rows:
        t = t or ""
        w = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).split(" ")
        w = [x for x in w if x]
        fails = {f for f, x in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), any(c in "#$%&*|" for c in t), d is not None and d > first[t]), strict=True) if x}
        by[s or ""].append((fails, d in good and d is not None, d in toxic and d is not None))
    out = []
    for part, docs in by.items():
        mine = []
        for order in permutations("ABCDE"):
            left, gone = docs, []
            for step, f in enumerate(order, 1):
                away = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                mine.append([part, "".join(order), step, len(left), len(away), sum(f in x[0] for x in gone), sum(x[0] == {f} for x in docs), sum(x[1] for x in away), sum(x[2] for x in away)])
                gone = gone + away
        share = defaultdict(int)
        for x in mine:
            share[x[1][x[2] - 1]] += x[4]
        out += [(*x, share[x[1][x[2] - 1]]) for x in mine]
    return sorted(out)


def test_audit(spark):
    r = random.Random(3)
    words = [f"w{k}" for k in range(400)]

    def text():
        t = " ".join(r.choice(words[: r.choice([20, 400])]) for _ in range(r.choice([5, 49, 50, 90])))
        return t + r.choice(["", "", "#", "|", "A" * r.choice([1, 40]), " ", "\n\n"])

    pool = [text() for _ in range(50)]
    rows = [(r.choice([k, k, k, None, 5]), r.choice([*pool, None, "", " "]), "en", r.choice(["a", "a", "a", "b", "", None]), 1) for k in range(300)]
    rows += [(1000, "odd " * 60, "en", "c", 1)] * 4
    labels = [(k, r.choice([0, 1, None]), r.choice([0, 1, None])) for k in range(0, 300, 2)] + [(4, 1, 1), (None, 1, 1), (1000, 0, 1)]
    df = spark.createDataFrame(rows, DOC).withColumns({c: F.lit("x") for c in ("part", "mask", "n", "digest", "step", "quality")})
    got = filter_audit.audit(df.repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("is_good", F.lit(1)))
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, labels)


def test_intervals_cover_each_order_once():
    for mask in range(1, 32):
        seen = sorted(k for m, _, a, b in filter_audit.intervals() if m == mask for k in range(a, b))
        assert seen == list(range(120))
    for m, step, a, b in filter_audit.intervals():
        for k in range(a, b):
            at = [i for i, x in enumerate(filter_audit.ORDERS[k], 1) if m >> "ABCDE".index(x) & 1]
            assert at[0] == step
