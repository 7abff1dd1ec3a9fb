"""Language identification by fusing evidence in Bayes' rule.

A text's likelihood under each language is a hashed byte-trigram model's. To it come the language that the markup
declares and the address suffix, each weighed by how well it agrees with the texts, and a prior of the host that is
smoothed to its domain and the domain to the corpus. Tables of agreement and priors are grouped sums over all rows.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .tables import cut
from .words import LOWER, text_blocks

BUCKETS = 65_536
#: Labelled rows that train the trigram model: a bounded sample by hash of the text.
TRAIN_ROWS = 20_000
#: Trigrams of a text depend on each other: their log-likelihood counts as this many times less.
TEMPER = 4.0
KAPPA = 20.0


def _trigrams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bucket of each byte's trigram or -1 where a text ends, offsets) of blocks of texts."""
    for row, data, offsets in text_blocks(texts):
        low = LOWER[data].astype(np.uint32)
        code = np.full(len(low), -1, np.int64)
        if len(low) > 2:
            code[:-2] = ((low[:-2] << 16 | low[1:-1] << 8 | low[2:]) * np.uint32(2654435761)) >> np.uint32(16)
        for k in (1, 2):
            ends = offsets[1:] - k
            code[ends[ends >= offsets[:-1]]] = -1
        yield row, code, offsets


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for row, code, offsets in _trigrams(batch.column(1)):
            for i in range(len(offsets) - 1):
                c = code[offsets[i] : offsets[i + 1]]
                counts.setdefault(langs[row + i], np.zeros(BUCKETS, np.int64))
                counts[langs[row + i]] += np.bincount(c[c >= 0], minlength=BUCKETS)
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c.astype("<i8").tobytes() for c in counts.values()], pa.binary())], names=["lang", "counts"])


def train(labelled: DataFrame, rows: int = TRAIN_ROWS, shards: int = 8) -> tuple[list[str], np.ndarray]:
    """(languages, log P(trigram bucket | language)) from a sample of labelled (lang, text)."""
    labelled = labelled.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    total = labelled.count()
    drawn = F.xxhash64("text").cast("double") / 2.0**64 + 0.5
    # a text that occurs very often counts once, so that the sample is bounded whatever the copies
    digest = F.xxhash64("text").alias("digest")
    sample = labelled.where(drawn < min(1.0, rows / max(1, total))).groupBy("lang", digest, F.length("text").alias("size")).agg(F.first("text").alias("text"))
    sample = sample.select("lang", "text").repartition(shards)
    sums: dict[str, np.ndarray] = {}
    for r in sample.mapInArrow(_counter, "lang string, counts binary").collect():  # languages x shards rows
        sums[r.lang] = sums.get(r.lang, 0) + np.frombuffer(r.counts, "<i8")
    langs = sorted(sums)
    if not langs:
        return ["und"], np.zeros((1, BUCKETS), np.float32)
    c = np.stack([sums[x] for x in langs]) + 0.2
    return langs, np.log(c / c.sum(1, keepdims=True)).astype(np.float32)


def _likelihoods(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.concatenate([model.value, np.zeros((len(model.value), 1), np.float32)], 1)  # bucket -1: nothing
        for batch in batches:
            out = np.zeros((batch.num_rows, len(table)))
            for row, code, offsets in _trigrams(batch.column(batch.num_columns - 1)):
                full = np.flatnonzero(offsets[:-1] < offsets[1:])
                if len(full):
                    for k, t in enumerate(table):
                        out[row + full, k] = np.add.reduceat(t[code], offsets[:-1][full], dtype=np.float64)
            out = (out - out.max(1, keepdims=True)) / TEMPER
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * len(table)), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*batch.schema.names[:-1], "ll"])

    return score


_HIDDEN = re.compile(r"<(script|style)\b", re.IGNORECASE | re.ASCII)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE | re.ASCII) for name in ("script", "style")}


def strip_markup(page: str) -> str:
    """A page's text, in one pass from left to right: comments, scripts, styles and tags are spaces. What opens and isn't closed
    is looked for once: an open comment or script is a tag, an open tag is text."""
    out, at, open_ended = [], 0, set()
    while (lt := page.find("<", at)) >= 0:
        out.append(page[at:lt])
        end = -1
        if page.startswith("<!--", lt) and "comment" not in open_ended:
            if (found := page.find("-->", lt + 4)) >= 0:
                end = found + 3
            else:
                open_ended.add("comment")
        elif (m := _HIDDEN.match(page, lt)) and (name := m[1].lower()) not in open_ended:
            if found := _CLOSE[name].search(page, m.end()):
                end = found.end()
            else:
                open_ended.add(name)
        if end < 0:
            if (gt := page.find(">", lt + 1)) < 0:
                at = lt
                break
            end = gt + 1
        out.append(" ")
        at = end
    out.append(page[at:])
    return "".join(out)


@F.pandas_udf(StringType())
def visible(html: pd.Series) -> pd.Series:
    """Text of pages: without markup, entities as characters."""
    return html.map(lambda t: t if t is None else markup.unescape(strip_markup(t)))


def page_evidence(pages: DataFrame) -> DataFrame:
    """page_id, host, declared, suffix and text of pages (page_id, url, html)."""
    host = F.lower(F.regexp_extract(F.col("url"), "^[A-Za-z][\\w+.-]*://([^/?#:]+)", 1))
    path = F.lower(F.regexp_extract(F.col("url"), "^[A-Za-z][\\w+.-]*://[^/?#]+/([A-Za-z]{2})(?:/|$)", 1))
    declared = F.lower(F.regexp_extract(F.col("html"), "(?i)<html\\b[^<>]*?(?<![\\w-])lang\\s*=\\s*[\"']?([A-Za-z]{2,3})", 1))
    none = lambda c: F.when(c != "", c)
    suffix = F.concat_ws("/", none(F.regexp_extract(host, "([a-z]+)$", 1)), none(path))
    return pages.select("page_id", none(host).alias("host"), none(declared).alias("declared"), none(suffix).alias("suffix"), visible(F.coalesce("html", F.lit(""))).alias("text"))


def fuse(evidence: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """evidence (host, declared, suffix, text and key columns) without text, with lang, prob and text_lang.

    A null host, declared language or suffix is no evidence; an empty text has equal likelihoods, so the other evidence
    and the corpus's prior decide; ties go to the first language. A row's own vote is taken out of its host's prior."""
    n = len(langs)
    keys = [f for f in evidence.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys), "ll array<double>"])
    shared = evidence.sparkSession.sparkContext.broadcast(model)
    rows = cut(evidence.select(*(f"`{f.name}`" for f in keys), F.col("text").cast("binary").alias("text")).mapInArrow(_likelihoods(shared), schema))
    rows = rows.withColumn("domain", F.regexp_extract("host", "([^.]+\\.[^.]+)$|^([^.]+)$", 0))
    odds = F.transform("ll", F.exp)
    total = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    rows = rows.withColumn("p", F.transform(odds, lambda x: x / total))
    sums = lambda *by: rows.where(" and ".join(f"{b} is not null" for b in by) or "true").groupBy(*by).agg(F.array(*(F.coalesce(F.sum(F.get("p", F.lit(k))), F.lit(0.0)) for k in range(n))).alias("c"))
    size = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    smooth = lambda c, m, base: F.transform(F.zip_with(c, base, lambda x, b: x + KAPPA * b), lambda x: x / (m + KAPPA))
    world = sums().select(F.transform("c", lambda x: (x + 1) / (size("c") + n)).alias("world"), F.col("c").alias("all"))
    domain = sums("domain").join(F.broadcast(world)).select(F.col("domain").alias("_d"), smooth(F.col("c"), size("c"), F.col("world")).alias("dp"))
    # a row for each host, written: the join with all rows is then one plain shuffle, which AQE splits where a host is hot
    hosts = cut(sums("host", "domain").join(domain, F.col("domain") == F.col("_d")).select(F.col("host").alias("_h"), F.col("c").alias("hc"), "dp"))

    def agreement(column: str, name: str) -> DataFrame:
        """P(value | language) of each value, relative to its share in the corpus."""
        by = sums(column).join(F.broadcast(world))
        share = (size("c") + 1) / (size("all") + n)
        return by.select(F.col(column).alias(f"_{name}"), F.transform(F.zip_with("c", "all", lambda x, a: (x + KAPPA * share) / (a + KAPPA)), lambda x: F.log(x / share)).alias(name))

    # written, so that the planner knows their sizes: a small one is shipped, a large one is joined by value
    declared, suffix = cut(agreement("declared", "dl")), cut(agreement("suffix", "sl"))
    full = rows.join(declared, F.col("declared") == F.col("_dl"), "left").join(F.broadcast(world)).join(suffix, F.col("suffix") == F.col("_sl"), "left").join(hosts, F.col("host") == F.col("_h"), "left")
    base = F.coalesce("dp", "world")
    others = F.coalesce(F.zip_with("hc", "p", lambda c, p: F.greatest(c - p, F.lit(0.0))), F.transform("p", lambda x: F.lit(0.0)))
    zero = F.transform("p", lambda x: F.lit(0.0))
    full = full.select(*(f"`{f.name}`" for f in keys), "ll", smooth(others, size(others), base).alias("prior"), F.coalesce("dl", zero).alias("dl"), F.coalesce("sl", zero).alias("sl"))
    log = F.zip_with(F.zip_with("ll", "prior", lambda a, b: a + F.log(b)), F.zip_with("dl", "sl", lambda a, b: a + b), lambda a, b: a + b)
    full = full.withColumn("log", log)
    best = F.array_max("log")
    name = lambda c: F.element_at(F.array(*map(F.lit, langs)), F.array_position(c, F.array_max(c)).cast("int"))
    prob = 1 / F.aggregate(F.transform("log", lambda x: F.exp(x - best)), F.lit(0.0), lambda a, x: a + x)
    return full.select(*(f"`{f.name}`" for f in keys), name(F.col("log")).alias("lang"), prob.alias("prob"), name(F.col("ll")).alias("text_lang"))


def identify(docs: DataFrame, pages: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id (null for pages), page_id (null for documents), host, declared, suffix, lang, prob and text_lang of each
    row of docs (doc_id, text, lang, source) and pages (page_id, url, html). docs' lang trains the text model and is no
    evidence for its row; a document's host is its source, and it has no markup or address. Null texts are empty. Repeated rows
    are rows each and all count for their host; empty tables give no rows, and without documents every page is `und`."""
    langs, model = train(docs, train_rows)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), F.col("source").cast("string").alias("host"), F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("suffix"), text.alias("text"))
    p = page_evidence(pages).select(F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), "host", "declared", "suffix", "text")
    return fuse(d.unionByName(p), langs, model)
