"""Filter interaction audit: what each of five filters removes in every one of their 120 orders.

A document is reduced to the mask of the filters that it fails, and masks are counted by part. In the order of
permutations by Lehmer rank, those that begin with the same s letters are one interval of ranks; so a mask's documents are
removed at step s, by a letter f of the mask, over the intervals of all beginnings of s - 1 letters outside the mask and
then f. Counts are added at the intervals' first rank and taken away after their last, and prefix sums over the 120 ranks
give what every order removes at every step. No document meets an order: the work after counting masks is 32 masks and
600 rows a part.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .tables import Scratch

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Patterns of the contract: white space between words, capitals, symbols.
GAP, CAPITALS, SYMBOLS = "[\\x20\\x09-\\x0D]+", "[A-Z]+", "[#$%&*|]"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 50, 65, 5
COUNTS = ["n", "good", "toxic"]


def lehmer_rank(letters: str) -> int:
    """Rank of the first permutation that begins with letters."""
    left, rank = list(FILTERS), 0
    for k, x in enumerate(letters):
        rank += left.index(x) * factorial(len(FILTERS) - 1 - k)
        left.remove(x)
    return rank


def intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) over which documents of a mask are removed at a step. Bit k of a
    mask is the k-th filter."""
    out = []
    for mask in range(1, 1 << len(FILTERS)):
        failed = [x for k, x in enumerate(FILTERS) if mask >> k & 1]
        passed = [x for x in FILTERS if x not in failed]
        for step in range(1, len(passed) + 2):
            for before in permutations(passed, step - 1):
                for f in failed:
                    low = lehmer_rank("".join(before) + f)
                    out.append((mask, step, low, low + factorial(len(FILTERS) - step)))
    return out


def _text_mask(text: Column) -> Column:
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    length = F.length(text)
    capitals = length - F.length(F.regexp_replace(text, CAPITALS, ""))
    fails = [n < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PERCENT * n, 100 * capitals > MAX_CAPITAL_PERCENT * length, text.rlike(SYMBOLS)]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def failure_masks(docs: DataFrame, labels: DataFrame, scratch: Scratch, part: str = "source") -> DataFrame:
    """part, mask, n, good, toxic: how many documents of a part fail exactly the filters of a mask.

    Of equal texts the smallest doc_id passes E, with all its repeated rows. A row without a doc_id passes E too, and makes
    no other row fail it; it has no label. A document with several labels is good or toxic if one of them says so.
    Nothing but ids, parts, masks and text digests is shuffled, and a (text, id) is one row of the joins, so neither a
    text with very many copies nor a large part is one task's work."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), _text_mask(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = scratch.cut(rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n")))
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    last = 1 << len(FILTERS) - 1
    named = rows.where("doc_id is not null").join(first, ["digest", "doc_id"], "left")
    named = named.withColumn("mask", F.col("mask") + F.when(F.col("first"), 0).otherwise(last))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("is_good"), (F.col("toxic") == 1).alias("is_toxic"))
    marks = marks.where("doc_id is not null").groupBy("doc_id").agg(F.max("is_good").alias("is_good"), F.max("is_toxic").alias("is_toxic"))
    named = named.join(marks, "doc_id", "left").select("part", "mask", "n", "is_good", "is_toxic")
    nameless = rows.where("doc_id is null").select("part", "mask", "n", F.lit(False).alias("is_good"), F.lit(False).alias("is_toxic"))
    counted = {"n": F.sum("n"), "good": F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)), "toxic": F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0))}
    return named.unionByName(nameless).groupBy("part", "mask").agg(*(v.alias(k) for k, v in counted.items()))


def totals(masks: DataFrame) -> DataFrame:
    """part, step (1 to 5), rank (0 to 119), n, good, toxic: what the permutation of that rank removes at that step."""
    spark = masks.sparkSession
    spans = F.broadcast(spark.createDataFrame(intervals(), "mask int, step int, low int, high int"))
    ends = masks.join(spans, "mask").select("part", "step", *COUNTS, F.explode(F.array(F.struct(F.col("low").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("high").alias("rank"), F.lit(-1).alias("sign")))).alias("e"))
    ends = ends.select("part", "step", F.col("e.rank").alias("rank"), *((F.col(c) * F.col("e.sign")).alias(c) for c in COUNTS))
    places = masks.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    places = places.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) - 1))).alias("rank"), *(F.lit(0).cast("long").alias(c) for c in COUNTS))
    steps = ends.where(F.col("rank") < len(ORDERS)).unionByName(places).groupBy("part", "step", "rank").agg(*(F.sum(c).alias(c) for c in COUNTS))
    so_far = W.partitionBy("part", "step").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    return steps.select("part", "step", "rank", *(F.sum(c).over(so_far).alias(c) for c in COUNTS))


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: 600 rows for each
    part of docs (doc_id, text and the part; other columns are ignored).

    A null part is the empty string, with the rows whose part is one. A null text is empty: it fails A and is one with
    other empty texts for E. An empty table gives no rows; empty labels lose nothing. Repeated rows count each."""
    scratch = Scratch(docs.sparkSession)
    kept = Scratch(docs.sparkSession)
    masks = kept.cut(failure_masks(docs, labels, scratch, part))
    scratch.clear()
    bits = [F.col("mask").bitwiseAND(1 << k) != 0 for k in range(len(FILTERS))]
    n = F.col("n")
    by_part = masks.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*(F.sum(F.when(b, n).otherwise(0)) for b in bits)).alias("fails"),
        F.array(*(F.sum(F.when(F.col("mask") == 1 << k, n).otherwise(0)) for k in range(len(FILTERS)))).alias("only"),
    )
    order = F.element_at(F.array(*map(F.lit, ORDERS)), F.col("rank") + 1)
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    rows = totals(masks).join(by_part, "part").withColumn("filter_order", order).withColumn("letter", letter)
    rows = rows.withColumn("at", F.instr(F.lit(FILTERS), F.col("letter")))
    through = F.sum("n").over(W.partitionBy("part", "filter_order").orderBy("step").rowsBetween(W.unboundedPreceding, 0))
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - through).alias("kept"), n.alias("removed"), (F.element_at("fails", F.col("at")) - n).alias("redundant"), F.element_at("only", F.col("at")).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.sum("n").over(W.partitionBy("part", "letter")).alias("shapley"),
    )
