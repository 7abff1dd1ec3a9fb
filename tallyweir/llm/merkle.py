"""A Merkle manifest of a dataset: a digest of each row, of each part, and of the whole, with a proof for each row.

Each part's rows are leaves in order; every eight nodes that stand side by side are hashed to their parent, level by level.
A level's siblings are fixed-offset lag and lead columns of a window over a run of eight, masked by the node's slot and
the run's length; the first node of a run hashes the parent. Proofs come down the tree again: a node's path is its own
siblings and then its parent's path, so a row meets one table an eighth of its size, not one a level.

Texts are hashed where they are read and never shuffled. A large part is numbered by ranges: rows are dealt by ranges of
(part, id), numbered within each, and the ranges' counts are summed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .tables import Scratch

WIDTH = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_hash(fields: list[Column]) -> Column:
    """Hash of fields, each as `-` if null, else its length in bytes, `:` and itself."""
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields)), 256)


def numbered(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """rows with i (long, from 0 in a group `g`, by order) and n (the group's rows). Rows that are equal in order must be
    equal in all that matters: they are numbered in any order, and may be dealt to several ranges."""
    tie = F.monotonically_increasing_id().alias("tie")
    dealt = scratch.cut(rows.select("*", tie).repartitionByRange("g", *order, "tie").withColumn("range", F.spark_partition_id()))
    sizes = dealt.groupBy("g", "range").agg(F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(W.partitionBy("g").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("g", "range", before.alias("before"), F.sum("rows").over(W.partitionBy("g")).alias("n"))
    place = F.row_number().over(W.partitionBy("g", "range").orderBy(*order, "tie"))
    return dealt.withColumn("place", place).join(sizes, ["g", "range"]).withColumn("i", F.col("before") + F.col("place") - 1).drop("range", "place", "before", "tie")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """nodes (g, i, n, node, ...) with run, slot, left and right: the run's nodes before and after, as one string each."""
    at = nodes.withColumns({"run": F.floor(F.col("i") / WIDTH), "slot": (F.col("i") % WIDTH).cast("int")})
    run = W.partitionBy("g", "run").orderBy("slot")
    length = F.least(F.lit(WIDTH).cast("long"), F.col("n") - WIDTH * F.col("run"))
    lags = [F.when(F.col("slot") >= k, F.lag("node", k).over(run)) for k in range(WIDTH - 1, 0, -1)]
    leads = [F.when(F.col("slot") + k < length, F.lead("node", k).over(run)) for k in range(1, WIDTH)]
    return at.withColumns({"left": F.concat_ws("", *lags), "right": F.concat_ws("", *leads)})


def parents(nodes: DataFrame) -> DataFrame:
    """g, i, n, node of the next level, from the first node of each run. A group's only node is its own parent."""
    up = F.when(F.col("n") == 1, F.col("node")).otherwise(F.sha2(F.concat("node", "right"), 256))
    return with_siblings(nodes).where("slot = 0").select("g", F.col("run").alias("i"), F.ceil(F.col("n") / WIDTH).alias("n"), up.alias("node"))


def grow(nodes: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """Levels from nodes up to one node a group. The driver learns the largest group's size, nothing else."""
    levels, n = [nodes], nodes.agg(F.max("n")).first()[0] or 1
    while n > 1:
        levels.append(scratch.cut(parents(levels[-1])))
        n = -(-n // WIDTH)
    return levels


def descend(levels: list[DataFrame], top: DataFrame, carried: list[str]) -> DataFrame:
    """levels[0] with `path` (array of left and right, from itself up; none where a node is its group's only one) and the
    columns in carried, from top (g, path and carried for each group)."""
    above = levels[-1].select("g", "i", "n").join(top, "g")
    for k in range(len(levels) - 2, -1, -1):
        own = F.when(F.col("n") == 1, F.array().cast("array<struct<left:string,right:string>>")).otherwise(F.array(F.struct("left", "right")))
        down = above.select("g", F.col("i").alias("run"), F.col("path").alias("rest"), *carried)
        above = with_siblings(levels[k]).join(down, ["g", "run"]).withColumn("path", F.concat(own, "rest")).drop("run", "slot", "left", "right", "rest")
    if len(levels) == 1:
        above = levels[0].join(top, "g")
    return above


def manifest(docs: DataFrame, part: str = "lang", fields: list[str] = FIELDS, key: str = "doc_id", seen: Column | None = None) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root and verified for each row of docs; other columns than fields
    and the part are ignored.

    seen: the leaf of the row as it was received, to be verified against the root (default: the leaf itself). A null part is
    a part of its own and comes first. Rows without a key come first in their part; rows with one key stand by their leaves,
    and repeated rows are leaves each. One row alone is subroot and root, and its proof is the hash of nothing. An
    empty table has no rows."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    lasting = Scratch(spark)
    leaf = leaf_hash([F.col(c) for c in fields])
    group = F.when(F.col(part).isNull(), "").otherwise(F.concat(F.lit("="), F.col(part).cast("string")))
    rows = docs.select(F.col(key).alias("key"), group.alias("g"), leaf.alias("node"), (leaf if seen is None else seen).alias("seen"))
    leaves = lasting.cut(numbered(rows, ["key", "node"], scratch))
    levels = grow(leaves, lasting)
    subroots = levels[-1].select("g", F.col("node").alias("subroot"))
    tops = lasting.cut(numbered(subroots.select(F.lit(0).alias("g"), F.col("g").alias("part"), F.col("subroot").alias("node")), ["part"], scratch))
    scratch.clear()
    high = grow(tops, lasting)
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    crown = high[-1].select("g", F.col("node").alias("root"), nothing.alias("path"))
    parts = descend(high, crown, ["root"]).select(F.col("part").alias("g"), F.col("node").alias("subroot"), "root", "path")
    out = descend(levels, lasting.cut(parts), ["subroot", "root"])
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), ""), 256)
    folded = F.aggregate("path", F.col("seen"), lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))
    out = out.select(F.col("key").alias(key), F.col("node").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(docs: DataFrame) -> Column:
    """Leaf of a row whose text was put in lower case where 3 divides the checksum of its doc_id; a row without a doc_id
    or a text isn't changed."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(hit, F.translate(F.col("text").cast("string"), UPPER, LOWER)).otherwise(F.col("text").cast("string"))
    return leaf_hash([text if c == "text" else F.col(c) for c in FIELDS])
