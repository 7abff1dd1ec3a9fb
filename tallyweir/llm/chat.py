"""Chat formatting in Spark expressions only.

A conversation's turns are collected in bounded chunks of turn numbers, sorted, and adjacent turns of one role merged
by array aggregation into blocks; blocks are concatenated. The template:

    <s>[INST]role[/INST]text</s>              a block
    <s>[INST]role[/INST]text[NEXT]text</s>    adjacent turns of one role

A control string inside a role or text gets a backslash after its first character (and one more if it has some
already), which is undone on reading; no other text changes. The loss mask covers texts of assistant turns, not marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, HEAD, BODY, NEXT, END = "<s>", "[INST]", "[/INST]", "[NEXT]", "</s>"
_NAMES = "/?(?:s>|INST\\]|NEXT\\])"
CHUNK = 64


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"([<\\[])(\\\\*)({_NAMES})", "$1\\\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, f"([<\\[])\\\\(\\\\*)({_NAMES})", "$1$2$3")


def _merge(blocks: Column, more: Column) -> Column:
    """blocks and more (array<struct<role, texts>>) in a row; where they meet in one role, one block."""
    last, first = F.try_element_at(blocks, F.lit(-1)), F.try_element_at(more, F.lit(1))
    one = F.struct(last["role"].alias("role"), F.concat(last["texts"], first["texts"]).alias("texts"))
    head = F.when(F.size(blocks) > 1, F.slice(blocks, 1, F.size(blocks) - 1)).otherwise(F.slice(blocks, 1, 0))
    rest = F.when(F.size(more) > 1, F.slice(more, 2, F.size(more) - 1)).otherwise(F.slice(more, 1, 0))
    meet = (F.size(blocks) > 0) & (F.size(more) > 0) & (last["role"] == first["role"])
    return F.when(meet, F.concat(head, F.array(one), rest)).otherwise(F.concat(blocks, more))


_BLOCKS = "array<struct<role:string,texts:array<string>>>"


def blocks_of(turns: DataFrame) -> DataFrame:
    """conv_id and blocks (role, texts) in turn order. A null role or text is empty; equal turn numbers go by role, then
    text; a null turn comes first; repeated rows stay."""
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    # a long conversation is collected in chunks, which are merged before they meet
    chunk = rows.groupBy("conv_id", F.floor(F.col("turn") / CHUNK).alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    single = lambda x: F.array(F.struct(x["role"].alias("role"), F.array(x["text"]).alias("texts")))
    chunk = chunk.select("conv_id", "chunk", F.aggregate("t", F.array().cast(_BLOCKS), lambda acc, x: _merge(acc, single(x))).alias("blocks"))
    whole = chunk.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "blocks"))).alias("c"))
    flat = whole.select("conv_id", F.flatten(F.transform("c", lambda x: x["blocks"])).alias("b"))
    # where chunks meet in one role their blocks are one: places of first blocks, then each stretch is copied once
    first = F.filter(F.sequence(F.lit(0), F.size("b") - 1), lambda i: (i == 0) | (F.get("b", i)["role"] != F.get("b", i - 1)["role"]))
    placed = flat.withColumn("at", F.concat(first, F.array(F.size("b"))))

    def stretch(k: Column) -> Column:
        i, to = F.get("at", k), F.get("at", k + 1)
        texts = F.flatten(F.transform(F.slice("b", i + 1, to - i), lambda x: x["texts"]))
        return F.struct(F.get("b", i)["role"].alias("role"), texts.alias("texts"))

    joined = F.transform(F.sequence(F.lit(0), F.size("at") - 2), stretch)
    return placed.select("conv_id", joined.alias("blocks"))


def format_chat(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """conv_id, segments (text, loss) and formatted (the segments' texts in a row) of each conversation of turns
    (conv_id, turn, role, text; other columns are ignored). Rows of a null conv_id are one conversation; an empty table
    gives an empty table."""
    mark = lambda t: F.struct(t.alias("text"), F.lit(False).alias("loss"))

    def segments(block: Column) -> Column:
        loss = block["role"] == learn
        texts = F.transform(block["texts"], lambda t, i: F.array(mark(F.when(i > 0, NEXT).otherwise("")), F.struct(escape(t).alias("text"), loss.alias("loss"))))
        return F.concat(F.array(mark(F.concat(F.lit(BEGIN + HEAD), escape(block["role"]), F.lit(BODY)))), F.flatten(texts), F.array(mark(F.lit(END))))

    out = blocks_of(turns).select("conv_id", F.filter(F.flatten(F.transform("blocks", segments)), lambda s: s["loss"] | (s["text"] != "")).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")
    halves = F.transform(blocks, lambda b: F.split(F.substr(b, F.lit(len(BEGIN + HEAD) + 1)), "\\[/INST\\]", 2))
    return F.flatten(F.transform(halves, lambda h: F.transform(F.split(F.get(h, F.lit(1)), "\\[NEXT\\]"), lambda t: F.struct(unescape(F.get(h, F.lit(0))).alias("role"), unescape(t).alias("text")))))


def digests(chats: DataFrame) -> DataFrame:
    """What the output holds, read back from it: counts and hashes of turns and of the text under the loss mask."""
    lost = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    out = chats.select("conv_id", "formatted", read_back(F.col("formatted")).alias("t"), lost.alias("lost"))
    text = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"), F.length("lost").cast("long").alias("loss_chars"),
        F.sha2("lost", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
