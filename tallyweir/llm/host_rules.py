"""Quality rules with host-level verdicts, in Spark expressions only.

Each text is measured; the rules' failures are summed by host (documents.source), a host's failure rate is shrunk to
the corpus's with an empirical beta prior (moments over hosts), and hosts whose shrunk rate is over a limit take their
documents with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cut, private, quoted

#: Patterns of the contract: words, symbols, lines.
GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS, REPEAT_WIDTH, MAX_REPEAT_PERCENT = 10, 5, 20
#: A host goes when its shrunk failure rate is over this.
HOST_LIMIT = 0.6
#: Hosts up to which the verdicts of rejected hosts are shipped to every task.
BROADCAST_HOSTS = 200_000
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
NEW = [*MEASURES, "base_failed", "host_rate", "kept"]


def with_measures(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns in keep (default: all of docs) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long)
    and base_failed; columns of docs with these names are replaced. A null text has no words and measures 0.

    The measures are one chain of expressions. Filters on them are pushed down by writing the chain out in place of each
    column, so write the result before filtering it."""
    k = REPEAT_WIDTH
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    kept = [quoted(c) for c in (docs.columns if keep is None else keep) if c.lower() not in NEW[:6]]
    w, ln, h, o, p = private(docs.columns, "w", "l", "h", "o", "p")
    one = docs.select(*kept, words.alias(w), lines.alias(ln), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    hashes = F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*(F.get(F.col(w), i + j) for j in range(k)))))
    two = one.select(
        *kept, "n_symbols", F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"), hashes.alias(h),
    )
    repeats = F.size(F.array_distinct(h)) < F.size(h)
    order = F.when(repeats, F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    three = two.select(*kept, "n_symbols", "n_words", "word_chars", "n_dup_lines", order.alias(o))
    twice = F.filter(F.col(o), lambda x, i: (x["h"] == F.get(F.col(o), i - 1)["h"]) | F.coalesce(x["h"] == F.get(F.col(o), i + 1)["h"], F.lit(False)))
    four = three.select(*kept, "n_symbols", "n_words", "word_chars", "n_dup_lines", F.array_sort(F.transform(twice, lambda x: x["i"])).alias(p))
    covered = F.aggregate(F.transform(F.col(p), lambda x, i: F.coalesce(F.least(F.get(F.col(p), i + 1) - x, F.lit(k)), F.lit(k))), F.lit(0), lambda a, x: a + x)
    five = four.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return five.select(*kept, *MEASURES, failed.alias("base_failed"))


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """host, n, failed, rate (failed / n) and shrunk: the mean of the beta posterior whose prior has the hosts' own
    mean and spread. A null host is a host of its own. Sums are taken before the shuffle, so a hot host is one row a
    task; the moments are one row."""
    by = measured.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    by = by.withColumn("rate", F.col("failed") / F.col("n"))
    # method of moments: spread of rates beyond binomial noise gives the prior's weight
    m = by.agg((F.sum("failed") / F.sum("n")).alias("mean"), F.count(F.lit(1)).alias("hosts"), F.var_pop("rate").alias("var"), F.avg(1 / F.col("n")).alias("noise"))
    noise = F.col("mean") * (1 - F.col("mean"))
    extra = F.greatest(F.coalesce(F.col("var"), F.lit(0.0)) - noise * F.col("noise"), noise * 1e-4)
    weight = F.when(noise > 0, F.greatest(noise / extra - 1, F.lit(1.0))).otherwise(F.lit(1.0))
    prior = m.select("mean", weight.alias("weight"))
    return by.join(F.broadcast(prior)).withColumn("shrunk", (F.col("failed") + F.col("mean") * F.col("weight")) / (F.col("n") + F.col("weight"))).select("host", "n", "failed", "rate", "shrunk")


def judge(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT, keep: list[str] | None = None, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """The columns in keep (default: all of docs) with the measures, base_failed, host_rate (shrunk), and kept: neither
    the rules nor the host's shrunk rate reject it. Columns of docs with these names are replaced. Without the host
    column all documents have one (null) host. An empty table gives an empty table.

    The measures are taken once and written with the columns that are kept; the hosts' sums and the result read that.
    broadcast_hosts changes the plan, never the result."""
    at, rate = private([*docs.columns, *NEW], "host", "rate")
    source = F.col(quoted(host)).cast("string") if host in docs.columns else F.lit(None).cast("string")
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in NEW]
    measured = cut(with_measures(docs.withColumn(at, source), [*names, at]))
    rates = cut(host_rates(measured, at)).select(F.col("host").alias(rate), F.col("shrunk").alias("host_rate"))
    # a verdict for each host; shipped where there are few hosts, else joined by host with AQE's skew handling
    few = rates.limit(broadcast_hosts + 1).count() <= broadcast_hosts
    joined = measured.join(F.broadcast(rates) if few else rates, F.col(at).eqNullSafe(F.col(rate)), "left")
    kept = ~F.col("base_failed") & (F.col("host_rate") <= limit)
    return joined.select(*map(quoted, names), *MEASURES, "base_failed", "host_rate", kept.alias("kept"))


def passing(docs: DataFrame) -> DataFrame:
    """docs (its columns, whatever their names) without the rejected rows."""
    clash = {c: private([*docs.columns, *NEW], f"own_{c}")[0] for c in docs.columns if c.lower() in NEW}
    passed = judge(docs.withColumnsRenamed(clash)).where("kept")
    return passed.select(*(F.col(quoted(clash.get(c, c))).alias(c) for c in docs.columns))
