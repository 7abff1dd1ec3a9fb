"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or nothing on each document. How often each vote pattern occurs is counted over
all documents (at most 3 ** labellers rows a target), expectation-maximisation estimates each heuristic's accuracy and
the posterior of each pattern, and those posteriors train a hashed linear scorer (FTRL-proximal, sparse) that then
scores every document. Two targets are fitted alike: bad quality and toxic wording.

Bad texts are bad in one way or another, and a heuristic sees its own kind of defect. So EM fits one class of good texts
and one for each kind (KINDS: the labellers that overlap on it); bad is whatever isn't good. Nothing is fixed but where EM
starts: accuracies and shares are its own.

The word lists of the toxicity labellers are English, and they say nothing on other texts. Two more labellers take
their terms (words and word beginnings) from given toxicity labels, so they know the insults of every language that has
labelled texts; without labels they say nothing. Labelled documents are in two folds by id: one of these is judged by the
terms that the other fold's labels give, never by its own label, and every other document by the terms of both.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import cut
from .words import BYTE_VALUES, LOWER, U64, mix, powers, text_blocks, windows, word_hashes

BITS = 18
#: Documents that train the scorers: a bounded sample by hash of doc_id; everything else covers all documents.
TRAIN_ROWS, SHARDS, EPOCHS = 12_000, 4, 6
#: Labelled documents that the terms are taken from: a bounded sample by hash of doc_id.
LABELLED_ROWS = 20_000
#: Bytes of word beginnings that are terms, beside whole words.
STEMS = range(5, 11)
#: A term occurs in this share of the toxic texts of the sample and in this number of them at least, and this share of
#: the texts with it is toxic.
TERM_SHARE, TERM_TEXTS, TERM_TOXIC = 0.005, 5, 0.9
GOOD, BAD, NONE = 0, 1, 2
#: Insults, in two overlapping lists.
INSULTS = frozenset(b"idiot idiots moron morons loser losers clown clowns scum trash fool fools imbecile vermin bastard jerk creep garbage".split())
SLURRING = frozenset(b"stupid pathetic worthless disgusting trash scum dumb ugly filthy idiotic vile despicable shut hate idiot moron".split())
#: Frequent English words; a text with few of them isn't English.
ENGLISH = frozenset(b"the of and to is that was for".split())
_LETTERS = np.array([(48 <= b <= 57) or (97 <= b <= 122) or (65 <= b <= 90) or b >= 128 for b in range(256)])
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if _LETTERS[b] else 32 for b in range(256))
_UPPER, _LOWER, _SYMBOLS = bytes(range(65, 91)), bytes(range(97, 123)), b"#*$%&|<>"
_SEEN = INSULTS | SLURRING | ENGLISH
QUALITY_LABELLERS = ["symbols", "decorated", "capitals", "shouting", "repeats", "variety", "bars", "tables", "lines", "sentences"]
TOXIC_LABELLERS = ["insults", "slurring", "density", "several", "terms", "dense_terms"]
#: Kinds of bad texts, by the labellers that see them.
QUALITY_KINDS = [["symbols", "decorated"], ["capitals", "shouting"], ["repeats", "variety"], ["bars", "tables"], ["lines"], ["sentences"]]
TOXIC_KINDS = [TOXIC_LABELLERS]
#: Measures from here on are bad, and up to here good; between, and where a text is too short to tell, nothing is said.
SYMBOLS, DECORATED, CAPITALS, SHOUTS, REPEATS, BARS, TABLES, AGAIN = (0.03, 0.015), (0.1, 0.05), (0.3, 0.2), (0.1, 0.05), (0.1, 0.05), (0.1, 0.05), (0.4, 0.2), (0.3, 0.15)
VARIETY, STOPS = (0.35, 0.5), (0.01, 0.02)
_NO_TERMS = np.empty(0, np.uint64)
_VALUES = BYTE_VALUES[LOWER]


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else NONE


def _over(x: float, limits: tuple[float, float]) -> int:
    return _vote(x > limits[0], x <= limits[1])


def _under(x: float, limits: tuple[float, float], told: bool) -> int:
    return _vote(x < limits[0], x >= limits[1]) if told else NONE


def votes(raw: bytes, term_hits: int | None = None) -> tuple[list[int], list[int], list[int], list[int]]:
    """Quality votes, toxicity votes, and bins of the measures behind either. term_hits: words with a labelled term;
    None if there are no such terms."""
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    upper = size - len(raw.translate(None, _UPPER))
    letters = upper + size - len(raw.translate(None, _LOWER))
    symbols = (size - len(raw.translate(None, _SYMBOLS))) / size
    capitals = upper / max(1, letters)
    same = sum(map(operator.eq, words, words[1:])) / max(1, n)
    bars, stops, shouts = raw.count(b"|") / max(1, n), raw.count(b".") / max(1, n), raw.count(b"!!") / max(1, n)
    lines = [x for x in raw.split(b"\n") if x]
    again = 1 - len(set(lines)) / max(1, len(lines))
    decorated = sum(raw.count(c * 3) for c in (b"#", b"*", b"$", b"%", b"&")) / max(1, n)
    variety = len(set(words)) / max(1, n) * max(1.0, (n / 400) ** 0.4)
    rows = sum(x.count(b" | ") >= 2 for x in lines) / max(1, len(lines))
    quality = [
        _over(symbols, SYMBOLS), _over(decorated, DECORATED), _over(capitals, CAPITALS), _over(shouts, SHOUTS), _over(same, REPEATS), _under(variety, VARIETY, n >= 20), _over(bars, BARS), _over(rows, TABLES), _over(again, AGAIN), _under(stops, STOPS, n > 30),
    ] if n else [NONE] * len(QUALITY_LABELLERS)
    plain = raw.translate(_PLAIN).split()
    hits = [w for w in plain if w in _SEEN]
    english = bool(hits) and len(hits) > 0.01 * len(plain)
    hits = [w for w in hits if w not in ENGLISH]
    kinds = set(hits)
    english |= bool(kinds)
    toxic = [_vote(bool(kinds & INSULTS), english), _vote(bool(kinds & SLURRING), english), _vote(len(hits) > 0.002 * len(plain), english), _vote(len(kinds) >= 2, not kinds and english)]
    some, known = bool(plain) and term_hits is not None, term_hits or 0
    toxic += [_vote(known >= 2 and known > 0.004 * len(plain), some), _vote(known > 0.008 * len(plain), some)]
    bins = [int(max(0, min(9, 20 * x))) for x in (symbols * 5, decorated, capitals, same, 1 - variety, bars, stops, shouts, again)] + [min(12, n.bit_length())]
    return quality, toxic, bins, [min(3, len(kinds)), min(3, len(hits)), min(3, known), min(5, int(250 * known / max(1, len(plain))))]


def _code(v: list[int]) -> int:
    return sum(x * 3**k for k, x in enumerate(v))


def _word_terms(data: np.ndarray, words: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words' numbers, hashes) of the terms of each kind: whole words, then word beginnings of each length."""
    yield np.arange(len(words)), words
    if not len(words):
        return
    length = np.add.reduceat(_LETTERS[data].astype(np.int64), starts)
    which = np.flatnonzero(length >= STEMS.start)
    at, length, total, factor = starts[which], length[which], np.zeros(len(which), np.uint64), powers(STEMS.stop)
    for k in range(STEMS.stop - 1):
        if k >= STEMS.start:
            long = length > k
            which, at, length, total = which[long], at[long], length[long], total[long]
        total += _VALUES[data[at + k]] * factor[k]
        if k + 1 in STEMS:
            yield which, mix(total ^ U64(k + 1))


def _features(texts: pa.Array, folds: pa.Array, terms: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, bytes, int | None]]:
    """(row, distinct hashed words, raw text, words with a term of the row's fold; terms are sorted) of each text."""
    fold_of = folds.to_numpy(zero_copy_only=False)
    for fold, known in enumerate(terms):
        mine = np.flatnonzero(fold_of == fold)
        if len(mine):
            for row, *rest in _fold_features(texts.take(pa.array(mine)), known):
                yield int(mine[row]), *rest


def _fold_features(texts: pa.Array, terms: np.ndarray) -> Iterator[tuple[int, np.ndarray, bytes, int | None]]:
    down = U64(64 - BITS)
    head = np.zeros(1 << 16, bool)  # first bits of the terms
    head[terms >> U64(48)] = True
    for row, data, offsets in text_blocks(texts):
        full, starts, bounds = word_hashes(data, offsets, in_word=_LETTERS)
        hit = np.zeros(len(full), np.int64)
        if len(terms):
            for which, h in _word_terms(data, full, starts):
                maybe = np.flatnonzero(head[h >> U64(48)])
                at = np.minimum(np.searchsorted(terms, h[maybe]), len(terms) - 1)
                hit[which[maybe[terms[at] == h[maybe]]]] = 1
        hits = np.concatenate([[0], np.cumsum(hit)])
        short = (full >> down).astype(np.int64)
        for i in range(len(offsets) - 1):
            a, b = bounds[i], bounds[i + 1]
            raw = data[offsets[i] : offsets[i + 1]].tobytes()
            yield row + i, np.unique(short[a:b]), raw, int(hits[b] - hits[a]) if len(terms) else None


def _bin_features(bins: list[int], first: int = 1) -> np.ndarray:
    return (mix(np.array([(k + first) * 1000 + b for k, b in enumerate(bins)], dtype=np.uint64)) >> U64(64 - BITS)).astype(np.int64)


def _patterns(terms):
    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [votes(raw, n)[:2] for _, _, raw, n in _features(batch.column(0), batch.column(1), terms.value)]
            yield pa.RecordBatch.from_arrays([pa.array([_code(v[k]) for v in found], pa.int32()) for k in (0, 1)], names=["quality", "toxic"])

    return patterns


def _copy_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds k0 to k2: minima of three hashes of the text's 5-word runs, most of which near copies share."""
    for batch in batches:
        keys = np.zeros((batch.num_rows, 3), np.uint64)
        for row, data, offsets in text_blocks(batch.column(batch.num_columns - 1)):
            words, _, bounds = word_hashes(data, offsets, in_word=_LETTERS)
            runs, at = windows(words, bounds, 5)
            for i in np.flatnonzero(np.diff(at)):
                keys[row + i] = [mix(runs[at[i] : at[i + 1]] ^ U64(k + 1)).min() for k in range(3)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(keys[:, k].view(np.int64)) for k in range(3))], names=[*batch.schema.names, "k0", "k1", "k2"])


def _document_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, fold) of each distinct term of each document."""
    for batch in batches:
        toxic, fold = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for row, data, offsets in text_blocks(batch.column(2)):
            words, starts, bounds = word_hashes(data, offsets, in_word=_LETTERS)
            found = list(_word_terms(data, words, starts))
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
            both = np.unique(np.stack([np.concatenate([text[w] for w, _ in found]).astype(np.uint64), np.concatenate([h for _, h in found])]), axis=1)
            of = row + both[0].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[1].view(np.int64)), pa.array(toxic[of]), pa.array(fold[of])], names=["term", "toxic", "fold"])


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("long"), F.lit(3)), F.lit(2)).cast("int")


def labelled_terms(docs: DataFrame, labels: DataFrame | None, rows: int = LABELLED_ROWS) -> tuple[list[np.ndarray], DataFrame | None]:
    """Sorted hashes of the terms that occur almost only in texts labelled toxic: those of fold 1, of fold 0 and of both,
    for documents of fold 0, of fold 1 and of none (2); and the folds (id, fold) of the documents that were asked.

    labels (doc_id, toxic) is sampled first, so what is joined to docs is bounded by rows; of near copies and of
    repeated rows in the sample one counts. Every kept term occurs in TERM_SHARE of the toxic texts, which bounds their
    number. Null labels and ids are ignored; of several labels of a document toxic wins; no labels give no terms."""
    if labels is None:
        return [_NO_TERMS] * 3, None
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col("toxic").cast("long")).alias("toxic"))
    share = min(1.0, rows / max(1, known.count()))
    known = cut(known.where(F.xxhash64("_id", F.lit(2)).cast("double") / 2.0**64 + 0.5 < share))
    raw = F.col("text").cast("string").cast("binary").alias("raw")
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("_id"), raw).join(F.broadcast(known), "_id")
    # repeated rows of an id count once, however many they are
    texts = texts.groupBy("_id", F.xxhash64("raw").alias("digest")).agg(F.first("toxic").alias("toxic"), F.first("raw").alias("raw"))
    sample = cut(texts.select("_id", "toxic", "raw").mapInArrow(_copy_keys, "_id long, toxic long, raw binary, k0 long, k1 long, k2 long"))
    one = sample.select("_id", "k0", "k1", "k2")
    for key in ("k0", "k1", "k2"):
        one = one.groupBy(key).agg(F.min(F.struct("_id", "k0", "k1", "k2")).alias("one")).select("one.*")
    same = ["_id", "k0", "k1", "k2"]
    chosen = sample.join(one, same, "left_semi").groupBy(*same).agg(F.min("raw").alias("raw"), F.first("toxic").alias("toxic"))
    chosen = cut(chosen.select("toxic", fold_of(F.col("_id")).alias("fold"), "raw"))
    found = chosen.mapInArrow(_document_terms, "term long, toxic long, fold int")
    mine = lambda f, x: F.sum(F.when(F.col("fold") == f, x)).alias
    counted = cut(found.groupBy("term").agg(*(c for f in (0, 1) for c in (mine(f, F.col("toxic"))(f"t{f}"), mine(f, F.lit(1))(f"n{f}")))))
    total = {r.fold: r.t for r in chosen.groupBy("fold").agg(F.sum("toxic").alias("t")).collect()}
    out = []
    for folds in ([1], [0], [0, 1]):
        t, n = (sum((F.coalesce(F.col(f"{c}{f}"), F.lit(0)) for f in folds), F.lit(0)) for c in "tn")
        kept = counted.where((t >= max(TERM_TEXTS, TERM_SHARE * sum(total.get(f, 0) for f in folds))) & (t >= TERM_TOXIC * n))
        out.append(np.sort(np.array([r.term for r in kept.select("term").collect()], np.int64).view(np.uint64)))
    return out, known.select(F.col("_id").alias("id"), fold_of(F.col("_id")).alias("fold"))


def posteriors(counts: dict[int, int], labellers: list[str], kinds: list[list[str]], rounds: int = 300) -> tuple[dict[int, float], np.ndarray]:
    """P(bad) of each vote pattern, and P(vote | class, the labeller votes) of each labeller (labellers x classes x good and
    bad; class 0 is good, the others are the kinds), by EM. Saying nothing is no evidence for any class. It starts from
    the votes: a pattern is of the kinds whose labellers call it bad, the more the surer. Counts start at one of each vote,
    so that no probability is 0."""
    classes = 1 + len(kinds)
    if not counts:
        return {}, np.full((len(labellers), classes, 2), 1 / 2)
    codes = np.array(sorted(counts))
    n = np.array([counts[c] for c in codes.tolist()], float)
    v = np.stack([codes // 3**k % 3 for k in range(len(labellers))], 1)
    seen = np.stack([(v[:, [labellers.index(x) for x in kind]] == BAD).sum(1) for kind in kinds])
    p = np.concatenate([[0.98 * 0.2 ** seen.sum(0)], 0.02 / len(kinds) + seen])
    p /= p.sum(0)
    votes_are = np.stack([v == x for x in (GOOD, BAD)]).astype(float)  # vote, pattern, labeller
    for _ in range(rounds):
        w = n * p
        share = (w.sum(1) + 1) / (n.sum() + classes)
        table = np.einsum("cp,xpk->kcx", w, votes_are) + 1
        table /= table.sum(2, keepdims=True)
        score = np.log(share)[:, None] + np.einsum("kcx,xpk->cp", np.log(table), votes_are)
        new = np.exp(score - score.max(0))
        new /= new.sum(0)
        done = np.abs(new - p).max() < 1e-6
        p = new
        if done:
            break
    return dict(zip(codes.tolist(), (1 - p[0]).tolist(), strict=True)), table


def _vector(words: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, values): words share a length of 1, each bin has 1, and so has the constant at the end."""
    x = np.ones(len(words) + len(bins) + 1)
    x[: len(words)] = 1 / np.sqrt(max(1, len(words)))
    return np.concatenate([words, bins, [2**BITS]]), x


class Scorer:
    """Logistic FTRL-proximal over hashed features: most weights stay exactly 0."""

    def __init__(self, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.5, l2: float = 0.1):
        self.z, self.n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) > self.l1, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), 0)

    def learn(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] += g * g


def _trainer(quality: dict[int, float], toxic: dict[int, float], terms):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for _, at, raw, n in sorted(_features(batch.column(0), batch.column(1), terms.value), key=operator.itemgetter(0)):
                q, t, bins, insults = votes(raw, n)
                rows.append((_vector(at, _bin_features(bins)), _vector(at, _bin_features(insults, 101)), quality[_code(q)], toxic[_code(t)]))
        a, b = Scorer(), Scorer()
        for _ in range(EPOCHS):
            for x, y, q, t in rows:
                a.learn(*x, q)
                b.learn(*y, t)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64()), *(pa.array([s.weights().astype("<f8").tobytes()], pa.binary()) for s in (a, b))], names=["n", "quality", "toxic"])

    return train


def _scorer(weights, terms):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wq, wt = weights.value
        for batch in batches:
            out = np.zeros((batch.num_rows, 2))
            for row, at, raw, n in _features(batch.column(batch.num_columns - 1), batch.column(batch.num_columns - 2), terms.value):
                _, _, bins, insults = votes(raw, n)
                for k, (w, kind) in enumerate(((wq, _bin_features(bins)), (wt, _bin_features(insults, 101)))):
                    features, x = _vector(at, kind)
                    out[row, k] = w[features] @ x
            p = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(1 - p[:, 0]), pa.array(p[:, 1])], names=[*batch.schema.names[:-2], "quality_score", "toxic_score"])

    return score


def classify(docs: DataFrame, labels: DataFrame | None = None, train_rows: int = TRAIN_ROWS, labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """doc_id, quality_score (P good), toxic_score (P toxic), good, toxic and kept (good and not toxic) of each row of
    docs (doc_id, text; other columns are ignored). labels (doc_id, toxic) gives the labellers "terms" and "dense_terms"
    their terms (see labelled_terms).

    A null text is empty; on a text without words no labeller says anything, and its scores are those of the words and
    measures it lacks. Rows without a doc_id are treated like others and have no label; repeated rows get equal scores,
    and equal texts train once. An empty table gives an empty table. train_rows and labelled_rows bound the training
    samples, not what is counted or scored."""
    spark = docs.sparkSession
    found, folds = labelled_terms(docs, labels, labelled_rows)
    terms = spark.sparkContext.broadcast(found)
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw"))
    if folds is None:
        docs = docs.select("doc_id", F.lit(2).alias("fold"), "raw")
    else:  # the sample's ids, at most about labelled_rows
        docs = docs.join(F.broadcast(folds), F.col("doc_id").cast("long") == F.col("id"), "left").select("doc_id", F.coalesce("fold", F.lit(2)).alias("fold"), "raw")
    voted = docs.select("raw", "fold").mapInArrow(_patterns(terms), "quality int, toxic int")
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("target"), F.col(c).alias("code")) for k, c in enumerate(("quality", "toxic")))))
    counts: list[dict[int, int]] = [{}, {}]
    for r in voted.select(each.alias("v")).groupBy("v.target", "v.code").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.target][r.code] = r.n
    quality, toxic = posteriors(counts[0], QUALITY_LABELLERS, QUALITY_KINDS)[0], posteriors(counts[1], TOXIC_LABELLERS, TOXIC_KINDS)[0]
    total = sum(counts[0].values())
    # distinct texts, drawn by their hash
    drawn = F.xxhash64("raw").cast("double") / 2.0**64 + 0.5
    sample = docs.select("raw", "fold").where(drawn < min(1.0, train_rows / max(1, total)))
    sample = sample.groupBy(drawn.alias("u"), F.octet_length("raw").alias("size")).agg(F.min("fold").alias("fold"), F.first("raw").alias("raw"))
    sample = sample.repartition(SHARDS, F.pmod(F.xxhash64("u", F.lit(1)), F.lit(SHARDS))).sortWithinPartitions("u", "size").select("raw", "fold")
    shards = sample.mapInArrow(_trainer(quality, toxic, terms), "n long, quality binary, toxic binary").collect()
    mean = lambda c: sum(r.n * np.frombuffer(r[c], "<f8") for r in shards) / sum(r.n for r in shards) if shards else np.zeros(2**BITS + 1)
    weights = spark.sparkContext.broadcast((mean("quality"), mean("toxic")))
    out = docs.mapInArrow(_scorer(weights, terms), f"doc_id {doc_type}, quality_score double, toxic_score double")
    out = out.withColumns({"good": F.col("quality_score") >= 0.5, "toxic": F.col("toxic_score") >= 0.5})
    return out.withColumn("kept", F.col("good") & ~F.col("toxic"))
