"""Toxicity: class-conditional Kneser-Ney bigram models, compared by length-normalised log-likelihood.

Three levels. ``P_c(w | h)`` discounts the class's bigram counts, of every known word before, and backs off to
what both classes share of the bigram, leant as the word itself leans: a pair that one class has not met weighs as
far as the other has more of it than both together. The class's word probabilities discount its word counts and
back off to probabilities shared by both classes: the number of contexts a word was met in, so that a rare
expression tells the classes apart only as far as it was met in different places. The likelihood ratio is averaged
over windows of a few dozen words (over the text, if it is shorter) and the largest average counts: a few toxic
sentences in a long document are not diluted. A logistic curve, fitted on labelled documents that the counts have
not seen, turns it into a score.

Counts are taken over all labelled training rows, and no table has a fixed size: the driver and the workers hold
12 bytes for each known word and 12 for each pair that weighs otherwise than its words do, which grows with the
labelled text. Only the rows that the curve is fitted on are bounded (``most_calibration``).
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedweave.llm.prefilter import maybe_in
from feedweave.llm.text import PUNCTUATION, chunks, mix, utf8, word_hashes
from feedweave.session import drop_folder, fresh_dir, shuffles_released, stage

LEAST_COUNT = 4
LEAST_CONTEXTS = 4
#: Taken off counts of 0, 1, 2, and 3 or more, whatever the size of the input: the bounds of modified Kneser-Ney, as
#: what a few texts repeat says little about a class.
DISCOUNTS = np.array([0, 1, 2, 3])
#: Ratios up to the first weigh nothing; no word weighs more than the second.
DEAD_BAND, MOST_RATIO = 1.5, 6.0
#: Log-odds of a text that nothing is known of: with no labels one toxic text is expected for three others.
UNINFORMED = float(np.log(0.5 / 1.5))
#: Marks the hash of a word before that is not a known one; a known one has its number.
UNKNOWN = np.uint64(1 << 31)


@dataclass
class Model:
    """Sorted tables of word and pair hashes with log-likelihood ratios, toxic to ordinary."""

    words: np.ndarray
    word_ratio: np.ndarray  # words + 1; the last is any other word
    pairs: np.ndarray
    pair_weight: np.ndarray  # of pairs that weigh otherwise than their words do
    window: int
    slope: float = 1.0
    offset: float = 0.0

    def weights(self, words: np.ndarray, before: np.ndarray) -> np.ndarray:
        """What each word says, given the one before it in its text."""
        w = find(self.words, words)
        h = np.roll(w, 1)
        h[before[:-1][before[:-1] < len(w)]] = len(self.words)
        out = weight(self.word_ratio[w])
        at = find(self.pairs, pair_keys(h, w))
        known = at < len(self.pairs)
        out[known] = self.pair_weight[at[known]]
        return out

    def evidence(self, words: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Largest mean ratio over a window of each text; 0 for a text without words."""
        total = np.concatenate([[0.0], np.cumsum(self.weights(words, before), dtype=np.float64)]) if len(words) else np.zeros(1)
        lengths = np.diff(before)
        counts = np.maximum(lengths - self.window, 0) + (lengths > 0)
        first = np.concatenate([[0], np.cumsum(counts)])
        doc = np.repeat(np.arange(len(lengths)), counts)
        start = before[:-1][doc] + np.arange(first[-1]) - first[:-1][doc]
        size = np.minimum(lengths, self.window)[doc]
        means = (total[start + size] - total[start]) / np.maximum(size, self.window // 4)
        out = np.zeros(len(lengths))
        some = counts > 0
        if some.any():
            out[some] = np.maximum.reduceat(means, first[:-1][some])
        return out


def weight(ratio: np.ndarray) -> np.ndarray:
    return np.sign(ratio) * np.clip(np.abs(ratio) - DEAD_BAND, 0, MOST_RATIO - DEAD_BAND)


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted table; its length for those that are not there."""
    at = np.searchsorted(table, keys)
    if not len(table):
        return at
    return np.where(table[np.minimum(at, len(table) - 1)] == keys, at, len(table))


def pair_keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (h.astype(np.uint64) << np.uint64(32)) | w.astype(np.uint64)


def _texts(batch: pa.RecordBatch, text: int):
    """Words of a batch, a few rows at a time: (first row, last row, words, words before each text)."""
    data, bounds = utf8(batch.column(text))
    for a, b in chunks(bounds):
        yield a, b, *word_hashes(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], PUNCTUATION)


def _word_counts(rows: DataFrame) -> DataFrame:
    """(word, toxic count, ordinary count, marks of the contexts it was met in), summed where the texts are."""

    def run(batches):
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for a, b, words, before in _texts(batch, 0):
                if not len(words):
                    continue
                label = np.repeat(toxic[a:b], np.diff(before))
                left = np.roll(words, 1)
                left[before[:-1][before[:-1] < len(words)]] = 1
                mark = np.uint64(1) << (mix(left) & np.uint64(63))
                order = np.argsort(words)
                sorted_words = words[order]
                first = np.flatnonzero(np.concatenate([[True], sorted_words[1:] != sorted_words[:-1]]))
                t = np.add.reduceat(label[order].astype(np.int64), first)
                n = np.diff(first, append=len(words))
                marks = np.bitwise_or.reduceat(mark[order], first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sorted_words[first].view(np.int64)), pa.array(t), pa.array(n - t),
                     pa.array(marks.view(np.int64))], names=["word", "t", "o", "marks"])

    counted = rows.select("text", "toxic").mapInArrow(run, "word long, t long, o long, marks long")
    return counted.groupBy("word").agg(
        F.sum("t").alias("t"), F.sum("o").alias("o"), F.bit_count(F.bit_or("marks")).alias("contexts"))


def _pair_counts(rows: DataFrame, words) -> DataFrame:
    """(the word before: its number or a marked hash, number of the known word, both counts); ``words`` is broadcast."""

    def run(batches):
        table = words.value
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for a, b, found, before in _texts(batch, 0):
                number = find(table, found)
                left = np.where(number < len(table), number.astype(np.uint64), mix(found) >> np.uint64(33) | UNKNOWN)
                left = np.roll(left, 1)
                left[before[:-1][before[:-1] < len(found)]] = UNKNOWN
                known = np.flatnonzero(number < len(table))
                label = np.repeat(toxic[a:b], np.diff(before))[known].astype(np.int64)
                pair = pair_keys(left[known], number[known])
                pair, which = np.unique(pair, return_inverse=True)
                t = np.bincount(which, weights=label, minlength=len(pair)).astype(np.int64)
                n = np.bincount(which, minlength=len(pair))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair.view(np.int64)), pa.array(t), pa.array(n - t)], names=["pair", "t", "o"])

    counted = rows.select("text", "toxic").mapInArrow(run, "pair long, t long, o long")
    counted = counted.groupBy("pair").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    return counted.select(F.shiftrightunsigned("pair", 32).alias("h"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("w"), "t", "o")


def _held(n: np.ndarray) -> np.ndarray:
    """What discounts leave of counts."""
    return n - DISCOUNTS[np.minimum(n, 3).astype(int)]


def _word_model(met: pa.Table, size: int) -> np.ndarray:
    """Probabilities of words in each class: 2 x (words + 1). Any other word is as likely in one as in the other."""
    n = np.zeros((2, size))
    for c, column in enumerate(("t", "o")):
        n[c, met.column("w").to_numpy()] = met.column(column).to_numpy()
    out = np.ones((2, size + 1))
    seen = n.sum(axis=1)
    if seen.min() > 0:
        share = n.sum(axis=0) / seen.sum()
        for c in range(2):
            held = _held(n[c]) / seen[c]
            out[c, :-1] = np.maximum(held + (1 - held.sum()) * share, 1e-300)
    return out


def _contexts(pair_counts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Words after each known word, and the share that it leaves to the words alone: 2 x (words + 1) each."""
    parts = [x for c in "to" for x in (F.sum(c), F.count_if(F.col(c) == 1), F.count_if(F.col(c) == 2), F.count_if(F.col(c) > 2))]
    rows = pair_counts.groupBy("h").agg(*[x.alias(f"x{i}") for i, x in enumerate(parts)]).toArrow()
    h = rows.column("h").to_numpy()
    totals, backoff = np.zeros((2, size + 1)), np.ones((2, size + 1))
    for c in range(2):
        total, *kinds = (rows.column(f"x{4 * c + i}").to_numpy() for i in range(4))
        totals[c, h] = total
        off = sum(d * k for d, k in zip(DISCOUNTS[1:], kinds))
        backoff[c, h] = np.where(total > 0, off / np.maximum(total, 1), 1)
    return totals, backoff


def _pair_weights(pair_counts: DataFrame, shared) -> DataFrame:
    """(pair, weight) of the pairs that weigh otherwise than their words do; ``shared`` is broadcast."""

    def run(batches):
        word_p, totals, backoff = shared.value
        for batch in batches:
            h, w, *n = (batch.column(i).to_numpy() for i in range(4))
            plain = np.log(word_p[0, w] / word_p[1, w])
            shared_p = (n[0] + n[1]) / (totals[0, h] + totals[1, h])
            # A pair that the discounts leave nothing of in either class weighs as its word does.
            held = [_held(n[c]) / np.maximum(totals[c, h], 1) for c in range(2)]
            p = [held[c] + backoff[c, h] * shared_p * np.exp((0.5 - c) * plain) for c in range(2)]
            own = weight(np.where(held[0] + held[1] > 0, np.log(p[0] / p[1]), plain))
            plain = weight(plain)
            other = np.flatnonzero(np.abs(own - plain) > 1e-3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair_keys(h[other], w[other]).view(np.int64)), pa.array(own[other].astype(np.float32))],
                names=["pair", "weight"])

    return pair_counts.select("h", "w", "t", "o").mapInArrow(run, "pair long, weight float")


def train(labelled: DataFrame, most_calibration: int = 20_000, window: int = 48) -> Model:
    """Learn from rows of ``text`` and ``toxic`` (0/1; rows where either is null are left out).

    Rows are parted by a hash of their text: four of five are counted, the fifth calibrates. Without both
    labels in the fifth the ratio itself gives the score, with the share of toxic labels if that is low: where nothing
    is known a score lies below a half. Rows that repeat a text and rows that share an id count each for itself.
    """
    with shuffles_released(labelled.sparkSession):
        return _train(labelled, most_calibration, window)


def _train(labelled: DataFrame, most_calibration: int, window: int) -> Model:
    spark = labelled.sparkSession
    folder = fresh_dir(spark, "toxicity")
    rows = labelled.filter("text IS NOT NULL AND toxic IS NOT NULL").select("text", F.col("toxic").cast("int").alias("toxic"))
    rows = stage(rows, "labelled", folder)
    part = F.pmod(F.xxhash64("text"), F.lit(5))
    sample = stage(_sample(rows.filter(part == 0), most_calibration), "sample", folder)
    bad, every = rows.agg(F.count_if(F.col("toxic") > 0), F.count("*")).first()
    counted = rows.filter(part != 0)
    kept = _word_counts(counted).filter(
        (F.col("t") + F.col("o") >= LEAST_COUNT) & (F.col("contexts") >= LEAST_CONTEXTS))
    words = np.sort(kept.select("word").toArrow().column("word").to_numpy().view(np.uint64))
    with _held_by_workers(spark, words) as shared:
        pair_counts = stage(_pair_counts(counted, shared), "pairs", folder)
    drop_folder(spark, f"{folder}/labelled")

    # Words of each class: in how many contexts each was met, discounted, and backed off to what both classes
    # share of them. Copies of a text add no contexts.
    met = pair_counts.groupBy("w").agg(F.count_if(F.col("t") > 0).alias("t"), F.count_if(F.col("o") > 0).alias("o")).toArrow()
    word_p = _word_model(met, len(words))

    # Pairs of a known word before, met by either class.
    following = pair_counts.filter(F.col("h") < int(UNKNOWN))
    totals, backoff = _contexts(following, len(words))
    if totals.sum(axis=1).min() > 0:
        with _held_by_workers(spark, (word_p, totals, backoff)) as shared:
            found = _pair_weights(following, shared).toArrow()
    else:
        found = pa.table({"pair": pa.array([], pa.int64()), "weight": pa.array([], pa.float32())})
    drop_folder(spark, f"{folder}/pairs")
    pairs = found.column("pair").to_numpy().view(np.uint64)
    order = np.argsort(pairs)
    word_ratio = np.log(word_p[0] / word_p[1]).astype(np.float32)
    model = Model(words, word_ratio, pairs[order], found.column("weight").to_numpy()[order], window)

    with _held_by_workers(spark, model) as shared:
        found = _evidence(sample, shared, ["toxic int"]).toArrow()
    drop_folder(spark, folder)
    evidence, toxic = (found.column(c).to_numpy() for c in ("evidence", "toxic"))
    if len(toxic) and toxic.min() < toxic.max():
        model.slope, model.offset = _logistic(evidence, toxic)
    else:
        model.offset = min(float(np.log((bad + 0.5) / (every - bad + 1.5))), UNINFORMED)
    return model


def _sample(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows by a hash of their text. Hashes alone are gathered to find the last one; no text is moved but copies of it."""
    rows = rows.withColumn("_mark", F.xxhash64("text", F.lit(1)))
    first = rows.select("_mark").orderBy("_mark").limit(most)
    last = first.groupBy("_mark").count().orderBy(F.desc("_mark")).first()
    if last is None:
        return rows.drop("_mark").limit(0)
    tied = rows.filter(F.col("_mark") == last["_mark"]).limit(last["count"])
    return rows.filter(F.col("_mark") < last["_mark"]).unionByName(tied).drop("_mark")


@contextmanager
def _held_by_workers(spark, value):
    """A broadcast of ``value`` that is given up again when what reads it has been done."""
    shared = spark.sparkContext.broadcast(value)
    try:
        yield shared
    finally:
        shared.destroy()


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset by Newton's method with a small ridge; rising."""
    centre, scale = x.mean(), x.std() or 1.0
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    b, ridge = np.zeros(2), np.array([1e-2, 1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(hessian, z.T @ (y - p) - ridge * b)
        b += np.clip(step, -2, 2)
    slope = max(b[0], 1e-3)
    return slope / scale, b[1] - slope * centre / scale


def _evidence(rows: DataFrame, model, keep: list[str]) -> DataFrame:
    """``keep`` (names with types) and the evidence of each row's text, null as empty."""
    names = [k.split(" ")[0] for k in keep]

    def run(batches):
        for batch in batches:
            for a, b, words, before in _texts(batch, len(names)):
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns[: len(names)]),
                     pa.array(model.value.evidence(words, before))], names=[*names, "evidence"])

    return rows.select(*names, F.col("text").cast("string")).mapInArrow(run, ", ".join([*keep, "evidence double"]))


def score_rows(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1); a null text is scored as an empty one, a column of that name is replaced.

    Each row is scored by its text alone: equal texts have equal scores, whatever their ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c != "score"]

    @F.pandas_udf("double")
    def evidence(texts: pd.Series) -> pd.Series:
        parts = [shared.value.evidence(words, before)
                 for _, _, words, before in _texts(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"]), 0)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    found = docs.select(*[F.col(f"`{c}`") for c in names], evidence(F.col("text").cast("string")).alias("score"))
    return found.withColumn("score", 1 / (1 + F.exp(-(F.col("score") * float(model.slope) + float(model.offset)))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    return score_rows(docs.select(F.col("doc_id").cast("long"), "text"), model).select("doc_id", "score")


def held_out(doc_id) -> F.Column:
    """Documents that nothing is learnt from: CRC-32 of the id as text divisible by 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text`` and ``toxic`` of the labelled documents that are not held out; a document with several labels comes with each.

    Labels grow with the documents, so the join deals both out by id at any size and no executor holds one side.
    """
    known = labels.select("doc_id", "toxic").filter(~held_out("doc_id") & F.col("toxic").isNotNull())
    likely = maybe_in(docs.select("doc_id", "text"), "doc_id", known.select("doc_id"))
    return likely.join(known.hint("merge"), "doc_id").select("text", "toxic")


def train_on(docs: DataFrame, labels: DataFrame, **bounds) -> Model:
    """Train on the rows of ``labelled``."""
    return train(labelled(docs, labels), **bounds)
