"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its byte n-grams (3 to 6, with word ends marked) and of
itself, hashed into buckets; a window of words is the average of its words'
averaged bucket vectors; a linear softmax of two classes reads that average.
Vectors and softmax are trained jointly in numpy (Adam), so a misspelling that
was never seen shares n-gram vectors with the words that were.  A text's
logit is that of its most toxic window, as one insult makes a long text toxic: in
training, each toxic text teaches by its currently most toxic window, after
a warm-up on all its windows.  A logistic curve fitted on texts that were kept from
training turns logits into scores.

Training reads a documented, bounded sample of the labelled rows (``SAMPLE``
texts a class, drawn by a hash of the id); scoring reads every whole text.

Defined cases: a null or empty text, or one without words, gets the score
of an average without words (the softmax's bias); without labelled rows of both
classes, every score is the share of toxic rows, or 0.05 without any; several labels of one
document count as toxic if one of them does; rows are scored one by one, so
repeated rows repeat the score; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lunchbox.llm import spans
from lunchbox.llm.ngrams import different, subwords
from lunchbox.llm.runtime import crc_remainder, numbered, released, ship

#: labelled texts of each class that training reads at most (twice that, if the hash is uneven)
SAMPLE = {1: 700, 0: 1_600}
WINDOW, BUCKET_LOG, WIDTH = 2, 18, 4
N_GRAMS = (3, 4, 5, 6)
WARM_STEPS, STEPS, RATE, DECAY = 10, 35, 0.08, 0.1
THRESHOLD = 0.7
#: scores are calibrated as if so many texts were toxic, whatever the sample's share
TOXIC_SHARE = 0.3


@dataclass
class Model:
    """What scoring needs: each bucket's toxic logit, the bias and the calibration."""

    bucket_logit: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -30, 30)))


def logits(texts: pa.Array, model: Model) -> np.ndarray:
    """Logit of the most toxic window of each text."""
    words = spans.Words(texts, spans.LETTERS)
    out = np.full(len(words.count), model.bias)
    if not len(words.doc):
        return out
    first, which = different(words)
    owner, bucket = subwords(words, first, N_GRAMS, BUCKET_LOG)
    per_word = np.bincount(owner, weights=model.bucket_logit[bucket]) / np.bincount(owner)
    total = np.r_[0, np.cumsum(per_word[which])]
    begin = np.arange(len(which))
    end = np.minimum(begin + WINDOW, words.first[1:][words.doc])
    begin = np.maximum(np.minimum(begin, end - WINDOW), words.first[:-1][words.doc])  # the last windows of a text are whole ones
    mean = (total[end] - total[begin]) / (end - begin)
    some = np.flatnonzero(words.count)
    out[some] += np.maximum.reduceat(mean, words.first[some])
    return out


def _words_of(texts: list[str]) -> tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, number of different words, which of them each word is, and their (number, bucket), chunk by chunk."""
    count, hashes, found, owners, buckets = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], np.zeros(0, np.uint64), [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for part in spans.chunks(pa.record_batch([pa.array(texts, pa.large_string())], ["text"])):
        words = spans.Words(part.column("text"), spans.LETTERS)
        count.append(words.count)
        if not len(words.doc):
            continue
        hashes.append(words.hashes())
        own, first = np.unique(hashes[-1], return_index=True)
        fresh = ~np.isin(own, found)
        owner, bucket = subwords(words, first[fresh], N_GRAMS, BUCKET_LOG)
        owners.append(owner + np.int32(len(found)))
        buckets.append(bucket)
        found = np.concatenate([found, own[fresh]])
    order = np.argsort(found)
    place = np.empty(len(found), np.int32)
    place[order] = np.arange(len(found))
    which = np.searchsorted(found[order], np.concatenate(hashes))
    return np.concatenate(count), len(found), which, place[np.concatenate(owners)], np.concatenate(buckets)


def train(texts: list[str], toxic: np.ndarray, seed: int = 7) -> Model:
    """Fit bucket vectors and softmax jointly on a sample of labelled texts."""
    toxic = np.asarray(toxic, bool)
    rate = float(toxic.mean()) if len(toxic) else 0.05
    constant = Model(np.zeros(1 << BUCKET_LOG, np.float32), 0.0, 0.0, float(np.log(max(rate, 1e-3) / max(1 - rate, 1e-3))))
    if not toxic.any() or toxic.all():
        return constant
    rng = np.random.default_rng(seed)
    held = rng.random(len(texts)) < 0.2
    if not (toxic[held].any() and not toxic[held].all() and toxic[~held].any() and not toxic[~held].all()):
        held[:] = False
    fit = np.flatnonzero(~held)
    count, n_words, which, owner, bucket = _words_of([texts[i] for i in fit])
    if not len(which):
        return constant
    label = toxic[fit]
    by_owner = np.argsort(owner, kind="stable")
    owner, bucket = owner[by_owner], bucket[by_owner]
    del by_owner
    n_sub = np.bincount(owner).astype(np.float32)
    sub_at = np.r_[0, np.cumsum(n_sub.astype(np.int64))][:-1]
    used = np.flatnonzero(np.bincount(bucket))
    place = np.zeros(1 << BUCKET_LOG, np.int32)
    place[used] = np.arange(len(used))
    bucket = place[bucket]
    to_bucket = np.argsort(bucket, kind="stable")
    bucket_at = np.searchsorted(bucket[to_bucket], np.arange(len(used)))

    doc = np.repeat(np.arange(len(count)), count)
    number = (np.arange(len(which)) - np.r_[0, np.cumsum(count)][doc]) // WINDOW  # window number in its text
    new = np.r_[True, (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])]
    del number
    window_at, window = np.flatnonzero(new), np.cumsum(new) - 1
    in_window = np.bincount(window).astype(np.float32)
    window_doc = doc[window_at]
    to_word = np.argsort(which, kind="stable")
    word_at = np.searchsorted(which[to_word], np.arange(n_words))
    is_toxic = label[window_doc]

    vectors = rng.normal(0, 0.1, (WIDTH, len(used))).astype(np.float32)  # a row a dimension: sums run along rows
    softmax = rng.normal(0, 0.1, (2, WIDTH)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, softmax, bias)]
    from_word, from_window = owner[to_bucket].astype(np.int32), window[to_word].astype(np.int32)
    which = which.astype(np.int32)
    del doc, new, owner, to_bucket, to_word, window
    released()

    def sums(values, at, first):  # a dimension after the other, which keeps temporary arrays small
        return np.stack([np.add.reduceat(row.take(at), first) for row in values])

    def forward():
        mean = sums(sums(vectors, bucket, sub_at) / n_sub, which, window_at) / in_window
        return mean, softmax @ mean + bias[:, None]

    per_doc = np.bincount(window_doc, minlength=len(label)).astype(np.float32)
    doc_first = np.searchsorted(window_doc, np.flatnonzero(per_doc > 0))
    with_windows = np.flatnonzero(per_doc > 0)
    clean = np.where(~is_toxic, 1.0, 0.0)
    clean *= 0.5 / max(clean.sum(), 1)
    for step in range(1, WARM_STEPS + STEPS + 1):
        mean, z = forward()
        margin = z[1] - z[0]
        if step <= WARM_STEPS:
            picked = np.where(is_toxic, 1 / per_doc[window_doc], 0)
        else:  # the most toxic window of each text; clean texts keep half the weight on all their windows
            top = np.maximum.reduceat(margin, doc_first)
            best = np.zeros(len(label), np.float32)
            best[with_windows] = top
            picked = np.where(is_toxic & (margin >= best[window_doc]), 1.0, 0)
            hard = np.where(~is_toxic & (margin >= best[window_doc]), 1.0, 0)
        mass = clean if step <= WARM_STEPS else clean / 2 + hard * (0.25 / max(hard.sum(), 1e-6))
        weight = mass + picked * (0.5 / max(picked.sum(), 1e-6))
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        g = (weight * (p - is_toxic)).astype(np.float32)
        dz = np.stack([-g, g])
        d_mean = (softmax.T @ dz) / in_window
        d_vectors = sums(sums(d_mean, from_window, word_at) / n_sub, from_word, bucket_at)
        for k, (param, grad) in enumerate(((vectors, d_vectors), (softmax, dz @ mean.T), (bias, dz.sum(1)))):
            m, v = moments[k]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            param -= RATE * DECAY * param * (k == 0)
            param -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)

    table = np.zeros(1 << BUCKET_LOG, np.float32)
    table[used] = (softmax[1] - softmax[0]) @ vectors
    model = Model(table, float(bias[1] - bias[0]), 1.0, 0.0)
    check = np.flatnonzero(held) if held.any() else fit
    model.slope, model.shift = _logistic(logits(pa.array([texts[i] for i in check], pa.large_string()), model), toxic[check])
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve of y over x, by Newton's method; targets are drawn in so that it ends."""
    scale = float(np.std(x)) or 1.0
    x = x / scale
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    weight = np.where(y, TOXIC_SHARE / max(y.sum(), 1), (1 - TOXIC_SHARE) / max((~y).sum(), 1)) * len(y)
    a = np.array([1.0, -float(np.mean(x))])
    rows = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ a, -30, 30)))
        hessian = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 0.05 * np.eye(2)
        step = np.linalg.solve(hessian, rows.T @ (weight * (p - target)) + 0.05 * a * [1, 0])
        a = a - np.clip(step, -2, 2)
    return float(max(a[0], 0) / scale), float(a[1])


def fitted(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1) -> Model:
    """Train on a bounded sample of the labelled rows that aren't held out."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "toxic is not null and doc_id is not null").where(crc_remainder("doc_id", modulus) != held_out)
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    have = {r.toxic: r.n for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20))
    sample = None
    for kind, most in SAMPLE.items():
        share = min(1.0, most / max(1, have.get(kind, 0)))
        part = own.where(F.col("toxic") == kind).where(draw < int(share * (1 << 20)) + (share >= 1)).limit(2 * most)
        sample = part if sample is None else sample.union(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy(F.lit(0).alias("all"))  # at most 2 * SAMPLE texts, in one task
    ship(docs.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        released()  # what earlier tasks of this worker left
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        model = train([t or "" for t in table.column("text").to_pylist()], table.column("toxic").to_numpy() == 1)
        released()
        return pa.table({"table": pa.array([model.bucket_logit.astype("<f4").tobytes()], pa.binary()), "bias": [model.bias],
                         "slope": [model.slope], "shift": [model.shift]})

    fit = rows.applyInArrow(run, "table binary, bias double, slope double, shift double").first()
    if fit is None:
        return train([], np.zeros(0, bool))
    return Model(np.frombuffer(fit["table"], "<f4"), fit.bias, fit.slope, fit["shift"])


def _with_score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of docs as c0, c1, ..., and each row's score."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    frame = numbered(docs)
    columns, kinds = frame.columns, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields)
    text = columns[docs.columns.index("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in spans.chunks(batch, text):
                value = own.score(logits(part.column(text), own))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(value, pa.float64())], [*columns, "score"])

    return frame.mapInArrow(run, f"{kinds}, score double")


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = fitted(docs, labels)
    out = _with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).withColumnRenamed("c0", "doc_id")
    return out.select("doc_id", (crc_remainder("doc_id", 3) == 1).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, all their columns."""
    return _with_score(docs, fitted(docs, labels)).where(F.col("score") < THRESHOLD).drop("score").toDF(*docs.columns)
