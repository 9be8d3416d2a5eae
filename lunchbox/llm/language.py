"""Language identification with error-correcting output codes.

Every language gets a codeword; for each bit of the codewords a binary n-gram
classifier tells the languages with a one there from those with a zero.  The
classifiers' weights are log ratios of hashed n-gram frequencies, counted per
language over all training documents in one pass (each task sums its own
counts; sums of segments are merged by Spark).  A text's evidence for a bit is the sum of its
n-grams' weights over the root of their number.  Decoding is weighted by loss: a
language's loss is the sum over bits of exp(-(bit as +-1) * evidence), the least loss
wins, and a text whose two least losses are close is flagged as ambiguous.

Defined cases: null text, and a text without a letter, is ``und`` with score 0
and ambiguous; without training documents every language is ``und``; with one
language, it is predicted for all others; a null lang never trains; rows are
judged one by one, so repeated rows repeat the result; empty tables give
empty results; further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lunchbox.llm import spans
from lunchbox.llm.ngrams import different, subwords
from lunchbox.llm.runtime import crc_remainder, ship

N_GRAMS, BUCKET_LOG, SEGMENT_LOG = (1, 2, 3, 4), 15, 12
CLIP = 6.0
#: the second language must be less likely than this
AMBIGUOUS = 0.2
UNKNOWN = "und"


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """A row of +-1 for each of n languages: all splits for up to 6, else random ones that are far apart."""
    if n <= 6:
        splits = [[1 if i == 0 or (k >> (i - 1)) & 1 else -1 for i in range(n)] for k in range(2 ** max(n - 1, 0) - 1)]
        return np.array(splits, np.float64).reshape(len(splits), n).T
    rng, best, best_distance = np.random.default_rng(seed), None, -1
    width = int(np.ceil(10 * np.log2(n)))
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, width))
        code[:, np.abs(code.sum(0)) == n] *= np.where(np.arange(n) == 0, -1, 1)[:, None]
        distance = ((width - code @ code.T) / 2 + width * np.eye(n)).min()
        if distance > best_distance:
            best, best_distance = code, distance
    return best


def n_gram_counts(docs: DataFrame) -> dict[str, np.ndarray]:
    """Bucket counts of each language over all rows (text, lang): languages times 2**BUCKET_LOG numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in spans.chunks(batch):
                words = spans.Words(part.column("text"), spans.LETTERS)
                if not len(words.doc):
                    continue
                langs = part.column("lang").dictionary_encode()
                code = langs.indices.to_numpy()[words.doc]
                first, which = different(words)
                owner, bucket = subwords(words, first, N_GRAMS, BUCKET_LOG)
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    times = np.bincount(which[code == k], minlength=len(first))
                    own = sums.setdefault(lang, np.zeros(1 << BUCKET_LOG))
                    own += np.bincount(bucket, weights=times[owner], minlength=1 << BUCKET_LOG)
        rows = [(lang, s, x.astype(np.int64).tobytes()) for lang, own in sums.items() for s, x in enumerate(own.reshape(-1, 1 << SEGMENT_LOG))]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.binary()))],
                                         ["lang", "segment", "counts"])

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SEGMENT_LOG, np.int64)
        for batch in batches:
            for x in batch.column("counts"):
                total += np.frombuffer(x.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["lang", "segment", "counts"])

    schema = "lang string, segment int, counts binary"
    out: dict[str, np.ndarray] = {}
    for row in docs.mapInArrow(count, schema).groupBy("lang", "segment").applyInArrow(merge, schema).toLocalIterator():
        out.setdefault(row.lang, np.zeros(1 << BUCKET_LOG, np.int64))[row.segment << SEGMENT_LOG:(row.segment + 1) << SEGMENT_LOG] = np.frombuffer(row.counts, np.int64)
    return out


class Model:
    """Languages, their codewords, and for each bit the weights of all buckets."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        self.code = codewords(len(self.languages))
        freq = np.array([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * len(counts[x])) for x in self.languages])
        self.weights = np.array([np.log(freq[bit > 0].mean(0) / freq[bit < 0].mean(0)) for bit in self.code.T], np.float32)

    def judge(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        words = spans.Words(texts, spans.LETTERS)
        langs, score, doubt = [UNKNOWN] * len(words.count), np.zeros(len(words.count)), np.ones(len(words.count), bool)
        # bytes of a word are letters, or parts of any other characters: only texts with a letter have a language
        some = np.array([i for i in np.flatnonzero(words.count) if any(map(str.isalpha, texts[i].as_py()))], np.int64)
        if not len(some) or not self.languages:
            return langs, score, doubt
        first, which = different(words)
        owner, bucket = subwords(words, first, N_GRAMS, BUCKET_LOG)
        per_doc = np.flatnonzero(words.count)
        place = np.searchsorted(per_doc, some)
        grams = np.add.reduceat(np.bincount(owner)[which], words.first[per_doc])[place]
        loss = np.zeros((len(some), len(self.languages)))
        for bit, weight in zip(self.code.T, self.weights):
            total = np.add.reduceat(np.bincount(owner, weights=weight[bucket])[which], words.first[per_doc])[place]
            evidence = np.clip(total / np.sqrt(grams), -CLIP, CLIP)
            loss += np.exp(-evidence[:, None] * bit)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        second = np.sort(p, 1)[:, -2] if p.shape[1] > 1 else np.zeros(len(p))
        for i, k in zip(some, best):
            langs[i] = self.languages[k]
        score[some], doubt[some] = p.max(1), second >= AMBIGUOUS
        return langs, score, doubt


def predicted(docs: DataFrame, modulus: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every row; held-out rows don't train."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    training = rows.where(F.coalesce(crc_remainder("doc_id", modulus) != held_out, F.lit(False))).where("lang is not null and text is not null")
    model = spark.sparkContext.broadcast(Model(n_gram_counts(training.select("text", "lang"))))  # languages times 2**BUCKET_LOG

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in spans.chunks(batch):
                langs, score, doubt = model.value.judge(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(score), pa.array(doubt)],
                                                 ["doc_id", "lang_pred", "score", "ambiguous"])

    out = rows.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")
    return out.select("doc_id", (crc_remainder("doc_id", modulus) == held_out).alias("held_out"), "lang_pred", "score", "ambiguous")
