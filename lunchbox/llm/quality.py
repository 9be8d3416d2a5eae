"""Quality by compression: zstandard dictionaries of good and of bad text, and which of them a text compresses better with.

Two views of a text are compressed, each with a dictionary of good and one of bad
texts: its bytes, and its outline, in which each word is one byte that says its length
and whether it has small letters (repeated words and odd
punctuation show there in every language).  The saving that the good dictionaries give over the bad ones,
over the square root of the text's length (``saving``), is the normalised difference: sizes
of texts add up over words that differ by chance, whose spread grows with that root.  A
logistic curve of the saving and of the reciprocal root, fitted on labelled texts that are in no dictionary,
turns it into a score; the second term is what a text too short to say much gets.

Dictionaries and curve read a documented, bounded sample of the labelled rows: up to ``SAMPLE``
texts a class, drawn by a hash of the id, one text an id, none over ``MOST_TEXT`` bytes; every third of them is kept
for the curve.  Scoring compresses every whole text.

Defined cases: a null or empty text has saving 0 and the score that the curve gives for no
length; without labelled rows of both classes, every score is the share of good rows, or 0.5 without
any; several labels of one document count as bad if one of them does, several texts of one id as its
least; labels without an id or a value aren't read; rows are scored one by one, so repeated rows
repeat the score; further columns, whatever their names, don't matter to ``scores`` and pass through ``with_quality``; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from lunchbox.llm import spans
from lunchbox.llm.runtime import crc_remainder, numbered, ship

#: labelled texts of each class that dictionaries and curve read at most, and the greatest size of each in bytes
SAMPLE, MOST_TEXT = 800, 1 << 16
#: bytes of a dictionary, zstandard's level, and every how many-th text is kept for the curve
DICTIONARY, LEVEL, KEPT = 300_000, 9, 3
THRESHOLD = 0.3
#: added to a text's length
LENGTH = 50

_SMALL, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_SMALL[97:123] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def outlines(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts (bytes and offsets) with one byte for each word: its length up to 26, as a small letter if it has one."""
    letter = _LETTER[raw]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    begin = at[:-1][at[:-1] < len(raw)]
    first[begin] = letter[begin]
    start = np.flatnonzero(first)
    rest = np.r_[0, np.cumsum(letter)]
    end = np.r_[start[1:], len(raw)]
    length = rest[end] - rest[start]  # letters up to the next word's start are this word's
    small = np.r_[0, np.cumsum(_SMALL[raw])]
    out = raw.copy()
    out[start] = np.where(small[end] > small[start], 96, 64) + np.minimum(length, 26)
    stays = ~letter | first
    return out[stays], np.r_[0, np.cumsum(stays)][at]


def views(texts: pa.Array) -> Iterator[tuple[bytes, bytes]]:
    """Bytes and outline of each text."""
    raw, at = spans.flat(texts)
    short, short_at = outlines(raw, at)
    for i in range(len(at) - 1):
        yield raw[at[i]:at[i + 1]].tobytes(), short[short_at[i]:short_at[i + 1]].tobytes()


@dataclass
class Model:
    """The dictionaries, (view, good or bad), and the curve: of the saving, of the reciprocal root, and a constant."""

    dictionaries: list[list[bytes]] | None
    curve: np.ndarray

    def __post_init__(self):
        self._compressors = None

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "curve": self.curve, "_compressors": None}

    def savings(self, texts: pa.Array) -> np.ndarray:
        """(saving, reciprocal root) of each text."""
        if self._compressors is None:
            self._compressors = [[_compressor(d) for d in pair] for pair in self.dictionaries]
        out = np.empty((len(texts), 2))
        for i, both in enumerate(views(texts)):
            saved = sum(len(bad.compress(v)) - len(good.compress(v)) for v, (good, bad) in zip(both, self._compressors) if v)
            root = (len(both[0]) + LENGTH) ** -0.5
            out[i] = saved * root, root
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.dictionaries is None:
            z = np.full(len(texts), self.curve[2])
        else:
            z = np.c_[self.savings(texts), np.ones(len(texts))] @ self.curve
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    own = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    own.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False)


def _dictionary(parts: list[bytes]) -> bytes:
    """Whole parts, one a line, as long as they fit; the last ones are what zstandard finds most cheaply."""
    out, size = [], 0
    for part in parts:
        if part and size + len(part) < DICTIONARY:
            out.append(part)
            size += len(part) + 1
    return b"\n".join(out)


def train(texts: list[str], good: np.ndarray) -> Model:
    """Dictionaries and curve of labelled texts, in their order."""
    good = np.asarray(good, bool)
    share = (good.sum() + 0.5) / (len(good) + 1)
    constant = Model(None, np.array([0, 0, float(np.log(share / (1 - share)))]))
    if good.all() or not good.any():
        return constant
    number = np.where(good, np.cumsum(good), np.cumsum(~good))  # number in its class
    kept = number % KEPT == 0
    if not (good[kept].any() and not good[kept].all()):
        return constant
    pairs = list(views(pa.array(texts, pa.large_string())))
    dictionaries = [[_dictionary([pairs[i][view] for i in np.flatnonzero(~kept & (good == kind))]) for kind in (True, False)] for view in (0, 1)]
    if not all(d for pair in dictionaries for d in pair):
        return constant
    model = Model(dictionaries, np.zeros(3))
    x = model.savings(pa.array([texts[i] for i in np.flatnonzero(kept)], pa.large_string()))
    model.curve = _curve(x, good[kept])
    return model


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic curve of y over x by Newton's method, with a small ridge."""
    scale = np.maximum(np.abs(x).max(0), 1e-9)
    rows = np.c_[x / scale, np.ones(len(x))]
    a, ridge = np.zeros(3), np.diag([1e-2, 1e-2, 1e-4])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(rows @ a, -30, 30)))
        hessian = (rows * (p * (1 - p) + 1e-6)[:, None]).T @ rows + ridge
        a = a - np.clip(np.linalg.solve(hessian, rows.T @ (p - y) + ridge @ a), -4, 4)
    a[0] = max(a[0], 0)
    return a / np.r_[scale, 1]


def fitted(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0) -> Model:
    """Train on a bounded sample of the labelled rows that aren't held out."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        "quality is not null and doc_id is not null").where(crc_remainder("doc_id", modulus) != held_out)
    own = own.groupBy("doc_id").agg(F.min(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"))
    have = {r.good: r.n for r in own.groupBy("good").agg(F.count("*").alias("n")).collect()}  # two rows
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20))
    sample = None
    for kind in (0, 1):
        share = min(1.0, SAMPLE / max(1, have.get(kind, 0)))
        part = own.where(F.col("good") == kind).where(draw < int(share * (1 << 20)) + (share >= 1)).limit(2 * SAMPLE)
        sample = part if sample is None else sample.union(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.octet_length("text") <= MOST_TEXT)
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "good").agg(F.min("text").alias("text"))
    rows = rows.groupBy(F.lit(0).alias("all"))  # at most 4 * SAMPLE texts of MOST_TEXT bytes, in one task
    ship(docs.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(spans.mix(table.column("doc_id").to_numpy().astype(np.int64).view(np.uint64)), kind="stable")
        table = table.take(order)
        model = train(table.column("text").to_pylist(), table.column("good").to_numpy() == 1)
        flat = [d for pair in model.dictionaries or [] for d in pair]
        return pa.table({"dictionaries": pa.array([flat], pa.list_(pa.binary())), "curve": pa.array([model.curve.tolist()], pa.list_(pa.float64()))})

    fit = rows.applyInArrow(run, "dictionaries array<binary>, curve array<double>").first()
    if fit is None:
        return train([], np.zeros(0, bool))
    flat = [bytes(d) for d in fit.dictionaries]
    return Model([flat[:2], flat[2:]] if flat else None, np.array(fit.curve))


def with_quality(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of docs as c0, c1, ..., and each row's ``score``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    frame = numbered(docs)
    columns, kinds = frame.columns, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields)
    text = columns[docs.columns.index("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in spans.chunks(batch, text):
                value = own.scores(part.column(text))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(value, pa.float64())], [*columns, "score"])

    return frame.mapInArrow(run, f"{kinds}, score double")


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = with_quality(rows, fitted(docs, labels)).withColumnRenamed("c0", "doc_id")
    return out.select("doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, all their columns."""
    return with_quality(docs, fitted(docs, labels)).where(F.col("score") >= THRESHOLD).drop("score").toDF(*docs.columns)
