"""Document fingerprints by a homomorphic multiset hash of paragraphs.

A paragraph (what stands between line feeds) is hashed to a wide vector, and a
document's fingerprint is the sum of its paragraphs' vectors: ``EXACT`` lanes
modulo 2**64 drawn from the paragraph's hash, and ``SKETCH`` lanes, also modulo 2**64, in which the
paragraph's runs of 12 bytes (3 in short paragraphs) count up or down.  So the order of paragraphs doesn't
matter, equal multisets have equal fingerprints, and a paragraph is inserted or
deleted by adding or subtracting its vector (``inserted``, ``deleted``).  The
likeness of two fingerprints is the cosine of their sketch lanes, 0 to 1, and 1
for equal ones.

``edited_pairs`` compares each document with an edited copy of itself and with
the next document by descending doc_id.  Documents are dealt out by ranges of
(doc_id, text hash) and sorted within; the first document of each range is sent along to
the range before it, so that each text is shuffled once and no task sees more than its range.

Defined cases: null text is empty; an empty text is the empty multiset, whose likeness to
another empty one is 1 and to any other 0; a null doc_id comes last; rows of equal doc_id
follow each other by a hash of their text; a single document is its own next one; an
empty table gives an empty result; further columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lunchbox.llm import spans
from lunchbox.llm.runtime import ship

EXACT, SKETCH_LOG = 16, 7
LONG, SHORT, SMALL = 12, 3, 32
SKETCH = 1 << SKETCH_LOG
MOST_RANGES = 4096
_U = np.uint64
_BYTE = spans.mix(np.arange(1, 257, dtype=np.uint64))
_LANE = spans.mix(np.arange(1, EXACT + 1, dtype=np.uint64))


class Fingerprints:
    """Fingerprints of many texts: exact lanes (n, EXACT) and sketch lanes (n, SKETCH)."""

    def __init__(self, exact: np.ndarray, sketch: np.ndarray):
        self.exact, self.sketch = exact, sketch

    def take(self, at) -> Fingerprints:
        return Fingerprints(self.exact[at], self.sketch[at])

    def strings(self) -> list[str]:
        return [a.astype("<u8").tobytes().hex() + b.astype("<i8").tobytes().hex() for a, b in zip(self.exact, self.sketch)]

    def likeness(self, other: Fingerprints) -> np.ndarray:
        x, y = self.sketch.astype(np.float64), other.sketch.astype(np.float64)
        size = np.sqrt((x * x).sum(1) * (y * y).sum(1))
        cosine = np.divide((x * y).sum(1), size, out=np.zeros(len(x)), where=size > 0)
        same = (self.exact == other.exact).all(1) & (self.sketch == other.sketch).all(1)
        return np.where(same, 1.0, np.clip(cosine, 0, 1))


def of_texts(texts: pa.Array) -> Fingerprints:
    raw, at = spans.flat(texts)
    n = len(at) - 1
    exact, sketch = np.zeros((n, EXACT), np.uint64), np.zeros((n, SKETCH), np.int64)
    filled = np.flatnonzero(np.diff(at))
    if not len(filled):
        return Fingerprints(exact, sketch)
    feeds = np.flatnonzero(raw == 10)
    start = np.sort(np.r_[at[filled], feeds + 1])
    end = np.sort(np.r_[at[filled + 1], feeds])
    # an empty last paragraph begins where the next text does: count line feeds, not places
    per_text = np.searchsorted(feeds, at[1:]) - np.searchsorted(feeds, at[:-1]) + 1
    owner = np.repeat(filled, per_text[filled])
    order = np.r_[0, np.cumsum(per_text[filled])][:-1]
    values = spans.span_hashes(raw, start, end)
    with np.errstate(over="ignore"):
        for k in range(EXACT):
            exact[filled, k] = np.add.reduceat(spans.mix(values + _LANE[k]), order)
    # byte windows inside paragraphs: LONG bytes, or SHORT in paragraphs below SMALL bytes
    cuts = spans.distinct(np.r_[feeds, at[1:]])
    width = np.diff(np.r_[0, cuts])
    cut, width = cuts[width > 0], width[width > 0]
    limit, small = np.repeat(cut, width), np.repeat(width < SMALL, width)
    bytes_, here = _BYTE[raw], np.arange(len(raw))
    text = np.repeat(np.arange(n), np.diff(at))
    marks, docs = [values], [owner]
    for length, chosen in ((LONG, ~small), (SHORT, small)):
        found = spans.window_hashes(bytes_, length)
        own = np.flatnonzero((chosen & (raw != 10) & (here + length <= limit))[:len(found)])
        marks.append(found[own])
        docs.append(text[own])
    mark, doc = np.concatenate(marks), np.concatenate(docs)
    lane = doc * SKETCH + (mark >> _U(64 - SKETCH_LOG)).astype(np.int64)
    sign = 1.0 - 2.0 * (mark & _U(1)).astype(np.float64)
    sums = np.bincount(lane, weights=sign, minlength=n * SKETCH).astype(np.int64)
    return Fingerprints(exact, sums.reshape(n, SKETCH))


def inserted(prints: Fingerprints, paragraphs: Fingerprints) -> Fingerprints:
    """Fingerprints after the insertion of a paragraph into each."""
    with np.errstate(over="ignore"):
        return Fingerprints(prints.exact + paragraphs.exact, prints.sketch + paragraphs.sketch)


def deleted(prints: Fingerprints, paragraphs: Fingerprints) -> Fingerprints:
    """Fingerprints after the deletion of a paragraph from each."""
    with np.errstate(over="ignore"):
        return Fingerprints(prints.exact - paragraphs.exact, prints.sketch - paragraphs.sketch)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in spans.chunks(batch):
                texts = part.column("text").fill_null("")
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(t) for t in texts.to_pylist()], pa.int64()),
                                                  pa.array(of_texts(texts).strings())], ["doc_id", "n_chars", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


FIRST = -(1 << 63)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows dealt by ranges, sorted by (range, edge, descending place); the edge row of a range is the document after it."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    place = rows.withColumn("order", F.coalesce("doc_id", F.lit(FIRST))).withColumn("tie", F.xxhash64("text"))
    ranges = min(MOST_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def greatest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            own = max(zip(batch.column("order").to_pylist(), batch.column("tie").to_pylist()), default=None)
            best = own if best is None or own is not None and own > best else best
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([best[0]], pa.int64()), pa.array([best[1]], pa.int64())], ["order", "tie"])

    spread = place.select("order", "tie").repartitionByRange(ranges, F.desc("order"), F.desc("tie"))
    heads = sorted({(r.order, r.tie) for r in spread.mapInArrow(greatest, "order long, tie long").collect()}, reverse=True)  # MOST_RANGES rows
    known = spark.createDataFrame([(o, t, (k or len(heads)) - 1) for k, (o, t) in enumerate(heads)], "order long, tie long, part int")
    bounds = F.array(*(F.struct(F.lit(o).cast("long").alias("order"), F.lit(t).cast("long").alias("tie")) for o, t in heads)) if heads else F.array()
    own = place.withColumn("part", F.size(F.filter(bounds, lambda b: b >= F.struct("order", "tie"))) - 1 if heads else F.lit(0))
    edge = place.join(F.broadcast(known), ["order", "tie"]).dropDuplicates(["order", "tie"])
    both = own.withColumn("edge", F.lit(False)).unionByName(edge.withColumn("edge", F.lit(True)))
    return both.repartition(max(1, len(heads)), "part").sortWithinPartitions("part", "edge", F.desc("order"), F.desc("tie")).select("doc_id", "text", "part", "edge")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, its edited copy's, and the likeness to that and to the next document."""
    ship(docs.sparkSession)
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for part in spans.chunks(batch):
                part = part if held is None else pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                held = part.slice(part.num_rows - 1)
                texts, where, edge = (part.column(c).to_pylist() for c in ("text", "part", "edge"))
                at = [i for i in range(len(texts) - 1) if not edge[i]]
                assert all(where[i] == where[i + 1] for i in at)
                if not at:
                    continue
                sizes = [len(texts[i]) for i in at]
                edited = [texts[i][:n - n // 2] + texts[i + 1][:n // 2] for i, n in zip(at, sizes)]
                prints, changed = of_texts(part.column("text")), of_texts(pa.array(edited, pa.large_string()))
                own, after = prints.take(at), prints.take(np.array(at) + 1)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(at)), pa.array(sizes, pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(own.strings()), pa.array(changed.strings()),
                    pa.array(own.likeness(changed)), pa.array(own.likeness(after))], names)

    return with_next(docs).mapInArrow(run, schema)
