"""Benchmark decontamination: 13-word windows of test items looked up in training texts.

The windows of all items (an item of fewer words, but not none, is one window)
become a set of 64-bit hashes that is broadcast to the workers.  Each worker
hashes the windows of its texts from prefix sums, looks them up, and compares
the words of every hit with the item's words, so a hash collision counts for
nothing.  A document is contaminated if words were hit and they are a
twentieth of its words or more.

The broadcast has a bound: ``MOST_WINDOWS`` windows.  A larger benchmark goes
another way: a bitmap of fixed size lets through the text windows that may be
in it, those are joined with the benchmark's windows by hash, and the verified
hits are gathered for each row.  Both ways give the same rows.

Defined cases: null or empty text has no words and isn't contaminated; null
and empty items have no window; equal windows of several items count for each;
a repeated item_id counts once; a null item_id is skipped; without windows
nothing is hit; rows are judged one by one, so repeated rows repeat the result;
further columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lunchbox.llm import spans
from lunchbox.llm.runtime import numbered, ship, written

WINDOW = 13
#: a document is contaminated if SHARE * n_hit >= n_words
SHARE = 20
MOST_WINDOWS = 1 << 20
BITMAP_LOG = 26
_U = np.uint64

WINDOWS = "item_id long, n int, hash long, words binary"
RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, n (words), hash and words of each distinct window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in spans.chunks(batch):
                words = spans.Words(part.column("text"), spans.ALNUM)
                hashes, ids, rows = words.hashes(), part.column("item_id").to_pylist(), []
                for i, n in enumerate(np.minimum(words.count, WINDOW)):
                    if n:
                        first = words.first[i]
                        own = spans.window_hashes(hashes[first:first + words.count[i]], n)
                        rows += [(ids[i], int(n), int(h), words.joined(first + k, n)) for k, h in enumerate(own.view(np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (pa.int64(), pa.int32(), pa.int64(), pa.binary()))], ["item_id", "n", "hash", "words"])

    own = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return own.where("item_id is not null").mapInArrow(run, WINDOWS).distinct()


class Lookup:
    """Windows by length: sorted hashes, and the items and words of each."""

    def __init__(self, rows: list):
        self.lengths = {}
        for n in sorted({r.n for r in rows}):
            own: dict[int, dict[bytes, list[int]]] = {}
            for r in rows:
                if r.n == n:
                    own.setdefault(r.hash & ((1 << 64) - 1), {}).setdefault(bytes(r.words), []).append(r.item_id)
            self.lengths[n] = (np.array(sorted(own), np.uint64), own)

    def hits(self, words: spans.Words) -> list[tuple[int, int, int, list[int]]]:
        """(text number, first word, words, items) of every verified hit."""
        found = []
        if not len(words.doc):
            return found
        hashes = words.hashes()
        for n, (known, by_hash) in self.lengths.items():
            value = spans.window_hashes(hashes, n)
            if not len(value):
                continue
            near = np.zeros(1 << 16, bool)  # a first look that most windows don't pass
            near[(known >> _U(48)).astype(np.int64)] = True
            at = np.flatnonzero(near[(value >> _U(48)).astype(np.int64)])
            place = np.minimum(np.searchsorted(known, value[at]), len(known) - 1)
            at = at[known[place] == value[at]]
            at = at[at + n <= words.first[1:][words.doc[at]]]
            for i in at:
                items = by_hash[int(value[i])].get(words.joined(i, n))
                if items:
                    found.append((int(words.doc[i]), int(i), n, items))
        return found


def _digest(items: set[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


NO_ITEMS = hashlib.sha256(b"").hexdigest()


def _judged(words: spans.Words, found: list) -> list[pa.Array]:
    """The columns of RESULT for the texts of a chunk."""
    mark = np.zeros(len(words.doc) + 1, np.int64)
    items: dict[int, set[int]] = {}
    for doc, first, n, own in found:
        mark[first] += 1
        mark[first + n] -= 1
        items.setdefault(doc, set()).update(own)
    hit = np.r_[0, np.cumsum(np.cumsum(mark)[:-1] > 0)]
    n_hit = hit[words.first[1:]] - hit[words.first[:-1]]
    n_items = [len(items.get(i, ())) for i in range(len(words.count))]
    digests = [_digest(items[i]) if i in items else NO_ITEMS for i in range(len(words.count))]
    return [pa.array(words.count, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()),
            pa.array(digests, pa.string()), pa.array((n_hit > 0) & (SHARE * n_hit >= words.count), pa.bool_())]


NAMES = [f"__{x.split()[0]}" for x in RESULT.split(", ")]


def _schema(frame: DataFrame, columns: list[str]) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    return ", ".join([f"`{c}` {kinds[c]}" for c in columns] + [f"__{x}" for x in RESULT.split(", ")])


def _by_broadcast(frame: DataFrame, text: str, windows: DataFrame) -> DataFrame:
    columns = frame.columns
    lookup = frame.sparkSession.sparkContext.broadcast(Lookup(windows.collect()))  # at most MOST_WINDOWS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lookup.value
        for batch in batches:
            for part in spans.chunks(batch, text):
                words = spans.Words(part.column(text), spans.ALNUM)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *_judged(words, own.hits(words))], [*columns, *NAMES])

    return frame.mapInArrow(run, _schema(frame, columns))


def _bitmap(windows: DataFrame) -> np.ndarray:
    """2**BITMAP_LOG bits (8 MB) of the windows' hashes, made in segments by the workers."""
    log = BITMAP_LOG - 10

    def segment(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << log, np.uint8)
        for batch in batches:
            bits[batch.column("place").to_numpy() & ((1 << log) - 1)] = 1
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([np.packbits(bits).tobytes()], pa.binary())], ["segment", "bits"])

    places = windows.select(F.shiftrightunsigned("hash", 64 - BITMAP_LOG).alias("place")).distinct()
    rows = places.groupBy(F.shiftright("place", log).alias("segment")).applyInArrow(segment, "segment long, bits binary")
    out = np.zeros(1 << (BITMAP_LOG - 3), np.uint8)
    for row in rows.toLocalIterator():
        width = 1 << (log - 3)
        out[row.segment * width:(row.segment + 1) * width] = np.frombuffer(row.bits, np.uint8)
    return out


def _joined_hits(frame: DataFrame, text: str, windows: DataFrame) -> DataFrame:
    """``frame`` with __hits, the verified hits (first, n, item_id) of each text, and __key."""
    lengths = [r.n for r in windows.select("n").distinct().collect()]  # WINDOW rows at most
    shared = frame.sparkSession.sparkContext.broadcast(_bitmap(windows))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for part in spans.chunks(batch, text):
                words = spans.Words(part.column(text), spans.ALNUM)
                keys, hashes, rows = part.column("__key").to_pylist(), words.hashes(), []
                for n in lengths:
                    at = spans.whole_windows(words, n)
                    value = spans.window_hashes(hashes, n)[at] if len(at) else np.zeros(0, np.uint64)
                    place = (value >> _U(64 - BITMAP_LOG)).astype(np.int64)
                    for k in np.flatnonzero((bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1):
                        i, doc = int(at[k]), int(words.doc[at[k]])
                        rows.append((keys[doc], i - int(words.first[doc]), n, int(value[k].view(np.int64)), words.joined(i, n)))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))], ["__key", "first", "n", "hash", "words"])

    keyed = frame.withColumn("__key", F.sha2(F.col(text).cast("string"), 256))
    passed = keyed.select("__key", text).mapInArrow(near, "__key string, first long, n int, hash long, words binary").distinct()
    hits = passed.join(windows, ["n", "hash", "words"]).groupBy("__key").agg(F.collect_list(F.struct("first", "n", "item_id")).alias("__hits"))
    return keyed.join(hits, "__key", "left")


def _by_join(frame: DataFrame, text: str, windows: DataFrame) -> DataFrame:
    columns = frame.columns

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in spans.chunks(batch, text):
                words, found = spans.Words(part.column(text), spans.ALNUM), []
                for doc, hits in enumerate(part.column("__hits").to_pylist()):
                    found += [(doc, int(words.first[doc]) + h["first"], h["n"], [h["item_id"]]) for h in hits or ()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *_judged(words, found)], [*columns, *NAMES])

    return _joined_hits(frame, text, windows).mapInArrow(judge, _schema(frame, columns))


def judged(docs: DataFrame, benchmark: DataFrame, most: int = MOST_WINDOWS) -> DataFrame:
    """The columns of docs as c0, c1, ..., and those of RESULT with two underscores before their names."""
    ship(docs.sparkSession)
    windows = written(item_windows(benchmark), "windows")
    way = _by_broadcast if windows.count() <= most else _by_join
    return way(numbered(docs), f"c{docs.columns.index('text')}", windows)


def contamination(docs: DataFrame, benchmark: DataFrame, most: int = MOST_WINDOWS) -> DataFrame:
    """doc_id and the columns of RESULT of every row."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return judged(ids, benchmark, most).select(F.col("c0").alias("doc_id"), *(F.col(c).alias(c[2:]) for c in NAMES))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, all their columns."""
    return judged(docs, benchmark).where("not __contaminated").drop(*NAMES).toDF(*docs.columns)


def _cut(words: spans.Words, texts: list[str | None], found: list) -> list[str | None]:
    """``texts`` without the hits (text, first word, number of words)."""
    ranges: dict[int, list[tuple[int, int]]] = {}
    for doc, first, n in found:
        begin = int(words.at[doc])
        ranges.setdefault(doc, []).append((int(words.start[first]) - begin, int(words.end[first + n - 1]) - begin))
    for doc, own_ranges in ranges.items():
        raw, out, done = texts[doc].encode(), [], 0
        for a, b in sorted(own_ranges):
            if a > done:
                out.append(raw[done:a])
            done = max(done, b)
        texts[doc] = b"".join([*out, raw[done:]]).decode()
    return texts


def without_spans(docs: DataFrame, benchmark: DataFrame, most: int = MOST_WINDOWS) -> DataFrame:
    """``docs`` with the hit words, and what separates them, cut out of their texts."""
    ship(docs.sparkSession)
    windows = written(item_windows(benchmark), "windows")
    frame, at = numbered(docs), docs.columns.index("text")
    text, schema, names = f"c{at}", frame.schema, frame.columns
    broadcast = windows.count() <= most
    lookup = docs.sparkSession.sparkContext.broadcast(Lookup(windows.collect())) if broadcast else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in spans.chunks(batch, text):
                words = spans.Words(part.column(text), spans.ALNUM)
                if lookup is not None:
                    found = [(doc, first, n) for doc, first, n, _ in lookup.value.hits(words)]
                else:
                    found = [(doc, int(words.first[doc]) + h["first"], h["n"]) for doc, hits in enumerate(part.column("__hits").to_pylist()) for h in hits or ()]
                columns = [part.column(c) for c in names]
                columns[at] = pa.array(_cut(words, part.column(text).to_pylist(), found), part.schema.field(text).type)
                yield pa.RecordBatch.from_arrays(columns, names)

    return (frame if broadcast else _joined_hits(frame, text, windows)).mapInArrow(cut, schema).toDF(*docs.columns)
