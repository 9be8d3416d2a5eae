"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

The model smooths a bigram count with the add-one unigram:

    P(w | v) = (c(v, w) + mu * P(w)) / (c(v) + mu),    P(w) = (c(w) + 1) / (N + V + 1)

Unigram counts are exact.  Bigram counts live in a log-frequency Bloom filter: every bigram
seen is entered once for each level up to that of its
count (levels double), and its count is read back by probing level after
level until one is missing, as the level's lower bound, so what bigrams
get never exceeds what their context has, but for false hits (1 in 10,000).  The centre of
``mu`` is the value at which the unseen share that the formula expects over all contexts is
the share of bigrams seen once, counted over the whole training corpus.  Texts
differ in how far they repeat the corpus, so the model of a text is an even mixture of
the models with ``mu`` times each of ``SPREAD``: it is a probability of the text
again, and within log10(6) of the best of them.

1.  ``blocks``: texts become blocks of about 8 MB: the hashes of the block's different words
    and, for each token, its place among them.  Text is read once, and blocks
    are a written table.
2.  ``counted``: a block's different unigrams and bigrams go to their hash ranges once, packed into
    arrays, with how often its training documents have them.  A range merges what
    it got, and answers each block with the counts of its words, so no task
    holds a vocabulary and a frequent word is sent once a block.  For bigrams it makes the
    filter's segment of that range, and answers with the levels the segment has.
3.  ``scores``: a filter that can't exceed ``MOST_BYTES`` is broadcast instead, and bigrams aren't
    answered; both give the same scores.

Defined cases: null text is empty and has the end token only; a null doc_id is neither held out nor
learned from; without training documents N and V are 0 and all tokens unknown; rows
are scored one by one, so repeated rows repeat the score (and count as often in training); an empty
table gives an empty result; further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lunchbox.llm import spans
from lunchbox.llm.runtime import crc_remainder, ship, written

BLOCK_BYTES, RANGE_TOKENS = 8 << 20, 2 << 20
LEAST, BITS, PROBES, MOST_LEVELS = 1, 20, 10, 60
SPREAD = np.array([1 / 16, 1, 16, 256, 4096, 65536])
MOST_BYTES = 64 << 20
_U = np.uint64
END, BEGIN = _U(0x9C1F3A5D7E2B4861), _U(0x3D5A9B7C1E2F4867)

BLOCKS = "block long, doc_ids array<long>, lengths array<long>, trains array<boolean>, low binary, high binary, words binary"


def blocks(rows: DataFrame) -> DataFrame:
    """Blocks of the rows (doc_id, text, trains)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size, number = 0, TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate([h for _, _, _, h in held])
            words = spans.distinct(tokens)
            place = np.searchsorted(words, tokens)
            joined = lambda k: [x for h in held for x in h[k]]
            values = (number, joined(0), joined(1), joined(2), place.astype("<u2").tobytes(), (place >> 16).astype("<u2").tobytes(), thin(words))
            types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], [x.split()[0] for x in BLOCKS.split(", ")])

        for batch in batches:
            for part in spans.chunks(batch):
                words = spans.Words(part.column("text"), spans.NOT_BLANK)
                lengths = words.count + 1
                tokens = np.insert(words.hashes(), words.first[1:], END)
                held.append((part.column("doc_id").to_pylist(), lengths.tolist(), part.column("trains").to_pylist(), tokens))
                size += len(words.raw) + 8 * part.num_rows
                if size >= BLOCK_BYTES:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    return rows.mapInArrow(run, BLOCKS)


class Block:
    """One row of ``blocks``."""

    def __init__(self, row: dict):
        self.doc_ids, self.lengths = row["doc_ids"], np.array(row["lengths"], np.int64)
        self.trains = np.repeat(np.array(row["trains"], bool), self.lengths)
        self.words = thick(row["words"])
        self.place = np.frombuffer(row["low"], "<u2").astype(np.int64) | (np.frombuffer(row["high"], "<u2").astype(np.int64) << 16)
        self.first = np.r_[0, np.cumsum(self.lengths)][:-1]

    def bigrams(self) -> np.ndarray:
        """Identity of the bigram that ends at each token."""
        own = self.words[self.place] >> _U(32)
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[self.first] = BEGIN >> _U(32)
        return spans.mix((before << _U(32)) | own)


def thin(keys: np.ndarray, base: int = 0) -> bytes:
    """Sorted keys as differences from one to the next, ``base`` first, in as few bytes each as the greatest one needs."""
    step = np.diff(np.r_[_U(base), keys])
    width = max(1, (int(step.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def thick(data: bytes, base: int = 0) -> np.ndarray:
    """The keys of ``thin``."""
    width = data[0]
    step = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    step[:, :width] = np.frombuffer(data, np.uint8)[1:].reshape(-1, width)
    out = step.reshape(-1).view("<u8").astype(np.uint64)
    if len(out):
        out[0] += _U(base)
    return np.cumsum(out, dtype=np.uint64)


def small(numbers: np.ndarray) -> bytes:
    """Counts or levels in as few bytes each as the greatest one needs."""
    most = int(numbers.max(initial=0))
    kind = next(k for k in (1, 2, 4, 8) if most < 1 << (8 * k))
    return bytes([kind]) + numbers.astype(f"<u{kind}").tobytes()


def large(data: bytes) -> np.ndarray:
    """The numbers of ``small``."""
    return np.frombuffer(data[1:], f"<u{data[0]}").astype(np.int64)


def _base(span: int, log: int) -> int:
    """Where a hash range begins."""
    return span << (64 - log) if log else 0


def _range_log(tokens: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1, tokens) / RANGE_TOKENS))))


def _cuts(keys: np.ndarray, log: int) -> np.ndarray:
    """Where each of the 2**log hash ranges begins in sorted keys."""
    at = np.searchsorted(keys, np.arange(1 << log, dtype=np.uint64) << _U(64 - log)) if log else np.zeros(1, np.int64)
    return np.r_[at, len(keys)]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts[order], first)


def _count_level(counts: np.ndarray) -> np.ndarray:
    """Level of each count: 0 below LEAST, then one more with each doubling."""
    return np.where(counts < LEAST, 0, np.log2(np.maximum(counts, LEAST) / LEAST).astype(np.int64) + 1)


def level_count(levels: np.ndarray) -> np.ndarray:
    """Least count of each level."""
    return np.where(levels == 0, 0.0, LEAST * 2.0 ** (levels - 1.0))


def _places(keys: np.ndarray, level: int, probe: int, bits: np.ndarray) -> np.ndarray:
    return (spans.mix(keys ^ spans.mix(np.array([level * 64 + probe + 1], np.uint64))) % bits).astype(np.int64)


def segment(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Filter of one range: every key at each of its levels."""
    levels = _count_level(counts)
    bits = max(64, -(-BITS * int(levels.sum()) // 8) * 8)
    out = np.zeros(bits, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = keys[levels >= level]
        for probe in range(PROBES):
            out[_places(own, level, probe, _U(bits))] = True
    return np.packbits(out).tobytes()


class Filter:
    """Segments one after another; ``levels`` probes them."""

    def __init__(self, segments: list[bytes]):
        size = np.array([len(s) for s in segments], np.int64)
        self.log = int(np.log2(len(segments)))
        self.bits = (size * 8).astype(np.uint64)
        self.base = np.r_[0, np.cumsum(size * 8)][:-1]
        self.data = np.frombuffer(b"".join(segments), np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        home = (keys >> _U(64 - self.log)).astype(np.int64) if self.log else np.zeros(len(keys), np.int64)
        out = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        for level in range(1, MOST_LEVELS + 1):
            for probe in range(PROBES):
                if not len(alive):
                    return out
                at = self.base[home[alive]] + _places(keys[alive], level, probe, self.bits[home[alive]])
                alive = alive[(self.data[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
            out[alive] = level
        return out


COUNTED = ("kind int, span long, n long, total long, once long, classes array<struct<class int, words long, tokens long>>, data binary, "
           "block long, found binary")


def counted(encoded: DataFrame, log: int, with_filter: bool) -> DataFrame:
    """For each range of unigrams (kind 0) and bigrams (kind 1) a row of sums, and a row for each block that has some of them.

    ``found`` of a block's row are the counts of its words, or the levels of its bigrams, in order of their hashes; ``with_filter``: the
    filter's segment in the row of sums instead of the levels.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Block(row)
                found = [(own.words, np.bincount(own.place[own.trains], minlength=len(own.words))), _summed(own.bigrams(), own.trains.astype(np.int64))]
                rows = []
                for kind, (keys, counts) in enumerate(found):
                    cut = _cuts(keys, log)
                    for s in range(1 << log):
                        if cut[s] < cut[s + 1]:
                            rows.append((kind, s, row["block"], thin(keys[cut[s]:cut[s + 1]], _base(s, log)), small(counts[cut[s]:cut[s + 1]])))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["kind", "span", "block", "keys", "times"])

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, keys, counts = key[0].as_py(), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        asked, held_keys, held_counts, size = [], [], [], 0  # a range's keys, a block each, packed: about RANGE_TOKENS in all
        base = _base(key[1].as_py(), log)
        for batch in batches:
            for block, packed, times in zip(*(batch.column(c).to_pylist() for c in ("block", "keys", "times"))):
                asked.append((block, packed))
                held_keys.append(thick(packed, base))
                held_counts.append(large(times))
                size += len(held_keys[-1])
                if size >= RANGE_TOKENS:
                    keys, counts = _summed(np.concatenate([keys, *held_keys]), np.concatenate([counts, *held_counts]))
                    held_keys, held_counts, size = [], [], 0
        keys, counts = _summed(np.concatenate([keys, *held_keys]), np.concatenate([counts, *held_counts]))
        held_keys, held_counts = [], []
        learned = counts > 0
        seen, times = keys[learned], counts[learned]
        level = np.log2(times).astype(np.int64)
        classes = [{"class": int(c), "words": int((level == c).sum()), "tokens": int(times[level == c].sum())} for c in spans.distinct(level)] if kind == 0 else []
        data = segment(seen, times) if kind == 1 else b""
        names = ["kind", "span", "n", "total", "once", "classes", "data", "block", "found"]
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                 pa.list_(pa.struct([("class", pa.int32()), ("words", pa.int64()), ("tokens", pa.int64())])), pa.binary(), pa.int64(), pa.binary())
        span = key[1].as_py()
        values = (kind, span, len(seen), int(times.sum()), int((times == 1).sum()), classes, data if with_filter else None, None, None)
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)
        if kind == 1 and with_filter:
            return
        answers = counts if kind == 0 else Filter([data]).levels(keys)
        for block, packed in asked:
            values = (kind, span, None, None, None, None, None, block, small(answers[np.searchsorted(keys, thick(packed, base))]))
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    packed = encoded.mapInArrow(pieces, "kind int, span long, block long, keys binary, times binary")
    return packed.groupBy("kind", "span").applyInArrow(merge, COUNTED)


def _mu(classes: list[tuple[int, int]], once: int, bigrams: int) -> float:
    """The weight of the unigram at which the expected unseen share over contexts (words, tokens) is that of bigrams seen once."""
    if not classes or not bigrams:
        return 1.0
    words, tokens = np.array(classes, np.float64).T
    share, mean = tokens / tokens.sum(), tokens / words
    low, high = 1e-3, 1e9
    for _ in range(100):
        middle = np.sqrt(low * high)
        low, high = (middle, high) if (share * middle / (mean + middle)).sum() < once / bigrams else (low, middle)
    return float(low)


def scores(docs: DataFrame, modulus: int = 7, held_out: int = 2, most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce(crc_remainder("doc_id", modulus) != held_out, F.lit(False)).alias("trains"))
    encoded = written(blocks(rows), "blocks")
    tokens = encoded.select(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    log = _range_log(tokens)
    with_filter = BITS * tokens // 8 + 9 * (1 << log) <= most_bytes  # a bigram has no more levels than occurrences
    tables = written(counted(encoded, log, with_filter), "counts")
    ranges = tables.where("block is null")
    sums = {r.kind: r for r in ranges.groupBy("kind").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("once").alias("once")).collect()}  # two rows
    n, v = (sums[0].total, sums[0].n) if 0 in sums else (0, 0)
    classes = ranges.where("kind = 0").select(F.explode("classes").alias("c")).groupBy("c.class").agg(F.sum("c.words"), F.sum("c.tokens")).collect()
    mu = _mu([(r[1], r[2]) for r in classes], sums[1].once, sums[1].total) if 1 in sums else 1.0  # a row a doubling
    begun = rows.where("trains").count()
    answers = tables.where("block is not null").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("kind", "span", "found"))).alias("answers"))
    joined = encoded.join(answers, "block")
    shared = None
    if with_filter:
        own = {r.span: bytes(r.data) for r in ranges.where("kind = 1").select("span", "data").toLocalIterator()}  # most_bytes in all
        shared = spark.sparkContext.broadcast(Filter([own.get(s, bytes(8)) for s in range(1 << log)]))
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Block(row)
                found = [np.concatenate([large(a["found"]) for a in row["answers"] if a["kind"] == kind] or [np.zeros(0, np.int64)]) for kind in (0, 1)]
                count = found[0][own.place]
                single = (count + 1) / (n + v + 1)
                before = np.empty_like(count)
                before[1:] = count[:-1]
                before[own.first] = begun
                ends = own.bigrams()
                keys = spans.distinct(ends)
                levels = found[1] if shared is None else shared.value.levels(keys)
                pair = level_count(levels[np.searchsorted(keys, ends)])
                pair = np.minimum(pair, np.minimum(count, before))  # a pair isn't more frequent than its words
                total = lambda x: np.add.reduceat(x, own.first)
                each = np.stack([total(np.log10((pair + m * single) / (before + m))) for m in mu * SPREAD])
                best = each.max(0)
                mixed = best + np.log10((10 ** (each - best)).mean(0))
                yield pa.RecordBatch.from_arrays([
                    pa.array(own.doc_ids, pa.int64()), pa.array(own.lengths, pa.int64()), pa.array(total((count > 0).astype(np.int64)), pa.int64()),
                    pa.array(np.full(len(own.lengths), n), pa.int64()), pa.array(total(np.log10(single))), pa.array(mixed)], names)

    out = joined.mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.select("doc_id", (crc_remainder("doc_id", modulus) == held_out).alias("held_out"), *names[1:])
