"""N-gram Jaccard join with prefix filters under several global token orders.

Two documents link when the Jaccard similarity of their sets of distinct
5-word shingles is 0.8 or more; the result holds each document's component.

1.  ``document_sets``: size and 128-bit identity of every set.  Equal sets are
    one node from here on, so exact copies never meet each other.
2.  ``token_levels``: every shingle is counted over all documents (packed into
    sorted arrays and pre-aggregated in each task, then merged by hash range).
    A shingle's level is 0 if it is in one set only, else it grows with the
    logarithm of its frequency.  The levels go to the workers as a bitmap and
    a list of frequent shingles, both of bounded size; beyond the bounds some
    unique shingles count as shared or frequent ones as rare, which makes
    filters weaker and never loses a link.
3.  ``indexed_sets``: shingles are ordered by (level, hash), rare ones first,
    under three hashes, which gives three global orders.  A set with more than
    a fifth of unique shingles can link with nothing.  The others get the shared
    shingles of their prefix under each order.
4.  ``star_pairs``: each node takes one candidate, the least edited node
    of the lists of its first prefix; the links found are contracted.
5.  ``cross_pairs``: all pairs of *different* components that meet in a list of
    the first order and pass the size and position bounds.  Large groups of
    copies have become one component by then, so their pairs aren't made.
6.  ``verified``: pairs must share a token in the prefixes of the second and
    third order too; then the exact overlap decides.

Defined cases: null or empty text has size 0 and is linked with nothing; rows
that repeat a text are members of one node; a component of rows without doc_id
has a null id; an empty table gives an empty result; only doc_id and text are
read, so further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lunchbox.llm import spans
from lunchbox.llm.graph import components
from lunchbox.llm.runtime import numbered, ship, written

WORDS = 5
#: similarity NUMERATOR / DENOMINATOR or more links
NUMERATOR, DENOMINATOR = 4, 5
#: bounds of what is broadcast: 2**28 bits are 32 MB, 2**21 longs are 16 MB
MOST_BITS, MOST_FREQUENT = 28, 1 << 21
TOKEN_BITS, SET_BITS = 36, 28
BUCKET_TOKENS, FLUSH_TOKENS = 2 << 20, 2 << 20
_U = np.uint64


def _text_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _nodes(words: spans.Words, doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """128-bit identity of each text's set as (n, 2) integers."""
    out = np.zeros((len(words.count), 2), np.uint64)
    if len(doc):
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        with np.errstate(over="ignore"):
            out[doc[first], 0] = np.add.reduceat(spans.mix(value), first)
            out[doc[first], 1] = np.add.reduceat(spans.mix(value ^ _U(0x5851F42D4C957F2D)), first)
    return out


def document_sets(docs: DataFrame, n_words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, node (binary; null for an empty set) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in spans.chunks(batch):
                words = spans.Words(part.column("text"), spans.NOT_BLANK)
                doc, value = spans.shingles(words, n_words)
                size = np.bincount(doc, minlength=part.num_rows)
                ids = _nodes(words, doc, value)
                nodes = [row.tobytes() if n else None for row, n in zip(ids, size)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(size, pa.int64()), pa.array(nodes, pa.binary())],
                                                 ["doc_id", "n_shingles", "node"])

    return _text_rows(docs).mapInArrow(run, "doc_id long, n_shingles long, node binary")


def _packed(keys: np.ndarray, many: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys (token, set) and (token, count) made distinct: those of one set, and counts of the others."""
    keys = spans.distinct(keys)
    token = keys >> _U(SET_BITS)
    first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(keys) else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, len(keys)])
    token, single = token[first], keys[first]
    if many:
        old = np.concatenate(many)
        old_token, old_count = old >> _U(SET_BITS), (old & _U((1 << SET_BITS) - 1)).astype(np.int64)
        every = spans.distinct(np.concatenate([token, old_token]))
        place = np.searchsorted(every, np.concatenate([token, old_token]))
        sums = np.bincount(place, weights=np.concatenate([count, old_count]), minlength=len(every)).astype(np.int64)
        one = np.zeros(len(every), np.uint64)
        one[place[:len(token)]] = single
        token, count, single = every, sums, one
    alone = count == 1
    capped = np.minimum(count[~alone], (1 << SET_BITS) - 1).astype(np.uint64)
    return single[alone], (token[~alone] << _U(SET_BITS)) | capped


def token_levels(docs: DataFrame, total: int, n_words: int = WORDS) -> dict:
    """Bitmap of shared shingles and list of frequent ones with their levels."""
    buckets_log = max(0, int(np.ceil(np.log2(max(1, total) / BUCKET_TOKENS))))
    bits = int(min(MOST_BITS, max(16, np.ceil(np.log2(max(2, total))))))
    buckets_log = min(buckets_log, bits - 3)
    shift = _U(TOKEN_BITS + SET_BITS - buckets_log) if buckets_log else None

    def bucket_of(keys: np.ndarray) -> np.ndarray:
        return (keys >> shift).astype(np.int64) if shift is not None else np.zeros(len(keys), np.int64)

    def flush(keys: list[np.ndarray]) -> pa.RecordBatch:
        single, many = _packed(np.concatenate(keys), [])
        cuts = np.arange((1 << buckets_log) + 1)
        at, at_many = np.searchsorted(bucket_of(single), cuts), np.searchsorted(bucket_of(many), cuts)
        used = [b for b in cuts[:-1] if at[b] < at[b + 1] or at_many[b] < at_many[b + 1]]
        return pa.RecordBatch.from_arrays([
            pa.array(used, pa.int64()),
            pa.array([single[at[b]:at[b + 1]].tobytes() for b in used], pa.binary()),
            pa.array([many[at_many[b]:at_many[b + 1]].tobytes() for b in used], pa.binary())], ["bucket", "single", "many"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for part in spans.chunks(batch):
                words = spans.Words(part.column("text"), spans.NOT_BLANK)
                doc, value = spans.shingles(words, n_words)
                owner = _nodes(words, doc, value)[:, 0] >> _U(64 - SET_BITS)
                held.append(((value >> _U(64 - TOKEN_BITS)) << _U(SET_BITS)) | owner[doc])
                n += len(doc)
                if n >= FLUSH_TOKENS:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, single, many = key[0].as_py(), np.zeros(0, np.uint64), []
        held, size = [], 0
        for batch in batches:
            for s, m in zip(batch.column("single"), batch.column("many")):
                held.append(np.frombuffer(s.as_buffer(), np.uint64))
                size += len(held[-1])
                many.append(np.frombuffer(m.as_buffer(), np.uint64))
                if size > 4 * BUCKET_TOKENS:  # keep what is held at about the bucket's distinct tokens
                    single, more = _packed(np.concatenate([single, *held]), many)
                    held, many, size = [], [more], 0
        _, shared = _packed(np.concatenate([single, *held]), many)
        token, count = shared >> _U(SET_BITS), (shared & _U((1 << SET_BITS) - 1)).astype(np.int64)
        segment = np.zeros(1 << (bits - buckets_log), np.uint8)
        segment[(token >> _U(TOKEN_BITS - bits)).astype(np.int64) - (bucket << (bits - buckets_log))] = 1
        kinds, counts, data = [0], [len(token)], [np.packbits(segment).tobytes()]
        level = np.log2(count).astype(np.int64)
        for k in np.unique(level[level >= 2]):
            own = token[level == k]
            kinds.append(int(k))
            counts.append(len(own))
            data.append(own.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(kinds), pa.int64()), pa.array(kinds, pa.int64()),
                                          pa.array(counts, pa.int64()), pa.array(data, pa.binary())], ["bucket", "kind", "n", "data"])

    packed = _text_rows(docs).mapInArrow(pack, "bucket long, single binary, many binary")
    found = written(packed.groupBy("bucket").applyInArrow(merge, "bucket long, kind long, n long, data binary"), "levels")
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    width = 1 << (bits - buckets_log - 3)
    for row in found.where("kind = 0").toLocalIterator():  # 2**MOST_BITS bits in all
        bitmap[row.bucket * width:(row.bucket + 1) * width] = np.frombuffer(row.data, np.uint8)
    least, room = 64, MOST_FREQUENT
    for row in found.where("kind > 0").groupBy("kind").agg(F.sum("n").alias("n")).orderBy(F.desc("kind")).collect():  # a row a level
        room -= row.n
        if room < 0:
            break
        least = row.kind
    token, level = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for row in found.where(F.col("kind") >= max(2, least)).toLocalIterator():  # MOST_FREQUENT tokens in all
        token.append(np.frombuffer(row.data, np.uint64))
        level.append(np.full(row.n, row.kind, np.int64))
    token, level = np.concatenate(token), np.concatenate(level)
    order = np.argsort(token)
    return {"bits": bits, "bitmap": bitmap, "token": token[order], "level": level[order].astype(np.int8)}


def _levels(value: np.ndarray, known: dict) -> np.ndarray:
    token = value >> _U(64 - TOKEN_BITS)
    place = (token >> _U(TOKEN_BITS - known["bits"])).astype(np.int64)
    level = ((known["bitmap"][place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1).astype(np.int8)
    if len(known["token"]):
        at = np.minimum(np.searchsorted(known["token"], token), len(known["token"]) - 1)
        hit = known["token"][at] == token
        level[hit] = known["level"][at[hit]]
    return level


INDEXED = "node binary, n long, alone long, first array<long>, second binary, third binary, whole binary"


def indexed_sets(docs: DataFrame, levels, n_words: int = WORDS) -> DataFrame:
    """One row for each distinct set that can link: its prefixes under three orders, and the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = levels.value
        for batch in batches:
            for part in spans.chunks(batch):
                words = spans.Words(part.column("text"), spans.NOT_BLANK)
                doc, value = spans.shingles(words, n_words)
                level = _levels(value, known)
                size = np.bincount(doc, minlength=part.num_rows)
                shared = np.bincount(doc[level > 0], minlength=part.num_rows)
                ids = _nodes(words, doc, value)
                can = np.flatnonzero((size > 0) & (DENOMINATOR * shared >= NUMERATOR * size))
                _, one = np.unique(ids[can], axis=0, return_index=True)
                can = np.sort(can[one])
                alone = size[can] - shared[can]
                take = size[can] - -(-NUMERATOR * size[can] // DENOMINATOR) + 1 - alone
                keep = np.isin(doc, can) & (level > 0)
                d, v, at_level = doc[keep], value[keep], level[keep]
                prefixes = []
                for salt in (0, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
                    o = np.lexsort((spans.mix(v ^ _U(salt)), at_level, d))
                    prefixes.append((v[o], np.searchsorted(d[o], can)))
                at = np.searchsorted(doc, can)
                rows = {k: [] for k in ("node", "n", "alone", "first", "second", "third", "whole")}
                for k, (i, q) in enumerate(zip(can, take)):
                    rows["node"].append(ids[i].tobytes())
                    rows["n"].append(int(size[i]))
                    rows["alone"].append(int(alone[k]))
                    for name, (tokens, begin) in zip(("first", "second", "third"), prefixes):
                        own = tokens[begin[k]:begin[k] + q]
                        rows[name].append(own.view(np.int64) if name == "first" else (own >> _U(32)).astype(np.uint32).tobytes())
                    rows["whole"].append(value[at[k]:at[k] + size[i]].tobytes())
                types = [pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows.values(), types)], list(rows))

    return _text_rows(docs).mapInArrow(run, INDEXED).dropDuplicates(["node"])


def verified(pairs: DataFrame, indexed: DataFrame) -> DataFrame:
    """The pairs (a, b) that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in batch.column(name)]
            good = []
            for k, (x2, y2, x3, y3, x, y) in enumerate(zip(get("second", np.uint32), get("second_b", np.uint32), get("third", np.uint32),
                                                           get("third_b", np.uint32), get("whole", np.uint64), get("whole_b", np.uint64))):
                if not np.isin(x2, y2).any() or not np.isin(x3, y3).any():
                    continue
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                if DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both):
                    good.append(k)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    own = ("second", "third", "whole")
    left = indexed.select(F.col("node").alias("a"), *own)
    right = indexed.select(F.col("node").alias("b"), *(F.col(c).alias(f"{c}_b") for c in own))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a binary, b binary")


def _lists(indexed: DataFrame) -> DataFrame:
    """A row for each token of a set's first prefix."""
    return indexed.select("node", "n", "alone", F.posexplode("first").alias("pos", "token"))


def star_pairs(indexed: DataFrame) -> DataFrame:
    """For each node the least edited node that shares a prefix token and may link with it."""
    lists = _lists(indexed)
    heads = lists.groupBy("token").agg(F.min(F.struct("alone", "n", "node")).alias("head"), F.count("*").alias("many")).where("many > 1").drop("many")
    met = lists.join(heads, "token").where("head.node <> node").where(
        f"{DENOMINATOR} * least(n, head.n) >= {NUMERATOR} * greatest(n, head.n)")
    return met.groupBy(F.col("node").alias("a")).agg(F.min("head").alias("head")).select("a", F.col("head.node").alias("b"))


def cross_pairs(indexed: DataFrame, labels: DataFrame) -> DataFrame:
    """All pairs of different components that share a token of the first prefix and pass the bounds."""
    lists = _lists(indexed).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = lists.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("token")
    lists = lists.join(mixed, "token", "left_semi")
    other = lists.select("token", *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "alone", "pos", "label")))
    total = NUMERATOR + DENOMINATOR
    # what both can share from their first common token on, against the overlap that links sets of these sizes
    bound = f"{total} * least(n - alone - pos, n_b - alone_b - pos_b) >= {NUMERATOR} * (n + n_b)"
    return lists.join(other, "token").where("node < node_b and label <> label_b").where(bound).select(
        F.col("node").alias("a"), F.col("node_b").alias("b")).distinct()


def linked_documents(docs: DataFrame, n_words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id that links reach) of every row."""
    spark = docs.sparkSession
    ship(spark)
    rows = written(document_sets(docs, n_words), "sets")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    levels = spark.sparkContext.broadcast(token_levels(docs, total, n_words))
    indexed = written(indexed_sets(docs, levels, n_words), "indexed")
    edges = written(verified(star_pairs(indexed), indexed), "star")
    labels = components(edges)
    edges = edges.union(written(verified(cross_pairs(indexed, labels), indexed), "cross"))
    labels = components(edges)
    rows = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "label", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is the least of its component; repeated rows count once.

    Rows without doc_id stay.  Rows that share a doc_id and differ in text stay
    if that id is the least of a component.
    """
    kept = linked_documents(docs).where("doc_id <=> component_id").select(F.col("doc_id").alias("kept")).distinct()
    frame, place = numbered(docs), docs.columns.index
    ids, text = f"c{place('doc_id')}", f"c{place('text')}"
    out = frame.join(kept, F.col(ids).cast("long").eqNullSafe(F.col("kept")), "left_semi")
    return out.dropDuplicates([ids, text]).toDF(*docs.columns)
