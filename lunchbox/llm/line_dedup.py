"""Fuzzy line deduplication by MinHash.

A line is the set of its 8-character shingles; lines of Jaccard similarity 0.8
or more are linked, and of each component of linked lines one line stays: its
first occurrence by document and line number.

1.  Equal lines are one from the start: a line is known by a 64-bit hash of its text, blanks at the ends not counted.
2.  ``bucket_members``: ``ROWS * BANDS`` least values under as many hashes of all shingles of a line, in any script; each
    ``ROWS`` of them make a band's key.  A pair is in no common bucket with probability (1 - s**ROWS)**BANDS: 0.005 at a similarity
    of 0.8, 0.0001 at 0.88.  Tasks work on blocks of different lines and send packed (key, line) arrays by hash range; what shares
    a key within a block is known there, and only the block's first line goes to the key's range, so a hot key sends one line a block.
    Ranges answer with the lines of keys that several lines have.
3.  ``linked``: in a bucket each line meets the bucket's head first, the line that shares buckets with most others (of a family of near copies
    the least edited one, which links with the rest), and the links found are contracted.  Then the shingles of the lines in buckets of several components are counted by component (``may_link``):
    what a line shares with other components at all bounds its similarity with each of their lines.  All pairs of *different* components that still share a
    bucket and pass that bound follow, those of hot buckets dealt out by chunks; while that is many pairs, further
    heads are met before, each of a further component of its bucket.
4.  ``similar``: the exact Jaccard similarity of all shingles decides.
5.  Components come from a distributed contraction (``graph.components``).
6.  ``without_similar_lines``: the numbers of the lines that go are gathered by document, and each text is rebuilt in one pass.

The signatures and the verification are numpy in Arrow batches; all else is DataFrame functions.  The form in DataFrame functions only
didn't meet the limits with whole results (README).

Defined cases: a line that is empty but for blanks isn't compared and always stays; lines of 1 to 7 characters are one shingle, so only
equal ones are linked; a null text stays null, an empty one empty; a text whose lines all go becomes empty and its row
stays.  A document is known by doc_id and text: rows that repeat both get the same result, rows of one id with different
texts (or without an id) are documents of their own, in order of a hash of the text; a null doc_id
comes last; other columns pass unchanged, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from lunchbox.llm import spans
from lunchbox.llm.graph import components
from lunchbox.llm.jaccard_join import BUCKET_TOKENS, MOST_BITS, SET_BITS, TOKEN_BITS, _packed as packed_tokens
from lunchbox.llm.runtime import freed, numbered, ship, written

SHINGLE = 8
#: similarity NUMERATOR / DENOMINATOR or more links
NUMERATOR, DENOMINATOR = 4, 5
ROWS, BANDS = 4, 10
#: different lines of a block, bytes of text a range of keys stands for, shingles worked on at once, entries a range holds before it merges
BLOCK_LINES, RANGE_BYTES, STEP, HELD = 1 << 15, 32 << 20, 1 << 18, 1 << 21
#: bytes of a line (or two) whose shingles are held at once when lines are compared
LONG = 4 << 20
#: lines of a chunk of a hot bucket; heads are met while pairs exceed FEW times the lines and fall by as much, MOST_TURNS times
CHUNK, FEW, MOST_TURNS = 1024, 4, 4

_U = np.uint64
_odd = spans.mix(np.arange(1, 2 * ROWS * BANDS + 1, dtype=np.uint64))
_FLIP, _TIMES = (_odd[:ROWS * BANDS] >> _U(32)).astype(np.uint32), (_odd[ROWS * BANDS:] >> _U(32)).astype(np.uint32) | np.uint32(1)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def line_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts, and start and end of each line, blanks at its ends left out; empty lines are missing."""
    raw, at = spans.flat(texts)
    cut = np.flatnonzero(raw == 10)
    start, end = np.sort(np.r_[at[:-1], cut + 1]), np.sort(np.r_[cut, at[1:]])
    solid = np.flatnonzero((raw != 32) & (raw != 10))
    first, last = np.searchsorted(solid, start), np.searchsorted(solid, end)
    some = first < last
    return raw, solid[first[some]], solid[last[some] - 1] + 1


def shingle_parts(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(line number, hash) of the shingles of all lines, in order, at most ``STEP`` at once; lines of fewer characters have none."""
    char = np.flatnonzero((raw & 0xC0) != 0x80)
    first = np.searchsorted(char, start)
    many = np.maximum(np.searchsorted(char, end) - first - (SHINGLE - 1), 0)
    char = np.r_[char, np.full(SHINGLE, len(raw))]
    total = np.r_[0, np.cumsum(many)]
    for low in range(0, int(total[-1]), STEP):
        number = np.arange(low, min(low + STEP, int(total[-1])))
        line = np.searchsorted(total, number, "right") - 1
        place = first[line] + number - total[line]
        begin, stop = char[place], char[place + SHINGLE]
        base = int(begin[0])
        yield line, spans.span_hashes(raw[base:int(stop[-1])], begin - base, stop - base)


def band_keys(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the lines that have shingles, and the keys (band, line) of their bands."""
    least = np.full((ROWS * BANDS, len(start)), 0xFFFFFFFF, np.uint32)
    has = np.zeros(len(start), bool)
    for line, value in shingle_parts(raw, start, end):
        at = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
        own = line[at]
        has[own] = True
        value = (value >> _U(32)).astype(np.uint32)
        for k in range(ROWS * BANDS):
            least[k, own] = np.minimum(least[k, own], np.minimum.reduceat((value ^ _FLIP[k]) * _TIMES[k], at))
    lines = np.flatnonzero(has)
    bands = least[:, lines].astype(np.uint64).reshape(BANDS, ROWS, -1)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], (BANDS, len(lines)))
    for k in range(ROWS):
        keys = spans.mix((keys << _U(32)) ^ (keys >> _U(32)) ^ bands[:, k])
    return lines, keys


def _unsigned(values: np.ndarray) -> np.ndarray:
    return values.view(np.uint64)


def _by_key(key: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, line), sorted, and where each key begins."""
    order = np.lexsort((line, key))
    key, line = key[order], line[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (line[1:] != line[:-1])][:len(key)]
    key, line = key[new], line[new]
    return key, line, np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])


_PACKED = "part int, keys binary, lines binary, known_keys binary, known_lines binary"


def _packed_block(key: np.ndarray, line: np.ndarray, parts_log: int) -> pa.RecordBatch:
    """A block's (key, line) by range: the first line of each key, and all lines of keys that several have (``known``), in any range."""
    key, line, at = _by_key(key, line)
    many = np.diff(np.r_[at, len(key)])
    known = np.repeat(many > 1, many)
    first_key, first_line = key[at], line[at]
    part = (first_key >> _U(64 - parts_log)).astype(np.int64) if parts_log else np.zeros(len(at), np.int64)
    cuts = np.searchsorted(part, np.arange((1 << parts_log) + 1))
    share = np.linspace(0, int(known.sum()), (1 << parts_log) + 1).astype(np.int64)  # spread evenly
    known_key, known_line = key[known], line[known]
    rows = [(p, first_key[a:b].tobytes(), first_line[a:b].tobytes(), known_key[c:d].tobytes(), known_line[c:d].tobytes())
            for p, (a, b, c, d) in enumerate(zip(cuts[:-1], cuts[1:], share[:-1], share[1:])) if a < b or c < d]
    kinds = [pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [c.split()[0] for c in _PACKED.split(", ")])


def bucket_members(docs: DataFrame) -> DataFrame:
    """(key, id) of the lines of every bucket that has several; a row may be there more than once."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts_log = max(0, int(np.ceil(np.log2(max(1, size) / RANGE_BYTES))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for piece in spans.chunks(batch):
                raw, start, end = line_spans(piece.column("text"))
                data, new, ids = raw.tobytes(), [], []
                for i, (a, b) in enumerate(zip(start.tolist(), end.tolist())):
                    own = xxhash.xxh64_intdigest(data[a:b], 42)
                    if own not in seen:
                        seen.add(own)
                        new.append(i)
                        ids.append(own)
                lines, keys = band_keys(raw, start[new], end[new])
                if len(lines):
                    held.append((keys.reshape(-1), np.tile(np.array(ids, np.uint64)[lines], BANDS)))
                if len(seen) >= BLOCK_LINES:
                    if held:
                        yield _packed_block(*map(np.concatenate, zip(*held)), parts_log)
                    seen, held = set(), []
        if held:
            yield _packed_block(*map(np.concatenate, zip(*held)), parts_log)

    def members(key: np.ndarray, line: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(line.view(np.int64))], ["key", "id"])

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have_key = have_line = np.zeros(0, np.uint64)  # the first line of each key
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            nonlocal have_key, have_line, held, size
            own_key, own_line, at = _by_key(np.concatenate([have_key, *(k for k, _ in held)]), np.concatenate([have_line, *(x for _, x in held)]))
            many = np.diff(np.r_[at, len(own_key)])
            shared = np.repeat(many > 1, many)
            have_key, have_line, held, size = own_key[at], own_line[at], [], 0
            return members(own_key[shared], own_line[shared])

        for batch in batches:
            get = lambda name, i: np.frombuffer(batch.column(name)[i].as_buffer(), np.uint64)
            for i in range(batch.num_rows):
                held.append((get("keys", i), get("lines", i)))
                size += len(held[-1][0])
                known = get("known_keys", i)
                if len(known):
                    yield members(known, get("known_lines", i))
                if size > max(HELD, len(have_key)):
                    yield merged()
        yield merged()

    packed = docs.select("text").mapInArrow(pack, _PACKED)
    return packed.groupBy("part").applyInArrow(merge, "key long, id long")


def _pairs(met: DataFrame) -> DataFrame:
    """Distinct (a, b) of rows with an id and a head."""
    return met.where("id <> head").select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct()


def with_degrees(members: DataFrame) -> DataFrame:
    """(key, id, degree): degree is the number of lines in all buckets of the line, greatest for the least edited of a family."""
    distinct = members.distinct()
    sizes = distinct.groupBy("key").agg(F.count("*").alias("size"))
    degrees = distinct.join(sizes, "key").groupBy("id").agg(F.sum("size").alias("degree"))
    return distinct.join(degrees, "id")


def mixed_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``members`` with label and many (lines of the bucket), where a bucket's lines are of several components."""
    lines = members.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = lines.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("many")).where("low <> high")
    return lines.join(mixed.select("key", "many"), "key")


def heads_of_components(mixed: DataFrame, place: int) -> DataFrame:
    """(key, head, head_n, head_alone, head_label): in each bucket the head of the component at this place, greatest degree first."""
    each = mixed.groupBy("key", "label").agg(F.min(F.struct((-F.col("degree")).alias("less"), "id", "n", "alone")).alias("head"))
    order = F.row_number().over(Window.partitionBy("key").orderBy("head"))
    return each.withColumn("place", order).where(F.col("place") == place).select(
        "key", F.col("head.id").alias("head"), F.col("head.n").alias("head_n"), F.col("head.alone").alias("head_alone"), F.col("label").alias("head_label"))


def _left(mixed: DataFrame) -> tuple[int, int]:
    """Lines of mixed buckets and their pairs of different components."""
    each = mixed.groupBy("key", "label").agg(F.count("*").alias("c")).groupBy("key").agg(F.sum("c").alias("t"), F.sum(F.col("c") * F.col("c")).alias("s"))
    lines, pairs = each.agg(F.sum("t"), F.sum((F.col("t").cast("decimal(19,0)") * F.col("t") - F.col("s")) / 2)).first()
    return int(lines or 0), int(pairs or 0)


def cross_pairs(mixed: DataFrame) -> DataFrame:
    """All pairs of different components that share a bucket and may link; hot buckets are dealt out by pairs of chunks."""
    chunks = F.ceil(F.col("many") / CHUNK).cast("long")
    rows = mixed.select("key", "id", "label", "n", "alone", chunks.alias("chunks"), F.pmod(F.xxhash64("id", F.lit(CHUNK)), chunks).alias("chunk"))
    own = rows.select("key", F.col("chunk").alias("i"), F.explode(F.sequence("chunk", F.col("chunks") - 1)).alias("j"), "id", "label", "n", "alone")
    other = rows.select("key", F.explode(F.sequence(F.lit(0).cast("long"), "chunk")).alias("i"), F.col("chunk").alias("j"),
                        *(F.col(c).alias(h) for c, h in (("id", "head"), ("label", "head_label"), ("n", "head_n"), ("alone", "head_alone"))))
    return _pairs(own.join(other, ["key", "i", "j"]).where("label <> head_label and (i < j or id < head)").where(BOUND))


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (id, label) after further edges (a, b)."""
    ends = edges
    for c in ("a", "b"):
        ends = ends.join(labels.select(F.col("id").alias(c), F.col("label").alias(f"label_{c}")), c, "left")
    ends = written(ends.select("a", "b", F.coalesce("label_a", "a").alias("label_a"), F.coalesce("label_b", "b").alias("label_b")), "ends")
    every = labels.union(ends.select("a", "label_a")).union(ends.select("b", "label_b")).distinct()
    found = components(ends.select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))).select(F.col("node").alias("label"), F.col("label").alias("to"))
    out = written(every.join(found, "label", "left").select("id", F.coalesce("to", "label").alias("label")), "merged")
    freed(ends, labels)
    return out


def shared_shingles(lines: DataFrame) -> dict:
    """Bitmap of the hashes of shingles that lines of several components have; ``lines``: label and body.

    Components are counted by hash range, like the shingles of ``jaccard_join``.  At most 2**``MOST_BITS`` bits reach the driver and the
    workers; beyond that more shingles count as shared, which weakens ``may_link`` and loses nothing.
    """
    total = lines.agg(F.sum(F.char_length("body"))).first()[0] or 0
    bits = int(min(MOST_BITS, max(16, np.ceil(np.log2(max(2, total))) + 3)))
    parts_log = min(max(0, int(np.ceil(np.log2(max(1, total) / BUCKET_TOKENS)))), bits - 3)

    def flush(keys: list[np.ndarray]) -> pa.RecordBatch:
        cuts = np.arange((1 << parts_log) + 1, dtype=np.uint64)
        every = []
        for x in packed_tokens(np.concatenate(keys), []):
            part = x >> _U(TOKEN_BITS + SET_BITS - parts_log) if parts_log else np.zeros(len(x), np.uint64)
            every.append((x, np.searchsorted(part, cuts)))
        rows = [(p, *(x[at[p]:at[p + 1]].tobytes() for x, at in every)) for p in range(1 << parts_log)]
        rows = [r for r in rows if r[1] or r[2]]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.binary()))],
                                          ["part", "single", "many"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in spans.chunks(batch, "body"):
                owner = spans.mix(piece.column("label").to_numpy().view(np.uint64)) >> _U(64 - SET_BITS)
                line, value = _distinct_shingles(piece.column("body"), 0, 1)
                held.append(((value >> _U(64 - TOKEN_BITS)) << _U(SET_BITS)) | owner[line])
                size += len(line)
                if size > HELD // 2:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, many, held, size = np.zeros(0, np.uint64), [], [], 0
        for batch in batches:
            for x, m in zip(batch.column("single"), batch.column("many")):
                held.append(np.frombuffer(x.as_buffer(), np.uint64))
                many.append(np.frombuffer(m.as_buffer(), np.uint64))
                size += len(held[-1]) + len(many[-1])
                if size > BUCKET_TOKENS:
                    single, more = packed_tokens(np.concatenate([single, *held]), many)
                    held, many, size = [], [more], 0
        _, shared = packed_tokens(np.concatenate([single, *held]), many)
        width = 1 << (bits - parts_log)
        segment = np.zeros(width, np.uint8)
        segment[(shared >> _U(SET_BITS + TOKEN_BITS - bits)).astype(np.int64) - key[0].as_py() * width] = 1
        yield pa.RecordBatch.from_arrays([key[0].cast(pa.int32()).as_py() * np.ones(1, np.int32), pa.array([np.packbits(segment).tobytes()], pa.binary())],
                                         ["part", "data"])

    found = written(lines.select("label", "body").mapInArrow(pack, "part int, single binary, many binary").groupBy("part").applyInArrow(
        merge, "part int, data binary"), "shared")
    width = 1 << (bits - parts_log - 3)
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for row in found.toLocalIterator():
        bitmap[row.part * width:(row.part + 1) * width] = np.frombuffer(row.data, np.uint8)
    freed(found)
    return {"bits": bits, "bitmap": bitmap}


def may_link(mixed: DataFrame, known: DataFrame) -> DataFrame:
    """``mixed`` with n (shingles of a line) and alone (those of no other component), without lines that can't link with any.

    A line of which more than a fifth is in its own component alone has no similarity of 0.8 with a line of another.
    """
    lines = written(mixed.select("id", "label").distinct().join(known, "id"), "mixed-lines")
    shared = mixed.sparkSession.sparkContext.broadcast(shared_shingles(lines))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, bitmap = shared.value["bits"], shared.value["bitmap"]
        for batch in batches:
            for piece in spans.chunks(batch, "body"):
                line, value = _distinct_shingles(piece.column("body"), 0, 1)
                at = (value >> _U(64 - bits)).astype(np.int64)
                hit = ((bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)
                n = np.bincount(line, minlength=piece.num_rows)
                alone = np.bincount(line[~hit], minlength=piece.num_rows)
                yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(n, pa.int64()), pa.array(alone, pa.int64())], ["id", "n", "alone"])

    sizes = lines.select("id", "body").mapInArrow(run, "id long, n long, alone long").where(f"{DENOMINATOR} * (n - alone) >= {NUMERATOR} * n")
    out = written(mixed.drop("many").join(sizes, "id"), "may-link")
    freed(lines)
    return out


#: what two lines can share at most, against the overlap that links sets of these sizes
BOUND = f"{NUMERATOR + DENOMINATOR} * least(n - alone, head_n - head_alone) >= {NUMERATOR} * (n + head_n)"


def linked(members: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, label) of the lines that link with a different line of one of their buckets."""
    known = bodies(members, lines)
    heads = members.groupBy("key").agg(F.min(F.struct((-F.col("degree")).alias("less"), "id")).alias("head"))
    tried = written(_pairs(members.join(heads.select("key", F.col("head.id").alias("head")), "key")), "candidates")
    edges = written(similar(tried, known), "similar")
    labels = components(edges).withColumnRenamed("node", "id")
    first = written(mixed_buckets(members, labels), "mixed")
    bounds = may_link(first, known)
    mixed, before = written(mixed_buckets(bounds.drop("label"), labels), "mixed"), None
    freed(first)
    for turn in range(MOST_TURNS + 1):
        rows, pairs = _left(mixed)
        if not pairs:
            break
        every = turn == MOST_TURNS or pairs <= FEW * rows or before is not None and before - pairs < FEW * rows
        if every:
            found = cross_pairs(mixed)
        else:  # the head of a further component
            found = _pairs(mixed.join(heads_of_components(mixed, turn + 2), "key").where("label <> head_label").where(BOUND).select("id", "head"))
        more = written(found.join(tried, ["a", "b"], "left_anti"), "candidates")
        further = written(similar(more, known), "similar")
        freed(more)
        if not further.isEmpty():
            labels = merged(labels, further)
        freed(further)
        if every:
            break
        after = written(mixed_buckets(mixed.drop("label", "many"), labels), "mixed")
        freed(mixed)
        mixed, before = after, pairs
    freed(known, tried, edges, bounds, mixed)
    return labels


def bodies(members: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, body) of the lines in buckets."""
    wanted = members.select("id").distinct()
    # a first look at 20 bits of the id keeps most other lines out of the shuffle; 2**20 numbers at most are broadcast
    prefix = F.shiftrightunsigned("id", 44).alias("prefix")
    near = lines.select("id", "body", prefix).join(F.broadcast(wanted.select(prefix).distinct()), "prefix", "left_semi")
    return written(near.select("id", "body").dropDuplicates(["id"]).join(wanted, "id", "left_semi"), "bodies")


def _distinct_shingles(texts: pa.Array, share: int, of: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of each line's different shingles, sorted; of several parts of all hashes the one asked for."""
    raw, at = spans.flat(texts)
    found = []
    for line, value in shingle_parts(raw, at[:-1], at[1:]):
        if of > 1:
            own = value % _U(of) == share
            line, value = line[own], value[own]
        found.append((line, value))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    line, value = (np.concatenate(x) for x in zip(*found))
    order = spans.by_doc(line, value)
    line, value = line[order], value[order]
    new = np.r_[True, (line[1:] != line[:-1]) | (value[1:] != value[:-1])][:len(line)]
    return line[new], value[new]


def _link(x: pa.Scalar, y: pa.Scalar) -> bool:
    """Do two lines link?  Part by part of all hashes, for very long ones."""
    texts = [pa.array([t.as_py()], pa.large_string()) for t in (x, y)]
    passes = 1 + sum(len(spans.flat(t)[0]) for t in texts) // LONG
    both = size = 0
    for p in range(passes):
        one, other = (_distinct_shingles(t, p, passes)[1] for t in texts)
        size += len(one) + len(other)
        both += len(np.intersect1d(one, other, assume_unique=True))
    return size > 0 and (NUMERATOR + DENOMINATOR) * both >= NUMERATOR * size


def similar(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard similarity of 0.8 or more; ``known``: id and body."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.concatenate([batch.column(c).to_numpy() for c in ("a", "b")])
            lines, first, which = np.unique(ids, return_index=True, return_inverse=True)
            texts = pa.chunked_array([batch.column(c) for c in ("body_a", "body_b")]).combine_chunks().take(pa.array(first))
            size = np.diff(spans.flat(texts)[1])
            sets: list[np.ndarray | None] = [None] * len(lines)  # a line of many pairs is worked on once
            short = np.flatnonzero(size <= LONG)
            own = pa.RecordBatch.from_arrays([pa.array(short), texts.take(pa.array(short))], ["line", "text"])
            for piece in spans.chunks(own):
                line, value = _distinct_shingles(piece.column("text"), 0, 1)
                cuts = np.searchsorted(line, np.arange(piece.num_rows + 1))
                for k, i in enumerate(piece.column("line").to_pylist()):
                    sets[i] = value[cuts[k]:cuts[k + 1]]
            good = np.zeros(batch.num_rows, bool)
            for k, (i, j) in enumerate(zip(which[:batch.num_rows].tolist(), which[batch.num_rows:].tolist())):
                x, y = sets[i], sets[j]
                if x is None or y is None:
                    good[k] = _link(texts[i], texts[j])
                    continue
                if len(x) > len(y):
                    x, y = y, x
                if not len(x) or DENOMINATOR * len(x) < NUMERATOR * len(y):
                    continue
                both = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)
                good[k] = (NUMERATOR + DENOMINATOR) * both >= NUMERATOR * (len(x) + len(y))
            yield batch.select(["a", "b"]).filter(pa.array(good))

    both = pairs.join(known.select(F.col("id").alias("a"), F.col("body").alias("body_a")), "a").join(
        known.select(F.col("id").alias("b"), F.col("body").alias("body_b")), "b")
    return both.mapInArrow(run, "a long, b long")


LAST = (1 << 63) - 1


def _document() -> list:
    """What a document is known by: its order by id, and a hash of its text."""
    return [F.coalesce(F.col("doc_id"), F.lit(LAST)).alias("order"), F.xxhash64("text").alias("own")]


def _occurrences(texts: DataFrame) -> DataFrame:
    """(order, own, no, id, body) of every line that is compared."""
    rows = texts.select(*_document(), "text")  # by itself: beside the generator, the text would be hashed again for each line
    rows = rows.select("order", "own", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    rows = rows.select("order", "own", "no", F.trim("line").alias("body")).where("body <> ''")
    return rows.withColumn("id", F.xxhash64("body"))


def line_labels(docs: DataFrame) -> DataFrame:
    """(id, label) of the lines that link with a different line."""
    ship(docs.sparkSession)
    texts = _texts(docs)
    found = written(bucket_members(texts), "members")
    members = written(with_degrees(found), "degrees")
    freed(found)
    out = linked(members, _occurrences(texts))
    freed(members)
    return out


def removed_lines(docs: DataFrame) -> DataFrame:
    """(order, own, gone): for each document that loses lines their numbers."""
    labels = line_labels(docs)
    lines = _occurrences(_texts(docs)).drop("body")
    place = F.struct("order", "own", "no")
    first = lines.groupBy("id").agg(F.min(place).alias("least"), F.max(place).alias("last"))  # a hot line sends a row a task
    first = first.join(labels, "id", "left")
    # lines without links are their own component; of linked ones the least place of all counts
    least = first.where("label is not null").groupBy("label").agg(F.min("least").alias("best"))
    decided = first.where("label is not null").join(least, "label").select("id", F.col("best").alias("stays"))
    decided = written(decided.union(first.where("label is null and least <> last").select("id", "least")), "decided")
    gone = lines.join(decided, "id").where(place != F.col("stays")).select("order", "own", "no").distinct()
    return gone.groupBy("order", "own").agg(F.collect_list("no").alias("gone"))  # at most a document's lines


def without_similar_lines(docs: DataFrame, removed: bool = False) -> DataFrame:
    """``docs`` without the lines that go; ``removed``: their number as a last column of that name."""
    names = docs.columns
    frame = numbered(docs)
    columns, text = frame.columns, f"c{names.index('text')}"
    keyed = frame.withColumn(text, F.col(text).cast("string")).withColumns(
        {"order": F.coalesce(F.col(f"c{names.index('doc_id')}").cast("long"), F.lit(LAST)), "own": F.xxhash64(F.col(text))})
    joined = keyed.join(removed_lines(docs), ["order", "own"], "left").select(*columns, "gone")

    def rebuilt(value: str, numbers: list[int]) -> str:
        drop = set(numbers)
        return "\n".join(line for k, line in enumerate(value.split("\n")) if k not in drop)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in spans.chunks(batch, text):
                gone, values = part.column("gone").to_pylist(), part.column(text)
                new = values
                if any(gone):
                    new = pa.array([rebuilt(v.as_py(), g) if g else v.as_py() for v, g in zip(values, gone)], pa.string())
                number = pa.array([len(g) if g else 0 for g in gone], pa.int64())
                yield pa.RecordBatch.from_arrays([*(new if c == text else part.column(c) for c in columns), number], [*columns, "removed"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.select(*columns).schema.fields)
    out = joined.mapInArrow(run, f"{kinds}, removed long")
    return out.toDF(*names, "removed") if removed else out.drop("removed").toDF(*names)


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (as they were), n_removed and kept_sha256 (of the text that is left) of every row."""
    rows = _texts(docs).withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long"))
    out = without_similar_lines(rows, removed=True)
    return out.select("doc_id", "n_lines", F.col("removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
