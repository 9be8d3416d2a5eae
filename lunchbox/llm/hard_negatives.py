"""Hard negatives by slots: for each positive of an anchor, the closest rows of other labels within a share of its score.

A row's score is its integer inner product with the anchor (components floor(``SCALE`` * x)).  An
anchor's positives are its first ``POSITIVES`` other rows of the same label.  A positive of score p
wants the first ``NEGATIVES`` rows of other labels with LOW * p <= 100 * score <= 100 * p: windows that
overlap and share rows.

1.  Anchors are read in blocks of a fixed number of bytes (``BLOCK_BYTES``), each broadcast in turn; every task
    multiplies its rows, chunk by chunk, with the block.
2.  First pass (``_same_label``): each task keeps the first rows of the anchor's label for each anchor (a combiner);
    a window over those gives the positives.
3.  Second pass (``_other_labels``): the positives' scores, each different one the upper limit of a window, cut the scores into
    disjoint slots.  A row falls into one slot of an anchor; each task keeps the first ``NEGATIVES`` rows
    of each slot, and a window over those keeps as many of all tasks.
4.  Suffix merge (``mined``): what a positive may have lies in its own slot and the lower ones.  The
    slots, one after the other downwards, give its first rows; those under its lower limit fall
    away.  Every window is answered by the same at most POSITIVES * NEGATIVES rows of an anchor.

Equal vectors of one label have equal scores with everything, so of a chunk's copies only the first few by id can
be returned; the others are left out before the multiplication.  That keeps a hot vector cheap and loses nothing.

Results are exact: products are whole numbers, held by single or double precision where the sizes
allow, and by 64-bit integers otherwise.  All rows of the commonest vector length (the greatest of equally common ones) are
searched for each anchor; no candidate is dropped by a sample or cap.

Defined cases: a row takes no part without an id, a label or a vector, with a null or non-finite component or one
beyond 2**17, or with another length.  Rows of one id are rows of their own, but a row with the
anchor's id is neither its positive nor its negative, and each row of an anchor's id is an anchor.  Ties go to the smaller id.  An
anchor without positives, a positive below 0 and one without rows in its window have no rows.  Of positives with equal
scores each has the same negatives.  Further columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lunchbox.llm.runtime import ship, written

SCALE, MOST_ENTRY, MOST_WIDTH = 256, 1 << 17, 1 << 12
ANCHOR_EVERY, POSITIVES, NEGATIVES, LOW = 100, 5, 5, 80
#: bytes of an anchor block (eight a component), rows of a chunk and anchors that are multiplied at once
BLOCK_BYTES, CHUNK, GROUP = 16 << 20, 4096, 1024

#: the contract's label: where the id is divisible by 7, the next one of ten
SHIFTED_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"

_LEAST = np.iinfo(np.int64).min


def usable(embeddings: DataFrame, label: str = "label") -> DataFrame:
    """(vec_id, label, width, embedding) of the rows that take part, but for their length."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                             F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where("vec_id is not null and label is not null and size(embedding) > 0")
    rows = rows.where(F.forall("embedding", lambda c: F.coalesce(F.abs(c) <= MOST_ENTRY, F.lit(False))))  # NaN is greater
    return rows.select("vec_id", F.expr(label).alias("label"), F.size("embedding").alias("width"), "embedding")


def _whole(column: pa.Array, width: int) -> np.ndarray:
    """floor(SCALE * x) of a list column of equal lengths, a row a vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False)).astype(np.int64).reshape(-1, width)


def _first_copies(ids: np.ndarray, labels: np.ndarray, x: np.ndarray, most: int) -> np.ndarray:
    """Numbers of rows by id, without those copies (label and vector) that can't be among an anchor's first ``most``.

    A copy goes if it is beyond the first ``most`` of its id, or if 2 * ``most`` are before it, of which
    ``most`` at least have another id than any one anchor.
    """
    order = np.argsort(ids, kind="stable")
    key = np.ascontiguousarray(np.c_[labels, x][order]).view([("", np.void, 8 * (x.shape[1] + 1))]).reshape(-1)
    kind = np.unique(key, return_inverse=True)[1]
    by = np.argsort(kind, kind="stable")  # by kind, then id
    by = by[_rank(kind[by], ids[order][by]) < most]
    by = by[_rank(kind[by]) < 2 * most]
    return order[np.sort(by)]


def _rank(*columns: np.ndarray) -> np.ndarray:
    """Number of each row in its run of equal rows, from 0."""
    at = np.arange(len(columns[0]))
    new = np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])][:len(at)]
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of two sets of whole vectors, exact."""
    bound = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return a.astype(kind) @ b.astype(kind).T


class _Best:
    """The first ``most`` (score, id) of each (anchor, slot): higher scores first, then smaller ids."""

    def __init__(self, anchors: int, slots: int, most: int):
        self.slots, self.most = slots, most
        self.place, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        #: score of the last of a full slot
        self.least = np.full(anchors * slots, _LEAST)

    def add(self, place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(place):
            return
        place, score, ids = np.r_[self.place, place], np.r_[self.score, score], np.r_[self.id, ids]
        order = np.lexsort((ids, -score, place))
        place, score, ids = place[order], score[order], ids[order]
        begin = np.searchsorted(place, place)
        rank = np.arange(len(place)) - begin
        keep = rank < self.most
        full = rank == self.most - 1
        self.least[place[full]] = score[full]
        self.place, self.score, self.id = place[keep], score[keep], ids[keep]


@dataclass
class Anchors:
    """A block of anchors by label: number in the block, id, label and vector; in the second pass also the slots' upper limits."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    #: (anchor, slot): upper limits, falling; unused slots have the least integer
    upper: np.ndarray | None = None
    #: the least score that one of the anchor's windows takes
    low: np.ndarray | None = None


def _chunks(batches: Iterator[pa.RecordBatch], width: int, most: int):
    """(ids, labels, vectors) of chunks of rows, the first ones small, so that bounds are known early."""
    size = 256
    for batch in batches:
        ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
        x = _whole(batch.column("embedding"), width)
        at = 0
        while at < len(ids):
            part = slice(at, at + size)
            keep = _first_copies(ids[part], labels[part], x[part], most)
            yield ids[part][keep], labels[part][keep], x[part][keep]
            at, size = at + size, min(2 * size, CHUNK)


def _found(best: list[tuple[int, _Best]]) -> Iterator[pa.RecordBatch]:
    for first, own in best:
        yield pa.RecordBatch.from_arrays([pa.array(own.place // own.slots + first, pa.int32()), pa.array(own.place % own.slots, pa.int32()),
                                          pa.array(own.score), pa.array(own.id)], ["anchor", "slot", "score", "id"])


_FOUND = "anchor int, slot int, score long, id long"


def _same_label(rows: DataFrame, shared, width: int) -> DataFrame:
    """First pass: each task's first POSITIVES rows of each anchor's label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Anchors = shared.value
        kinds, first = np.unique(own.labels, return_index=True)
        last = np.r_[first[1:], len(own.labels)]
        groups = [(k, a, min(a + GROUP, z)) for k, f, z in zip(kinds, first, last) for a in range(f, z, GROUP)]
        best = [(a, _Best(z - a, 1, POSITIVES)) for _, a, z in groups]
        for ids, labels, x in _chunks(batches, width, POSITIVES):
            of = {k: np.flatnonzero(labels == k) for k in np.intersect1d(kinds, labels)}
            for (kind, a, z), (_, top) in zip(groups, best):
                if (r := of.get(kind)) is None:
                    continue
                score = _product(own.x[a:z], x[r])
                # a row with the anchor's own id doesn't count, so it can't make a bound either
                wanted = (score >= top.least[:, None]) & (own.ids[a:z, None] != ids[r][None, :])
                at, row = np.nonzero(wanted)
                top.add(at.astype(np.int64), score[at, row].astype(np.int64), ids[r[row]])
        yield from _found(best)

    return rows.mapInArrow(run, _FOUND)


def _other_labels(rows: DataFrame, shared, width: int) -> DataFrame:
    """Second pass: each task's first NEGATIVES rows of other labels in each slot of each anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Anchors = shared.value
        slots = own.upper.shape[1]
        groups = [(a, min(a + GROUP, len(own.ids))) for a in range(0, len(own.ids), GROUP)]
        best = [(a, _Best(z - a, slots, NEGATIVES)) for a, z in groups]
        for ids, labels, x in _chunks(batches, width, NEGATIVES):
            for (a, z), (_, top) in zip(groups, best):
                score = _product(own.x[a:z], x)
                other = (own.labels[a:z, None] != labels[None, :]) & (own.ids[a:z, None] != ids[None, :])
                other &= score >= own.low[a:z, None]
                least = top.least.reshape(-1, slots)
                for s in range(slots):
                    upper = own.upper[a:z, s]
                    below = own.upper[a:z, s + 1] if s + 1 < slots else np.full(z - a, _LEAST)
                    used = np.flatnonzero(upper > _LEAST)
                    if not len(used):
                        continue
                    part = score[used] if len(used) < z - a else score
                    wanted = (part <= upper[used, None]) & (part > below[used, None]) & (part >= least[used, s, None]) & other[used]
                    at, row = np.nonzero(wanted)
                    top.add(used[at] * slots + s, part[at, row].astype(np.int64), ids[row])
        yield from _found(best)

    return rows.mapInArrow(run, _FOUND)


def _first(found: DataFrame, most: int) -> DataFrame:
    """``found`` with its rank (from 1) in its anchor's slot; the first ``most``."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def blocks(anchors: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges [from, to) of ``at`` (partition, then row) with at most ``most`` anchors each; ``anchors`` is a written table."""
    own = anchors.groupBy((F.shiftright("at", 33)).alias("part"), F.floor(F.col("at").bitwiseAND((1 << 33) - 1) / most).alias("piece"))
    out, size = [], most + 1
    for row in own.agg(F.min("at").alias("least"), F.count("*").alias("n")).orderBy("least").toLocalIterator():
        if size + row.n > most:
            out.append(row.least)
            size = 0
        size += row.n
    return list(zip(out, [*out[1:], (1 << 63) - 1]))


def mined(embeddings: DataFrame, label: str = "label", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``label``: SQL over vec_id and label."""
    spark = embeddings.sparkSession
    ship(spark)
    rows = usable(embeddings, label)
    top = rows.groupBy("width").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    width = top.width if top else 1
    if width > MOST_WIDTH:
        raise ValueError(f"vectors have {width} components, {MOST_WIDTH} are the most")
    rows = rows.where(F.col("width") == width).select("vec_id", "label", "embedding")
    anchors = written(rows.where(F.col("vec_id") % ANCHOR_EVERY == 0).withColumn("at", F.monotonically_increasing_id()), "anchors")
    out = None
    for low, high in blocks(anchors, max(1, block_bytes // (8 * width))):
        part = written(_block(anchors.where((F.col("at") >= low) & (F.col("at") < high)), rows, width), "negatives")
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], _RESULT)


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _block(anchors: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """The result's rows of one block of anchors."""
    spark = rows.sparkSession
    table = anchors.select("vec_id", "label", "embedding").toArrow().sort_by([("label", "ascending"), ("vec_id", "ascending")])
    own = Anchors(table.column("vec_id").to_numpy(), table.column("label").to_numpy(), _whole(table.column("embedding"), width))
    positives = written(_first(_same_label(rows, spark.sparkContext.broadcast(own), width), POSITIVES), "positives")

    found = positives.select("anchor", "rank", "score").toArrow()  # POSITIVES numbers an anchor of the block
    at, rank, score = (found.column(c).to_numpy() for c in ("anchor", "rank", "score"))
    limits = np.full((len(own.ids), POSITIVES), _LEAST)
    limits[at, rank - 1] = score
    limits[:, 1:][limits[:, 1:] == limits[:, :-1]] = _LEAST  # equal scores make one slot
    limits[limits < 0] = _LEAST  # LOW * p > 100 * p: an empty window
    own.upper = np.ascontiguousarray(np.sort(limits, axis=1)[:, ::-1])
    used = np.where(own.upper == _LEAST, np.iinfo(np.int64).max, own.upper).min(1)
    own.low = np.array([-(-LOW * int(p) // 100) if p < np.iinfo(np.int64).max else 0 for p in used], np.int64)
    negatives = _first(_other_labels(rows, spark.sparkContext.broadcast(own), width), NEGATIVES)

    # slots of an anchor downwards, at most POSITIVES * NEGATIVES rows
    merged = negatives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "rank", "score", "id"))).alias("all"))
    slot = F.dense_rank().over(Window.partitionBy("anchor").orderBy(F.desc("positive_score"))) - 1
    wanting = positives.where("score >= 0").select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    wanting = wanting.withColumn("own", slot).join(merged, "anchor")
    first = F.slice(F.filter("all", lambda r: r["slot"] >= F.col("own")), 1, NEGATIVES)
    times = lambda score, n: score.cast("decimal(20,0)") * n
    inside = F.filter(first, lambda r: times(r["score"], 100) >= times(F.col("positive_score"), LOW))
    each = wanting.select("anchor", "positive_id", "positive_score", F.posexplode(inside).alias("place", "row"))
    ids = spark.createDataFrame(pa.table({"anchor": pa.array(np.arange(len(own.ids), dtype=np.int32)), "anchor_id": own.ids}))  # a block's
    return each.join(F.broadcast(ids), "anchor").select("anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("row.id").alias("negative_id"),
                                                        "positive_score", F.col("row.score").alias("negative_score"))


#: the same rows by plain SQL: all products of anchors and rows
SQL = f"""
WITH own AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own_label, r.vec_id, r.label, list_inner_product(a.x, r.x)::BIGINT AS score
  FROM own a JOIN own r ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> r.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
inside AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.own_label
   AND {LOW} * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM inside WHERE rank <= {NEGATIVES}
"""
