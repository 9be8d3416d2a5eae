"""Quality: held-out accuracy, the outline against a plain version, edge cases."""

import re
import zlib

import numpy as np
import pyarrow as pa
from brute import EDGES

from lunchbox.llm import quality, spans


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.scores(documents, labels).join(labels, "doc_id").where("held_out").collect()
    assert rows and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.98
    assert np.mean([s >= 0.3 for s in good]) > 0.98 and np.mean([s < 0.3 for s in bad]) > 0.85


def plain_outline(text):
    def letter(match):
        word = match.group(0)
        return bytes([(96 if re.search(rb"[a-z]", word) else 64) + min(len(word), 26)])
    return re.sub(rb"[A-Za-z\x80-\xff]+", letter, text.encode())


def test_outline_against_plain_version():
    texts = [t or "" for _, t in EDGES] + ["ABC def GHi. 12x", "é!É!ß", "a", "", "b" * 40, " end"]
    raw, at = spans.flat(pa.array(texts))
    out, out_at = quality.outlines(raw, at)
    assert [out[out_at[i]:out_at[i + 1]].tobytes() for i in range(len(texts))] == [plain_outline(t) for t in texts]


def test_training_reads_no_held_out_label(spark):
    documents = spark.createDataFrame([(i, f"{'good words here' if i % 2 else 'BAD!! TEXT!!'} {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    other = spark.createDataFrame([(i, i % 2 if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2) for i in range(400)], "doc_id long, quality int")
    one = {r.doc_id: r.score for r in quality.scores(documents, labels).collect()}
    assert one == {r.doc_id: r.score for r in quality.scores(documents, other).collect()}
    assert all((s >= 0.3) == bool(i % 2) for i, s in one.items())


def test_quality_edges(spark, edges, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int, text string, score int")
    rows = quality.scores(edges, none).collect()
    assert len(rows) == edges.count() and {r.score for r in rows} == {0.5}
    labels = spark.createDataFrame([(i, int(i in (7, 9, 15, 5, 12)), 1, "t", 1) for i in (2, 4, 5, 6, 7, 8, 9, 12, 13, 15, 16, 11)] + [
        (None, 1, 1, "t", 1), (4, None, 1, "t", 1), (7, 0, 1, "t", 1)], none.schema)
    rows = quality.scores(edges, labels).collect()
    assert len(rows) == edges.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1  # null and empty
    assert all(r.held_out is None for r in rows if r.doc_id is None)
    assert quality.scores(empty, labels).count() == 0
    assert quality.good_documents(edges, labels).columns == edges.columns
    ones = spark.createDataFrame([(4, 1, 1, "t", 1), (7, 1, 1, "t", 1)], none.schema)
    assert all(r.score > 0.5 for r in quality.scores(edges, ones).collect())
