import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lunchbox.llm import fingerprint as P, token_files as S

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("ids", [
    np.zeros(0, np.uint64), np.zeros(1, np.uint64), np.zeros(5000, np.uint64), np.full(1025, 1 << 59, np.uint64),
    np.array([2 ** 64 - 1, 0, 2 ** 60, 2 ** 60 - 1, 5], np.uint64), np.random.default_rng(0).integers(0, 50257, 30_000).astype(np.uint64),
    np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64) >> np.random.default_rng(2).integers(0, 63, 5000).astype(np.uint64),
])
def test_packing_round_trip(ids):
    words, offsets, escapes = S.pack(ids)
    assert (S.unpack(words, escapes) == ids).all()
    data = S.record([5, None], [ids, ids[:3]])
    doc_ids, lengths, back = S.parsed(data)
    assert doc_ids == [5, None] and lengths.tolist() == [len(ids), len(ids[:3])] and (back == np.r_[ids, ids[:3]]).all()
    both = np.r_[ids, ids[:3]]
    for k in range(len(range(0, len(both), S.BLOCK))):
        assert (S.block(data, k) == both[k * S.BLOCK:(k + 1) * S.BLOCK]).all()


def files_of(docs):
    return [tuple(r) for r in S.read(S.write(docs, PATH)).orderBy("start").collect()]


def test_files_equal_the_library(documents, edges, empty):
    library = Tokenizer.from_file(PATH)
    for docs in (documents.select("doc_id", "text"), edges):
        start, want = 0, {}
        got = files_of(docs)
        ids = [r[0] for r in got]
        assert ids == sorted(ids, key=lambda i: -(1 << 63) if i is None else i)
        for r in docs.select("doc_id", "text").collect():
            own = library.encode(r.text or "", add_special_tokens=False).ids + [2]
            want.setdefault(r.doc_id, []).append((len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        for doc_id, begin, n, crc in got:
            assert begin == start
            want[doc_id].remove((n, crc))
            start += n
        assert not any(want.values())
    assert files_of(empty) == []


def test_multiset_of_paragraphs():
    s = P.of_texts(pa.array(["a\nb", "b\na", "a\nb\n", "", "a\nb\nb", "\n", "A\nb", None, "x y z w\nq", "q\nx y z w"])).strings()
    assert [s.index(x) for x in s] == [0, 0, 2, 3, 4, 5, 6, 3, 8, 8]
    one, b = P.of_texts(pa.array(["a\nb"])), P.of_texts(pa.array(["b"]))
    more = P.inserted(one, b)
    assert more.strings()[0] == s[4] and P.deleted(more, b).strings()[0] == s[0]
    assert P.deleted(one, b).strings() == P.of_texts(pa.array(["a"])).strings()


def test_edited_and_next_documents(documents, texts):
    rows = {r.doc_id: r for r in P.edited_pairs(documents).collect()}
    order = sorted(texts, reverse=True)
    single = dict(zip([i for i, _ in order], P.of_texts(pa.array([t for _, t in order])).strings()))
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        r, n = rows[i], len(t or "")
        edited = (t or "")[:n - n // 2] + (after or "")[:n // 2]
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (n, hashlib.sha256(edited.encode()).hexdigest(), single[i])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert np.mean([r.near_edited > r.near_next for r in rows.values()]) > 0.95


def test_fingerprint_edges(spark, edges, empty):
    rows = P.edited_pairs(edges).collect()
    assert len(rows) == edges.count() and sorted(r.n_chars for r in rows) == sorted(len(r.text or "") for r in edges.collect())
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    assert P.edited_pairs(empty).count() == 0
    single = P.edited_pairs(spark.createDataFrame([(3, "abcd")], "doc_id long, text string")).first()
    assert single.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and single.near_next == 1.0
    assert P.fingerprints(edges).count() == edges.count()


def test_likeness_of_very_many_repeats(spark):
    line = "one line that a log file repeats very often\n"
    prints = P.of_texts(pa.array([line * 40_000, line * 20_000, line * 70_000]))
    assert prints.likeness(prints.take([1, 2, 0])).min() > 0.999999
