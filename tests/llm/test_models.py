"""Learned operators: held-out accuracy, exact parts against plain versions, edge cases."""

import collections
import math
import zlib

import brute
import numpy as np
import pytest
from brute import SF
from pyspark.sql import functions as F

from lunchbox.llm import language, language_model, toxicity


def crc(i):
    return zlib.crc32(str(i).encode())


def test_language_of_held_out_documents(documents):
    out = language.predicted(documents).join(documents.select("doc_id", "lang"), "doc_id")
    rows = [r for r in out.collect() if r.held_out]
    assert rows and all(crc(r.doc_id) % 4 == 2 and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


def test_language_edges(spark, edges, empty):
    rows = language.predicted(edges).collect()
    assert len(rows) == edges.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (1, 2, 3, 10, 14))
    assert all(r.lang_pred == "en" for r in rows if r.doc_id in (4, 7, 11))
    assert all(r.held_out is None for r in rows if r.doc_id is None)
    assert language.predicted(empty).count() == 0
    unlabelled = language.predicted(edges.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 9, 20])
def test_codewords_differ(n):
    code = language.codewords(n)
    assert len({tuple(row) for row in code}) == n
    assert all(abs(code.sum(0)) < n)


def test_language_model_against_counts(documents, texts):
    rows = {r.doc_id: r for r in language_model.scores(documents).collect()}
    tokens = {i: brute.BLANK_WORDS.findall(brute.lower(t)) + [None] for i, t in texts}
    count = collections.Counter(w for i, ws in tokens.items() if crc(i) % 7 != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(ws), sum(count[w] > 0 for w in ws), n, crc(i) % 7 == 2)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    other = {r.doc_id: r.score for r in language_model.scores(documents, most_bytes=0).collect()}
    assert all(math.isclose(rows[i].score, s, rel_tol=1e-12) for i, s in other.items())


def test_filter_reads_back_levels():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 20_000).astype(np.uint64) * np.uint64(2))
    counts = rng.geometric(0.3, len(keys)).astype(np.int64) ** 3
    one = language_model.Filter([language_model.segment(keys, counts)])
    want = language_model._count_level(counts)
    assert (one.levels(keys) >= want).all() and (one.levels(keys) == want).mean() > 0.999
    assert (language_model.level_count(want) <= counts).all()
    assert (one.levels(keys + np.uint64(1)) > 0).mean() < 0.001


def test_language_model_edges(edges, empty):
    rows = language_model.scores(edges).collect()
    assert len(rows) == edges.count()
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (1, 2, 3, 10))
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert language_model.scores(empty).count() == 0
    nothing = language_model.scores(edges.where("doc_id is null")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in nothing)


def test_toxicity_of_held_out_documents(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity.scores(documents, labels).join(labels, "doc_id").where("held_out").collect()
    assert rows and all(crc(r.doc_id) % 3 == 1 and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    mine, clean = [r.score for r in rows if r.toxic == 1], [r.score for r in rows if r.toxic == 0]
    assert np.mean([a > b for a in mine for b in clean]) > 0.9
    assert np.mean([s >= 0.7 for s in clean]) < 0.05


def test_misspellings_share_vectors():
    rng = np.random.default_rng(2)
    calm = ["table", "window", "garden", "river", "yellow", "music", "paper", "stone", "bread", "cloud"]
    texts, y = [], []
    for k in range(300):
        words = list(rng.choice(calm, 30))
        if k % 2:
            words[5] = rng.choice(["grumblefink", "grumblefunk", "grumblefonk"])
        texts.append(" ".join(words))
        y.append(k % 2)
    model = toxicity.train(texts, np.array(y))
    import pyarrow as pa
    calm_text = " ".join(calm * 50)
    score = model.score(toxicity.logits(pa.array([calm_text, calm_text + " Grumblefenk", "grumblefank"]), model))
    assert score[0] < 0.5 and score[1] > 0.7 and score[2] > 0.7


def test_toxicity_edges(spark, edges, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.scores(edges, none).collect()
    assert len(rows) == edges.count() and all(0 <= r.score < 0.7 for r in rows)
    labels = spark.createDataFrame([(i, 1, int(i in (7, 9, 15))) for i in (2, 4, 6, 7, 8, 9, 15, 16, 11)] + [(None, 1, 1), (4, 1, None)], none.schema)
    rows = toxicity.scores(edges, labels).collect()
    assert len(rows) == edges.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scores(empty, labels).count() == 0
    assert toxicity.without_toxic(edges, none).columns == edges.columns
    assert toxicity.without_toxic(edges, none).count() == edges.count()


def test_filter_holds_bigrams_seen_once():
    keys = np.arange(1, 5001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    levels = language_model.Filter([language_model.segment(keys, np.ones(len(keys), np.int64))]).levels(keys)
    assert (levels >= 1).all() and (language_model.level_count(levels) == 1).mean() > 0.999


@pytest.mark.parametrize("base", [0, 5 << 58])
def test_thin_keys_and_small_numbers_come_back(base):
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 500):
        keys = np.unique(rng.integers(base, base + (1 << 58), n, dtype=np.uint64))
        assert (language_model.thick(language_model.thin(keys, base), base) == keys).all() and len(language_model.thick(language_model.thin(keys, base), base)) == len(keys)
        for most in (1, 255, 256, 1 << 20, 1 << 40):
            counts = rng.integers(0, most, n)
            assert (language_model.large(language_model.small(counts)) == counts).all()
    assert len(language_model.thin(np.arange(1000, dtype=np.uint64))) == 1001


@pytest.mark.parametrize("log", [0, 3])
def test_ranges_count_and_answer_every_block_at_once(spark, log):
    rows = spark.createDataFrame([(i, t, i % 3 != 0) for i, t in enumerate(["a b a b", "c a b", "", "a b new", "b a b c c"] * 4)],
                                 "doc_id long, text string, trains boolean").repartition(4)
    language_model.ship(spark)
    encoded = language_model.written(language_model.blocks(rows), "blocks")
    table = language_model.counted(encoded, log, False).collect()
    blocks = [language_model.Block(r.asDict()) for r in encoded.collect()]
    learned = [collections.Counter(), collections.Counter()]
    for b in blocks:
        learned[0].update(b.words[b.place[b.trains]].tolist())
        learned[1].update(b.bigrams()[b.trains].tolist())
    for kind, want in enumerate(learned):
        sums = [r for r in table if r.kind == kind and r.block is None]
        assert (sum(r.n for r in sums), sum(r.total for r in sums)) == (len(want), sum(want.values()))
        for r, b in zip(encoded.collect(), blocks):
            found = sorted((t.span, t.found) for t in table if t.kind == kind and t.block == r.block)
            got = np.concatenate([language_model.large(f) for _, f in found])
            keys = b.words if kind == 0 else np.unique(b.bigrams())
            counts = np.array([want[k] for k in keys.tolist()])
            assert len(got) == len(keys) and ((got == counts) if kind == 0 else (got >= language_model._count_level(counts))).all()


def test_bigrams_travel_once(documents):
    """Ranges answer while they count: nothing is asked for again after the counts are written."""
    plan = language_model.scores(documents, most_bytes=0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "GroupsInArrow" not in plan


def test_hashes_of_long_texts_take_chunks(monkeypatch):
    """Chunks give the hashes of the whole, empty spans at the end included, and keep no powers of a whole text's length."""
    from lunchbox.llm import spans
    rng = np.random.default_rng(4)
    raw = rng.integers(97, 123, 4096).astype(np.uint8)
    raw[rng.random(4096) < 0.2] = 32
    start = np.r_[np.sort(rng.integers(0, 4096, 900)), 4096]
    end = np.r_[np.minimum(start[:-1] + np.sort(rng.integers(0, 900, 900)), 4096), 4096]
    values = spans.mix(np.arange(5000, dtype=np.uint64))
    want = spans.span_hashes(raw, start, end), [spans.window_hashes(values, n) for n in (1, 3, 13)]
    monkeypatch.setattr(spans, "CHUNK_BYTES", 256)
    assert (spans.span_hashes(raw, start, end) == want[0]).all()
    assert all((spans.window_hashes(values, n) == w).all() for n, w in zip((1, 3, 13), want[1]))
    monkeypatch.undo()
    spans._powers.clear()
    long = np.full(6 << 20, 97, np.uint8)
    long[::7] = 32
    first = np.arange(1, len(long) - 7, 7)
    assert len(np.unique(spans.span_hashes(long, first, first + 6))) == 1
    assert all(len(up) <= 2 * spans.CHUNK_BYTES for up, _ in spans._powers.values())


def test_toxicity_training_is_the_same_in_chunks(monkeypatch):
    from lunchbox.llm import spans
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["stone", "bread", "cloud", "vile", "x" * 40], 30 * (k % 5))) for k in range(60)]
    want = toxicity.train(texts, np.arange(60) % 3 == 0)
    monkeypatch.setattr(spans.chunks, "__defaults__", ("text", 500))
    model = toxicity.train(texts, np.arange(60) % 3 == 0)
    assert (model.bucket_logit == want.bucket_logit).all() and (model.bias, model.slope, model.shift) == (want.bias, want.slope, want.shift)
