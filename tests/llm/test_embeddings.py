"""Whitening against numpy's eigenvectors, hard negatives against all products, and both at the edges."""

import math

import duckdb
import numpy as np
import pytest
from brute import SF

from lunchbox.llm import hard_negatives, whitening

EXTRA = "embedding array<float>, label int, n long, component int, score long, at string, width int"


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet")


def rows_of(spark, values):
    """(vec_id, vector, label) rows with columns whose names the operators use too."""
    return spark.createDataFrame([(i, v, c, 1, 2, 3, "a", 4) for i, v, c in values], f"vec_id long, {EXTRA}").repartition(3)


# whitening

def brute_whitening(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    centred = x - s / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    return n, ((n * x - s) ** 2).sum(1), centred @ basis[:, :32] / np.sqrt(values[:32]), values / values.sum()


def test_whitening_against_numpy(embeddings):
    rows = whitening.whitened(embeddings).orderBy("vec_id", "component").toPandas()
    given = embeddings.orderBy("vec_id").toPandas()
    n, deviation, want, share = brute_whitening(given.embedding.tolist())
    assert len(rows) == 32 * n and set(rows.n) == {n}
    assert rows.deviation.values.reshape(n, 32)[:, 0].tolist() == deviation.tolist()
    assert np.allclose(rows.explained.values[:32], share[:32], rtol=1e-10)
    mine = rows.whitened.values.reshape(n, 32)
    assert np.allclose(mine * np.sign((mine * want).sum(0)), want, atol=1e-8)
    assert rows.identity_error.nunique() == 1 and rows.identity_error[0] < 1e-9
    assert np.abs(np.cov(mine.T, bias=True) - np.eye(32)).max() < 1e-9


@pytest.mark.parametrize("values", [[3, 2, 1], [1, 1, 1, 1], [5, 5, 1, 1, 1, 0, 0], [1e6, 1, 1e-3, 0], list(range(1, 33)) * 2, [0, 0], [-1, 2, -3]])
def test_components_of_known_matrices(values):
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(len(values),) * 2))[0]
    a = q @ np.diag(np.array(values, float)) @ q.T
    found, basis = whitening.components((a + a.T) / 2)
    scale = max(1, np.abs(values).max())
    assert np.allclose(found, sorted(values, reverse=True), atol=1e-12 * scale)
    assert np.allclose(basis.T @ basis, np.eye(len(values)), atol=1e-12)
    assert np.allclose(a @ basis, basis * found, atol=1e-11 * scale)


def test_polar_factor():
    a = np.random.default_rng(4).normal(size=(40, 40))
    a = a + a.T
    u = whitening.polar(a)
    values, basis = np.linalg.eigh(a)
    assert np.allclose(u, basis @ np.diag(np.sign(values)) @ basis.T, atol=1e-10)


def test_whitening_edges(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=3).tolist(), 1) for i in range(20)] + [(None, [0.5, 0.25, 1.0], None), (3, [1.0, 2.0, 3.0], 2), (3, [1.0, 2.0, 3.0], 2)]
    bad = [(90, None, 1), (91, [], 1), (92, [1.0, None, 2.0], 1), (93, [1.0, math.nan, 2.0], 1), (94, [math.inf, 1.0, 2.0], 1), (95, [1.0, 2.0], 1),
           (96, [1.0, 1e30, 2.0], 1)]
    rows = whitening.whitened(rows_of(spark, good + bad)).collect()
    assert len(rows) == 3 * len(good) and sum(r.vec_id is None for r in rows) == 3
    n, deviation, want, share = brute_whitening([np.array(v, np.float32).astype(float) for _, v, _ in good])
    assert sorted(r.deviation for r in rows if r.component == 1) == sorted(deviation.tolist())
    assert all(math.isclose(r.explained, share[r.component - 1], rel_tol=1e-9) for r in rows)
    assert sorted(round(abs(r.whitened), 8) for r in rows) == sorted(np.abs(want).round(8).reshape(-1).tolist())
    # one direction has no variance
    flat = whitening.whitened(rows_of(spark, [(i, [float(i), 2.0 * i, 1.0], 1) for i in range(9)])).collect()
    assert {r.component for r in flat} == {1} and math.isclose(flat[0].explained, 1)
    for none in ([], [(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1)] * 5, bad[:3]):
        out = whitening.whitened(rows_of(spark, none))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_is_exact_beyond_doubles(spark):
    values = [(i, [1e8 * (i % 7), 0.1 * i], 1) for i in range(50)]
    rows = whitening.projected(rows_of(spark, values), whitening.fitted(rows_of(spark, values))).collect()
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v, _ in values]
    s = [sum(c) for c in zip(*x)]
    want = {i: sum((50 * c - t) ** 2 for c, t in zip(v, s)) for i, v in enumerate(x)}
    assert {r.vec_id: int(r.deviation_exact) for r in rows} == want and max(want.values()) > 1 << 53


# hard negatives

def brute_negatives(rows):
    """(anchor, positive, rank, negative, scores) of (id, vector, label) rows, in plain Python."""
    own = [(i, [math.floor(256 * float(np.float32(c))) for c in v], c) for i, v, c in rows]
    out = []
    for a, x, label in own:
        if a % 100:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(x, y)), i, c) for i, y, c in own if i != a), key=lambda r: r[:2])
        for p, positive, _ in [r for r in scored if r[2] == label][:5]:
            inside = [r for r in scored if r[2] != label and 80 * -p <= 100 * -r[0] <= 100 * -p][:5]
            out += [(a, positive, k + 1, i, -p, -s) for k, (s, i, _) in enumerate(inside)]
    return sorted(out)


def mined(df, **more):
    return sorted(map(tuple, hard_negatives.mined(df, **more).collect()))


def test_negatives_against_sql(embeddings):
    embeddings_path = f"{SF}/embeddings.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{embeddings_path}'")
    want = sorted(con.sql(hard_negatives.SQL).fetchall())
    assert want and mined(embeddings, label=hard_negatives.SHIFTED_LABEL) == want
    # blocks of two anchors
    assert mined(embeddings, label=hard_negatives.SHIFTED_LABEL, block_bytes=2 * 8 * 64) == want


def test_negatives_with_ties_copies_and_overlapping_windows(spark):
    rng = np.random.default_rng(6)
    kinds = [rng.integers(-2, 3, 4).astype(float).tolist() for _ in range(6)]
    rows = [(int(i) * 50, kinds[rng.integers(0, 6)], int(rng.integers(0, 3))) for i in range(60)]
    rows += [(int(i), [1.0, 1.0, 0.0, 0.0], int(i % 2)) for i in range(301, 700)]  # a third and more are one vector
    rows += [(7, [1.0, 1.0, 0.0, 0.0], 1)] * 12 + [(100, [2.0, 0.0, 1.0, 0.0], 1)] * 3 + [(100, [0.0, 1.0, 0.0, 0.0], 0)] * 8
    want = brute_negatives(rows)
    assert len(want) > 200 and mined(rows_of(spark, rows)) == want
    assert mined(rows_of(spark, rows), block_bytes=96) == want


def test_negatives_with_great_numbers(spark):
    rng = np.random.default_rng(7)
    rows = [(i * 20, (rng.normal(size=3) * 10 ** float(i % 5)).tolist(), i % 2) for i in range(60)]
    assert mined(rows_of(spark, rows)) == brute_negatives(rows)


def test_negatives_edges(spark):
    assert mined(rows_of(spark, [])) == []
    good = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.1], 2), (3, [0.9, 0.0], 2), (-100, [0.0, 1.0], 9), (200, [-1.0, -1.0], 1), (4, [0.0, 0.0], 9)]
    bad = [(None, [1.0, 0.0], 1), (5, None, 1), (6, [1.0, 0.0], None), (7, [1.0, None], 2), (8, [math.nan, 1.0], 2), (9, [math.inf, 1.0], 2), (10, [], 2),
           (11, [1.0, 0.0, 0.0], 2), (100, [1.0], 1), (12, [1e9, 1.0], 2)]
    got = mined(rows_of(spark, good + bad))
    assert got == brute_negatives(good)
    assert mined(rows_of(spark, bad[:7])) == [] and mined(rows_of(spark, good[:1])) == []


def test_copies_that_cannot_be_returned():
    ids = np.array([5, 5, 5, 5, 1, 2, 3, 4, 6, 7, 8, 9, 10, 11])
    labels, x = np.zeros(len(ids), np.int64), np.ones((len(ids), 2), np.int64)
    left = hard_negatives._first_copies(ids, labels, x, 2)
    assert sorted(ids[left].tolist()) == [1, 2, 3, 4]
    left = hard_negatives._first_copies(ids, np.arange(len(ids)) % 2, x, 3)
    assert len(left) == 12 and (ids[left] == 5).sum() == 4
