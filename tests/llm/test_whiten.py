"""Whitening by block matrices against a direct computation."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm import op12_whiten

SF = "/root/testdata/sf0.001"
ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("x", T.ArrayType(T.LongType())),
                     *[T.StructField(c, T.StringType()) for c in ("row", "w", "deviation", "part", "seq", "index")]])


@pytest.fixture()
def make(spark):
    def f(vectors):
        return spark.createDataFrame([(i, v) + ("c",) * 6 for i, v in vectors], ROWS)
    return f


def direct(x):
    """Centred rows, eigenvalues and axes by falling eigenvalue, exact deviations."""
    n = len(x)
    away = [[n * v - s for v, s in zip(row, np.array(x, object).sum(axis=0))] for row in x]
    centred = np.array([[float(v) / n for v in row] for row in away])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return centred, values[::-1], axes[:, ::-1], [sum(v * v for v in row) for row in away]


def check(out, fit, vectors, components=32):
    kept = {i: v for i, v in vectors}
    centred, values, axes, square = direct(list(kept.values()))
    got = {r.row.vec_id: r for r in out.collect()}
    assert fit["n"] == len(kept) and set(got) == set(kept)
    k = min(components, int((values > values[0] * 1e-12).sum()))
    assert np.allclose(fit["eigenvalues"][:k], values[:k], rtol=1e-9)
    w = np.array([got[i].w for i in kept])
    assert w.shape == (len(kept), k)
    want = centred @ axes[:, :k] / np.sqrt(values[:k])
    for c in range(k):  # either sign, the same for all rows
        sign = 1 if np.abs(w[:, c] - want[:, c]).max() < np.abs(w[:, c] + want[:, c]).max() else -1
        assert np.allclose(sign * w[:, c], want[:, c], atol=1e-6)
    assert [got[i].deviation for i in kept] == square
    cov = (w - w.mean(axis=0)).T @ (w - w.mean(axis=0)) / len(w)
    assert fit["identity_error"] < 1e-6 and np.abs(cov - np.eye(k)).max() < 1e-6
    return fit


@pytest.mark.parametrize("parts", [1, 5])
def test_random_vectors(make, parts):
    rnd = np.random.default_rng(3)
    x = (rnd.normal(size=(300, 6)) * [50, 20, 9, 40, 3, 14]).astype(np.int64) + 1_000_000
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    df = make(vectors).repartition(parts)
    check(*op12_whiten.whiten(df, "x", ["vec_id"]), vectors)
    check(*op12_whiten.whiten(df, "x", components=2), vectors, components=2)


def test_blocks_of_a_few_rows(make, monkeypatch):
    monkeypatch.setattr(op12_whiten, "BLOCK_ROWS", 7)
    monkeypatch.setattr(op12_whiten, "BLOCKS_PER_TASK", 2)
    rnd = np.random.default_rng(4)
    x = rnd.integers(-40, 40, size=(101, 5)) * [5, 4, 3, 2, 1] + 1_000_000
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    check(*op12_whiten.whiten(make(vectors).repartition(3), "x"), vectors)


def test_dropped_repeated_and_flat(make):
    rnd = np.random.default_rng(5)
    x = rnd.integers(0, 100, size=(40, 3)).tolist()
    good = [(i, [*v, 7]) for i, v in enumerate(x)] + [(100 + k, [*x[0], 7]) for k in range(30)]  # hot copies, a flat dimension
    odd = [(-1, None), (-2, []), (-3, [1, None, 3, 4]), (-4, [1, 2, 3])]
    out, fit = op12_whiten.whiten(make(good + odd), "x")
    check(out, fit, good)
    assert len(fit["eigenvalues"]) == 4 and out.select(F.size("w")).distinct().collect()[0][0] == 3


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [5, 6])], [(1, [5, 6]), (2, [5, 6]), (None, [5, 6])]])
def test_without_variance(make, vectors):
    out, fit = op12_whiten.whiten(make(vectors), "x")
    assert out.count() == 0 and fit["n"] == sum(bool(v) for _, v in vectors)


def test_deviations_are_exact():
    x = np.array([[3 << 40, -5], [1 << 41, 9]], np.int64)
    sums = [int(v) for v in x.sum(axis=0)]
    centred, square = op12_whiten.deviations(2, x, sums)
    want = [[2 * int(v) - s for v, s in zip(row, sums)] for row in x]
    assert square == [None if sum(v * v for v in w) >= 1 << 63 else sum(v * v for v in w) for w in want]
    assert centred.tolist() == [[v / 2 for v in w] for w in want]


def test_entries_are_counted_in_steps(spark):
    rows = [(1, [0.5, -0.01]), (2, None), (3, [1.0, None]), (4, [math.nan, 1.0]), (5, [math.inf, 1.0]), (6, [1e30, 0.0]), (7, [])]
    df = spark.createDataFrame(rows, "k int, v array<double>").select("k", op12_whiten.quantised(F.col("v")).alias("x"))
    assert {r.k: r.x for r in df.collect()} == {1: [1_000_032, 999_999], 2: None, 3: None, 4: None, 5: None, 6: None, 7: []}


def test_query_over_a_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in r.embedding] for r in rows]
    centred, values, axes, square = direct(x)
    got = op12_whiten.op12_whiten_blocks(spark, SF).collect()
    assert len(got) == 32 * len(rows)
    at = {r.vec_id: k for k, r in enumerate(rows)}
    w = np.zeros((len(rows), 32))
    for r in got:
        w[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == len(rows) and r.deviation == square[at[r.vec_id]] and r.identity_error < 1e-4
        assert abs(r.explained - values[r.component - 1] / values.sum()) <= 1e-9
    want = centred @ axes[:, :32] / np.sqrt(values[:32])
    assert np.abs(np.abs(w) - np.abs(want)).max() < 1e-6
