import math

import numpy as np

from rulegrove.llm import topk


def brute(rows, k, every):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, q in ok:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)[:k]
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(best)}
    return out


def test_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=12) * rng.exponential()]) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(100)]  # one very common vector: ties
    rows += [(600, None), (601, [1.0, None]), (620, [float("nan")] * 12), (640, [float("inf")] * 12), (None, rows[0][1]), (660, []), (680, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS id")
    got = topk.exact_topk(df, 7, 20).collect()
    assert {tuple(r) for r in got} == brute(rows, 7, 20) and len(got) == len(brute(rows, 7, 20))


def test_blocks_stripes_and_groups(spark, monkeypatch):
    rng = np.random.default_rng(2)
    z = np.floor(rng.normal(size=(3000, 8)) * 5)
    turn = np.linalg.eigh(z.T @ z)[1][:, ::-1]
    ids = np.arange(3000)
    q, c, s = topk.best_of(z[::50], ids[::50], z, ids, turn, 5)
    for n, i in enumerate(ids[::50]):
        best = sorted((-float(z[i] @ z[j]), j) for j in ids if j != i)[:5]
        assert [(-a, b) for a, b in zip(s[q == n], c[q == n])] == best
    rows = [(i, [float(x) / 64 for x in v]) for i, v in enumerate(z[:900])]
    monkeypatch.setattr(topk, "STRIPE_ROWS", 200)
    monkeypatch.setattr(topk, "QUERY_ROWS", 20)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.exact_topk(df, 4, 10).collect()} == brute(rows, 4, 10)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.exact_topk(df, 20, 20).collect()] == [(0, 1, 1, 64 * 128)]
    assert topk.exact_topk(df.limit(0), 20, 20).collect() == []


def test_bands_cut_queries_and_overflow_is_told(spark, monkeypatch):
    import pytest

    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (50 if i % 97 == 0 else 0.5)]) for i in range(1200)]
    monkeypatch.setattr(topk, "STRIPE_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.exact_topk(df, 3, 15).collect()} == brute(rows, 3, 15)
    same = [(i, [1.0, 2.0]) for i in range(300)] + [(300 + i, [float(i), 1.0]) for i in range(100)]
    df = spark.createDataFrame(same, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.exact_topk(df, 5, 50).collect()} == brute(same, 5, 50)
    huge = spark.createDataFrame([(0, [3e17, 1.0]), (1, [3e17, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.exact_topk(huge, 1, 1).collect()
