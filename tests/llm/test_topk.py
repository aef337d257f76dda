import math

import numpy as np
from pyspark.sql import functions as F
from skymatch.llm import topk as T

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k, every):
    fine = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for own, (q, x) in enumerate(fine):
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i) for at, (i, y) in enumerate(fine) if at != own)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def make(n, d, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * rng.exponential(size=(n, 1))
    x[3] = x[7] = x[11]  # ties
    x[20] = 0
    return [(i, x[i].astype(np.float32).tolist(), 0) for i in range(n)]


def check(spark, rows, k=10, every=100):
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in T.top_k(spark.createDataFrame(rows, SCHEMA), k, every).collect())
    assert got == brute(rows, k, every)


def test_matches_brute_force(spark):
    check(spark, make(700, 24, 1))


def test_several_query_blocks_and_steps(spark, monkeypatch):
    monkeypatch.setattr(T, "QUERY_BLOCK", 16)
    check(spark, make(400, 24, 2), k=5, every=3)


def test_left_out_and_uneven_vectors(spark):
    rows = make(60, 20, 3)
    rows += [(100, None, 0), (200, [1.0, None], 0), (300, [float("nan")] * 20, 0), (400, [float("inf")] * 20, 0), (None, [1.0] * 20, 0), (500, [0.5] * 7, 0), (600, [], 0)]
    check(spark, rows)


def test_repeated_rows_are_queries_and_candidates_of_their_own(spark):
    rows = make(150, 20, 6)
    rows += [rows[100], rows[100], rows[7], (100, rows[3][1], 0)]
    check(spark, rows)
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in ("x", "key", "norm", "rank", "score", "query_id", "query_row")])
    assert sorted(tuple(r) for r in T.top_k(df, 10, 100).collect()) == brute(rows, 10, 100)
    assert T.top_k(df, 10, 100).where("query_id = 100").count() == 40


def test_scores_of_any_size():
    x = np.array([[2**28, -(2**40)], [2**33, 2**20]], dtype=np.int64)
    search = T.Search(np.array([0, 1]), np.array([0, 100]), x, np.eye(2), 5)
    search.show(np.array([0, 1, 2]), np.array([0, 100, 7]), np.concatenate([x, [[2**21, 3]]]).astype(np.int64))
    assert search.best == [[(-(2**60), 100), (-(2**49 - 3 * 2**40), 7)], [(-(2**60), 0), (-(2**54 + 3 * 2**20), 7)]]
    with np.testing.assert_raises(OverflowError):
        T._wide_scores(x[:1], x[0])


def test_fewer_than_k_and_none(spark):
    check(spark, make(25, 20, 4)[:4])
    assert T.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
