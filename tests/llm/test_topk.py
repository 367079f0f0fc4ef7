import numpy as np
from pyspark.sql import functions as F

from bluelines.llm import topk


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string, v string")


def every(n):
    return lambda c: c % n == 0


def brute(rows, n, k):
    """Every row against every other row, repeated ids included."""
    vectors = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            vectors.append((i, tuple(int(np.floor(64 * float(np.float32(x)))) for x in v)))
    out = []
    for at, (q, v) in enumerate(vectors):
        if q % n == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for k2, (i, w) in enumerate(vectors) if k2 != at and len(w) == len(v))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def check(spark, rows, n=5, k=7):
    df = topk.top_k(frame(spark, [(i, v, 0, "x", "y") for i, v in rows]), every(n), k)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, df.collect())) == brute(rows, n, k)


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 50)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 24))
    rows = [(i, [float(x) for x in centres[i % 5] + rng.normal(size=24) * (0.05 if i % 3 else 1)]) for i in range(300)]
    check(spark, rows)
    check(spark, rows, k=1)


def test_ties_odd_rows_and_small_sets(spark):
    same = [0.25, -0.5, 0.125]
    rows = [(i, same) for i in range(60)]
    rows += [(100, None), (105, [1.0, None, 2.0]), (110, [float("nan"), 1.0, 1.0]), (115, [float("inf"), 0.0, 0.0]), (None, same),
             (120, [0.1, 0.2]), (121, [0.3, 0.1]), (125, []), (130, [0.9, 0.9, 0.9]), (130, [0.1, 0.1, 0.1]), (130, [0.9, 0.9, 0.9]), (131, [1e6, -1e6, 1e6])]
    check(spark, rows)
    check(spark, [(0, same)])
    check(spark, [])
    check(spark, [(3, same)])


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(2)
    x, q = rng.integers(-90, 90, (200, 48)).astype(float), rng.integers(-90, 90, (9, 48)).astype(float)
    exact, last = x @ q.T, None
    for m in topk.LEVELS:
        bound = topk.statistics(x, m) @ topk.statistics(q, m).T
        assert (bound >= exact - 1e-6).all()
        assert last is None or (bound <= last + 1e-6).all()
        last = bound


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**22 + i), float(-(2**22) + 3 * i), 1.0]) for i in range(40)]
    check(spark, rows)
    assert topk.top_k(frame(spark, []), every(1)).agg(F.count(F.lit(1))).first()[0] == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(7, [2.0, 2.0]), (7, [0.5, 0.5]), (5, [1.0, 1.0]), (10, [0.25, 0.25]), (10, [0.25, 0.25]), (10, [3.0, -1.0])]
    check(spark, rows)
    got = topk.top_k(frame(spark, [(i, v, 0, "x", "y") for i, v in rows]), every(5), 3).where("query_id = 5").orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(7, 16384), (10, 8192), (7, 4096)]
