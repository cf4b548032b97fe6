import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import product_search as ps, queries
from tests.llm.inputs import SMALL
from tests.oracle_compare import database, differences

SCHEMA = "vec_id long, embedding array<double>, label int, query string, x int"


def brute(rows, every, k=5, scale=256):
    """All products in Python integers; the query's own row is left out by its position."""
    kept = []
    for i, v in rows:
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            kept.append((i, [int(np.floor(scale * float(c))) for c in v]))
    out = []
    for at, (i, q) in enumerate(kept):
        if i is None or i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, c)), j is None, j) for n, (j, c) in enumerate(kept) if n != at]
        scores.sort(key=lambda t: (t[0], t[1], t[2] if t[2] is not None else 0))
        out += [(i, r + 1, j, -s) for r, (s, _, j) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def searched(spark, rows, every, **options):
    df = spark.createDataFrame([(i, v, 0, "clash", 1) for i, v in rows], SCHEMA)
    found = ps.top_products(df, F.col("vec_id") % every == 0, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_query_equals_sql(spark):
    df = queries.QUERIES["op11_top_products"](spark, SMALL)
    n, only_spark, only_sql = differences(df, database(SMALL), queries.ORACLE_SQL["op11_top_products"])
    assert not only_spark and not only_sql
    assert df.count() == 50


@pytest.mark.parametrize("options", [{}, {"block_bytes": 400, "seeds": 3, "group": 2}, {"seeds": 1}])
def test_random_vectors_of_many_lengths(spark, options):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=9) * rng.exponential(2)).tolist()) for i in range(300)]
    assert searched(spark, rows, 10, **options) == brute(rows, 10)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0, 3.0]), (0, [1.0, 2.0, 3.0]), (0, [-1.0, 0.5, 0.0]), (1, [1.0, 2.0, 3.0]), (2, None),
            (4, []), (3, [1.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 0.0, 0.0]), (8, [None, 1.0, 1.0]),
            (None, [9.0, 9.0, 9.0]), (None, [9.0, 9.0, 9.0]), (10, [0.0, 0.0, 0.0]), (12, [-0.001, 0.001, 0.0039]),
            (14, [1.0, 2.0, 3.0]), (7, [1e3, -1e3, 0.0])]
    for options in ({}, {"block_bytes": 50, "seeds": 2, "group": 1}):
        assert searched(spark, rows, 2, **options) == brute(rows, 2)


def test_ties_and_copies(spark):
    rows = [(i, [1.0, 1.0] if i % 3 else [0.5, 0.5]) for i in range(120)] + [(5, [1.0, 1.0])] * 40
    assert searched(spark, rows, 30, block_bytes=160, group=1) == brute(rows, 30)


def test_few_rows(spark):
    assert searched(spark, [], 1) == []
    assert searched(spark, [(0, [1.0])], 1) == []
    assert searched(spark, [(0, []), (1, [])], 1) == [(0, 1, 1, 0), (1, 1, 0, 0)]


def test_great_magnitudes_are_bounded(spark):
    rows = [(0, [1e30, 1.0]), (1, [-1e30, 1.0]), (2, [1e30, 1e30])]
    scores = [r[3] for r in searched(spark, rows, 1)]
    assert all(-2**63 <= s < 2**63 for s in scores) and len(scores) == 6 and scores[0] > 2**60


def test_pruning_leaves_few_exact_products(monkeypatch):
    """Clustered vectors: most pairs fall to the bounds, and none of the best is lost."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 32)) * np.linspace(3, 0.1, 32)
    x = np.rint(64 * (centres[rng.integers(0, 20, 6000)] + 0.1 * rng.normal(size=(6000, 32)))).astype(np.int64)
    x = x[np.argsort(-(x**2).sum(axis=1))]
    turn = np.linalg.eigh((x.T @ x).astype(float))[1][:, ::-1]
    count = [0]
    real = ps.exact
    monkeypatch.setattr(ps, "exact", lambda q, c, a, b: (count.__setitem__(0, count[0] + len(a)), real(q, c, a, b))[1])
    q, c = ps.Rotated(x[::60], turn), ps.Rotated(x, turn)
    best = ps.best_of(q, np.full(len(q), -1e300), c, np.arange(len(c)), np.zeros(len(c), bool), 6)
    expected = np.sort(x[::60] @ x.T, axis=1)[:, ::-1][:, :6]
    assert (best.score.reshape(-1, 6) == expected).all()
    assert count[0] < 0.3 * len(q) * len(c)
