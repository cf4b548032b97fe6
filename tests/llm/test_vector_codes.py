import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import queries, vector_codes as vc
from tests.llm.inputs import SMALL
from tests.oracle_compare import database, differences

SCHEMA = "vec_id long, embedding array<double>, label int, code string, far int"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Every distance in Python integers."""
    kept = [(i, [int(np.floor(scale * float(c))) for c in v], l) for i, v, l in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max([len(v) for _, v, _ in kept], default=0)
    size = max(1, -(-width // parts))
    kept = [(i, v + [0] * (size * parts - len(v)), l) for i, v, l in kept]
    least = {}
    for i, v, _ in kept:
        if i is not None:
            least[i] = min(v, least.get(i, v))
    ids = sorted(least)[:entries]
    cut = lambda v, k: v[k * size:(k + 1) * size]
    books = [[cut(least[i], k) for i in ids] for k in range(parts)]
    far = lambda a, b: sum((x - y)**2 for x, y in zip(a, b))

    def chosen(k):
        return [min((far(cut(v, k), e), j) for j, e in enumerate(books[k])) for _, v, _ in kept]
    if not ids:
        return [(i, None, None, None, hashlib.sha256(b"").hexdigest()) for i, _, _ in kept]
    for _ in range(rounds):
        for k in range(parts):
            members = {}
            for (_, v, _), (_, j) in zip(kept, chosen(k)):
                members.setdefault(j, []).append(cut(v, k))
            for j, m in members.items():
                books[k][j] = [sum(c) // len(m) for c in zip(*m)]
    final = list(zip(*[chosen(k) for k in range(parts)]))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in final]
    labels = {}
    for (_, _, l), e in zip(kept, errors):
        labels[l] = labels.get(l, 0) + e
    return sorted([(i, "".join(f"{j:02x}" for _, j in f), e, labels[l], digest)
                   for (i, _, l), f, e in zip(kept, final, errors)], key=repr)


def compressed(spark, rows, **options):
    df = spark.createDataFrame([(i, v, l, "clash", 1) for i, v, l in rows], SCHEMA)
    out = vc.compress(df, **options)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_query_equals_sql(spark):
    df = queries.QUERIES["op13_vector_codes"](spark, SMALL)
    n, only_spark, only_sql = differences(df, database(SMALL), queries.ORACLE_SQL["op13_vector_codes"])
    assert not only_spark and not only_sql
    assert df.count() == 500


@pytest.mark.parametrize("options", [{}, {"entries": 9, "rounds": 2, "pivots": 3}, {"parts": 3, "entries": 5, "pivots": 1}])
def test_random_vectors(spark, options):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=12).tolist(), int(i) % 4) for i in rng.permutation(400)]
    expected = brute(rows, **{k: v for k, v in options.items() if k != "pivots"})
    assert compressed(spark, rows, **options) == expected


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [1.0, -2.0, 0.5, 0.25, 7.0], 1), (3, [1.0, -2.0, 0.5, 0.25, 6.0], 1), (3, [1.0, -2.0, 0.5, 0.25, 6.0], 1),
            (1, None, 1), (2, [], None), (4, [1.0], None), (5, [nan] * 5, 2), (6, [inf, 0.0], 2), (7, [None, 1.0], 2),
            (None, [9.0] * 5, 3), (8, [-0.0001, 0.0001, 0.0, -7.77, 2.0], None), (9, [0.0] * 5, 1)]
    assert compressed(spark, rows) == brute(rows)
    assert compressed(spark, rows, entries=2) == brute(rows, entries=2)
    assert compressed(spark, [(None, [1.0], 1), (None, [2.0], 1)]) == brute([(None, [1.0], 1), (None, [2.0], 1)])
    assert compressed(spark, []) == []


def test_ties_copies_and_unused_entries(spark):
    rows = [(i, [float(i % 3), 1.0, float(i % 2), 0.0], 0) for i in range(90)] + [(700, [1.0, 1.0, 1.0, 0.0], 0)] * 60
    assert compressed(spark, rows, entries=12) == brute(rows, entries=12)


def test_great_magnitudes_are_bounded(spark):
    out = compressed(spark, [(0, [1e30, 0.0, 0.0, 0.0], 0), (1, [-1e30, 0.0, 0.0, 0.0], 0), (2, [1e300] * 4, 0)], entries=1)
    assert len(out) == 3 and all(0 <= r[2] < 2**63 and 0 <= r[3] < 2**63 for r in out)


@pytest.mark.parametrize("top, width", [(1000, 6), (2**26, 4)])
def test_dense_chunks_are_exact(monkeypatch, top, width):
    monkeypatch.setattr(vc, "DENSE", 0)
    rng = np.random.default_rng(4)
    x, entries = rng.integers(-top, top, (3000, width)), rng.integers(-top, top, (40, width))
    entries[7] = entries[3]
    pivots = vc.farthest_first(entries, 4)
    index, error, _ = vc.nearest(x, vc.distances(x, pivots), entries, vc.distances(entries, pivots))
    d = ((x[:, None, :] - entries[None, :, :])**2).sum(axis=2)
    assert (index == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()


def test_most_entries_are_never_evaluated():
    rng = np.random.default_rng(2)
    entries = rng.integers(-1000, 1000, (256, 8))
    x = entries[rng.integers(0, 256, 5000)] + rng.integers(-40, 40, (5000, 8))
    pivots = vc.farthest_first(entries, 8)
    index, error, tried = vc.nearest(x, vc.distances(x, pivots), entries, vc.distances(entries, pivots))
    d = ((x[:, None, :] - entries[None, :, :])**2).sum(axis=2)
    assert (index == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()
    assert tried < 0.1 * d.size
