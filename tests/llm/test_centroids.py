import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlake.llm import centroids, queries

LONG = 2**63 - 1


def whole(x):
    return math.floor(x * 1024) if abs(x) < 2.0**53 else int(x) * 1024


def brute(rows, k=8, rounds=10, width=64):
    """(id, cluster, distance) rows, centroids, in plain Python integers."""
    fine = [(i, [float(x) for x in v]) for i, v in rows if i is not None and v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    data = [(i, [whole(x) for x in v]) for i, v in fine]
    start = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v, n) for n, (i, v) in enumerate(fine))[:k]
    c = [data[n][1] for _, _, n in start]
    near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, w)), j) for j, w in enumerate(c))
    for _ in range(rounds):
        own = [[] for _ in c]
        for _, v in data:
            own[near(v)[1]].append(v)
        c = [[sum(col) // len(o) for col in zip(*o)] if o else w for o, w in zip(own, c)]
    return sorted((i, near(v)[1], min(LONG, near(v)[0])) for i, v in data), c


def found(spark, rows, kind="float", **options):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({"id": F.lit("x"), "v": F.lit(1), "cluster": F.lit(2)})
    out, c = centroids.cluster(df, **options)
    return sorted(tuple(r) for r in out.collect()), c


def test_against_brute_force(spark):
    rnd = random.Random(1)
    middle = [[rnd.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [float(np.float32(x + rnd.gauss(0, 0.7))) for x in middle[i % 5]]) for i in range(400)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_ties_copies_and_large_values(spark, kind):
    """Equal distances go to the smaller number, also where float32 can't tell them apart; values beyond int64 stay exact."""
    rnd = random.Random(2)
    far = 1e30 if kind == "float" else 1e306
    # few values, so that many distances are equal
    rows = [(i, [rnd.choice([-1.0, 0.0, 1.0]) * (1 if rnd.random() < 0.9 else 2**20)] * 32 + [0.5] * 32) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]
    rows += [(200 + i, [(-1) ** i * far * (1 + i % 3)] + [float(i)] * 63) for i in range(8)]
    rows += [(300 + i, [2.0**24 + i % 2] * 64) for i in range(10)]
    rows = [(i, [float(np.float32(x)) if kind == "float" else x for x in v]) for i, v in rows]
    assert found(spark, rows, kind, k=12) == brute(rows, k=12)


def test_bounds_hold():
    """The true score always lies in its interval, and most vectors are decided by intervals alone."""
    rng = np.random.default_rng(3)
    for size in (10, 1e3, 1e6, 1e9):
        a, c = np.floor(rng.normal(size=(300, 64)) * size), np.floor(rng.normal(size=(8, 64)) * size)
        lo, hi = centroids.intervals(a, c)
        true = [[sum(int(y) ** 2 for y in w) - 2 * sum(int(x) * int(y) for x, y in zip(v, w)) for w in c] for v in a]
        assert all(lo[i, j] <= true[i][j] <= hi[i, j] for i in range(300) for j in range(8))
    _, exact = centroids._nearest(a, a / 1024, [[int(x) for x in row] for row in c], 1024)
    assert len(exact) < 30


def test_overlaps_are_recomputed():
    """Two centroids a unit apart, far out: float32 can't separate them, the exact way does."""
    a = np.full((4, 64), 2.0**25) + np.arange(4)[:, None]
    c = [[2**25 + 3] * 64, [2**25 + 2] * 64, [2**25 + 2] * 64]
    at, exact = centroids._nearest(a, a / 1024, c, 1024)
    assert exact == [0, 1, 2, 3] and at.tolist() == [1, 1, 1, 0]


def test_hostile_rows(spark):
    v = [0.25] * 64
    rows = [(1, v), (1, v), (2, None), (3, v[:-1]), (4, [*v, 1.0]), (5, [*v[:-1], None]), (6, [*v[:-1], float("nan")]), (7, [*v[:-1], float("inf")]), (None, v), (8, [-0.0001] * 64), (9, [])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [])[0] == [] and found(spark, [(1, None)])[0] == []
    assert centroids.report(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, c = brute(rows)
    got = queries.QUERIES["op13_float32_centroids"](spark, sf).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == want
    for r in got:
        assert r.cluster_inertia == sum(d for _, j, d in want if j == r.cluster) and r.inertia == sum(d for _, _, d in want)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, c[r.cluster])).encode()).hexdigest()
