import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txnlake.llm import maxscore

KIND = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50):
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    out = set()
    for q, v in fine:
        if q % every == 0:
            best = sorted((-clip(sum(a * b for a, b in zip(v, w))), i) for i, w in fine if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, KIND).withColumns({"id": F.lit("x"), "score": F.lit(1)})
    return {tuple(r) for r in maxscore.top_k(df, F.col("vec_id") % 50 == 0, **options).collect()}


@pytest.mark.parametrize("options", [{}, {"shard": 37}, {"block": 3, "shard": 64}])
def test_against_brute_force(spark, options):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) * (1 + 4 * (j < 3)) for j in range(24)]) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(60)]  # ties
    assert found(spark, rows, **options) == brute(rows)


def test_hostile_values(spark):
    rows = [(0, [1.0, 2.0]), (1, [3e37, 1e30]), (2, None), (3, [float("nan")]), (4, []), (5, [1.0]), (6, [1.0, None]), (7, [float("inf"), 0.0]), (50, [1e20]), (100, [-1.0]), (None, [1.0]), (-50, [0.5, -0.5]), (8, [0.0, 0.0])]
    assert found(spark, rows) == brute(rows)


def test_repeats_and_empty(spark):
    rows = [(0, [1.0]), (0, [-1.0]), (1, [2.0]), (1, [2.0]), (2, [3.0])]
    assert sorted(found(spark, rows)) == [(0, 1, 1, -256 * 512), (0, 2, 1, -256 * 512), (0, 3, 2, -256 * 768)]
    assert found(spark, []) == set() and found(spark, [(1, [1.0])]) == set() and found(spark, [(50, [1.0])]) == set()


def test_few_terms_are_traversed():
    """With skewed weights the light terms are only probed."""
    rng = np.random.default_rng(1)
    post = rng.normal(size=(32, 5000)) * 100
    q = np.r_[rng.normal(size=2) * 1000, rng.normal(size=30)]
    ids = np.arange(5000)
    want = maxscore._best(ids, q @ post, 5)
    held = maxscore._best(ids[:500], q @ post[:, :500], 5)
    got = maxscore._search(q, -1, ids[500:], post[:, 500:], post[:, 500:].max(axis=1), post[:, 500:].min(axis=1), held, 5)
    assert (got[0] == want[0]).all() and np.allclose(got[1], want[1])


def test_terms_are_skipped(spark, monkeypatch):
    """After a task's first, small shard most terms are non-essential where few terms carry the scores, and results are exact."""
    rnd = random.Random(4)
    rows = [(i, [rnd.random() * (40 if t < 4 else 0.5) for t in range(64)]) for i in range(1500)]
    assert found(spark, rows) == brute(rows)
    seen = []
    search = maxscore._search

    def spied(q, qid, ids, postings, hi, lo, held, k, **more):
        full = len(held[1]) == k
        seen.append((full, len(ids)))
        if full:
            total = np.cumsum(np.sort(np.maximum(q * hi, q * lo)))
            seen[-1] += (int(np.searchsorted(np.maximum.accumulate(total), held[1][-1])),)
        return search(q, qid, ids, postings, hi, lo, held, k, **more)

    monkeypatch.setattr(maxscore, "_search", spied)
    ids = pa.array([i for i, _ in rows])
    batch = pa.RecordBatch.from_arrays([ids, pa.array([v for _, v in rows], pa.list_(pa.float64()))], names=["id", "v"])
    list(maxscore._scan([(0, rows[0][1]), (50, rows[50][1])], 5, 256.0, 8192, 64)([batch]))
    bare = [x for x in seen if not x[0]]
    assert sum(x[1] for x in bare) == 2 * 64 and all(x[2] >= 30 for x in seen if x[0])
