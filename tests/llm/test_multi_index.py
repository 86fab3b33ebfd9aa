import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlake.llm import multi_index, queries

KIND = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50):
    """{query id: [(score, id)]} of distinct ids, nearest first."""
    fine = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v) and any(v)]
    width = max((len(v) for _, v in fine), default=0)
    m = np.array([v + [0.0] * (width - len(v)) for _, v in fine]).reshape(-1, width)
    ids, out = [i for i, _ in fine], {}
    asked = {}
    for n, i in enumerate(ids):
        if i % every == 0 and (i not in asked or fine[n][1] < fine[asked[i]][1]):
            asked[i] = n
    for q, n in asked.items():
        best = {}
        for i, s in zip(ids, multi_index.cosine(m[n], m).tolist()):
            if i != q:
                best[i] = max(s, best.get(i, -2))
        out[q] = sorted((-s, i) for i, s in best.items())[:k]
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, KIND).withColumns({"id": F.lit("x"), "h1": F.lit(1), "v": F.lit(2), "score": F.lit(0)})
    out = {}
    for r in sorted(multi_index.search(df, F.col("vec_id") % 50 == 0, **options).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((-r.score, r.id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_whole_budget_is_exact(spark):
    """With a budget of all entries the answers are those of brute force, ties and copies included."""
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(12)]) for i in range(400)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(200)] + [(3000 + i, [2 * x for x in rows[i][1]]) for i in range(30)]
    rows += [(50, rows[50][1]), (50, rows[3][1]), (1003, rows[9][1])]  # repeated, and ids with two vectors
    for options in ({}, {"block": 16}, {"codes": 2, "block": 1}):
        assert found(spark, rows, recall=1.0, trial=10**6, **options) == brute(rows)


def test_hostile_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [3e37, 1e30]), (2, None), (3, [float("nan")]), (4, []), (5, [1.0]), (6, [1.0, None]), (7, [float("inf"), 0.0]), (50, [1e-40]), (100, [-1.0]), (None, [1.0]), (-50, [0.5, -0.5]), (8, [0.0, 0.0])]
    got, want = found(spark, rows), brute(rows)
    assert {q: [i for _, i in x] for q, x in got.items()} == {q: [i for _, i in x] for q, x in want.items()}
    for q in want:
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=0, atol=1e-12)
    assert found(spark, []) == {} and found(spark, [(1, [1.0])]) == {} and found(spark, [(50, [1.0])]) == {} and found(spark, [(50, [1.0]), (1, [2.0])]) == {50: [(-1.0, 1)]}


def test_traversal_order():
    """Every pair once, by summed distance."""
    rng = np.random.default_rng(1)
    a, b = rng.random(9), rng.random(13)
    pairs = list(multi_index.traverse(a, b))
    sums = [a[i] + b[j] for i, j in pairs]
    assert len(set(pairs)) == 117 and sums == sorted(sums)
    counts = np.ones(117, np.int64)
    counts[pairs[0][0] * 13 + pairs[0][1]] = 0
    assert multi_index.cells_for(a, b, counts, 3) == [i * 13 + j for i, j in pairs[1:4]]


@pytest.mark.parametrize("noise", [0.1, 0.6])
def test_recall_and_saving(spark, noise):
    """Recall on clustered and on noisy vectors; on clustered ones only a small part is met."""
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(40, 32))
    rows = [(i, (middle[i % 40] + noise * rng.normal(size=32)).tolist()) for i in range(4000)]
    got, want = found(spark, rows), brute(rows)
    assert set(got) == set(want) and all(len(x) == 5 for x in got.values())
    assert np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / 5 for q in want]) >= 0.9


def test_one_vector_held_by_a_third(spark):
    """Copies: answers are the smallest ids, and an entry is one row however many share it."""
    rnd = random.Random(9)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [rnd.random() for _ in range(3)]) for i in range(900)]
    got = found(spark, rows, recall=1.0, trial=10**6)
    assert got == brute(rows) and [i for _, i in got[0]] == [3, 6, 9, 12, 15]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, hits, n = brute(rows), 0, 0
    scores = {q: dict((i, -s) for s, i in x) for q, x in brute(rows, k=len(rows)).items()}
    for r in queries.QUERIES["op12_multi_index"](spark, sf).collect():
        hits, n = hits + (r.vec_id in {i for _, i in want[r.query_id]}), n + 1
        assert abs(r.score - scores[r.query_id][r.vec_id]) < 1e-12
    assert n == 5 * len(want) and hits / n >= 0.9
