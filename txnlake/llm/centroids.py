"""Exact integer k-means whose assignments are screened in float32.

Components become floor(scale * x). For each vector a and centroid c only |c|^2 - 2 a.c matters. A float32 matrix product gives a.c with
an error of at most gamma * |a| * |c|, gamma = (n + 4) u / (1 - (n + 4) u), u = 2**-24, n components, in whatever order it is summed
(Cauchy-Schwarz bounds the sum of absolute products). So every score has an interval that holds the true value. Centroids whose interval
starts above the least upper end are out; where one is left, it is the nearest one for sure. Vectors whose intervals overlap are
recomputed in exact integers, and of equal distances the smallest number wins. Values that int64 can't carry go through Python integers.

A round is a pass over the vectors where they were read, and no vector is shuffled: a task gives exact sums for each centroid, in limbs
of 32 bits, which Spark adds up; the driver gets (centroids x limbs x components) rows and sends the new centroids. Rounds keep no state
in executors, so a lost one repeats its own part of a round. Centroids that no round changes any more end the rounds early.

Rows: vectors that are null, have another number of components than ``width``, or hold null or non-finite components, and rows without
id, take no part. Rows repeated with an id are vectors like any other; as first centroids they come in order of their components.
Fewer vectors than centroids: as many centroids as vectors. Distances and inertia beyond a long are held at its end. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.store import written

LONG = 2**63 - 1
LIMB = 32
UNIT = 2.0**-24


def kept(vectors: DataFrame, id_col: str, vec_col: str, width: int) -> DataFrame:
    """(id, v) of the vectors that take part, components as double."""
    v = F.col(vec_col)
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & (F.size(v) == width) & fine).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))


def integers(v, scale: int) -> list[int]:
    """floor(scale * x) of every component, exactly; scale is a power of two."""
    return [int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in map(float, v)]


def _small(width: int) -> float:
    """Below it the squared distance of two vectors fits in int64."""
    return math.sqrt(2.0**62 / max(1, width)) / 2


def intervals(a: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of |c|^2 - 2 a.c for all rows of a and c, which hold integers as float64. What overflows is not a number."""
    n = a.shape[1] + 4
    gamma = n * UNIT / (1 - n * UNIT)
    with np.errstate(all="ignore"):
        dot = (a.astype(np.float32) @ c.astype(np.float32).T).astype(np.float64)
        own = (c * c).sum(axis=1)
        length = np.sqrt((a * a).sum(axis=1))[:, None] * np.sqrt(own)
        score = own - 2 * dot
        error = 2 * gamma * length * (1 + 1e-9) + 1e-12 * (own + 2 * np.abs(dot))
        return score - error, score + error


def _nearest(a: np.ndarray, raw: np.ndarray, c: list[list[int]], scale: int) -> tuple[np.ndarray, list[int]]:
    """The centroid of every row of a (integers as float64; raw: before scaling), and the rows that had to be computed exactly."""
    cf = np.array([[float(x) if abs(x) < 1 << 1000 else math.inf for x in row] for row in c])
    lo, hi = intervals(a, cf)
    with np.errstate(all="ignore"):
        open_ = ~(lo > hi.min(axis=1)[:, None])  # not a number: open
    out = open_.argmax(axis=1)
    exact = np.flatnonzero(open_.sum(axis=1) != 1)
    if not len(exact):
        return out, []
    small = _small(a.shape[1])
    fits = (np.abs(a[exact]).max(axis=1, initial=0) < small) & (np.abs(cf).max(initial=0) < small)
    plain = exact[fits]
    for part in np.array_split(plain, max(1, len(plain) // 1024)):
        d = ((a[part].astype(np.int64)[:, None, :] - cf.astype(np.int64)) ** 2).sum(axis=2)
        out[part] = np.where(open_[part], d, LONG).argmin(axis=1)
    for r in exact[~fits]:
        v = integers(raw[r], scale)
        out[r] = min((sum((x - y) ** 2 for x, y in zip(v, c[j])), j) for j in range(len(c)) if open_[r, j])[1]
    return out, exact.tolist()


def _rows(batch: pa.RecordBatch, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    raw = batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(-1, width)
    with np.errstate(over="ignore"):
        return np.floor(raw * scale), raw


def _sums(c: list[list[int]], width: int, scale: int):
    """Exact sums and counts of the vectors nearest to each centroid, in limbs."""

    def run(batches):
        total = defaultdict(lambda: [0] * (width + 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            a, raw = _rows(batch, width, scale)
            at, _ = _nearest(a, raw, c, scale)
            fits = np.abs(a).max(axis=1, initial=0) < _small(width)
            for j in np.unique(at):
                own = (at == j) & fits
                part = [*a[own].astype(np.int64).sum(axis=0).tolist(), int((at == j).sum())]
                total[j] = [x + y for x, y in zip(total[j], part)]
            for r in np.flatnonzero(~fits):
                t = total[at[r]]
                total[at[r]] = [*(x + y for x, y in zip(t, integers(raw[r], scale))), t[-1]]
        rows = []
        for j, values in total.items():
            limb = 0
            left = [(1 if x >= 0 else -1, abs(x)) for x in values]
            while any(x for _, x in left):
                rows.append((int(j), limb, [s * (x & ((1 << LIMB) - 1)) for s, x in left]))
                left, limb = [(s, x >> LIMB) for s, x in left], limb + 1
        cols = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.list_(pa.int64()))], names=["cluster", "limb", "sums"])

    return run


def _assign(c: list[list[int]], width: int, scale: int):
    """(id, cluster, distance) of every vector."""
    exact = np.array([[x if abs(x) <= LONG else 0 for x in row] for row in c], np.int64)
    near = np.array([max(map(abs, row), default=0) < _small(width) for row in c])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, raw = _rows(batch, width, scale)
            at, _ = _nearest(a, raw, c, scale)
            fits = (np.abs(a).max(axis=1, initial=0) < _small(width)) & near[at]
            d = np.zeros(len(a), np.int64)
            d[fits] = ((a[fits].astype(np.int64) - exact[at[fits]]) ** 2).sum(axis=1)
            for r in np.flatnonzero(~fits):
                d[r] = min(LONG, sum((x - y) ** 2 for x, y in zip(integers(raw[r], scale), c[at[r]])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.int32()), pa.array(d)], names=["id", "cluster", "distance"])

    return run


def first_centroids(rows: DataFrame, k: int, seed: int, scale: int) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``<seed>:<id>``, in that order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return [integers(r.v, scale) for r in rows.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()]


def moved(rows: DataFrame, c: list[list[int]], width: int, scale: int) -> list[list[int]]:
    """The centroids after a round: exact floor(sum / count); those without vectors stay."""
    parts = rows.select("v").mapInArrow(_sums(c, width, scale), "cluster int, limb int, sums array<long>")
    added = parts.select("cluster", "limb", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "limb", "at").agg(F.sum("x").alias("x"))
    total = defaultdict(lambda: [0] * (width + 1))
    for r in added.collect():  # centroids x limbs x components
        total[r.cluster][r.at] += r.x << (LIMB * r.limb)
    return [[x // total[j][-1] for x in total[j][:-1]] if j in total else row for j, row in enumerate(c)]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024, width: int = 64) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of every vector kept, written to the shared folder, and the final centroids. scale: a power of two."""
    rows = kept(vectors, id_col, vec_col, width)
    c = first_centroids(rows, k, seed, scale)
    if not c:
        return vectors.sparkSession.createDataFrame([], "id long, cluster int, distance long"), []
    for _ in range(rounds):
        before, c = c, moved(rows, c, width, scale)
        if c == before:
            break
    return written(rows.mapInArrow(_assign(c, width, scale), "id long, cluster int, distance long"), "clusters"), c


def report(vectors: DataFrame, **options) -> DataFrame:
    """The rows of cluster() with cluster_inertia, inertia and centroid_sha256."""
    found, c = cluster(vectors, **options)
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).cast("decimal(38,0)").alias("total"))
    sums = {r.cluster: int(r.total) for r in per.collect()}  # a row for each centroid
    every = min(LONG, sum(sums.values()))
    facts = [(j, min(LONG, sums.get(j, 0)), every, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for j, row in enumerate(c)]
    of = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(of), "cluster")
