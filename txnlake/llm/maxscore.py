"""Exact top-k by inner product with MaxScore.

Terms are the vector components. In a shard of candidates each term has a bound: the most that it can add to the score of any
candidate there, given the query's weight. Sorted by bound, the longest prefix of terms whose bounds together stay below the
query's k-th best score so far is non-essential: no candidate can get in by those alone. Postings of essential terms are
traversed for the whole shard; the others are probed, strongest first, for candidates that are still competitive. Shards return
their own k best and are merged. A task's first shard is small (``first``) and each next one twice as large, up to ``shard``: only the
first is scored without a k-th best score to beat.

Queries are taken in blocks of at most ``block`` rows, so what is sent to the executors is bounded; candidates stay where they
were read, and no shuffle carries vectors. Scores are integers: double arithmetic is exact below 2**53, and a shard whose bound
is beyond that is computed with Python integers; scores beyond a long are held at its ends.

Rows: vectors that are null or hold null or non-finite components, and rows without id, take no part. Components that a shorter
vector lacks count as zero. Rows with the query's own id are not its candidates; of several rows with a query's id the least
vector is the query; repeated candidates each take a rank. Ties go to the smaller id. Empty vectors score 0. Empty tables give
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm.store import written

EXACT = float(2**53)
LONG = 2**63 - 1


def _usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col)
    fine = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(F.col(id_col).isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))


def _matrix(vectors: list, width: int, scale: float) -> np.ndarray:
    """Terms as rows, candidates as columns: a term's postings lie side by side."""
    out = np.zeros((width, len(vectors)))
    lengths = np.fromiter(map(len, vectors), np.int64, len(vectors))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        if n:
            out[:n, at] = np.floor(np.stack([vectors[i] for i in at]) * scale).T
    return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= floor
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _search(q: np.ndarray, qid: int, ids: np.ndarray, postings: np.ndarray, hi: np.ndarray, lo: np.ndarray, held: tuple, k: int, step: int = 8) -> tuple:
    """The k best of held and of this shard's candidates."""
    floor = held[1][-1] if len(held[1]) == k else -np.inf
    bound = np.maximum(q * hi, q * lo)
    order = np.argsort(bound)
    total = np.cumsum(bound[order])
    split = int(np.searchsorted(np.maximum.accumulate(total), floor)) if floor > -np.inf else 0
    others, essential = order[:split], np.sort(order[split:])
    if len(essential) == len(q):
        scores, alive = q @ postings, None
    elif len(essential):
        scores, alive = q[essential] @ postings[essential], None
    else:
        return held  # all bounds together stay below the k-th score
    rest = total[split - 1] if split else 0.0
    for i in range(split, 0, -step):
        keep = np.flatnonzero(scores + rest >= floor)
        alive = keep if alive is None else alive[keep]
        scores = scores[keep]
        if not len(alive):
            return held
        part = others[max(0, i - step) : i]
        scores = scores + q[part] @ postings[np.ix_(part, alive)]
        rest = total[i - step - 1] if i - step > 0 else 0.0
    got = ids if alive is None else ids[alive]
    own = (scores >= floor) & (got != qid)
    return _best(np.concatenate([held[0], got[own]]), np.concatenate([held[1], scores[own]]), k)


def _plain(q: np.ndarray, qid: int, ids: np.ndarray, postings: np.ndarray, held: tuple, k: int) -> tuple:
    """The same in Python integers, for values at which doubles are not exact."""
    qi = [int(x) for x in q]
    rows = [(-max(-LONG - 1, min(LONG, sum(a * int(b) for a, b in zip(qi, col)))), int(i)) for i, col in zip(ids, postings.T) if i != qid]
    best = sorted(rows + [(-int(s), int(i)) for i, s in zip(*held)])[:k]
    return np.array([i for _, i in best], np.int64), np.array([-s for s, _ in best], object)


def _scan(queries: list[tuple[int, list[float]]], k: int, scale: float, shard: int, first: int):
    width = max((len(v) for _, v in queries), default=0)
    qids = [i for i, _ in queries]
    qs = _matrix([np.array(v) for _, v in queries], width, scale).T

    def solve(ids, vectors, held):
        postings = _matrix([v[:width] for v in vectors], width, scale)
        hi, lo = postings.max(axis=1, initial=-np.inf), postings.min(axis=1, initial=np.inf)
        most = np.maximum(np.abs(hi), np.abs(lo))
        for j, (qid, q) in enumerate(zip(qids, qs)):
            if float(np.abs(q) @ most) < EXACT and held[j][1].dtype != object:
                held[j] = _search(q, qid, ids, postings, hi, lo, held[j], k)
            else:
                held[j] = _plain(q, qid, ids, postings, held[j], k)

    def run(batches):
        held = [(np.zeros(0, np.int64), np.zeros(0))] * len(qids)
        ids, vectors, size = [], [], min(first, shard)
        for batch in batches:
            ids.append(batch.column(0).to_numpy())
            col = batch.column(1)
            flat, at = col.flatten().to_numpy(), col.offsets.to_numpy()
            at = at - at[0]
            vectors += [flat[a:b] for a, b in zip(at[:-1], at[1:])]
            while len(vectors) >= size:
                every = np.concatenate(ids)
                solve(every[:size], vectors[:size], held)
                ids, vectors, size = [every[size:]], vectors[size:], min(2 * size, shard)
        if vectors:
            solve(np.concatenate(ids), vectors, held)
        rows = [(q, int(i), int(s)) for q, (got, scores) in zip(qids, held) for i, s in zip(got, scores)]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], names=["query_id", "id", "score"])

    return run


def top_k(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, scale: float = 256.0, block: int = 4096, shard: int = 8192, first: int = 64) -> DataFrame:
    """(query_id, rank, id, score): the k best candidates of each query, with scores over floor(scale * x).

    is_query: a condition over id_col that marks the rows used as queries.
    """
    rows = _usable(vectors, id_col, vec_col)
    asked = _usable(vectors.where(is_query), id_col, vec_col).groupBy("id").agg(F.min("v").alias("v"))
    blocks = -(-asked.count() // block)
    parts = []
    for b in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b) if blocks > 1 else asked
        mine = sorted((r[0], list(r[1])) for r in own.collect())  # about block rows
        found = rows.mapInArrow(_scan(mine, k, scale, shard, first), "query_id long, id long, score long")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
        parts.append(written(best, "topk") if blocks > 1 else best)
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
