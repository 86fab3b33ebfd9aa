"""Nearest neighbours by cosine over an inverted multi-index.

Vectors are brought to length 1 and cut in two halves, and each half is quantised with a codebook of its own (k-means on a bounded sample,
fitted in one task). A pair of codes is a cell; the index holds every vector in its cell. For a query the pairs are traversed in the order
of their summed squared distance with a heap, until the cells met hold ``budget`` entries; these are reranked by exact cosine.

The budget is measured, not set: ``trial`` queries, drawn by hash, are first answered by a whole scan, and their true neighbours show how far
the traversal must go so that a share ``recall`` of them is met. Where the vectors are clustered that is a small part of them; on noise
no index of this kind can do with little.

An entry is a distinct vector with its k + 1 smallest ids: copies have equal scores and ties go to the smaller id, so no other id of a
vector can be in an answer, and a vector that a third of all rows share costs as much as one. Queries of one vector are asked once.
Cells are laid out one after another and cut into blocks of about ``block`` entries, a large cell into several; a query goes to the
blocks that hold its cells, a block's entries come first in its task and queries stream past them. Nothing that grows with the input is
collected or broadcast: codebooks and cell counts have at most ``codes`` squared rows.

Rows: vectors that are null, zero, empty or hold null or non-finite components, and rows without id, take no part. Components that a
shorter vector lacks count as zero. An id is ranked once for a query, by its nearest vector; repeated rows are one candidate; of several
vectors with a query's id the least one is the query. A query is not its own candidate. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm.store import written

ENTRY, ASKED = 0, 1
SLACK = 1e-9  # more than the rounding error of a matrix product of unit vectors


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, h1, h2) of the vectors that take part; two hashes of 64 bits stand for the vector."""
    v = F.col(vec_col)
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.where(F.col(id_col).isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    return rows.select("id", "v", F.xxhash64(F.lit(1), "v").alias("h1"), F.xxhash64(F.lit(2), "v").alias("h2"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, each scaled by a power of two, which changes no cosine and keeps squares finite."""
    flat, at = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), column.offsets.to_numpy()
    at = at - at[0]
    n = len(column)
    if n and len(flat) == n * width and (np.diff(at) == width).all():
        out = flat.reshape(n, width)
    else:
        out = np.zeros((n, width))
        for i, (a, b) in enumerate(zip(at[:-1], at[1:])):
            out[i, : b - a] = flat[a:b]
    _, exponent = np.frexp(np.abs(out).max(axis=1, initial=0))
    return np.ldexp(out, -exponent[:, None])


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.sqrt((m * m).sum(axis=1))[:, None]


def cosine(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Of q and every row of m, the same whatever else stands in m."""
    return (m * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((m * m).sum(axis=1)))


def _squares(a: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * a @ codes.T + (codes * codes).sum(axis=1), 0)


def _k_means(a: np.ndarray, k: int, rounds: int) -> np.ndarray:
    c = a[np.random.default_rng(0).choice(len(a), min(k, len(a)), replace=False)]
    for _ in range(rounds):
        at = _squares(a, c).argmin(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, a)
        n = np.bincount(at, minlength=len(c))[:, None]
        c = np.where(n > 0, sums / np.maximum(n, 1), c)
    return c


def codebooks(entries: DataFrame, n: int, width: int, codes: int, sample: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Codes for the first and the second half, from about `sample` entries, in one task."""
    half = (width + 1) // 2

    def fit(batches):
        ids, rows = [], []
        for b in batches:
            ids.append(b.column(0).to_numpy())
            rows.append(_unit(_matrix(b.column(1), width)))
        a = np.concatenate(rows)[np.argsort(np.concatenate(ids), kind="stable")]
        for part, own in ((0, a[:, :half]), (1, a[:, half:])):
            c = _k_means(own, codes, rounds)
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(c), pa.int32()), pa.array(c.tolist(), pa.list_(pa.float64()))], names=["part", "code"])

    drawn = entries.where(_share(F.col("h1"), sample / n)).select("h1", "v")
    if drawn.limit(1).count() == 0:
        drawn = entries.orderBy("h1").limit(1).select("h1", "v")
    found = drawn.repartition(1).mapInArrow(fit, "part int, code array<double>").collect()
    return tuple(np.array([r.code for r in found if r.part == p]).reshape(-1, w) for p, w in ((0, half), (1, width - half)))


def _share(h: Column, share: float) -> Column:
    """About this share of the rows, drawn by a hash."""
    return F.pmod(F.xxhash64(F.lit(3), h), F.lit(1 << 40)) < F.lit(int(min(1.0, share) * (1 << 40)))


def traverse(d1: np.ndarray, d2: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of codes in the order of their summed distance. The heap holds one pair for each first code met."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    o1, o2 = o1.tolist(), o2.tolist()
    heap = [(s1[0] + s2[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield o1[i], o2[j]
        if j == 0 and i + 1 < len(s1):
            heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))
        if j + 1 < len(s2):
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))


def cells_for(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, budget: int) -> list[int]:
    """The cells that hold entries, until budget of them are met."""
    out, met = [], 0
    for i, j in traverse(d1, d2):
        cell = i * len(d2) + j
        if counts[cell]:
            out.append(cell)
            met += counts[cell]
            if met >= budget:
                break
    return out


class _Best:
    """For each query the `most` best distinct ids so far, ties to the smaller id."""

    def __init__(self, most: int):
        self.most, self.held = most, {}

    def add(self, key: tuple[int, int], found: list[tuple[float, int]]) -> None:
        best, seen = [], set()
        for s, i in sorted(self.held.get(key, []) + found):
            if i not in seen:
                seen.add(i)
                best.append((s, i))
                if len(best) == self.most:
                    break
        self.held[key] = best

    def batch(self) -> pa.RecordBatch:
        rows = [(*key, i, -s) for key, best in self.held.items() for s, i in best]
        self.held = {}
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=["h1", "h2", "id", "score"])


FOUND = "h1 long, h2 long, id long, score double"


def _rank(best: _Best, keys: list, q: np.ndarray, unit: np.ndarray, m: np.ndarray, ids: list[list[int]], may: np.ndarray | None) -> None:
    """Put the nearest of the rows of m, which has unit rows as well, into best; may: the rows that a query may have."""
    scores = _unit(q) @ unit.T
    if may is not None:
        scores[~may] = -np.inf
    n = scores.shape[1]
    for key, own, s in zip(keys, q, scores):
        floor = np.partition(s, n - best.most)[n - best.most] - SLACK if n > best.most else -np.inf
        near = np.flatnonzero((s >= floor) & (s > -np.inf))
        if len(near):
            exact = cosine(own, m[near]).tolist()
            best.add(key, [(-x, i) for x, r in zip(exact, near) for i in ids[r]])


def _scan(trial: list, width: int, k: int):
    """(query, score, cell) of the k entries nearest to each of a bounded list of queries, their own entries left out, in every task."""
    keys = np.array([(r.h1, r.h2) for r in trial], np.int64)
    q = _unit(_matrix(pa.array([list(r.v) for r in trial], pa.list_(pa.float64())), width))

    def run(batches):
        scores, cells = np.full((len(q), 0), -np.inf), np.zeros((len(q), 0), np.int32)
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                s = q @ _unit(_matrix(part.column("v"), width)).T
                s[(part.column("h1").to_numpy() == keys[:, :1]) & (part.column("h2").to_numpy() == keys[:, 1:])] = -np.inf
                scores = np.concatenate([scores, s], axis=1)
                cells = np.concatenate([cells, np.broadcast_to(part.column("cell").to_numpy(), s.shape)], axis=1)
                best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                scores, cells = np.take_along_axis(scores, best, 1), np.take_along_axis(cells, best, 1)
        at, n = np.nonzero(scores > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(scores[at, n]), pa.array(cells[at, n], pa.int32())], names=["q", "score", "cell"])

    return run


def _rerank(width: int, most: int, flush: int = 50_000):
    """Blocks in order, in each the entries before the queries. Memory: one block, and the best of at most `flush` queries."""

    def run(batches):
        best, block, entries, ready = _Best(most), None, [], None
        for b in batches:
            blocks, kinds = b.column("block").to_numpy(), b.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for start, end in zip([0, *cuts], [*cuts, b.num_rows]):
                if end == start:
                    continue
                part = b.slice(start, end - start)
                if blocks[start] != block:
                    block, entries, ready = blocks[start], [], None
                if kinds[start] == ENTRY:
                    entries.append((_matrix(part.column("v"), width), part.column("cells").flatten().to_numpy(), part.column("ids").to_pylist()))
                    continue
                if not entries:
                    continue
                if ready is None:
                    m = np.concatenate([e[0] for e in entries])
                    known, at = np.unique(np.concatenate([e[1] for e in entries]), return_inverse=True)
                    ready = m, _unit(m), known, at, [i for e in entries for i in e[2]]
                m, unit, known, at, ids = ready
                for s in range(0, part.num_rows, 256):
                    some = part.slice(s, 256)
                    lists = some.column("cells")
                    flat, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
                    place = np.minimum(np.searchsorted(known, flat), len(known) - 1)
                    there = known[place] == flat
                    may = np.zeros((some.num_rows, len(known)), bool)
                    may[np.repeat(np.arange(some.num_rows), sizes)[there], place[there]] = True
                    keys = list(zip(some.column("h1").to_pylist(), some.column("h2").to_pylist()))
                    _rank(best, keys, _matrix(some.column("v"), width), unit, m, ids, may[:, at])
                if len(best.held) > flush:
                    yield best.batch()
        yield best.batch()

    return run


def _top(found: DataFrame, most: int) -> DataFrame:
    """The `most` best ids of each query, an id once."""
    order = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "id")
    once = found.groupBy("h1", "h2", "id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, codes: int = 256, sample: int = 16_384, trial: int = 256, recall: float = 0.96, block: int = 2048) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found for each query. is_query: a condition over id_col that marks the rows asked.

    Of each half there are at most `codes` codes, and as many as leave about eight entries to a cell.
    """
    spark, most = vectors.sparkSession, k + 1
    rows = usable(vectors, id_col, vec_col)
    distinct_ids = rows.select("h1", "h2", "id").distinct()
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    few = distinct_ids.withColumn("n", place).where(F.col("n") <= most).groupBy("h1", "h2").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = written(rows.groupBy("h1", "h2").agg(F.first("v").alias("v")).join(few, ["h1", "h2"]), "entries")
    n, width = entries.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    width = max(2, width)  # so that there are two halves
    queries = written(usable(vectors.where(is_query), id_col, vec_col).groupBy("id").agg(F.min(F.struct("v", "h1", "h2")).alias("q")).select("id", "q.h1", "q.h2"), "queries")
    asked = written(entries.join(queries.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").select("h1", "h2", "v"), "asked")
    n_asked = asked.count()
    if not n_asked:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    codes = max(1, min(codes, int((n / 8) ** 0.5)))
    first, second = codebooks(entries, n, width, codes, sample)
    half, across = first.shape[1], len(second)

    def placed(batches):
        for b in batches:
            u = _unit(_matrix(b.column("v"), width))
            cell = _squares(u[:, :half], first).argmin(axis=1) * across + _squares(u[:, half:], second).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32())], names=[*b.schema.names, "cell"])

    index = written(entries.mapInArrow(placed, f"h1 long, h2 long, v {dict(entries.dtypes)['v']}, ids array<bigint>, cell int"), "index")
    counts = np.zeros(len(first) * across, np.int64)
    for r in index.groupBy("cell").count().collect():  # codes squared at most
        counts[r.cell] = r["count"]
    drawn = asked.where(_share(F.col("h1"), trial / n_asked)).collect()  # about `trial` rows
    budget = max(most, _budget(index, drawn, first, second, counts, width, k, recall)) if drawn else n
    start = np.cumsum(counts) - counts
    layout = spark.createDataFrame([(int(c), int(start[c]), int(counts[c])) for c in np.flatnonzero(counts)], "cell int, start long, n long")

    def sent(batches):
        """A row for each query and block, with the cells to look at there."""
        for whole in batches:
            for b in (whole.slice(at, 256) for at in range(0, whole.num_rows, 256)):
                u = _unit(_matrix(b.column("v"), width))
                times, to, cells = [], [], []
                for r, (d1, d2) in enumerate(zip(_squares(u[:, :half], first), _squares(u[:, half:], second))):
                    own = {}
                    for c in cells_for(d1, d2, counts, budget):
                        for at in range(start[c] // block, (start[c] + counts[c] - 1) // block + 1):
                            own.setdefault(int(at), []).append(c)
                    times += [r] * len(own)
                    to += own
                    cells += own.values()
                rows = [b.column(c).take(pa.array(times, pa.int64())) for c in ("h1", "h2", "v")]
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), *rows, pa.array(cells, pa.list_(pa.int32()))], names=["block", "h1", "h2", "v", "cells"])

    to_block = F.floor((F.col("start") + F.pmod(F.xxhash64(F.lit(4), "h1", "h2"), F.col("n"))) / block)
    held = index.join(F.broadcast(layout), "cell").select(to_block.alias("block"), F.lit(ENTRY).alias("kind"), "h1", "h2", "v", F.array("cell").alias("cells"), "ids")
    kind = f"block long, h1 long, h2 long, v {dict(entries.dtypes)['v']}, cells array<int>"
    going = asked.repartition(max(8, -(-n_asked // 1024)), "h1", "h2").mapInArrow(sent, kind).select("block", F.lit(ASKED).alias("kind"), "h1", "h2", "v", "cells", F.lit(None).cast("array<bigint>").alias("ids"))
    met = held.unionByName(going).repartition("block").sortWithinPartitions("block", "kind")
    best = _top(met.mapInArrow(_rerank(width, most), FOUND), most)
    lists = best.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("id").alias("found")))).alias("best"))
    answers = queries.join(lists, ["h1", "h2"]).select(F.col("id").alias("query_id"), F.slice(F.filter("best", lambda x: x["found"] != F.col("id")), 1, k).alias("best"))
    out = answers.select("query_id", F.posexplode("best").alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.found").alias("id"), (-F.col("x.s")).alias("score"))


def _budget(index: DataFrame, drawn: list, first: np.ndarray, second: np.ndarray, counts: np.ndarray, width: int, k: int, recall: float) -> int:
    """How many entries a traversal must meet so that it meets a share `recall` of the drawn queries' true neighbours."""
    near = index.mapInArrow(_scan(drawn, width, k), "q int, score double, cell int")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cell"))
    wanted: dict[int, list[int]] = {}
    for r in near.withColumn("n", place).where(F.col("n") <= k).collect():  # k for each drawn query
        wanted.setdefault(r.q, []).append(r.cell)
    u = _unit(_matrix(pa.array([list(r.v) for r in drawn], pa.list_(pa.float64())), width))
    half, across, met = first.shape[1], len(second), []
    for q, cells in wanted.items():
        d1, d2 = _squares(u[q : q + 1, :half], first)[0], _squares(u[q : q + 1, half:], second)[0]
        left, total = set(cells), 0
        for i, j in traverse(d1, d2):
            cell = i * across + j
            total += int(counts[cell])
            if cell in left:
                left.remove(cell)
                met += [total] * cells.count(cell)
                if not left:
                    break
    return sorted(met)[max(0, int(np.ceil(recall * len(met))) - 1)] if met else 0
