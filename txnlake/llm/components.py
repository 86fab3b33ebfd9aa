"""Connected components by alternating large-star and small-star steps over Spark joins.

The number of edges never grows from step to step, rounds are logarithmic in practice, and a hub's edges are joined (and
split by adaptive execution), never gathered in one task. Nodes may be of any orderable type. Each round is written to the
shared folder, so a lost executor repeats one round at most; the table of the round before is deleted then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.store import release, written


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return (r[0], r[1])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select(F.col("b").alias("x"), F.col("a").alias("y")))
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return both.join(least, "x").where(F.col("y") > F.col("x")).select(F.col("y").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has an edge; root is the least node of its component.

    Self-loops, repeated and null-ended edges are ignored. No edges: no rows.
    """
    e = edges.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).where(f"`{left}` IS NOT NULL AND `{right}` IS NOT NULL AND a <> b").distinct()
    e = written(e, "edges")
    mark = _mark(e)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        before, e = e, written(_small_star(_large_star(e)), "stars")
        release(before)
        now = _mark(e)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
