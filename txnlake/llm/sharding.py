"""Balanced label propagation: shards with equal row counts that cut few links between equal texts.

Links are those between rows of equal text. A group of equal texts is a hub that its rows hang on, so the neighbours of a row are
counted for each shard, never paired. Rows start in hashed shards. In each round a Spark join brings every group's counts to the
shards where it has rows; rows move towards the shard that holds most of their neighbours. Quotas: what enters a shard must fit
in its free room and what leaves it; the moves between two shards that do not all fit are taken by gain (in powers of two), the
last level by hash. Where a shard is full, small groups that are whole in it
leave it, which cuts nothing, in exchange for rows that gain by coming. The statistics that the driver decides on have
shards**2 * 64 rows at most.

A round's table has a row for each (group, shard), not for each row, so a group that holds a third of all rows is at most
``shards`` rows. A row takes its place in its group's split by the hash of its id. At the end counts are made exact: in each shard
the rows beyond its quota (unlinked ones first, then those of the smallest groups) go to shards below theirs. Ranks for that, and
the slots, come from one range-partitioned sort whose places are written down; no shard is gathered in one task.

Law ``rows``: shard counts differ by one at most. Rows: null text has size 1 and belongs to the empty texts; null ids and
repeated rows are rows like any other. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.store import written

WHOLE_GROUPS_BELOW = 10  # log2 of the gain from which rows, not groups, are taken by hash


def quotas(want: np.ndarray, room: np.ndarray, rounds: int = 30) -> np.ndarray:
    """How much of want[i, j] may move from i to j if what enters j fits in room[j] and what leaves j."""
    take = want.astype(float).copy()
    for _ in range(rounds):
        into, limit = take.sum(axis=0), np.maximum(room, 0) + take.sum(axis=1)
        scale = np.where(into > limit, limit / np.maximum(into, 1e-9), 1.0)
        if (scale == 1).all():
            break
        take *= scale
    return take


def _accept(stats: list, room: np.ndarray, spare: np.ndarray, shards: int) -> tuple[dict[tuple[int, int], tuple[int, float]], np.ndarray]:
    """For (from, to): the level of gain above which all moves are taken, and the share taken at that level.

    Then, for (from, to), the share of the spare rows in `from` that leave in exchange for rows which found no room there.
    """
    want = np.zeros((shards, shards))
    for r in stats:
        want[r.shard, r.to] += r.n
    take, out = quotas(want, room), {}
    unmet = np.maximum(want - take, 0)
    swap = unmet * np.minimum(1.0, spare / np.maximum(unmet.sum(axis=0), 1e-9))
    take += swap
    for i in range(shards):
        for j in range(shards):
            left, levels = take[i, j], sorted((r for r in stats if (r.shard, r.to) == (i, j)), key=lambda r: -r.level)
            for r in levels:
                if left <= 0:
                    break
                out[i, j] = (r.level, min(1.0, left / r.n))
                left -= r.n
    return out, swap.T / np.maximum(spare, 1e-9)[:, None]


def _pick(pairs: list[tuple[Column, object]], default: object) -> Column:
    """The value of the first condition that holds."""
    return reduce(lambda out, p: F.when(p[0], F.lit(p[1])).otherwise(out), reversed(pairs), F.lit(default))


def _unit(*cols: object) -> Column:
    """A hash of the columns in [0, 1)."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def propagate(split: DataFrame, rows: int, shards: int, rounds: int) -> DataFrame:
    """(g, shard, n) of linked groups after the rounds; capacity for linked rows is an even share of all rows."""
    capacity = rows / shards
    for k in range(rounds):
        load = np.zeros(shards)
        for r in split.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # shards rows
            load[r.shard] = r.n
        room = capacity - load
        opened = F.array(*[F.lit(bool(x > 0.001 * capacity)) for x in room])
        place = F.struct("n", F.xxhash64("g", "shard").alias("tie"), "shard")
        best = split.groupBy("g").agg(F.sum("n").alias("total"), F.max(place).alias("any"), F.max(F.when(opened[F.col("shard")], place)).alias("open"))
        scored = split.join(best, "g")
        # the fullest neighbouring shard while it has room, else the fullest that has; swaps only where none has
        goal = F.when(opened[F.col("any.shard")], F.col("any")).otherwise(F.coalesce("open", "any"))
        scored = scored.withColumn("goal", goal)
        ahead = (F.col("goal.n") > F.col("n")) | ((F.col("goal.n") == F.col("n")) & (F.col("goal.tie") > F.xxhash64("g", "shard")))
        to = F.when((F.col("goal.shard") != F.col("shard")) & ahead, F.col("goal.shard"))
        level = F.floor(F.log2(F.col("goal.n").cast("double"))).cast("int")
        scored = scored.select("g", "shard", "n", to.alias("to"), level.alias("level"), (F.col("n") == F.col("total")).alias("whole"))
        # a small group that is whole in a shard may leave it without a cut, to make room for rows that gain by coming
        free = F.col("to").isNull() & F.col("whole") & (F.col("n") <= max(2.0, capacity / 64))
        scored = written(scored.withColumn("free", free).where("to IS NOT NULL OR free"), "moves")
        stats = scored.where("to IS NOT NULL").groupBy("shard", "to", "level").agg(F.sum("n").alias("n")).collect()  # shards**2 * 64 rows at most
        spare = np.zeros(shards)
        for r in scored.where("free").groupBy("shard").agg(F.sum("n").alias("n")).collect():
            spare[r.shard] = r.n
        taken, leaving = _accept(stats, room, spare, shards)
        if not taken:
            break
        at = lambda i, j: (F.col("shard") == i) & (F.col("to") == j)
        least = _pick([(at(i, j), v[0]) for (i, j), v in taken.items()], 99)
        share = _pick([(at(i, j), v[1]) for (i, j), v in taken.items()], 0.0)
        part = F.when(F.col("level") >= WHOLE_GROUPS_BELOW, F.floor(F.col("n") * share).cast("long")).otherwise(F.when(_unit("g", F.lit(k)) < share, F.col("n")).otherwise(F.lit(0)))
        n = F.when(F.col("level") > least, F.col("n")).when(F.col("level") < least, F.lit(0)).otherwise(part).cast("long")
        moved = scored.where("to IS NOT NULL").select("g", "shard", "to", n.alias("n")).where("n > 0")
        if leaving.any():
            ends = np.cumsum(leaving, axis=1)
            place = _pick([((F.col("shard") == i) & (_unit("g", F.lit(100 + k)) < float(ends[i, j])), j) for i in range(shards) for j in range(shards) if leaving[i, j] > 0], -1)
            moved = moved.unionByName(scored.where("free").select("g", "shard", place.alias("to"), "n").where("to >= 0"))
        change = split.select("g", "shard", "n").unionByName(moved.select("g", "shard", (-F.col("n")).alias("n"))).unionByName(moved.select("g", F.col("to").alias("shard"), "n"))
        split = written(change.groupBy("g", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "split")
    return split


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", rounds: int = 6) -> DataFrame:
    """(id_col, size, text_crc32, g, shard, slot): one row for each row of docs; g tells groups of equal texts apart."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("g"))
    rows = written(rows.withColumn("start", F.pmod(F.xxhash64(F.col(id_col), "g", F.lit(1)), F.lit(shards)).cast("int")), "rows")
    counts = rows.groupBy("g", "start").agg(F.count("*").alias("n"))
    total = counts.groupBy("g").agg(F.sum("n").alias("total")).where("total > 1")
    split = written(counts.join(total, "g").select("g", F.col("start").alias("shard"), "n"), "split")
    count = rows.count()
    split = propagate(split, count, shards, rounds)
    # a group's split as the ends of its shards' parts; at most `shards` entries
    ends = split.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("parts"), F.sum("n").alias("total"))
    rows = rows.join(ends, "g", "left")
    at = _unit(id_col, F.lit(2)) * F.col("total")
    found = F.aggregate(
        "parts",
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(-1).alias("shard")),
        lambda acc, p: F.struct((acc["end"] + p["n"]).alias("end"), F.when(acc["shard"] >= 0, acc["shard"]).when(at < acc["end"] + p["n"], p["shard"]).otherwise(F.lit(-1)).alias("shard")),
        lambda acc: acc["shard"],
    )
    rows = rows.withColumn("shard", F.when(F.col("total").isNull(), F.col("start")).otherwise(F.when(found >= 0, found).otherwise(F.col("start"))))
    rows = rows.select(id_col, "size", "text_crc32", "g", F.coalesce("total", F.lit(1)).alias("links"), "shard")
    order = ["shard", "links", "g", id_col]
    rows = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "placed")
    parts = sorted(tuple(r) for r in rows.groupBy(F.shiftright("place", 33).alias("part")).count().collect())  # a row for each partition
    held = np.zeros(shards, np.int64)
    for r in rows.groupBy("shard").count().collect():
        held[r[0]] = r[1]
    quota = np.full(shards, count // shards)
    quota[np.argsort(-held, kind="stable")[: count % shards]] += 1
    surplus, lack = np.maximum(held - quota, 0), np.maximum(quota - held, 0)
    stay = held - surplus
    first, movers, gaps = (np.cumsum(x) - x for x in (held, surplus, lack))
    offsets = spark.createDataFrame([(int(p), int(o)) for (p, _), o in zip(parts, np.cumsum([0, *(n for _, n in parts)])[:-1])], "part long, before long")
    rows = rows.withColumn("part", F.shiftright("place", 33)).join(F.broadcast(offsets), "part")
    of = lambda v: F.array(*[F.lit(int(x)) for x in v])[F.col("shard")]
    rows = rows.withColumn("rank", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) - of(first))
    rows = rows.withColumn("nth", F.when(F.col("rank") < of(surplus), of(movers) + F.col("rank")))
    goal = _pick([(F.col("nth") < int(gaps[j] + lack[j]), j) for j in range(shards) if lack[j]], -1)
    rows = rows.withColumn("shard", F.when(F.col("nth").isNull(), F.col("shard")).otherwise(goal)).withColumn("slot", F.when(F.col("nth").isNull(), F.col("rank")))
    # the shard is the new one here; rows that stayed have their slot but for the surplus before them
    slot = F.when(F.col("nth").isNull(), F.col("slot") - of(surplus)).otherwise(of(stay) + F.col("nth") - of(gaps))
    return rows.select(id_col, "size", "text_crc32", "g", "shard", slot.alias("slot"))
