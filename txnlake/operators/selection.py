"""Exact percentiles by distributed selection: no group's values ever stand in one buffer.

A round takes split values from a quantile sketch of each group and counts, exactly, what lies below and at them. A wanted rank then either
is a split's own value or lies between two splits, and only rows strictly between those go on to the next round, a small part of the
rows however they are distributed: a value that is held by many rows becomes a split and is answered. Groups of at most `small` rows
left are sorted in one row. The first round reads the rows twice, each later one what the one before it left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions.store import release, written

STATE = ["g", "n", "first", "last", "a1", "a2", "below", "left"]


def exact_percentile(df: DataFrame, by: list[str], value: Column, p: float = 0.5, small: int = 100_000, parts: int = 16) -> DataFrame:
    """(by, n, percentile): of the values that are not null, interpolated between the two nearest ranks. Groups may be null."""
    key = F.struct(*[F.col(b) for b in by]) if by else F.struct(F.lit(0).alias("all"))
    rows = written(df.select(key.alias("g"), value.cast("double").alias("v")).where("v IS NOT NULL"), "values")
    at = (F.col("n") - 1) * F.lit(float(p))
    blank = F.lit(None).cast("double")
    groups = rows.groupBy("g").agg(F.count("*").alias("n"))
    groups = written(groups.select("g", "n", F.floor(at).alias("first"), F.ceil(at).alias("last"), blank.alias("a1"), blank.alias("a2"), F.lit(0).cast("long").alias("below"), F.col("n").alias("left")), "groups")
    answers = []
    while True:
        answers.append(written(_sorted(groups.where(F.col("left") <= small), rows), "answers"))
        large = groups.where(F.col("left") > small)
        if not large.limit(1).count():
            break
        before = groups, rows
        groups = written(_narrowed(large, rows, parts), "groups")
        rows = written(_own(rows, groups).where((F.col("v") > F.col("lo")) & (F.col("v") < F.col("hi"))).select("g", "v"), "values")
        groups = groups.select(*STATE)
        release(*before)
    found = reduce(DataFrame.unionByName, answers)
    at = (F.col("n") - 1) * F.lit(float(p))
    mixed = (F.col("last") - at) * F.col("a1") + (at - F.col("first")) * F.col("a2")
    result = F.when((F.col("first") == F.col("last")) | (F.col("a1") == F.col("a2")), F.col("a1")).otherwise(mixed)
    return found.select(*[F.col(f"g.`{b}`") for b in by], "n", result.alias("percentile"))


def _own(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rows with what is known of their group; other groups' rows go."""
    return rows.join(groups.withColumnRenamed("g", "_g"), F.col("g").eqNullSafe(F.col("_g"))).drop("_g")


def _sorted(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """The answers of groups of which few rows are left."""
    lists = _own(rows, groups.select("g")).groupBy(F.col("g").alias("_g")).agg(F.sort_array(F.collect_list("v")).alias("vs"))
    both = groups.join(lists, F.col("g").eqNullSafe(F.col("_g")), "left")
    nth = lambda rank: F.get("vs", (F.col(rank) - F.col("below")).cast("int"))
    return both.select("g", "n", "first", "last", F.coalesce("a1", nth("first")).alias("a1"), F.coalesce("a2", nth("last")).alias("a2"))


def _narrowed(groups: DataFrame, rows: DataFrame, parts: int) -> DataFrame:
    """STATE after a round, and lo and hi: the open interval where the unanswered ranks lie. No such rank: nothing is left."""
    cuts = [i / parts for i in range(parts + 1)]
    sketch = _own(rows, groups.select("g")).groupBy("g").agg(F.percentile_approx("v", cuts, 10 * parts).alias("s"), F.min("v").alias("least"), F.max("v").alias("most"))
    sketch = sketch.select("g", F.array_sort(F.array_distinct(F.concat("s", F.array("least", "most")))).alias("s"))
    sketch = written(sketch, "splits")
    size = parts + 3
    split = [F.get("s", F.lit(i)) for i in range(size)]
    counts = _own(rows, sketch).groupBy("g").agg(F.first("s").alias("s"), *[F.count_if(F.col("v") < x).alias(f"l{i}") for i, x in enumerate(split)], *[F.count_if(F.col("v") <= x).alias(f"e{i}") for i, x in enumerate(split)])
    each = F.array(*[F.struct(F.get("s", F.lit(i)).alias("v"), F.col(f"l{i}").alias("l"), F.col(f"e{i}").alias("e")) for i in range(size)])
    counts = counts.select(F.col("g").alias("_g"), F.slice(each, F.lit(1), F.size("s")).alias("c"))
    both = groups.join(counts, F.col("g").eqNullSafe(F.col("_g")))
    rank = lambda name: F.col(name) - F.col("below")
    at = lambda name: F.try_element_at(F.filter("c", lambda x: (x["l"] <= rank(name)) & (rank(name) < x["e"])), F.lit(1))["v"]
    answer = lambda a, name: F.coalesce(F.col(a), at(name))
    both = both.withColumns({"b1": answer("a1", "first"), "b2": answer("a2", "last")})
    open_rank = F.when(F.col("b1").isNull(), rank("first")).when(F.col("b2").isNull(), rank("last"))
    # a column of its own: in a lambda of the select below, "below" would be the new one
    both = both.withColumn("r", open_rank)
    under = F.filter("c", lambda x: x["e"] <= F.col("r"))
    over = F.filter("c", lambda x: x["l"] > F.col("r"))
    low, high = F.try_element_at(under, F.lit(-1)), F.try_element_at(over, F.lit(1))
    is_open = F.col("r").isNotNull()
    return both.select(
        "g", "n", "first", "last", F.col("b1").alias("a1"), F.col("b2").alias("a2"), F.when(is_open, F.col("below") + low["e"]).otherwise(F.col("below")).alias("below"),
        F.when(is_open, high["l"] - low["e"]).otherwise(F.lit(0)).alias("left"), F.when(is_open, low["v"]).alias("lo"), F.when(is_open, high["v"]).alias("hi"),
    )
