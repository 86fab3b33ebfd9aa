"""Exact percentiles, pages and samples."""

import random

import pytest
from pyspark.sql import functions as F

from txnlake.operators.selection import exact_percentile


@pytest.mark.parametrize("p", [0.0, 0.5, 0.37, 1.0])
def test_equals_percentile(spark, p):
    """Skewed, repeated and two-valued groups, null groups and values, groups of one row."""
    rnd = random.Random(1)
    rows = [("a", rnd.gauss(0, 1) * 10 ** rnd.randrange(-20, 20)) for _ in range(3000)] + [("b", float(i % 2)) for i in range(1000)] + [("c", 7.0)] * 500
    rows += [(None, float(i)) for i in range(700)] + [("d", 1.0), ("d", None), ("e", None), ("f", -0.5), ("f", 2.0)] + [("g", 1.0 if i < 501 else 2.0) for i in range(1001)]
    df = spark.createDataFrame(rows, "k string, v double")
    want = {r.k: r.x for r in df.groupBy("k").agg(F.percentile("v", F.lit(p)).alias("x")).collect() if r.x is not None}
    got = exact_percentile(df, ["k"], F.col("v"), p, small=40)
    assert {r.k: r.percentile for r in got.collect()} == want and {r.k: r.n for r in got.collect()}["a"] == 3000


def test_all_rows_as_one_group(spark):
    df = spark.range(20_000).select((F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100).alias("v"))
    want = df.agg(F.percentile("v", F.lit(0.5))).first()[0]
    assert exact_percentile(df, [], F.col("v"), small=10).first().percentile == want
    assert exact_percentile(df.limit(0), [], F.col("v")).count() == 0




def test_pages(spark):
    """Pages equal those of a sorted offset; a late one reads no more than an early one, with ties and nulls in the order."""
    from txnlake.operators.paging import Pages

    df = spark.range(30_000).select(F.col("id"), F.when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id"), F.lit(500))).alias("at"))
    pages = Pages(df.repartition(7), ["at", "id"])
    want = [tuple(r) for r in df.orderBy("at", "id").select("id", "at").collect()]
    assert pages.total == 30_000
    for number, size in ((0, 10), (3, 100), (299, 100), (7, 4001), (300, 100), (0, 40_000)):
        assert [tuple(r) for r in pages.page(number, size).collect()] == want[number * size : (number + 1) * size]
    plan = pages.scan(20_000, 10)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(at_" in plan and "Exchange" not in plan
    assert Pages(df.limit(0), ["at", "id"]).page(0, 10).count() == 0
    pages.close()


def test_samples_do_not_depend_on_partitions(spark):
    from txnlake.operators.recon import null_profile

    df = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, F.concat(F.lit("x"), F.col("id"))).alias("s"), F.lit(None).cast("int").alias("none"))
    a, b = (sorted(map(str, null_profile(x).collect())) for x in (df.repartition(9), df.orderBy(F.desc("id")).coalesce(1)))
    assert a == b
    got = {r.column: r for r in null_profile(df).collect()}
    assert len(got["id"].samples) == 3 == len(set(got["id"].samples)) and got["none"].samples == [] and got["s"].n_null == 500 and got["s"].dtype == "string"
    assert all(r.samples == [] and r.n_null == 0 for r in null_profile(df.limit(0)).collect())
