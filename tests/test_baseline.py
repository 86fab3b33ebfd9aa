"""The stateful baseline of days against the batch window, in any order of batches."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txnlake.streaming import baseline

KIND = "subcategory string, transaction_date date, amount_abs_eur decimal(12,2)"


def made(n, seed):
    rnd = random.Random(seed)
    return [(rnd.choice(["a", "a", "b", None, ""]), dt.date(2022, 1, 1) + dt.timedelta(days=rnd.randrange(900)), Decimal(rnd.randrange(1, 10_000)) / 100) for _ in range(n)]


def whole(spark, rows):
    df = spark.createDataFrame(rows, KIND).where("subcategory <> ''").withColumn("c", (F.col("amount_abs_eur") * 100).cast("long"))
    days = df.groupBy("subcategory", "transaction_date").agg(F.count("*").alias("n"), F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"), F.max("c").alias("m"))
    w = Window.partitionBy("subcategory").orderBy(F.unix_date("transaction_date")).rangeBetween(-365, -1)
    over = days.select("subcategory", "transaction_date", *[F.coalesce(F.sum(x).over(w), F.lit(0)) for x in "nsq"], F.max("m").over(w))
    return {(r[0], r[1]): tuple(map(lambda x: x if x is None else int(x), r[2:])) for r in over.collect()}


@pytest.mark.parametrize("order", ["time", "late"])
def test_any_order_of_batches(spark, tmp_path, order):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", baseline.STATE_STORE)
    rows = sorted(made(300, 1), key=lambda r: (r[1], str(r[0])))
    parts = [rows[:200], rows[200:260], rows[260:]]
    seen, sizes = {}, []

    def collect(df, n):
        got = df.collect()
        sizes.append(len(got))
        seen.update({(r[0], r[1]): tuple(None if x is None else int(x) for x in r[2:]) for r in got})

    try:
        for part in parts if order == "time" else parts[::-1]:
            spark.createDataFrame(part, KIND).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(KIND).parquet(str(tmp_path / "in"))
            out = baseline.day_baselines(stream).writeStream.outputMode("update").foreachBatch(collect)
            out.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert seen == whole(spark, rows)
    if order == "time":
        assert max(s for s in sizes[1:]) <= 60 + 2  # a batch in time gives its own days only


def test_sliding_sums():
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    sums = {day(0): (1, 5, 25, 5), day(3): (2, 4, 8, 3), day(10): (1, 1, 1, 1), day(13): (1, 9, 81, 9)}
    assert baseline.baselines(sums, set(sums), 10) == [(day(0), 0, 0, 0, None), (day(3), 1, 5, 25, 5), (day(10), 3, 9, 33, 5), (day(13), 3, 5, 9, 3)]
