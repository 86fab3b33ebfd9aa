"""The rolling baseline: what a subcategory spent in the days before a transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WIDE = "decimal(28,4)"


def _amounts(df: DataFrame, amount: str, date: str) -> DataFrame:
    df = df.withColumn("_day", F.unix_date(F.col(date).cast("date"))).withColumn("_a", F.col(amount).cast("decimal(12,2)"))
    return df.withColumn("_q", (F.col("_a") * F.col("_a")).cast("decimal(25,4)"))


def _named(group: str):
    return F.col(group).isNotNull() & (F.col(group) != "")


def daily_sums(df: DataFrame, amount: str = "amount_abs_eur", date: str = "transaction_date", group: str = "subcategory") -> DataFrame:
    """(group, day, n, s, q, m): count, sum, sum of squares and greatest amount of each group and day.

    Such rows of disjoint sets add up (merged_days), in any order, so they can be kept beside a table that grows by batches.
    """
    sums = _amounts(df, amount, date).groupBy(group, F.col(date).cast("date").alias("day"))
    return sums.agg(F.count("_a").alias("n"), F.sum("_a").cast("decimal(22,2)").alias("s"), F.sum("_q").cast("decimal(35,4)").alias("q"), F.max("_a").alias("m"))


def merged_days(daily: DataFrame, group: str = "subcategory") -> DataFrame:
    """One row for each group and day."""
    return daily.groupBy(group, "day").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(22,2)").alias("s"), F.sum("q").cast("decimal(35,4)").alias("q"), F.max("m").alias("m"))


def rolling_stats(df: DataFrame, amount: str = "amount_abs_eur", date: str = "transaction_date", group: str = "subcategory", key: str = "transaction_hash", days: int = 365, daily: DataFrame | None = None) -> DataFrame:
    """df with hist_n_txns, hist_avg_amount_eur, hist_std_amount_eur and hist_max_amount_eur.

    A row's history are rows of its group from `days` days before to just before it in (date, key) order. Earlier days are summed
    for each day first, so the sliding frame runs over days, not rows; the same day adds a running frame over its own rows.
    Sums are exact decimals: the deviation is NULL, not noise, where all amounts are equal. A missing or blank group has no history.

    daily: the daily_sums of all rows, where they are at hand; then df may hold a part of the rows, whole days of a group.
    """
    spread = Window.partitionBy(group).orderBy("_day").rangeBetween(-days, -1)
    before = Window.partitionBy(group, "_day").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    df, named = _amounts(df, amount, date), _named(group)
    if daily is None:
        daily = df.where(named).groupBy(group, "_day").agg(F.count("_a").alias("n"), F.sum("_a").alias("s"), F.sum("_q").alias("q"), F.max("_a").alias("m"))
    else:
        daily = merged_days(daily.where(named), group).withColumn("_day", F.unix_date("day"))
    daily = daily.select(group, "_day", F.sum("n").over(spread).alias("_n1"), F.sum("s").over(spread).alias("_s1"), F.sum("q").over(spread).alias("_q1"), F.max("m").over(spread).alias("_m1"))
    df = df.join(daily, [group, "_day"], "left")
    own = lambda f, c: F.when(named, f(c).over(before))
    df = df.withColumns({"_n2": own(F.count, "_a"), "_s2": own(F.sum, "_a"), "_q2": own(F.sum, "_q"), "_m2": own(F.max, "_a")})
    both = lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    n = both(F.col("_n1"), F.col("_n2")).cast("long")
    s, q = both(F.col("_s1"), F.col("_s2")).cast("decimal(18,2)"), both(F.col("_q1"), F.col("_q2")).cast(WIDE)
    df = df.withColumns({"hist_n_txns": n, "_s": s, "_q": q, "hist_max_amount_eur": F.greatest("_m1", "_m2")})
    count = F.col("hist_n_txns")
    spread_out = (count.cast("decimal(10,0)") * F.col("_q")).cast("decimal(38,4)") - (F.col("_s") * F.col("_s")).cast("decimal(38,4)")
    df = df.withColumn("hist_avg_amount_eur", F.when(count > 0, F.col("_s").cast("double") / count))
    df = df.withColumn("hist_std_amount_eur", F.when((count >= 2) & (spread_out > 0), F.sqrt(spread_out.cast("double")) / count))
    return df.drop("_day", "_a", "_q", "_n1", "_s1", "_q1", "_m1", "_n2", "_s2", "_q2", "_m2", "_s")
