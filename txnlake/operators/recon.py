"""Reconciliation of two transaction sets, and profiles of one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.functions.scalars import strip
from txnlake.operators.selection import exact_percentile

CENTS = "decimal(18,2)"


def expense_rows(df: DataFrame, kind: str | None = "type", category: str = "category") -> DataFrame:
    """Rows whose type says expense (without a type column: negative amounts), but for transfers and withdrawals."""
    own = F.contains(F.lower(kind), F.lit("expense")) if kind and kind in df.columns else F.col("amount") < 0
    return df.where(F.coalesce(own, F.lit(False)) & ~F.coalesce(F.lower(category).rlike("transfer|withdraw"), F.lit(False)))


def keyed(df: DataFrame) -> DataFrame:
    date = F.coalesce(F.date_format("date", "yyyy-MM-dd"), F.lit("NO_DATE"))
    return df.withColumn("txn_key", F.concat_ws("_", date, F.coalesce(F.col("amount").cast(CENTS).cast("string"), F.lit("NO_AMOUNT")), strip(F.coalesce("category", F.lit("NO_CATEGORY")))))


def missing_both_ways(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose key the other side lacks, with the side that has them."""
    a, b = keyed(left), keyed(right)
    return a.join(b.select("txn_key"), "txn_key", "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a.select("txn_key"), "txn_key", "left_anti").withColumn("side", F.lit("right")))


def monthly(df: DataFrame) -> DataFrame:
    return df.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.sum(F.col("amount").cast(CENTS)).cast(CENTS).alias("total"))


def overlap(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides within the dates that both cover. The two dates are read first, so that the filter reaches the scans."""
    ends = [d.agg(F.min("date"), F.max("date")).first() for d in (left, right)]
    if any(x is None for e in ends for x in e):
        return left.limit(0), right.limit(0)
    first, last = max(e[0] for e in ends), min(e[1] for e in ends)
    return tuple(d.where(F.col("date").between(F.lit(first), F.lit(last))) for d in (left, right))


def monthly_comparison(left: DataFrame, right: DataFrame) -> DataFrame:
    """Counts and totals of both sides for each month of the overlap; a month that one lacks counts as zero."""
    a, b = (monthly(d) for d in overlap(left, right))
    both = a.withColumnsRenamed({"n": "n_left", "total": "total_left"}).join(b.withColumnsRenamed({"n": "n_right", "total": "total_right"}), "month", "full_outer").na.fill(0, ["n_left", "n_right"])
    both = both.withColumns({c: F.coalesce(c, F.lit(0).cast(CENTS)) for c in ("total_left", "total_right")})
    return both.withColumns({"n_diff": F.col("n_left") - F.col("n_right"), "total_diff": (F.col("total_left") - F.col("total_right")).cast(CENTS)})


def summary(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: counts, distinct keys, totals, the difference in per cent and its verdict."""
    side = lambda d, p: keyed(d).agg(F.count("*").alias(f"n_{p}"), F.countDistinct("txn_key").alias(f"keys_{p}"), F.sum(F.col("amount").cast(CENTS)).cast(CENTS).alias(f"total_{p}"))
    row = side(left, "left").crossJoin(side(right, "right"))  # one row each
    share = F.try_divide(F.abs(F.col("total_left") - F.col("total_right")).cast("double"), F.abs("total_left").cast("double"))
    row = row.withColumn("diff_pct", F.round(share * 100, 4))
    verdict = F.when(share < 0.05, "similar").when(share < 0.15, "moderate").otherwise("significant")
    return row.withColumn("verdict", verdict)


def breakdown(df: DataFrame, *by: str) -> DataFrame:
    """Sums and counts of expenses (below zero) and income (above), and the net."""
    a = F.col("amount").cast(CENTS)
    part = lambda c: F.coalesce(F.sum(F.when(c, a)), F.lit(0)).cast(CENTS)
    return df.groupBy(*by).agg(
        part(a < 0).alias("expenses"), part(a > 0).alias("income"), F.sum(a).cast(CENTS).alias("net"),
        F.count_if(a < 0).alias("n_expenses"), F.count_if(a > 0).alias("n_income"), F.count_if(a == 0).alias("n_zero"),
    )


def category_top(df: DataFrame, k: int = 15) -> DataFrame:
    total = F.sum(F.col("amount").cast(CENTS)).cast(CENTS)
    return df.groupBy("category").agg(F.count("*").alias("n"), total.alias("total")).orderBy(F.desc("n"), "category").limit(k)


def amount_stats(df: DataFrame, *by: str) -> DataFrame:
    """Mean, exact median, least and greatest amount; the median never gathers a group (see selection)."""
    a = F.col("amount").cast("double")
    rest = df.groupBy(*by).agg(F.round(F.avg(a), 4).alias("mean"), F.min(a).alias("least"), F.max(a).alias("most"))
    middle = exact_percentile(df, list(by), a).select(*[F.col(b).alias(f"_{b}") for b in by], F.round("percentile", 4).alias("median"))
    same = reduce(lambda x, b: x & F.col(b).eqNullSafe(F.col(f"_{b}")), by, F.lit(True))
    return rest.join(middle, same, "left").select(*by, "mean", "median", "least", "most")


def null_profile(df: DataFrame, samples: int = 3, by=F.xxhash64) -> DataFrame:
    """(column, n_null, pct_null, dtype, samples) in one pass over the table.

    samples: at most so many values as text. A column's values fall in that many parts by their hash, `by`, a long, and each part shows
    the value of its least hash: the same values however the rows are dealt out, and the aggregate merges like a minimum.
    """
    kinds = dict(df.dtypes)
    text = {c: F.col(c).cast("string") for c in df.columns}
    own = lambda c, i: F.min(F.when(F.col(c).isNotNull() & (F.pmod(by(text[c]), F.lit(samples)) == i), F.struct(by(text[c]).alias("h"), text[c].alias("v")))).alias(f"{c}#{i}")
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns], *[own(c, i) for c in df.columns for i in range(samples)])
    shown = lambda c: F.filter(F.array(*[F.col(f"`{c}#{i}`.v") for i in range(samples)]), lambda x: x.isNotNull())
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null"), F.lit(kinds[c]).alias("dtype"), shown(c).alias("samples")) for c in df.columns]))
    return one.select("_n", rows.alias("x")).select("x.column", "x.n_null", F.round(F.coalesce(F.try_divide(F.col("x.n_null") * 100.0, F.col("_n")), F.lit(0.0)), 4).alias("pct_null"), "x.dtype", "x.samples")


def batch_profile(df: DataFrame) -> DataFrame:
    """One row: rows, repeated hashes, dates and amounts."""
    a = F.col("amount").cast(CENTS)
    return df.agg(F.count("*").alias("n"), (F.count("*") - F.countDistinct("transaction_hash")).alias("n_duplicates"), F.min("date").alias("first"), F.max("date").alias("last"), F.min(a).alias("least"), F.max(a).alias("most"), F.sum(a).cast(CENTS).alias("total"))
