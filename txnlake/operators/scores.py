"""Notability and save potential of expenses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlake.functions import values as V
from txnlake.functions.scalars import lookup
from txnlake.operators.rolling import rolling_stats

# Columns, labels and reasons of the two scores are given; here and below.
NOTABILITY_COLUMNS = [
    "transaction_hash", "transaction_date", "subcategory", "amount_abs_eur", "hist_window_days", "hist_n_txns", "hist_avg_amount_eur",
    "hist_std_amount_eur", "hist_max_amount_eur", "amount_z_score", "is_new_subcategory", "is_new_subcategory_max", "notability_score",
    "notability_label", "notability_reason", "extra_stats",
]
SAVE_COLUMNS = [
    "transaction_hash", "transaction_date", "subcategory", "classification", "amount_abs_eur", "avoidability", "month_txn_count",
    "hist_avg_monthly_count", "freq_ratio", "freq_excess", "amount_z_score", "amt_excess", "save_potential_score",
    "save_potential_label", "save_potential_reason",
]


def expenses(df: DataFrame) -> DataFrame:
    """Expenses, of either case, with a date (of a string its first ten characters count) and an amount."""
    out = df.where(F.upper("transaction_type") == "EXPENSE")
    date = F.col("transaction_date")
    if dict(df.dtypes)["transaction_date"] == "string":
        date = F.substring(date, 1, 10)
    out = out.withColumn("transaction_date", date.try_cast("date")).withColumn("amount_abs_eur", F.col("amount_abs_eur").try_cast("decimal(12,2)"))
    return out.where(F.col("transaction_date").isNotNull() & F.col("amount_abs_eur").isNotNull())


def z_score() -> Column:
    return F.when(F.col("hist_std_amount_eur") > 0, (F.col("amount_abs_eur").cast("double") - F.col("hist_avg_amount_eur")) / F.col("hist_std_amount_eur"))


def shown(c: Column, digits: int) -> Column:
    """A number with so many decimals, ties to even."""
    return F.format_string(f"%.{digits}f", F.rint(c * 10.0**digits) / 10.0**digits)


def notability(df: DataFrame, days: int = 365, extra=None, daily: DataFrame | None = None) -> DataFrame:
    """How unusual each expense is. extra: a function over the result that may fill extra_stats. daily: see rolling_stats."""
    df = rolling_stats(expenses(df), days=days, daily=daily)
    z, new, top = F.col("amount_z_score"), F.col("is_new_subcategory"), F.col("is_new_subcategory_max")
    df = df.withColumns({"hist_window_days": F.lit(days), "amount_z_score": z_score(), "is_new_subcategory": F.col("hist_n_txns") == 0})
    df = df.withColumn("is_new_subcategory_max", F.coalesce(F.col("amount_abs_eur") > F.col("hist_max_amount_eur"), F.lit(True)))
    score = F.greatest(F.coalesce(z, F.lit(0.0)), F.lit(0.0)) + F.when(new, 4.0).otherwise(0.0) + F.when(top & ~new, 2.0).otherwise(0.0)
    label = (
        F.when(new, "New Category").when(z.isNull(), "Insufficient History").when(z >= 3, "Extreme Outlier")
        .when(z >= 2, "High Outlier").when(z >= 1, "Above Average").when(top, "New Record").otherwise("Normal")
    )
    sub = F.coalesce("subcategory", F.lit("None"))
    reason = (
        F.when(new, F.concat(F.lit("First time spending in "), sub))
        .when(top, F.concat(F.lit("Largest ever "), sub, F.lit(" transaction")))
        .when(z >= 2, F.concat(shown(z, 1), F.lit("σ above your usual "), sub, F.lit(" spend (avg €"), shown(F.col("hist_avg_amount_eur"), 0), F.lit(")")))
    )
    df = df.withColumns({"notability_score": score, "notability_label": label, "notability_reason": reason, "extra_stats": F.expr("cast(map() as map<string,string>)")})
    return (extra(df) if extra else df).select(*NOTABILITY_COLUMNS)


def monthly_counts(df: DataFrame, days: int = 365) -> DataFrame:
    """(year_month, subcategory, month_txn_count, hist_avg_monthly_count): the average is over the months present in the days before.

    A missing subcategory is counted but has no average.
    """
    return _with_average(df.groupBy("year_month", "subcategory").agg(F.count("*").alias("month_txn_count")), days)


def monthly_counts_of_days(daily: DataFrame, days: int = 365) -> DataFrame:
    """The same from daily_sums."""
    return _with_average(daily.groupBy(F.date_format("day", "yyyy-MM").alias("year_month"), "subcategory").agg(F.sum("n").alias("month_txn_count")), days)


def _with_average(counts: DataFrame, days: int) -> DataFrame:
    month = F.unix_date(F.to_date(F.concat("year_month", F.lit("-01"))))
    prior = Window.partitionBy("subcategory").orderBy("_month").rangeBetween(-days, -1)
    counts = counts.withColumn("_month", month)
    return counts.withColumn("hist_avg_monthly_count", F.when(F.col("subcategory").isNotNull(), F.avg("month_txn_count").over(prior))).drop("_month")


def save_potential(df: DataFrame, days: int = 365, daily: DataFrame | None = None) -> DataFrame:
    """Whether each expense could have been saved: avoidability, frequency and amount. daily: see rolling_stats."""
    base = expenses(df)
    months = monthly_counts(base, days) if daily is None else monthly_counts_of_days(daily, days)
    months = months.withColumnsRenamed({"year_month": "_ym", "subcategory": "_sub"})
    df = rolling_stats(base, days=days, daily=daily).withColumn("amount_z_score", z_score())
    df = df.join(months, F.col("year_month").eqNullSafe(F.col("_ym")) & F.col("subcategory").eqNullSafe(F.col("_sub")), "left")
    kind = F.upper(F.trim(F.col("classification")))
    avoid = lookup(kind, V.AVOIDABILITY, F.lit(V.AVOIDABILITY["NEED"]))
    ratio = F.when(F.col("hist_avg_monthly_count") > 0, F.col("month_txn_count") / F.col("hist_avg_monthly_count"))
    clip = lambda c, top: F.least(F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0)), F.lit(top))
    df = df.withColumns({"avoidability": avoid, "freq_ratio": ratio})
    df = df.withColumns({"freq_excess": clip(F.col("freq_ratio") - 1.0, V.FREQUENCY_CAP), "amt_excess": clip(F.col("amount_z_score"), V.AMOUNT_CAP)})
    score = F.col("avoidability") * V.WEIGHTS["avoidability"] + F.col("freq_excess") * V.WEIGHTS["frequency"] + F.col("amt_excess") * V.WEIGHTS["amount"]
    df = df.withColumn("save_potential_score", score)
    label = F.when(score >= 5, "High Save Potential").when(score >= 3, "Medium Save Potential").when(score >= 1, "Low Save Potential").otherwise("Minimal")
    what = lookup(kind, {"WANT": "Discretionary (WANT)", "NEED": "Necessary (NEED)", "MUST": "Obligation (MUST)"}, F.lit("Necessary (NEED, default)"))
    sub = F.coalesce("subcategory", F.lit("None"))
    often = F.when(F.col("freq_ratio") > 1.01, F.concat(shown(F.col("freq_ratio"), 1), F.lit("x usual "), sub, F.lit(" frequency this month")))
    much = F.when(F.col("amount_z_score") >= 1, F.concat(shown(F.col("amount_z_score"), 1), F.lit("σ above avg "), sub, F.lit(" spend")))
    return df.withColumns({"save_potential_label": label, "save_potential_reason": F.concat_ws(" + ", what, often, much)}).select(*SAVE_COLUMNS)
