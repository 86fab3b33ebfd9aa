"""The wide export without names: made-up merchants and cities, rank aliases, scaled money."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions import values as V
from txnlake.functions.scalars import round_half_even, scaled_euros, strip
from txnlake.operators.layers import numbered

MONEY = ["amount", "amount_abs", "amount_eur", "amount_abs_eur", "amount_bgn", "amount_abs_bgn", "hist_avg_amount_eur", "hist_std_amount_eur"]
INTERNAL = ["source_raw_id", "created_by", "source_record_id", "category_id"]
NOTABILITY = ["notability_score", "notability_label", "notability_reason", "hist_n_txns", "hist_avg_amount_eur", "hist_std_amount_eur", "amount_z_score", "is_new_subcategory", "is_new_subcategory_max"]
SAVE = ["save_potential_score", "save_potential_label", "save_potential_reason", "avoidability", "freq_ratio", "freq_excess", "amt_excess", "month_txn_count", "hist_avg_monthly_count"]


def _seed(key: Column, first: int) -> Column:
    return F.conv(F.substring(key, first, 8), 16, 10).cast("long")


def _pick(names: list[str], seed: Column) -> Column:
    return F.array(*map(F.lit, names))[(seed % len(names)).cast("int")]


def merchant(subcategory: Column, key: Column) -> Column:
    """A merchant of the first kind whose name is part of the subcategory, by hash; else the subcategory."""
    low, seed = F.lower(subcategory), _seed(key, 1)
    return reduce(lambda out, kv: F.when(F.contains(low, F.lit(kv[0])), _pick(kv[1], seed)).otherwise(out), reversed(list(V.MERCHANTS.items())), subcategory)


def city(subcategory: Column, month: Column, key: Column) -> Column:
    low, seed = F.lower(subcategory), _seed(key, 9)
    has = lambda keys: reduce(lambda a, b: a | b, (F.contains(low, F.lit(k)) for k in keys))
    summer = month.isin(*V.SUMMER_MONTHS) & has(V.OUTDOOR_KEYS) & (seed % 6 == 0)
    return F.when(has(V.TRAVEL_KEYS), _pick(V.TRAVEL_CITIES, seed)).when(has(V.SUBSCRIPTION_KEYS), _pick(V.SUBSCRIPTION_CITIES, seed)).when(summer, V.SUMMER_CITY).otherwise(V.HOME_CITY)


def rank_alias(df: DataFrame, column: str, prefix: str, most: int | None = None, name: str | None = None) -> DataFrame:
    """Values as "prefix #rank" by frequency, ties by value; blank ones NULL; ranks beyond `most` as "prefix #other".

    Ranks are taken over range partitions, so no task sorts all distinct values.
    """
    value = F.when(strip(F.col(column).cast("string")) != "", F.col(column))
    counts = df.where(value.isNotNull()).groupBy(F.col(column).alias("_value")).agg((-F.count("*")).alias("_less"))
    ranked = numbered(counts, ["_less", "_value"], "_rank")
    alias = F.concat(F.lit(f"{prefix} #"), F.col("_rank").cast("string"))
    if most:
        alias = F.when(F.col("_rank") > most, F.lit(f"{prefix} #other")).otherwise(alias)
    out = df.join(ranked.select("_value", alias.alias("_alias")), F.col(column) == F.col("_value"), "left").drop("_value")
    return out.withColumn(name or column, F.col("_alias")).drop("_alias")


def wide(silver: DataFrame, notable: DataFrame, save: DataFrame) -> DataFrame:
    key = "transaction_hash"
    return silver.join(notable.select(key, *NOTABILITY), key, "left").join(save.select(key, *SAVE), key, "left")


def anonymised(df: DataFrame, scale: float = V.SCALE) -> DataFrame:
    key, sub = F.col("transaction_hash"), F.col("subcategory")
    df = df.withColumns({"merchant": merchant(sub, key), "city": city(sub, F.month("transaction_date"), key)})
    df = df.withColumn("description", F.concat("merchant", F.lit(" – "), "city"))
    for column, prefix in (("payee", "Merchant"), ("account_name", "Account")):
        if column in df.columns:
            df = rank_alias(df, column, prefix)
    if "account_name" in df.columns:
        df = rank_alias(df, "account_name", "Account Group", 3, "account_group")
    if "labels" in df.columns:
        df = df.withColumn("labels", F.lit(None).cast("string"))
    df = df.withColumns({c: round_half_even(F.col(c).cast("double") * scale) for c in MONEY if c in df.columns})
    return df.withColumns({c: scaled_euros(F.col(c), scale) for c in ("notability_reason", "save_potential_reason") if c in df.columns}).drop(*INTERNAL)
