"""Category enrichment, income typing, account presets and data-quality flags."""

from __future__ import annotations

import datetime as dt
import difflib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions import values as V


def mapping(spark: SparkSession) -> DataFrame:
    """The 82-row taxonomy, numbered from 0."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(V.MAPPING)], "mapping_no int, subcategory string, category string, classification string")


def enriched(silver: DataFrame, categories: DataFrame) -> DataFrame:
    """Category and classification where missing, and the kind of income. categories has a row for each subcategory at most."""
    known = F.broadcast(categories.select("subcategory", F.col("category").alias("_category"), F.col("classification").alias("_class")))
    df = silver.join(known, "subcategory", "left")
    category = F.coalesce(F.col("category"), F.col("_category")) if "category" in silver.columns else F.col("_category")
    df = df.withColumn("category", category).withColumn("classification", F.coalesce("classification", "_class"))
    income = F.col("transaction_type") == "INCOME"
    # an unmapped category is not known to differ from Income, so it counts as real income
    df = df.withColumn("income_type", F.when(income, F.when(F.col("category") != "Income", "REFUND").otherwise("REAL")))
    return df.withColumn("classification", F.when(~income, F.col("classification"))).drop("_category", "_class")


def preset_filter(df: DataFrame, preset: dict | None, account: str = "account", date: str = "date") -> DataFrame:
    """Rows of allowed accounts, up to an account's last day. No preset: all rows. A preset without such a column is an error."""
    if not preset:
        return df
    if account not in df.columns:
        raise ValueError(f"a preset filters by {account}, which the rows do not have")
    name = F.trim(F.col(account))
    ends = preset.get("account_end_dates") or {}
    late = [(name == a) & ~F.coalesce(F.col(date).cast("date") <= F.lit(dt.date.fromisoformat(str(d))), F.lit(False)) for a, d in ends.items()]
    keep = name.isin(*preset["allowed_accounts"])
    return df.where(reduce(lambda x, y: x & ~y, late, keep))


def unrecognised(df: DataFrame, preset: dict, account: str = "account") -> DataFrame:
    name = F.trim(F.col(account))
    return df.where(~name.isin(*preset["allowed_accounts"])).groupBy(name.alias(account)).agg(F.count("*").alias("n"))


ERRORS = ("UNMAPPED_SUBCAT", "INCOME_UNMAPPED_REAL")


def flagged(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Data-quality flags, comma-joined, and whether one is an error. Unflagged rows stay with an empty string."""
    known = F.broadcast(categories.select("subcategory", F.col("category").alias("_category"), F.lit(True).alias("_known")))
    df = df.join(known, "subcategory", "left")
    income, category = F.col("transaction_type") == "INCOME", F.col("_category")
    marks = [
        F.when(F.col("_known").isNull(), "UNMAPPED_SUBCAT"),
        F.when(F.col("subcategory").isin("Transfer", "Transfer, withdraw"), "TRANSFER"),
        F.when(income & (F.col("subcategory") == "Aliments"), "ALIMENTS_INCOME"),
        F.when(income & category.isNull(), "INCOME_UNMAPPED_REAL"),
        F.when(income & (category != "Income"), "INCOME_NON_INCOME_REFUND"),
    ]
    flags = F.concat_ws(",", *marks)
    return df.withColumn("flags", flags).withColumn("is_error", reduce(lambda a, b: a | b, (F.contains(F.col("flags"), F.lit(e)) for e in ERRORS))).drop("_category", "_known")


def suggestions(df: DataFrame, categories: DataFrame, cutoff: float = 0.6) -> DataFrame:
    """(subcategory, suggestion): the closest known name for every distinct unknown one, by difflib's ratio."""
    names = [r[0] for r in categories.select("subcategory").collect()]  # the taxonomy
    unknown = df.select("subcategory").distinct().where(F.col("subcategory").isNotNull()).join(F.broadcast(categories.select("subcategory")), "subcategory", "left_anti")

    def closest(batches):
        for pdf in batches:
            pdf["suggestion"] = [(difflib.get_close_matches(s, names, n=1, cutoff=cutoff) or [""])[0] for s in pdf["subcategory"]]
            yield pdf

    return unknown.mapInPandas(closest, "subcategory string, suggestion string")


def inserted_if_absent(target: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """target and the seed rows whose key it lacks; the first of equal seed keys."""
    new = seed.dropDuplicates([key]).join(target.select(key), key, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)
