"""The driver's tables as transactions: one deterministic view, as a raw export and as cleaned layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions import values as V
from txnlake.operators import clean, enrich, layers

#: Incoming transactions start before the stored ones end, so that loads meet rows they know.
STORED_UNTIL, INCOMING_FROM = "1999-07-01", "1999-01-01"
PRESET = {"allowed_accounts": ["BUILDING", "AUTOMOBILE", "MACHINERY"], "account_end_dates": {"BUILDING": "1998-06-30"}}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions: id, date, type, amount, subcategory, currency, account, payee, payment, description."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    names = enrich.mapping(spark).select("mapping_no", F.col("subcategory").alias("_sub"))
    key = F.col("o_orderkey")
    df = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(F.broadcast(names), (F.col("o_custkey") % len(V.MAPPING)).cast("int") == F.col("mapping_no"))
    price = F.col("o_totalprice").cast("decimal(12,2)")
    kind = F.when(key % 50 == 7, "Transfer").when(F.col("o_orderstatus") == "P", "Income").otherwise("Expenses")
    return df.select(
        key.alias("id"),
        F.col("o_orderdate").cast("date").alias("date"),
        kind.alias("type"),
        F.when(F.col("o_orderstatus") == "P", price).otherwise((-price).cast("decimal(12,2)")).alias("amount"),
        F.when(key % 97 == 3, "Aliments (Financial expenses)").when(key % 89 == 5, "Mystery shop").otherwise(F.col("_sub")).alias("subcategory"),
        F.element_at(F.array(*map(F.lit, ("EUR", "BGN", "USD", "XYZ"))), (key % 4 + 1).cast("int")).alias("currency"),
        F.col("c_mktsegment").alias("account"),
        F.col("c_name").alias("payee"),
        F.col("o_orderpriority").alias("payment"),
        F.concat(F.lit("order "), key.cast("string")).alias("description"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as an export of strings."""
    t = txn(spark, sf_dir)
    return t.select(
        F.date_format("date", "yyyy-MM-dd").alias("date"), F.col("description").alias("note"), "type", "payee", F.col("amount").cast("string").alias("amount"),
        F.lit("").alias("labels"), "account", F.col("subcategory").alias("category"), "currency", "payment",
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean(raw(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enriched(layers.silver(cleaned(spark, sf_dir), "loader"), enrich.mapping(spark))


def stored(df: DataFrame, date: str = "transaction_date") -> DataFrame:
    return df.where(F.col(date) < F.lit(STORED_UNTIL).cast("date"))


def incoming(df: DataFrame, date: str = "transaction_date") -> DataFrame:
    return df.where(F.col(date) >= F.lit(INCOMING_FROM).cast("date"))
