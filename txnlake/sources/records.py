"""Nested API records: flattening and mapping to the cleaner's input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.functions import scalars as S

SCHEMA = """id string, recordDate string, recordType string, paymentType string, note string, payee string, payer string,
amount struct<value: double, currencyCode: string>, baseAmount struct<value: double, currencyCode: string>,
category struct<id: string, name: string>, accountId string, labels array<struct<name: string>>, recordState string, createdAt string, updatedAt string"""
# The columns of a record that are flattened.
KNOWN = ("id", "recordDate", "recordType", "paymentType", "note", "payee", "payer", "amount", "category", "accountId", "labels", "baseAmount")
# API name -> name in the cleaner's input, for the columns that are there.
RENAMES = {
    "id": "source_record_id", "recordDate": "date", "recordDateTimestamp": "date_time", "recordType": "type", "category_name": "category",
    "account_name": "account", "accountId": "account_id", "amount_value": "amount", "amount_currency": "currency", "paymentType": "payment",
    "recordState": "record_state", "createdAt": "created_at", "updatedAt": "updated_at",
}
# Columns of the cleaner's input, in order.
EXPECTED = [
    "source_record_id", "date", "date_time", "note", "type", "payee", "payer", "amount", "labels", "account_name", "account", "account_id",
    "category_parent_name", "category_id", "category", "currency", "payment", "base_amount_value", "base_amount_currency", "record_state",
    "created_at", "updated_at",
]


def flattened(df: DataFrame) -> DataFrame:
    """One flat row for each record; a base amount that is no object counts as EUR; other top-level columns pass through."""
    kinds = dict(df.dtypes)
    base = kinds.get("baseAmount", "")
    struct = base.startswith("struct")
    have = lambda c: F.col(c) if c in kinds else F.lit(None).cast("string")
    labels = F.array_join(F.transform(F.coalesce("labels", F.array()), lambda x: F.coalesce(x["name"], F.lit(""))), ", ") if "labels" in kinds else F.lit("")
    value = F.col("baseAmount.value") if struct else have("baseAmount")
    currency = F.when(F.col("baseAmount").isNull(), "EUR").otherwise(F.col("baseAmount.currencyCode")) if struct else F.lit("EUR")
    plain = ["id", "recordDate", "recordType", "paymentType", "note", "payee", "payer"]
    return df.select(
        *[have(c).alias(c) for c in plain],
        F.col("amount.value").alias("amount_value"), F.col("amount.currencyCode").alias("amount_currency"),
        F.col("category.id").alias("category_id"), F.col("category.name").alias("category_name"), have("accountId").alias("accountId"),
        labels.alias("labels"), value.alias("base_amount_value"), currency.alias("base_amount_currency"),
        *[F.col(c) for c in df.columns if c not in KNOWN],
    )


def with_names(df: DataFrame, accounts: DataFrame, categories: DataFrame) -> DataFrame:
    """Account names (an unknown id keeps the id, none is empty) and parent categories. Both lookups have unique ids."""
    a = accounts.select(F.col("id").alias("_aid"), F.col("name").alias("_aname"))
    parents = parent_categories(categories).select(F.col("id").alias("_cid"), F.col("parent_name").alias("category_parent_name"))
    out = df.join(a, F.col("accountId") == F.col("_aid"), "left").withColumn("account_name", F.coalesce("_aname", "accountId", F.lit("")))
    return out.join(parents, F.col("category_id") == F.col("_cid"), "left").drop("_aid", "_aname", "_cid")


def parent_categories(categories: DataFrame) -> DataFrame:
    """Each category with its parent's name."""
    p = categories.select(F.col("id").alias("_pid"), F.col("name").alias("parent_name"))
    return categories.join(p, F.col("parentId") == F.col("_pid"), "left").drop("_pid")


def mapped(df: DataFrame) -> DataFrame:
    """Flat records as the cleaner's input: signs, types, date part, counterparty, names and order of columns."""
    amount = S.signed(F.col("amount_value").cast("double"), F.col("recordType"))
    df = df.withColumns({
        "amount_value": amount, "recordType": S.record_type(F.col("recordType")), "paymentType": S.payment_type(F.col("paymentType")),
        "recordDateTimestamp": F.col("recordDate"), "recordDate": F.split_part(F.col("recordDate"), F.lit("T"), F.lit(1)),
        "payee": S.counterparty(F.coalesce("payee", F.lit("")), F.coalesce("payer", F.lit(""))),
    })
    df = df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns})
    return df.select(*[c for c in EXPECTED if c in df.columns])
