"""The cleaner: a raw export of strings to typed, identified transactions. One chain of projections and one filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.functions import scalars as S

RENAMES = {"note": "description", "category": "subcategory", "payment": "payment_method"}
REQUIRED = ["date", "amount", "transaction_type", "subcategory"]


def named(df: DataFrame) -> DataFrame:
    """Column names in lower case without outer space, and under the names of the schema."""
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    return df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns})


def typed(df: DataFrame) -> DataFrame:
    """Dates, amounts and types parsed; what cannot be parsed is NULL."""
    amount = S.parse_amount(F.col("amount"))
    df = df.withColumns({"date": S.parse_date(F.col("date")), "amount": amount, "amount_abs": F.abs(amount), "transaction_type": S.standard_type(F.col("type"))})
    return df.withColumn("subcategory", S.renamed_subcategory(F.col("subcategory"), F.col("transaction_type")))


def converted(df: DataFrame) -> DataFrame:
    base = (F.col("base_amount_value").cast("double"), F.col("base_amount_currency")) if "base_amount_value" in df.columns else ()
    return df.withColumns(S.conversion(F.col("amount"), F.col("currency"), *base))


def identified(df: DataFrame, null_token: str = "") -> DataFrame:
    df = df.withColumns(S.calendar(F.col("date"))).withColumn("classification", F.lit(None).cast("string"))
    description = F.col("description") if "description" in df.columns else F.lit(None).cast("string")
    return df.withColumn("transaction_hash", S.transaction_hash(F.col("date"), F.col("amount"), F.col("subcategory"), description, null_token))


def complete(df: DataFrame) -> DataFrame:
    """Rows that have all required fields."""
    return df.dropna(subset=REQUIRED)


def clean(raw: DataFrame, null_token: str = "") -> DataFrame:
    return raw.transform(named).transform(typed).transform(converted).transform(lambda d: identified(d, null_token)).transform(complete)


def validate(df: DataFrame, rows_in: int | None = None, least_share: float = 0.8) -> list[str]:
    """Raises on missing columns and on nulls in required fields; returns warnings."""
    need = [*REQUIRED, "transaction_hash"]
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    row = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in need]).first()
    nulls = {c: row[c] for c in need if row[c]}
    if nulls:
        raise ValueError(f"null values in required columns: {nulls}")
    return [f"only {row['n']} of {rows_in} rows were kept"] if rows_in and row["n"] < least_share * rows_in else []
