"""Load policies and targeted refresh as DataFrame functions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlake.operators.scores import notability, save_potential

HASH = "transaction_hash"


def deduplicated(batch: DataFrame, order: str, key: str = HASH) -> DataFrame:
    """One row for each key: the first by order."""
    w = Window.partitionBy(key).orderBy(order)
    return batch.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def new_rows(batch: DataFrame, target: DataFrame, key: str = HASH) -> DataFrame:
    """Rows of the batch whose key the target lacks."""
    return batch.join(target.select(key), key, "left_anti")


def duplicates(df: DataFrame, key: str = HASH) -> DataFrame:
    """(key, n) of the keys with several rows."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_rows(df: DataFrame, key: str = HASH) -> DataFrame:
    """All rows of such keys, with their number: one shuffle by the key. A null key is no key."""
    n = F.count("*").over(Window.partitionBy(key))
    return df.where(F.col(key).isNotNull()).withColumn("n", n).where("n > 1")


def upserted(target: DataFrame, source: DataFrame, key: str = HASH, json_columns: tuple[str, ...] = ()) -> DataFrame:
    """target with the rows of source put in or over it; columns that source lacks become NULL. The target's columns, in order."""
    for c in json_columns:
        if c in source.columns and dict(source.dtypes)[c].startswith("map"):
            source = source.withColumn(c, F.to_json(c))
    have, kinds = set(source.columns), dict(target.dtypes)
    source = source.select(*[(F.col(c) if c in have else F.lit(None)).cast(kinds[c]).alias(c) for c in target.columns])
    return target.join(source.select(key), key, "left_anti").select(*target.columns).unionByName(source)


@dataclass(frozen=True)
class Metric:
    """A gold table: its name, what it reads of silver and how it is computed."""

    name: str
    columns: tuple[str, ...]
    compute: Callable[..., DataFrame]


_BASE = (HASH, "transaction_date", "transaction_type", "amount_abs_eur", "subcategory")
METRICS = {
    "notability": Metric("transaction_notability", _BASE, notability),
    "save-potential": Metric("transaction_save_potential", (*_BASE, "classification", "year_month"), save_potential),
}


def target_info(silver: DataFrame, hashes: DataFrame) -> DataFrame:
    """One row: the subcategories of the target expenses and the range of their dates."""
    own = silver.where("transaction_type = 'EXPENSE'").join(hashes.select(HASH), HASH, "left_semi")
    return own.agg(F.sort_array(F.collect_set("subcategory")).alias("subcategories"), F.min("transaction_date").alias("date_from"), F.max("transaction_date").alias("date_to"))


def silver_slice(silver: DataFrame, columns: tuple[str, ...], subcategories: list[str] | None = None, date_from=None, date_to=None, days: int = 365) -> DataFrame:
    """Expenses of the subcategories from `days` days before date_from to date_to. Nothing given: no filter. Filters reach the scan."""
    df = silver.where("transaction_type = 'EXPENSE'")
    if subcategories:
        df = df.where(F.col("subcategory").isin(*subcategories))
    if date_from is not None:
        df = df.where(F.col("transaction_date") >= F.date_sub(F.lit(date_from), days))
    if date_to is not None:
        df = df.where(F.col("transaction_date") <= F.lit(date_to))
    return df.select(*columns)


def refreshed(silver: DataFrame, metric: Metric, hashes: DataFrame | None = None, days: int = 365, strict_slice: bool = False) -> DataFrame:
    """The metric's rows for the target hashes, or for all expenses, from silver alone.

    The slice is widened to whole months at both ends so that monthly counts equal those of a full run; strict_slice leaves it as
    the targets' dates give it.
    """
    if hashes is None:
        return metric.compute(silver_slice(silver, metric.columns), days)
    info = target_info(silver, hashes).first()  # one row; the list is of taxonomy size
    if info.date_from is None:
        return metric.compute(silver_slice(silver, metric.columns).limit(0), days)
    first, last = info.date_from, info.date_to
    if not strict_slice:
        first = first.replace(day=1) - dt.timedelta(days=31)
        last = (last.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    rows = silver_slice(silver, metric.columns, info.subcategories, first, last, days)
    return metric.compute(rows, days).join(hashes.select(HASH), HASH, "left_semi")


def reach(changed: DataFrame, days: int = 365) -> DataFrame:
    """(subcategory, month): where scores depend on the changed rows (subcategory, transaction_date).

    A row is in the baselines of its subcategory for `days` days from its own on, and in the counts of its whole month.
    """
    months = F.sequence(F.trunc("transaction_date", "month"), F.trunc(F.date_add("transaction_date", days), "month"), F.expr("INTERVAL 1 MONTH"))
    return changed.select("subcategory", F.explode(months).alias("m")).select("subcategory", F.date_format("m", "yyyy-MM").alias("month")).distinct()


def _reached(df: DataFrame, reached: DataFrame, how: str) -> DataFrame:
    r = reached.select(F.col("subcategory").alias("_sub"), F.col("month").alias("_month"))
    return df.join(r, F.col("subcategory").eqNullSafe(F.col("_sub")) & (F.date_format("transaction_date", "yyyy-MM") == F.col("_month")), how)


def rescored(silver: DataFrame, daily: DataFrame, metric: Metric, reached: DataFrame, days: int = 365) -> DataFrame:
    """The metric's rows for the expenses that are reached; silver: their months at least; daily: sums of those and of the days before."""
    return metric.compute(_reached(silver_slice(silver, metric.columns), reached, "left_semi"), days, daily=daily)


def replaced_where_reached(reached: DataFrame) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A merge for Warehouse.upsert: what the table has where reached gives way to the new rows."""
    return lambda target, rows: _reached(target, reached, "left_anti").unionByName(rows)
