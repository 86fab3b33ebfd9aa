"""Row-level audit: what a correction changed between two snapshots of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audit_diff(before: DataFrame, after: DataFrame, key: str = "transaction_hash", actor: str | None = None, reason: str | None = None, suppressed: bool = False) -> DataFrame:
    """(key, operation, changed_fields, old_values, new_values, actor, reason).

    A deleted row is logged whole; of an updated row only the changed fields; unchanged and inserted rows not at all. Values compare
    null-safe. Loads call it suppressed and log nothing.
    """
    columns = [c for c in before.columns if c != key and c in after.columns]
    text = lambda side, c: F.col(f"{side}.{c}").cast("string")
    b, a = before.alias("b"), after.alias("a")
    both = b.join(a, F.col(f"b.{key}") == F.col(f"a.{key}"), "left")
    entries = F.array(*[F.struct(F.lit(c).alias("field"), text("b", c).alias("old"), text("a", c).alias("new")) for c in [key, *columns]])
    both = both.select(F.col(f"b.{key}").alias(key), F.col(f"a.{key}").isNull().alias("_gone"), entries.alias("_all"))
    both = both.withColumn("_changed", F.filter("_all", lambda e: ~e["old"].eqNullSafe(e["new"])))
    as_map = lambda entries, side: F.map_from_entries(F.transform(entries, lambda e: F.struct(e["field"], e[side])))
    gone = F.col("_gone")
    out = both.select(
        key,
        F.when(gone, "DELETE").otherwise("UPDATE").alias("operation"),
        F.when(~gone, F.transform("_changed", lambda e: e["field"])).alias("changed_fields"),
        as_map(F.when(gone, F.col("_all")).otherwise(F.col("_changed")), "old").alias("old_values"),
        F.when(~gone, as_map(F.col("_changed"), "new")).alias("new_values"),
        F.coalesce(F.lit(actor), F.current_user()).alias("actor"),
        F.lit(reason).cast("string").alias("reason"),
    )
    return out.where(F.lit(not suppressed) & ((F.col("operation") == "DELETE") | (F.size("changed_fields") > 0)))


def corrected(df: DataFrame, key: str, changes: DataFrame, columns: list[str]) -> DataFrame:
    """df with the columns of `changes` laid over it by key."""
    c = changes.select(key, *[F.col(x).alias(f"_{x}") for x in columns], F.lit(True).alias("_hit"))
    out = df.join(c, key, "left")
    return reduce(lambda d, x: d.withColumn(x, F.when(F.col("_hit"), F.col(f"_{x}")).otherwise(F.col(x))), columns, out).select(*df.columns)
