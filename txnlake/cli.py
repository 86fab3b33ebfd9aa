"""Command line: loads, gold refresh, duplicate export, anonymised export, data-quality dry run."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.operators import anonymise, clean, enrich, layers, merge, recon
from txnlake.plans.load import Loader
from txnlake.plans.warehouse import Warehouse
from txnlake.sources import api, files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="txnlake")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--mode", choices=["full", "incremental"], default="incremental")
    p.add_argument("--source", choices=["file", "api"], default="file")
    p.add_argument("--file")
    p.add_argument("--api-url")
    p.add_argument("--api-token")
    p.add_argument("--from-date", type=dt.date.fromisoformat)
    p.add_argument("--to-date", type=dt.date.fromisoformat)
    p.add_argument("--account-filter")
    p.add_argument("--presets")
    p.add_argument("--refresh-gold", choices=[*merge.METRICS, "both"])
    p.add_argument("--window-days", type=int, default=365)
    p.add_argument("--export-anonymised")
    p.add_argument("--export-duplicates")
    p.add_argument("--dry-run", action="store_true", help="run every stage, write nothing to the warehouse")
    p.add_argument("--dump", help="with --dry-run: a folder for each stage's rows as CSV")
    p.add_argument("--compare", help="reconcile silver with this cleaned export (CSV)")
    p.add_argument("--out", help="with --compare: a folder for the reports as CSV")
    p.add_argument("--correct", help="a CSV file of transaction_hash and the columns to lay over silver (with transaction_date: only its months are looked at)")
    p.add_argument("--actor", help="with --correct: who is logged, by default the current user")
    p.add_argument("--reason", help="with --correct: why")
    p.add_argument("--compact", action="store_true", help="merge small folders of bronze and silver")
    p.add_argument("--vacuum", action="store_true", help="delete folders that no recent manifest names; not beside a running load")
    return p


def dry_run(spark: SparkSession, w: Warehouse, raw: DataFrame, preset: dict | None, dump: str | None = None) -> dict[str, int]:
    """Every stage of a load with its number of rows, and the flags of what would be inserted; returns the numbers."""
    old, categories = w.read("silver.transactions"), enrich.mapping(spark)
    cleaned = clean.clean(raw)
    kept = enrich.preset_filter(cleaned, preset)
    silver = enrich.enriched(layers.silver(kept, "dry-run"), categories)
    new = merge.new_rows(silver, old) if old is not None else silver
    flags = enrich.flagged(new, categories).where("flags <> ''")
    stages = {"extracted": raw, "cleaned": cleaned, "filtered": kept, "silver": silver, "repeated": merge.duplicate_rows(silver), "new": new, "flagged": flags}
    counts = {}
    for name, rows in stages.items():
        counts[name] = rows.count()
        print(f"{name}: {counts[name]}")
        if dump:
            files.export_csv(rows, f"{dump}/{name}")
    if preset:
        enrich.unrecognised(cleaned, preset).orderBy(F.desc("n"), "account").show(truncate=False)
    flags.groupBy("is_error", "flags").agg(F.count("*").alias("n")).orderBy(F.desc("is_error"), "flags").show(truncate=False)
    flags.select("flags", "transaction_date", "subcategory", "amount").orderBy("flags", "transaction_date").show(20, truncate=False)
    enrich.suggestions(new, categories).show(truncate=False)
    return counts


def compare(spark: SparkSession, w: Warehouse, export: DataFrame, out: str | None = None) -> None:
    """Reconcile silver (left) with an export of date, amount, category and type (right): summary, months, missing rows."""
    silver = w.read("silver.transactions").select(F.col("transaction_date").alias("date"), F.col("amount"), F.col("subcategory").alias("category"), F.col("transaction_type").alias("type"))
    other = clean.typed(clean.named(export)).select("date", "amount", F.col("subcategory").alias("category"), F.col("transaction_type").alias("type"))
    left, right = recon.expense_rows(silver), recon.expense_rows(other)
    reports = {"summary": recon.summary(left, right), "months": recon.monthly_comparison(left, right).orderBy("month"), "missing": recon.missing_both_ways(left, right).orderBy("side", "txn_key")}
    for name, rows in reports.items():
        rows.show(20, truncate=False)
        if out:
            files.export_csv(rows, f"{out}/{name}")


COMPACTED = (("bronze.transactions_raw", None, None), ("silver.transactions", "transaction_date", "transaction_hash"), ("silver.daily_spend", "day", None))


def corrections(spark: SparkSession, w: Warehouse, path: str) -> tuple[DataFrame, list[str]]:
    """The rows of a corrections file with silver's types, and the columns that they set."""
    kinds = dict(w.read("silver.transactions").dtypes)
    found = files.csv(spark, path)
    unknown = set(found.columns) - set(kinds)
    if unknown or merge.HASH not in found.columns:
        raise SystemExit(f"corrections need {merge.HASH} and columns of silver; unknown: {sorted(unknown)}")
    changes = found.select(*[F.col(c).cast(kinds[c]).alias(c) for c in found.columns])
    return changes, [c for c in found.columns if c not in (merge.HASH, "transaction_date")]


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("txnlake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    w = Warehouse(spark, a.warehouse)
    w.create()
    w.preflight()

    def extract(date_from, date_to):
        if a.source == "file":
            return files.scan(spark, a.file)
        iso = lambda d: d.isoformat() if d else None
        return api.extract(spark, a.api_url, iso(date_from), iso(date_to), a.api_token, a.window_days)

    found = files.presets(a.presets) if a.presets else {}
    if a.account_filter not in (None, "all") and a.account_filter not in found:
        raise SystemExit(f"unknown account filter {a.account_filter}; there are {sorted(found)}")
    preset = found.get(a.account_filter)
    review = lambda rows: files.export_csv(rows.orderBy("transaction_hash", "source_row_number"), f"{w.root}/review/duplicate_transactions")
    loader = Loader(spark, w, extract, a.mode, a.source, preset, days=a.window_days, review=review)
    if a.refresh_gold:
        names = tuple(merge.METRICS) if a.refresh_gold == "both" else (a.refresh_gold,)
        print(loader.refresh(names=names))
    elif a.export_anonymised:
        gold = [w.read(f"gold.{m.name}") for m in merge.METRICS.values()]
        files.export_csv(anonymise.anonymised(anonymise.wide(w.read("silver.transactions"), *gold)).orderBy("transaction_date", "transaction_hash"), a.export_anonymised, single=False)
    elif a.export_duplicates:
        batch = layers.silver(clean.clean(extract(a.from_date, a.to_date)), "review")
        files.export_csv(merge.duplicate_rows(batch).orderBy("transaction_hash", "transaction_date"), a.export_duplicates)
    elif a.dry_run:
        dry_run(spark, w, extract(a.from_date, a.to_date), preset if a.mode == "incremental" else None, a.dump)
    elif a.compare:
        compare(spark, w, files.scan(spark, a.compare), a.out)
    elif a.correct:
        print(loader.correct(*corrections(spark, w, a.correct), a.actor, a.reason))
    elif a.compact:
        print({t: w.compact(t, day=d, key=k) for t, d, k in COMPACTED})
    elif a.vacuum:
        print(len(w.vacuum()))
    else:
        return int(not loader.run(a.from_date, a.to_date))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
