"""Loads: full (truncate and reload) and incremental (append what is new), with targeted refresh of gold."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.store import release, written
from txnlake.operators import audit, clean, enrich, layers, merge, rolling, scores
from txnlake.plans.warehouse import Conflict, Folder, State, Warehouse, month_of

LOG = logging.getLogger("txnlake.load")
EMPTY = "nothing to load"
SILVER, DAILY, DAY = "silver.transactions", "silver.daily_spend", "transaction_date"


@dataclass
class Loader:
    """extract: (date_from, date_to) -> raw rows; preset: account filter, of incremental loads only; strict: equal hashes are an error.

    Hooks: post_transform over the cleaned rows; silver_policy (batch, silver so far or None) -> rows to add, by default the batch in a
    first or full load and else the rows that silver lacks; review gets the rows of repeated hashes of a full load.

    stream: name and number of a micro-batch; one that the warehouse has seen adds nothing. A load that meets another writer's changes to
    what it relies on starts its commit again from the new state, `attempts` times at most.
    """

    spark: SparkSession
    warehouse: Warehouse
    extract: Callable[[dt.date | None, dt.date | None], DataFrame]
    mode: str = "incremental"
    source: str = "file"
    preset: dict | None = None
    strict: bool = False
    days: int = 365
    created_by: str = "txnlake"
    post_transform: Callable[[DataFrame], DataFrame] | None = None
    silver_policy: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None
    review: Callable[[DataFrame], None] | None = None
    stream: tuple[str, int] | None = None
    attempts: int = 5
    counts: dict = field(default_factory=dict)

    def watermark(self) -> dt.date | None:
        """The last date in silver, from the ranges of its folders where they are known."""
        folders = self.warehouse.state().tables.get(SILVER, [])
        if folders and all(f.hi for f in folders):
            return dt.date.fromisoformat(max(f.hi for f in folders))
        return self.warehouse.frame(folders).agg(F.max(DAY)).first()[0] if folders else None

    def run(self, date_from: dt.date | None = None, date_to: dt.date | None = None) -> bool:
        """True on success, an empty load included. A failure is logged and raised; gold failures are only logged."""
        started, batch = dt.datetime.now(), str(uuid.uuid4())
        row = {"run_id": str(uuid.uuid4()), "mode": self.mode, "source": self.source, "batch_id": batch, "started_at": started, "status": "FAILED"}
        try:
            self._load(batch, date_from, date_to)
            row["status"] = "SUCCESS"
            return True
        except Exception as e:
            row["error"] = str(e)[:1000]
            raise
        finally:
            end = dt.datetime.now()
            self.warehouse.log_run(row | self.counts | {"finished_at": end, "duration_seconds": (end - started).total_seconds()})

    def _load(self, batch: str, date_from, date_to) -> None:
        if self.mode == "incremental" and self.source == "api":
            date_to = date_to or dt.date.today()
            last = self.watermark()
            date_from = date_from or (last + dt.timedelta(days=1) if last else date_to - dt.timedelta(days=self.days))
            if date_from >= date_to:
                LOG.info(EMPTY)
                return
        raw = self.extract(date_from, date_to).persist()
        rows = None
        try:
            self.counts["rows_extracted"] = raw.count()
            if not self.counts["rows_extracted"]:
                LOG.info(EMPTY)
                return
            rows = clean.clean(raw)
            rows = self.post_transform(rows) if self.post_transform else rows
            rows = rows.withColumn("_order", F.monotonically_increasing_id()).persist()
            self.counts["rows_transformed"] = rows.count()
            if not self.counts["rows_transformed"]:
                LOG.info(EMPTY)
                return
            for warning in clean.validate(rows, self.counts["rows_extracted"]):
                LOG.warning(warning)
            kept = enrich.preset_filter(rows, self.preset) if self.mode == "incremental" else rows
            new = self._retried(kept, batch)
        finally:
            raw.unpersist()
            if rows is not None:
                rows.unpersist()
        self.refresh(new)

    def _retried(self, rows: DataFrame, batch: str) -> DataFrame | None:
        for left in reversed(range(self.attempts)):
            try:
                return self._commit(rows, batch)
            except Conflict as e:
                if not left:
                    raise
                LOG.info("%s; again", e)
        raise AssertionError

    def _commit(self, rows: DataFrame, batch: str) -> DataFrame | None:
        """Staging, bronze and silver in one commit. Returns the new expenses, or None for all."""
        w = self.warehouse
        seen = w.state()
        numbered = layers.numbered(rows, ["_order"]).drop("_order")
        full = self.mode == "full" or not seen.tables.get(SILVER)
        repeated = merge.duplicate_rows(numbered)
        if self.strict and repeated.limit(1).count():
            raise ValueError("the batch has several rows of one transaction_hash")
        if full and self.review:
            self.review(repeated)
        # of equal hashes the first row stays
        unique = merge.deduplicated(numbered, "source_row_number")
        silver = written(enrich.enriched(layers.silver(unique, self.created_by), enrich.mapping(self.spark)), "batch")
        all_rows = self.counts["rows_transformed"] if self.mode == "full" or not self.preset else rows.count()
        if self.stream and seen.streams.get(self.stream[0], -1) >= self.stream[1]:
            # committed by a run that died before gold was refreshed, or before the stream noted it
            self.counts |= {"rows_staged": 0, "rows_bronze": 0, "rows_silver": 0, "rows_skipped": all_rows}
            return silver.where("transaction_type = 'EXPENSE'")
        months = {r[0] for r in silver.select(month_of(DAY)).distinct().collect()}
        if self.silver_policy:
            new, relies = self.silver_policy(silver, None if full else w.read(SILVER, seen)), None
        else:
            new, relies = (silver if full else w.absent(SILVER, silver, merge.HASH, DAY, seen)), months
        stamp = F.current_timestamp()
        changes = {
            "staging.raw_transactions": w.stage("staging.raw_transactions", layers.staging(numbered, self.source, batch)),
            "bronze.transactions_raw": w.stage("bronze.transactions_raw", layers.bronze(numbered, self.source, batch).withColumn("ingestion_timestamp", stamp)),
            SILVER: w.stage(SILVER, new.withColumn("created_at", stamp), month_of(DAY), DAY, merge.HASH),
        }
        changes[DAILY] = self._daily(w.frame(changes[SILVER]) if changes[SILVER] else silver.limit(0))
        append = ("bronze.transactions_raw",) if full else ("bronze.transactions_raw", SILVER, DAILY)
        w.commit(changes, append, seen, guard={} if full else {SILVER: relies}, latest=("staging.raw_transactions",), stream=self.stream)
        added = changes[SILVER]
        n = sum(f.rows for f in added)
        self.counts |= {"rows_staged": all_rows, "rows_bronze": all_rows, "rows_silver": n, "rows_skipped": all_rows - n}
        if full:
            return None
        return (w.frame(added) if added else silver.limit(0)).where("transaction_type = 'EXPENSE'")

    def _daily(self, silver: DataFrame) -> list[Folder]:
        """Staged sums of spend by subcategory and day: what baselines need of rows, kept beside silver in its commits."""
        return self.warehouse.stage(DAILY, rolling.daily_sums(scores.expenses(silver)), month_of("day"), "day")

    def correct(self, changes: DataFrame, columns: list[str], actor: str | None = None, reason: str | None = None) -> int:
        """Lay columns of `changes` over silver by hash and log every changed row to metadata.transaction_audit, in one commit.

        Only folders that hold one of the hashes are written anew, and daily sums of their months. Then gold is refreshed where the changed
        rows, before and after, are in baselines or counts. Returns the number of changed rows.
        """
        for left in reversed(range(self.attempts)):
            try:
                n, reached = self._corrected(changes, columns, actor, reason)
                break
            except Conflict:
                if not left:
                    raise
        if reached is not None:
            self.refresh(reached)
        return n

    def _corrected(self, changes: DataFrame, columns: list[str], actor: str | None, reason: str | None) -> tuple[int, DataFrame | None]:
        w = self.warehouse
        seen = w.state()
        held = self._holding(changes, seen)
        if not held:
            return 0, None
        before = w.frame(held)  # its files stay until a vacuum
        added = w.stage(SILVER, audit.corrected(before, merge.HASH, changes, columns), month_of(DAY), DAY, merge.HASH)
        after = w.frame(added)
        log = w.stage("metadata.transaction_audit", audit.audit_diff(before, after, actor=actor, reason=reason).withColumn("changed_at", F.current_timestamp()))
        n = sum(f.rows for f in log)
        months = {f.part for f in [*held, *added]}
        others = [f for f in seen.tables[SILVER] if f.part in months and f not in held]
        days = self._daily(w.frame([*others, *added]))
        old_days = [f.path for f in seen.tables.get(DAILY, []) if f.part in months]
        changed = {SILVER: added, DAILY: days, "metadata.transaction_audit": log}
        w.commit(changed, ("metadata.transaction_audit",), seen, replaced={SILVER: [f.path for f in held], DAILY: old_days}, guard={SILVER: months, DAILY: months})
        if not n:
            return 0, None
        hit = w.frame(log).select(merge.HASH)
        return n, before.unionByName(after).join(hit, merge.HASH, "left_semi")

    def _holding(self, changes: DataFrame, seen: State) -> list[Folder]:
        """Silver's folders that hold one of the hashes; where `changes` has their dates, only folders of those are looked at."""
        w = self.warehouse
        folders = w.holders(SILVER, changes, merge.HASH, DAY, seen)[0] if DAY in changes.columns else seen.tables.get(SILVER, [])
        if not folders:
            return []
        where = F.regexp_extract(F.input_file_name(), "/(v-[^/]*/[^/]*)/[^/]*$", 1)
        there = w.frame(folders).select(merge.HASH, where.alias("where")).join(changes.select(merge.HASH), merge.HASH, "left_semi")
        hit = {r[0] for r in there.select("where").distinct().collect()}  # folders at most
        return [f for f in folders if f.path.split("/transactions/")[-1] in hit]

    def refresh(self, changed: DataFrame | None = None, names: tuple[str, ...] = tuple(merge.METRICS)) -> dict[str, int]:
        """Recompute gold wherever scores depend on the changed rows (subcategory, transaction_date) of silver, or as a whole.

        A whole table is replaced, so rows without a transaction go. Else the months of the rows that are reached are read of silver,
        and of the days before them the daily sums alone; the result equals that of a whole run, in whatever order batches came.
        """
        out, w = {}, self.warehouse
        now = w.state()
        month = F.date_format(DAY, "yyyy-MM")
        if changed is not None:
            reached = written(merge.reach(changed, self.days), "reach")
            there = {f.part for f in now.tables[SILVER]}
            months = {r[0] for r in reached.select("month").distinct().collect()} & there  # months at most
            if not months:
                return dict.fromkeys(names, 0)
            first = (dt.date.fromisoformat(f"{min(months)}-01") - dt.timedelta(days=self.days + 31)).isoformat()[:7]
            rows, daily = w.read_months(SILVER, months, now), w.read_months(DAILY, {f.part for f in now.tables[DAILY] if first <= f.part <= max(months)}, now)
        for name in names:
            metric = merge.METRICS[name]
            table = f"gold.{metric.name}"
            try:
                if changed is None:
                    found = merge.refreshed(w.read(SILVER, now), metric, None, self.days)
                else:
                    found = merge.rescored(rows, daily, metric, reached, self.days)
                found = written(found.withColumn("computed_at", F.current_timestamp()), metric.name)
                out[name] = found.count()
                if changed is None:
                    w.commit({table: w.stage(table, found, month)})
                else:
                    w.upsert(table, found, month, merge.replaced_where_reached(reached), months)
                release(found)
            except Exception:
                LOG.exception("gold table %s was not refreshed", table)
        return out
