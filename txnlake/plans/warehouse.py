"""Layers as lists of Parquet folders under numbered manifests.

A commit writes new folders aside, then publishes the next manifest, which names the folders of all tables. Manifests appear complete and
under a number that was free (see publish), and each number is the last one plus one: a writer that finds its number taken reads what the
other has done and tries the next, so no commit is passed over or lost. Readers see all of a commit or nothing, and a writer that dies
leaves the state before.

A folder's entry holds its month, number of rows, least and greatest date, size, and the size of its Bloom filter over keys. Loads use
them to read only folders that can hold a batch's rows. Commits name what they rely on (``guard``, ``seen``): whole tables or months. If
another writer changed that meanwhile, Conflict. A stream's batches carry numbers that a manifest remembers, so that none is added twice.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.operators import bloom
from txnlake.plans.publish import Publisher

LAYERS = ("staging", "bronze", "silver", "gold", "metadata")
RUNS = "run_id string, mode string, source string, status string, started_at timestamp, finished_at timestamp, duration_seconds double, rows_extracted long, rows_transformed long, rows_staged long, rows_bronze long, rows_silver long, rows_skipped long, batch_id string, error string"
CLOSED = "\n-- end"
NO_MONTH = "none"


class Conflict(RuntimeError):
    """Another writer changed something that this one relied on."""


class Unfinished(RuntimeError):
    """A manifest that no commit of this kind can have left; repair() puts it aside."""


@dataclass(frozen=True)
class Folder:
    """Rows of a table. lo and hi: range of dates as text; bits: size of the Bloom filter; None or 0: not known."""

    path: str
    part: str | None = None
    rows: int | None = None
    lo: str | None = None
    hi: str | None = None
    bits: int = 0
    bytes: int = 0

    @property
    def version(self) -> str:
        return self.path if self.part is None else self.path.rsplit("/", 1)[0]

    def may_hold(self, lo: str, hi: str) -> bool:
        return self.lo is None or self.hi is None or (self.lo <= hi and lo <= self.hi)


@dataclass(frozen=True)
class State:
    """A manifest: its number, the folders of all tables, the last batch of each stream."""

    number: int = 0
    tables: dict[str, list[Folder]] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)

    def text(self, writer: str) -> str:
        tables = {t: [asdict(f) for f in folders] for t, folders in self.tables.items()}
        return json.dumps({"tables": tables, "streams": self.streams, "writer": writer}) + CLOSED

    @classmethod
    def of(cls, number: int, text: str) -> State | None:
        """None: the text is cut off."""
        if not text.endswith(CLOSED):
            return None
        got = json.loads(text[: -len(CLOSED)])
        return cls(number, {t: [Folder(**f) for f in folders] for t, folders in got["tables"].items()}, got["streams"])

    def paths(self, table: str) -> list[str]:
        return [f.path for f in self.tables.get(table, [])]


def month_of(day: str) -> Column:
    """The month of a date column; rows without date have a month of their own."""
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_MONTH))


class Warehouse:
    """Tables under a folder of any Hadoop file system. A reader sees the state of one manifest."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Publisher(spark, self.root)
        self._fs, self._path = self.files.fs, self.files._path

    def create(self) -> None:
        for layer in LAYERS:
            self._fs.mkdirs(self._path(f"{self.root}/{layer}"))

    def preflight(self) -> None:
        """All layers must exist."""
        missing = [x for x in LAYERS if not self._fs.exists(self._path(f"{self.root}/{x}"))]
        if missing:
            raise RuntimeError(f"missing layers: {missing}")

    # ---- states

    def _numbers(self) -> list[int]:
        return sorted((int(n[9:-5]) for n in self.files.names("manifest-*.json")), reverse=True)

    @staticmethod
    def _name(number: int) -> str:
        return f"manifest-{number:012d}.json"

    def at(self, number: int) -> State | None:
        return State.of(number, self.files.read(self._name(number))) if number else State()

    def state(self, strict: bool = False) -> State:
        """The last manifest. One that is cut off is passed over by readers; a writer (strict) must not pass over it."""
        for n in self._numbers():
            found = self.at(n)
            if found is not None:
                return found
            if strict:
                raise Unfinished(f"{self.root}/{self._name(n)}")
        return State()

    def repair(self) -> list[str]:
        """Put manifests that are cut off aside, under another name."""
        bad = [self._name(n) for n in self._numbers() if self.at(n) is None]
        for name in bad:
            self._fs.rename(self.files.path(name), self.files.path(f"_cut-off-{uuid.uuid4().hex}-{name}"))
        return bad

    def manifest(self) -> dict[str, list[str]]:
        now = self.state()
        return {t: now.paths(t) for t in now.tables}

    def paths(self, table: str) -> list[str]:
        return self.state().paths(table)

    # ---- rows

    def frame(self, folders: list[Folder]) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(*[f.path for f in folders])

    def read(self, table: str, state: State | None = None) -> DataFrame | None:
        folders = (state or self.state()).tables.get(table)
        return self.frame(folders) if folders else None

    def read_range(self, table: str, first: dt.date, last: dt.date, state: State | None = None) -> DataFrame | None:
        """The folders that can hold rows from first to last; their other rows come along."""
        folders = (state or self.state()).tables.get(table)
        if not folders:
            return None
        near = [f for f in folders if f.may_hold(first.isoformat(), last.isoformat())]
        return self.frame(near) if near else self.frame(folders[:1]).limit(0)

    def read_months(self, table: str, months: set[str], state: State | None = None) -> DataFrame | None:
        """The folders of these months; the table's schema without rows if there are none."""
        folders = (state or self.state()).tables.get(table)
        if not folders:
            return None
        own = [f for f in folders if f.part is None or f.part in months]
        return self.frame(own) if own else self.frame(folders[:1]).limit(0)

    def stage(self, table: str, df: DataFrame, by: Column | None = None, day: str | None = None, key: str | None = None) -> list[Folder]:
        """Write rows of the table, with `by` a folder for each of its values; they are not visible before commit().

        day: a date column whose range is noted; key: a column over which each month gets a Bloom filter.
        """
        if by is None:
            return self._store(table, df, False, day, key)
        return self._store(table, df.withColumn("_part", F.coalesce(by.cast("string"), F.lit(NO_MONTH))), True, day, key)

    def _store(self, table: str, df: DataFrame, parted: bool, day: str | None, key: str | None) -> list[Folder]:
        version = f"{self.root}/{table.replace('.', '/')}/v-{uuid.uuid4().hex}"
        (df.write.partitionBy("_part") if parted else df.write).parquet(version)
        return self._described(version, df, parted, day, key)

    def _described(self, version: str, df: DataFrame, parted: bool, day: str | None, key: str | None) -> list[Folder]:
        """Entries of a version that was just written: a pass over two of its columns."""
        own = [c for c in dict.fromkeys((day, key)) if c]
        rows = self.spark.read.schema(df.select(*own, *["_part"] * parted).schema if own or parted else df.schema).parquet(version)
        part = F.col("_part") if parted else F.lit("")
        lo, hi = (g(day).cast("string") if day else F.lit(None).cast("string") for g in (F.min, F.max))
        blank = F.count(F.when(F.col(day).isNull(), 1)) if day else F.lit(0)
        found = rows.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), lo.alias("lo"), hi.alias("hi"), blank.alias("blank")).collect()  # as many as months
        out = []
        for r in sorted(found, key=lambda r: r.part):
            path = f"{version}/_part={r.part}" if parted else version
            size = self._fs.getContentSummary(self._path(path)).getLength()
            ranged = (r.lo, r.hi) if not r.blank else (None, None)
            out.append(Folder(path, r.part if parted else None, r.rows, *ranged, bloom.size(r.rows) if key and parted else 0, size))
        if not out and not parted:
            out = [Folder(version, None, 0)]
        if key and parted and out:
            sizes = self.spark.createDataFrame([(f.part, f.bits) for f in out], "_part string, bits long")  # a row for each month
            name = F.concat(F.lit(f"{version.rsplit('/', 1)[-1]}/"), "_part")
            keys = rows.select(key, "_part").join(F.broadcast(sizes), "_part").select(key, "bits", name.alias("part"))
            filters = bloom.built(keys, key, "part", "bits")
            filters.withColumn("_part", F.substring_index("part", "/", -1)).write.partitionBy("_part").parquet(f"{version}/_bloom")
        return out

    def _filters(self, folders: list[Folder]) -> DataFrame:
        """(part, word, bits) of the folders' Bloom filters; part is version/month."""
        return self.spark.read.schema("part string, word long, bits long").parquet(*[f"{f.version}/_bloom/_part={f.part}" for f in folders])

    def holders(self, table: str, rows: DataFrame, key: str, day: str | None = None, state: State | None = None, filter_above: int = 64 << 20) -> tuple[list[Folder], DataFrame | None]:
        """The table's folders that can hold any of the keys, and the keys that may be there (None: any of them).

        With `day`, a key's date: only folders of its months whose range of dates meets that of the rows there. Then, where those
        folders are larger than filter_above bytes in sum, their Bloom filters; below that, reading them costs less than asking.
        """
        folders = (state or self.state()).tables.get(table, [])
        if day is not None and folders:
            spans = {r.m: (r.lo, r.hi) for r in rows.groupBy(month_of(day).alias("m")).agg(F.min(day).cast("string").alias("lo"), F.max(day).cast("string").alias("hi")).collect()}  # months of a batch
            folders = [f for f in folders if (f.part in spans and (spans[f.part][0] is None or f.may_hold(*spans[f.part]))) or (f.part is None and any(lo is None or f.may_hold(lo, hi) for lo, hi in spans.values()))]
        if day is None or not all(f.bits and f.part is not None for f in folders) or sum(f.bytes for f in folders) <= filter_above:
            return folders, None
        name = lambda f: f"{f.version.rsplit('/', 1)[-1]}/{f.part}"
        asked = self.spark.createDataFrame([(f.part, name(f), f.bits) for f in folders], "m string, part string, bits long")
        keys = rows.select(F.col(key).alias("k"), month_of(day).alias("m")).distinct().join(asked, "m")
        maybe = bloom.possible(keys, "k", "part", "bits", self._filters(folders))
        hit = {r.part for r in maybe.select("part").distinct().collect()}  # folders at most
        return [f for f in folders if name(f) in hit], maybe.select("key").distinct()

    def absent(self, table: str, rows: DataFrame, key: str, day: str | None = None, state: State | None = None, filter_above: int = 64 << 20) -> DataFrame:
        """The rows whose key the table lacks. Reads the key column of holders() alone."""
        folders, maybe = self.holders(table, rows, key, day, state, filter_above)
        if not folders:
            return rows
        there = self.frame(folders).select(key)
        if maybe is not None:
            there = there.join(maybe, there[key] == maybe["key"], "left_semi")
        return rows.join(there, key, "left_anti")

    # ---- commits

    def commit(self, changes: dict[str, list[Folder]], append: tuple[str, ...] = (), seen: State | int | None = None, replaced: dict[str, list[str]] | None = None, guard: dict[str, set[str] | None] | None = None, latest: tuple[str, ...] = (), stream: tuple[str, int] | None = None) -> int:
        """Make the folders current, all at once, and return the manifest's number.

        Folders of tables in `append` are added to what is there; with `replaced`, in place of the paths that it names; else they are
        the table. seen: the state that `changes` was computed from. If since then another writer has changed a table that is set as a
        whole, removed a path of `replaced`, or changed what `guard` names (months of a table, or None for all), Conflict. Tables in
        `latest` hold what was written last, whoever wrote it.
        stream: name and number of a batch; one that a manifest knows already is not added again.
        """
        seen = self.at(seen) if isinstance(seen, int) else seen
        replaced, guard, writer = replaced or {}, guard or {}, uuid.uuid4().hex
        while True:
            now = self.state(strict=True)
            if stream and now.streams.get(stream[0], -1) >= stream[1]:
                return now.number
            if seen is not None and now.number > seen.number:
                self._check(now, seen, {*changes} - {*append, *replaced, *latest}, guard)
            tables = dict(now.tables)
            for t, new in changes.items():
                if t in replaced:
                    gone = set(replaced[t])
                    if gone - set(now.paths(t)):
                        raise Conflict(f"{t}: folders to be replaced are gone")
                    tables[t] = [f for f in now.tables.get(t, []) if f.path not in gone] + new
                else:
                    tables[t] = (now.tables.get(t, []) if t in append else []) + new
            after = State(now.number + 1, tables, now.streams | dict([stream] if stream else []))
            if self._publish(self._name(after.number), after.text(writer)):
                return after.number

    def _publish(self, name: str, text: str) -> bool:
        return self.files.publish(name, text)

    @staticmethod
    def _check(now: State, seen: State, whole: set[str], guard: dict[str, set[str] | None]) -> None:
        moved = [t for t in sorted(whole) if now.paths(t) != seen.paths(t)]
        for t, months in guard.items():
            own = lambda s: {f.path for f in s.tables.get(t, []) if months is None or f.part is None or f.part in months}  # noqa: B023, E731
            if own(now) != own(seen):
                moved.append(t)
        if moved:
            raise Conflict(f"changed meanwhile: {moved}")

    def upsert(self, table: str, rows: DataFrame, month: Column, merge: Callable[[DataFrame, DataFrame], DataFrame], months: set[str] | None = None, attempts: int = 5) -> int:
        """Put rows into or over the table's, month by month. A row's key decides its month. Only months hit are read and rewritten.

        months: those to rewrite, where some may have lost all rows. Writers of other months go on; one of the same month makes this one start again from what that one left.
        """
        month = F.coalesce(month.cast("string"), F.lit(NO_MONTH))
        hit = {r[0] for r in rows.select(month).distinct().collect()} | (months or set())  # as many as there are months
        for left in reversed(range(attempts)):
            now = self.state()
            old = [f for f in now.tables.get(table, []) if f.part is None or f.part in hit]
            new = self.stage(table, merge(self.frame(old), rows) if old else rows, month)
            try:
                return self.commit({table: new}, seen=now, replaced={table: [f.path for f in old]}, guard={table: hit})
            except Conflict:
                if not left:
                    raise
        raise AssertionError

    def compact(self, table: str, target: int = 128 << 20, day: str | None = None, key: str | None = None) -> int:
        """Merge a month's folders that are smaller than `target` bytes into folders of about that size; returns how many went.

        Appends meanwhile stay. If another writer removes one of the merged folders first, Conflict, and nothing is changed.
        """
        now, gone, new = self.state(), [], []
        small = defaultdict(list)
        for f in now.tables.get(table, []):
            if f.bytes < target:
                small[f.part].append(f)
        bins = [[b for b in packed(folders, target) if len(b) > 1] for folders in small.values()]
        for level in range(max(map(len, bins), default=0)):
            some = [f for own in bins if len(own) > level for f in own[level]]  # a bin of each month: one write
            parted = some[0].part is not None
            month = F.regexp_extract(F.input_file_name(), r"/_part=([^/]*)/[^/]*$", 1) if parted else F.lit(0)
            rows = self.frame(some).withColumn("_part", month).repartition("_part")  # a task gets a bin, so `target` bytes at most
            new += self._store(table, rows if parted else rows.drop("_part"), parted, day, key)
            gone += [f.path for f in some]
        if gone:
            self.commit({table: new}, seen=now, replaced={table: gone})
        return len(gone)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the folders that none of the last `keep` manifests names, and older manifests. Not beside a running load."""
        numbers = self._numbers()
        kept = [s for n in numbers[:keep] if (s := self.at(n)) is not None]
        wanted = {f.version for s in kept for folders in s.tables.values() for f in folders}
        gone = []
        for f in self._fs.globStatus(self._path(f"{self.root}/*/*/v-*")) or []:
            path = f.getPath()
            name = f"{self.root}/{path.getParent().getParent().getName()}/{path.getParent().getName()}/{path.getName()}"
            if name not in wanted:
                self._fs.delete(path, True)
                gone.append(name)
        for n in numbers[keep:]:
            self.files.delete(self._name(n))
        self.files.sweep()
        return gone

    def log_run(self, row: dict) -> None:
        """Append a run; its own files, so that a failed load is logged too."""
        names = [c.strip().split()[0] for c in RUNS.split(",")]
        self.spark.createDataFrame([tuple(row.get(n) for n in names)], RUNS).coalesce(1).write.mode("append").parquet(f"{self.root}/metadata/pipeline_runs")

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUNS).parquet(f"{self.root}/metadata/pipeline_runs")


def packed(folders: list[Folder], target: int) -> list[list[Folder]]:
    """First fit, largest first: bins of at most target bytes."""
    bins: list[tuple[int, list[Folder]]] = []
    for f in sorted(folders, key=lambda f: (-f.bytes, f.path)):
        at = next((i for i, (size, _) in enumerate(bins) if size + f.bytes <= target), None)
        if at is None:
            bins.append((f.bytes, [f]))
        else:
            bins[at] = (bins[at][0] + f.bytes, [*bins[at][1], f])
    return [b for _, b in bins]


NAME = re.compile(r"^\d{3,}_[a-z0-9_]+\.sql$")


class Migrations:
    """A ledger of applied migration files by name and SHA-256; an edited file is refused.

    Folder and ledger may be on any Hadoop file system. An entry of the ledger is a file of its own, published before the migration is
    counted as applied, so that of two runs one records it.
    """

    def __init__(self, spark: SparkSession, folder: str, ledger: str):
        self.spark, self.folder, self.ledger = spark, Publisher(spark, folder.rstrip("/")), Publisher(spark, ledger.rstrip("/"))

    def files(self) -> list[str]:
        found = sorted(self.folder.names("*.sql"))
        bad = [f for f in found if not NAME.match(f)]
        if bad:
            raise RuntimeError(f"migration names must be NNN_short_name.sql: {bad}")
        return found

    def _sum(self, name: str) -> str:
        return hashlib.sha256(self.folder.read(name).encode()).hexdigest()

    def applied(self) -> dict[str, str]:
        return {n[: -len(".json")]: json.loads(self.ledger.read(n))["checksum"] for n in self.ledger.names("*.sql.json")}

    def verify(self) -> None:
        done = self.applied()
        bad = [f for f in self.files() if f in done and done[f] != self._sum(f)]
        if bad:
            raise RuntimeError(f"applied migrations were edited: {bad}")

    def status(self) -> list[tuple[str, str]]:
        done = self.applied()
        return [(f, "applied" if f in done else "pending") for f in self.files()]

    def run(self, dry_run: bool = False, baseline: bool = False) -> list[str]:
        """Apply pending files in order, or with baseline only record them. Returns their names."""
        self.verify()
        done = self.applied()
        pending = [f for f in self.files() if f not in done]
        for f in [] if dry_run else pending:
            for statement in [] if baseline else filter(str.strip, self.folder.read(f).split(";")):
                self.spark.sql(statement)
            self.ledger.publish(f"{f}.json", json.dumps({"checksum": self._sum(f), "applied_at": dt.datetime.now(dt.UTC).isoformat()}))
        return pending
