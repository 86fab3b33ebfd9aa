"""Commits that interleave, pruned reads, compaction and corrections."""

import datetime as dt
import hashlib
import threading

import pytest
from pyspark.sql import functions as F

from txnlake.operators import bloom, merge
from txnlake.plans.load import Loader
from txnlake.plans.publish import Publisher
from txnlake.plans.warehouse import Conflict, Folder, Warehouse, month_of, packed

KIND = "transaction_hash string, transaction_date date, v int"
T = "silver.t"


@pytest.fixture
def w(spark, tmp_path):
    out = Warehouse(spark, str(tmp_path / "w"))
    out.create()
    return out


def rows(spark, *days_and_values):
    return spark.createDataFrame([(hashlib.sha256(f"{d}{v}".encode()).hexdigest(), dt.date.fromisoformat(d), v) for d, v in days_and_values], KIND)


def staged(w, df):
    return w.stage(T, df, month_of("transaction_date"), "transaction_date", "transaction_hash")


def values(w, table=T):
    return sorted(r.v for r in w.read(table).collect())


class Held(Warehouse):
    """A writer that stops before it publishes, its text already written aside."""

    def _publish(self, name, text):
        if self.meanwhile:
            self.files.write_aside(text)
            self.meanwhile.pop()()
        return super()._publish(name, text)


@pytest.mark.parametrize("times", [1, 3])
def test_no_commit_is_lost_between_writing_and_publishing(spark, w, times):
    a, b = Held(spark, w.root), Warehouse(spark, w.root)
    w.commit({T: w.stage(T, rows(spark, ("2024-01-01", 1)))})
    a.meanwhile = [lambda i=i: b.commit({T: b.stage(T, rows(spark, ("2024-01-01", 10 + i)))}, append=(T,)) for i in range(times)]
    n = a.commit({T: a.stage(T, rows(spark, ("2024-01-01", 2)))}, append=(T,))
    assert values(w) == [1, 2, *range(10, 10 + times)] and n == 2 + times and w._numbers() == list(range(n, 0, -1))


def test_many_writers_at_once(spark, w):
    paths = [w.stage(T, rows(spark, ("2024-01-01", i))) for i in range(24)]

    def run(own):
        for p in own:
            Warehouse(spark, w.root).commit({T: p}, append=(T,))

    threads = [threading.Thread(target=run, args=(paths[i::6],)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert values(w) == list(range(24)) and w._numbers() == list(range(24, 0, -1))


def test_ways_of_publishing(spark, tmp_path):
    """A link and a rename refuse a taken name and leave its text; other file systems are refused."""
    p = Publisher(spark, str(tmp_path))
    for way, name in ((p._link, "linked"), (p._rename, "renamed")):
        assert way(p.write_aside("first"), name) is True and way(p.write_aside("second"), name) is False
        assert p.read(name) == "first"
    assert p.publish("x.json", "é") and not p.publish("x.json", "y") and p.read("x.json") == "é"
    p.sweep()
    assert sorted(f.name for f in tmp_path.iterdir() if not f.name.endswith(".crc")) == ["linked", "renamed", "x.json"]

    class Other:
        def __init__(self, scheme):
            self.scheme = scheme

        def getUri(self):
            return self

        def getScheme(self):
            return self.scheme

        def hasPathCapability(self, path, name):
            return False

        def __getattr__(self, name):
            return getattr(p_fs, name)

    p_fs, p.fs = p.fs, Other("s3x")
    with pytest.raises(NotImplementedError):
        p.publish("z.json", "z")


def test_conditional_put_with_a_lost_answer(spark, tmp_path):
    """A store that took the text but whose answer was lost counts as published; another's text does not."""
    p = Publisher(spark, str(tmp_path))

    class Builder:
        def __init__(self, fs, path):
            self.fs, self.at = fs, path

        def must(self, *_):
            return self

        def build(self):
            return self

        def write(self, data):
            self.data = data

        def close(self):
            if not self.fs.exists(self.at):
                out = self.fs.create(self.at, False)
                out.write(self.data)
                out.close()
            raise RuntimeError("connection reset")

    class Store:
        def __init__(self, fs):
            self.own = fs

        def createFile(self, path):
            return Builder(self.own, path)

        def __getattr__(self, name):
            return getattr(self.own, name)

    p.fs = Store(p.fs)
    assert p._put("a.json", "mine") is True and p._put("a.json", "other") is False and p.read("a.json") == "mine"


def test_guards_by_month(spark, w):
    """Who relies on a month is stopped by a change of that month only."""
    w.commit({T: staged(w, rows(spark, ("2024-01-01", 1), ("2024-02-01", 2)))})
    seen = w.state()
    w.commit({T: staged(w, rows(spark, ("2024-02-02", 3)))}, append=(T,))
    w.commit({T: staged(w, rows(spark, ("2024-01-02", 4)))}, append=(T,), seen=seen, guard={T: {"2024-01"}})
    with pytest.raises(Conflict):
        w.commit({T: staged(w, rows(spark, ("2024-02-03", 5)))}, append=(T,), seen=seen, guard={T: {"2024-02"}})
    with pytest.raises(Conflict):
        w.commit({T: staged(w, rows(spark, ("2024-03-03", 6)))}, append=(T,), seen=seen, guard={T: None})
    assert values(w) == [1, 2, 3, 4]


def test_a_load_that_is_overtaken_adds_no_hash_twice(spark, w):
    """Another load commits the same rows between a load's reading and its commit."""
    export = lambda: spark.createDataFrame([("2024-01-05", "a", "Expenses", "p", "-10", "", "Cash", "Groceries", "EUR", "card"), ("2024-01-09", "b", "Expenses", "p", "-11", "", "Cash", "Groceries", "EUR", "card")], "date string, note string, type string, payee string, amount string, labels string, account string, category string, currency string, payment string")
    Loader(spark, w, lambda a, b: export().where("note = 'a'"), "full").run()
    late = Loader(spark, w, lambda a, b: export())
    absent, calls = w.absent, []

    def slow(*args, **more):
        out = absent(*args, **more)
        if not calls:
            calls.append(1)
            Loader(spark, Warehouse(spark, w.root), lambda a, b: export()).run()
        return out

    w.absent = slow
    assert late.run() and late.counts["rows_silver"] == 0
    silver = w.read("silver.transactions")
    assert silver.count() == 2 == silver.select("transaction_hash").distinct().count()


def test_incremental_reads_the_months_of_the_batch(spark, w):
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 13) for d in (3, 17)]
    w.commit({T: staged(w, rows(spark, *[(d, i) for d in days for i in range(50)]))})
    w.commit({T: staged(w, rows(spark, *[(d, i) for d in days[4:6] for i in range(50, 60)]))}, append=(T,))
    state = w.state()
    assert len(state.tables[T]) == 13 and all(f.rows in (100, 20) and f.bits == bloom.size(f.rows) and f.lo[:7] == f.part for f in state.tables[T])
    batch = rows(spark, ("2024-03-03", 7), ("2024-03-17", 55), ("2024-03-17", 1000), ("2024-03-18", 1))
    for limit in (1 << 40, 0):  # by dates alone; by Bloom filters as well
        new = w.absent(T, batch, "transaction_hash", "transaction_date", filter_above=limit)
        assert {(str(r.transaction_date), r.v) for r in new.collect()} == {("2024-03-17", 1000), ("2024-03-18", 1)}
        read = new.inputFiles()
        assert read and all("/_part=2024-03/" in f or "/_bloom/_part=2024-03/" in f for f in read)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert "v#" not in plan.split("FileScan parquet [")[-1].split("]")[0]  # keys alone
    held, _ = w.holders(T, rows(spark, ("2024-03-17", 55)), "transaction_hash", "transaction_date", filter_above=0)
    assert [f.rows for f in held] == [20]  # the other folder of the month can't hold it
    fresh = w.absent(T, rows(spark, ("2025-01-01", 1)), "transaction_hash", "transaction_date")
    assert not fresh.inputFiles() and fresh.count() == 1
    assert not any(w.holders(T, rows(spark, ("2024-03-05", 1)), "transaction_hash", "transaction_date", filter_above=0)[0])
    near = w.read_range(T, dt.date(2024, 5, 1), dt.date(2024, 6, 2))
    assert {f.split("_part=")[1][:7] for f in near.inputFiles()} == {"2024-05"} and near.count() == 100
    assert w.read_range(T, dt.date(2030, 5, 1), dt.date(2030, 6, 2)).count() == 0


def test_rows_without_a_date(spark, w):
    """They have a month of their own, are found again, and are upserted in place."""
    kind = spark.createDataFrame([("a", None, 1), ("b", dt.date(2024, 1, 1), 2)], KIND)
    w.commit({T: staged(w, kind)})
    batch = spark.createDataFrame([("a", None, 1), ("c", None, 3)], KIND)
    assert [r.transaction_hash for r in w.absent(T, batch, "transaction_hash", "transaction_date").collect()] == ["c"]
    for v in (5, 6):
        w.upsert("gold.t", spark.createDataFrame([("a", None, v)], KIND), F.date_format("transaction_date", "yyyy-MM"), merge.upserted)
    assert [(r.transaction_hash, r.v) for r in w.read("gold.t").collect()] == [("a", 6)]


def test_bloom_filters(spark):
    """No key that is there is missed; of others about a hundredth passes."""
    keys = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), (F.col("id") % 3).cast("string").alias("p"), F.lit(bloom.size(1000)).alias("bits"))
    filters = bloom.built(keys, "k", "p", "bits")
    assert bloom.possible(keys, "k", "p", "bits", filters).count() == 3000
    others = spark.range(10_000, 14_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit("1").alias("p"), F.lit(bloom.size(1000)).alias("bits"))
    assert bloom.possible(others, "k", "p", "bits", filters).count() < 120


def test_compaction_beside_an_append(spark, w):
    for n in range(12):
        w.commit({T: staged(w, rows(spark, (f"2024-0{1 + n % 2}-0{1 + n % 9}", n)))}, append=(T,))
    before = w.state()
    commit = w.commit

    def later(*args, **more):
        w.commit = commit
        other = Warehouse(spark, w.root)
        other.commit({T: staged(other, rows(spark, ("2024-01-20", 99)))}, append=(T,))
        return commit(*args, **more)

    w.commit = later
    assert w.compact(T, day="transaction_date", key="transaction_hash") == 12
    after = w.state().tables[T]
    assert values(w) == [*range(12), 99] and sorted(f.part for f in after) == ["2024-01", "2024-01", "2024-02"]
    assert {f.part: (f.lo, f.hi, f.rows) for f in after if f.rows == 6} == {m: (min(d), max(d), 6) for m, d in ((m, [f.lo for f in before.tables[T] if f.part == m]) for m in ("2024-01", "2024-02"))}
    assert [r.v for r in w.absent(T, rows(spark, ("2024-01-01", 0), ("2024-01-01", 50)), "transaction_hash", "transaction_date", filter_above=0).collect()] == [50]
    size = max(f.bytes for f in after) + 1
    for n in range(8):
        w.commit({"bronze.b": w.stage("bronze.b", rows(spark, ("2024-01-01", n)))}, append=("bronze.b",))
    one = w.state().tables["bronze.b"][0].bytes
    w.compact("bronze.b", target=4 * one)
    assert len(w.paths("bronze.b")) == 2 and values(w, "bronze.b") == list(range(8)) and size
    gone = w.state()
    w.commit({T: staged(w, rows(spark, ("2024-01-01", 1)))})
    with pytest.raises(Conflict):
        w.commit({T: []}, seen=gone, replaced={T: gone.paths(T)[:1]})


def test_packing_of_folders():
    folders = [Folder(str(i), bytes=b) for i, b in enumerate([70, 50, 50, 30, 10, 10, 5])]
    bins = packed(folders, 100)
    assert sorted(f.path for b in bins for f in b) == [str(i) for i in range(7)] and all(sum(f.bytes for f in b) <= 100 for b in bins) and len(bins) == 3


def test_corrections_rewrite_their_folder_and_refresh_gold(spark, w):
    kind = "date string, note string, type string, payee string, amount string, labels string, account string, category string, currency string, payment string"
    lines = [(f"2024-{m:02d}-10", f"n{m}", "Expenses", "p", f"-{10 + m}", "", "Cash", "Groceries", "EUR", "card") for m in range(1, 7)]
    loader = Loader(spark, w, lambda a, b: spark.createDataFrame(lines, kind), "full")
    loader.run()
    silver = {r.description: r for r in w.read("silver.transactions").collect()}
    before = w.paths("silver.transactions")
    for change in (
        spark.createDataFrame([(silver["n4"].transaction_hash, "Rent")], "transaction_hash string, subcategory string"),
        spark.createDataFrame([(silver["n5"].transaction_hash, silver["n5"].transaction_date, "Rent")], "transaction_hash string, transaction_date date, subcategory string"),
    ):
        assert loader.correct(change, ["subcategory"], "me", "wrong shop") == 1
    after = w.paths("silver.transactions")
    assert {p[-7:] for p in set(before) - set(after)} == {"2024-04", "2024-05"} and len(after) == 6
    assert w.read("metadata.transaction_audit").count() == 2
    assert loader.correct(spark.createDataFrame([("unknown", "x")], "transaction_hash string, subcategory string"), ["subcategory"]) == 0
    # gold equals a full run over the corrected silver
    for metric in merge.METRICS.values():
        want = metric.compute(merge.silver_slice(w.read("silver.transactions"), metric.columns), 365)
        got = w.read(f"gold.{metric.name}").select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def lines(n, seed):
    import random

    rnd = random.Random(seed)
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=rnd.randrange(900)) for _ in range(n)]
    return [(str(d), f"n{i}", rnd.choice(["Expenses", "Expenses", "Income"]), "p", str(-rnd.randrange(1, 2000) / 10), "", "Cash", rnd.choice(["Groceries", "Rent", "Taxi", ""]), "EUR", "card") for i, d in enumerate(days)]


EXPORT = "date string, note string, type string, payee string, amount string, labels string, account string, category string, currency string, payment string"


@pytest.mark.parametrize("order", ["time", "late", "mixed"])
def test_gold_equals_a_whole_run_in_any_order_of_batches(spark, w, order):
    """Late days score the rows that they reach again."""
    every = sorted(lines(160, 4))
    batches = {"time": [every[:120], every[120:150], every[150:]], "late": [every[60:], every[30:60], every[:30]], "mixed": [every[::3], every[1::3], every[2::3]]}[order]
    for b in batches:
        Loader(spark, w, lambda x, y, b=b: spark.createDataFrame(b, EXPORT)).run()
    silver = w.read("silver.transactions")
    assert silver.count() == 160
    for metric in merge.METRICS.values():
        want = metric.compute(merge.silver_slice(silver, metric.columns), 365)
        got = w.read(f"gold.{metric.name}").select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_refresh_reads_what_it_reaches(spark, w, monkeypatch):
    every = sorted(lines(160, 5))
    Loader(spark, w, lambda a, b: spark.createDataFrame(every[:150], EXPORT)).run()
    read, frame = [], Warehouse.frame

    def spied(self, folders):
        read.append(folders)
        return frame(self, folders)

    monkeypatch.setattr(Warehouse, "frame", spied)
    Loader(spark, w, lambda a, b: spark.createDataFrame([("2024-06-30", "x", "Expenses", "p", "-7", "", "Cash", "Taxi", "EUR", "card")], EXPORT)).run()
    silver = {f.part for folders in read for f in folders if "/silver/transactions/" in f.path}
    assert silver <= {"2024-06"} and {f.part for folders in read for f in folders if "/gold/" in f.path} <= {"2024-06"}
    days = {f.part for folders in read for f in folders if "/daily_spend/" in f.path}
    assert min(days) >= "2023-04"
