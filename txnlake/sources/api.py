"""A paged REST source as a Python data source: one partition for each slice of dates, read by the executors.

As a stream its offset is the last record taken, by date and id. A batch is what lies between two offsets, so that a restart reads the
same records again; new records that are dated before the offset are not seen (the watermark's rule).
"""

from __future__ import annotations

import datetime as dt
import json
import time
import urllib.error
import urllib.parse
import urllib.request

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from txnlake.sources.records import SCHEMA, flattened, mapped, with_names

PAGE, PAUSE_S, ATTEMPTS, LONGEST_WAIT_S = 200, 0.2, 5, 60


def fetched(url: str, headers: dict[str, str], opener=urllib.request.urlopen, sleep=time.sleep) -> dict:
    """The JSON of a page. A 409 says in how many minutes to come back; after ATTEMPTS of them, RuntimeError."""
    for _ in range(ATTEMPTS):
        try:
            with opener(urllib.request.Request(url, headers=headers)) as r:
                return json.loads(r.read())
        except urllib.error.HTTPError as e:
            if e.code != 409:
                raise
            body = e.read() or b"{}"
            sleep(min(float(json.loads(body).get("retry_after_minutes", 1)) * 60, LONGEST_WAIT_S))
    raise RuntimeError(f"the API was still busy after {ATTEMPTS} attempts")


def pages(base: str, date_from: str, date_to: str, headers: dict[str, str], opener=urllib.request.urlopen, sleep=time.sleep):
    """Records by date; date_from is included, date_to isn't."""
    offset = 0
    while offset is not None:
        q = urllib.parse.urlencode([("recordDate", f"gte.{date_from}"), ("recordDate", f"lt.{date_to}"), ("sortBy", "+recordDate"), ("limit", PAGE), ("offset", offset)])
        page = fetched(f"{base}/records?{q}", headers, opener, sleep)
        yield from page.get("records", [])
        offset = page.get("nextOffset")
        if offset is not None:
            sleep(PAUSE_S)


def last_record(base: str, headers: dict[str, str], opener=urllib.request.urlopen, sleep=time.sleep) -> tuple[str, str] | None:
    """(recordDate, id) of the greatest record: pages from the end, as long as they hold the last date only."""
    best, offset = None, 0
    while offset is not None:
        page = fetched(f"{base}/records?{urllib.parse.urlencode([('sortBy', '-recordDate'), ('limit', PAGE), ('offset', offset)])}", headers, opener, sleep)
        keys = [_place(r) for r in page.get("records", [])]
        best = max([*keys, *([best] if best else [])], default=None)
        offset = page.get("nextOffset") if keys and keys[-1][0] == best[0] else None
        if offset is not None:
            sleep(PAUSE_S)
    return best


def _place(record: dict) -> tuple[str, str]:
    return str(record.get("recordDate") or ""), str(record.get("id") or "")


class _Slice(InputPartition):
    """Records of some days, and with `after` and `until` only those between the two places (until included)."""

    def __init__(self, date_from: str, date_to: str, after: tuple[str, str] | None = None, until: tuple[str, str] | None = None):
        self.date_from, self.date_to, self.after, self.until = date_from, date_to, after, until


def slices(first: dt.date, last: dt.date, days: int, *bounds) -> list[_Slice]:
    """Slices of so many days; last is not included."""
    starts = [first + dt.timedelta(days=n) for n in range(0, max(0, (last - first).days), days)]
    return [_Slice(s.isoformat(), min(s + dt.timedelta(days=days), last).isoformat(), *bounds) for s in starts]


def _headers(options) -> dict[str, str]:
    return {"Authorization": f"Bearer {options['token']}"} if "token" in options else {}


def _taken(options, partition: _Slice):
    for r in pages(options["url"], partition.date_from, partition.date_to, _headers(options)):
        if partition.after is None or partition.after < _place(r) <= partition.until:
            yield (json.dumps(r),)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        first, last = (dt.date.fromisoformat(self.options[k]) for k in ("from", "to"))
        return slices(first, last, int(self.options.get("slicedays", "92")))

    def read(self, partition):
        return _taken(self.options, partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are {"date": ..., "id": ...} of the last record taken."""

    def __init__(self, options):
        self.options, self.last = options, None

    def initialOffset(self):
        return {"date": self.options.get("since", "1970-01-01"), "id": ""}

    def latestOffset(self):
        found = last_record(self.options["url"], _headers(self.options))
        now = max(found or ("", ""), self.last or tuple(self.initialOffset().values()))  # an offset never goes back
        self.last = now
        return {"date": now[0], "id": now[1]}

    def partitions(self, start, end):
        after, until = ((o["date"], o["id"]) for o in (start, end))
        if until <= after:
            return []
        first, last = (dt.date.fromisoformat(o[0][:10]) for o in (after, until))
        return slices(first, last + dt.timedelta(days=1), int(self.options.get("slicedays", "92")), after, until)

    def read(self, partition):
        return _taken(self.options, partition)

    def commit(self, end):
        pass


class RecordSource(DataSource):
    @classmethod
    def name(cls):
        return "txn_api"

    def schema(self):
        return "value string"

    def reader(self, schema):
        return _Reader(self.options)

    def streamReader(self, schema):
        return _StreamReader(self.options)


def _lookup(base: str, kind: str, headers: dict[str, str], opener, sleep) -> list[dict]:
    """All entries of an account or category list, page by page: as many as a person keeps."""
    out, offset = [], 0
    while offset is not None:
        q = urllib.parse.urlencode([("limit", PAGE), ("offset", offset)])
        page = fetched(f"{base}/{kind}?{q}", headers, opener, sleep)
        out += page.get(kind, [])
        offset = page.get("nextOffset")
        if offset is not None:
            sleep(PAUSE_S)
    return out


def lookups(spark: SparkSession, url: str, token: str | None = None, opener=urllib.request.urlopen, sleep=time.sleep) -> tuple[DataFrame, DataFrame]:
    """(accounts, categories): id and name, of categories the parent's id as well. The first of equal ids counts; no name is Unknown."""
    headers = {"Authorization": f"Bearer {token}"} if token else {}
    out = []
    for kind, schema in (("accounts", "id string, name string"), ("categories", "id string, name string, parentId string")):
        first = {}
        for x in _lookup(url, kind, headers, opener, sleep):
            if x.get("id") is not None:
                first.setdefault(str(x["id"]), (str(x["id"]), x.get("name") or "Unknown", *([x.get("parentId")] if kind == "categories" else [])))
        out.append(spark.createDataFrame(list(first.values()), schema))
    return tuple(out)


def extract(spark: SparkSession, url: str, date_from: str | None = None, date_to: str | None = None, token: str | None = None, days: int = 365) -> DataFrame:
    """Records of the range as the cleaner's input, with names of accounts and parent categories."""
    flat = flattened(records(spark, url, date_from, date_to, token, days))
    return mapped(with_names(flat, *lookups(spark, url, token)))


def records(spark: SparkSession, url: str, date_from: str | None = None, date_to: str | None = None, token: str | None = None, days: int = 365) -> DataFrame:
    """Nested records of the range, by default the last `days` days. No records: an empty table."""
    from pyspark.sql import functions as F

    last = dt.date.fromisoformat(date_to) if date_to else dt.date.today() + dt.timedelta(days=1)
    first = date_from or (last - dt.timedelta(days=days)).isoformat()
    spark.dataSource.register(RecordSource)
    options = {"url": url, "from": first, "to": last.isoformat()} | ({"token": token} if token else {})
    raw = spark.read.format("txn_api").options(**options).load()
    return raw.select(F.from_json("value", SCHEMA).alias("r")).select("r.*")


def record_stream(spark: SparkSession, url: str, token: str | None = None, since: str | None = None) -> DataFrame:
    """A stream of the records after `since` (a date) as the cleaner's input; accounts and categories are those of its start."""
    from pyspark.sql import functions as F

    spark.dataSource.register(RecordSource)
    options = {"url": url} | ({"token": token} if token else {}) | ({"since": since} if since else {})
    raw = spark.readStream.format("txn_api").options(**options).load()
    flat = flattened(raw.select(F.from_json("value", SCHEMA).alias("r")).select("r.*"))
    return mapped(with_names(flat, *lookups(spark, url, token)))
