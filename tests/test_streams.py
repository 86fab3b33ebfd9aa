"""Streams that are killed and started again: no row twice, none lost."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from txnlake.operators import merge
from txnlake.plans.load import Loader
from txnlake.plans.warehouse import Warehouse
from txnlake.sources import api
from txnlake.streaming import ingest

EXPORT = "date string, note string, type string, payee string, amount string, labels string, account string, category string, currency string, payment string"


def drop_file(spark, folder, *notes):
    rows = [(f"2024-0{1 + ord(n) % 3}-05", n, "Expenses", "p", f"-{ord(n)}", "", "Cash", "Groceries", "EUR", "card") for n in notes]
    spark.createDataFrame(rows, EXPORT).coalesce(1).write.mode("append").csv(str(folder), header=True)


class Killed(RuntimeError):
    pass


def after(f):
    def run(*args, **more):
        f(*args, **more)
        raise Killed

    return run


def instead(f):
    def run(*args, **more):
        raise Killed

    return run


@pytest.mark.parametrize("place, when", [("_commit", instead), ("_commit", after), ("refresh", instead), ("refresh", after)])
def test_killed_in_a_batch(spark, tmp_path, monkeypatch, place, when):
    w = Warehouse(spark, str(tmp_path / "w"))
    w.create()
    run = lambda: ingest.ingest(spark, str(tmp_path / "in"), w, str(tmp_path / "cp"), "files").awaitTermination()
    drop_file(spark, tmp_path / "in", "a", "b")
    run()
    drop_file(spark, tmp_path / "in", "b", "c", "d", "d")
    with monkeypatch.context() as m:
        m.setattr(Loader, place, when(getattr(Loader, place)))
        with pytest.raises(Exception, match="Killed"):
            run()
    run()
    silver = w.read("silver.transactions")
    hashes = [r[0] for r in silver.select("transaction_hash").collect()]
    assert len(hashes) == len(set(hashes)) == 4 and w.read("bronze.transactions_raw").count() == 6
    assert w.state().streams == {"files": 1}
    for metric in merge.METRICS.values():
        assert w.read(f"gold.{metric.name}").count() == 4
    assert w.runs().where("status = 'SUCCESS'").count() == 2


def test_two_streams_and_a_load_share_a_warehouse(spark, tmp_path):
    """Streams are told apart by name; what one has added the others leave out."""
    w = Warehouse(spark, str(tmp_path / "w"))
    w.create()
    for n in range(2):
        drop_file(spark, tmp_path / "in", "a", "b")
        ingest.ingest(spark, str(tmp_path / "in"), w, str(tmp_path / f"cp{n}"), f"s{n}").awaitTermination()
    assert w.state().streams == {"s0": 0, "s1": 0} and w.read("silver.transactions").count() == 2


@pytest.fixture
def server():
    stored = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            u = urlparse(self.path)
            q = parse_qs(u.query)
            if u.path != "/records":
                body = {u.path[1:]: []}
            else:
                found = sorted(stored, key=lambda r: (r["recordDate"], r["id"]), reverse=q["sortBy"] == ["-recordDate"])
                bounds = dict(x.split(".", 1) for x in q.get("recordDate", []))
                found = [r for r in found if bounds.get("gte", "") <= r["recordDate"][:10] < bounds.get("lt", "9")]
                at, n = int(q["offset"][0]), 2  # small pages
                body = {"records": found[at : at + n]} | ({"nextOffset": at + n} if at + n < len(found) else {})
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *args):
            pass

    s = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", stored
    s.shutdown()


def record(i, day):
    return {"id": f"{i:03d}", "recordDate": f"{day}T10:00:00Z", "recordType": "expense", "note": f"n{i}", "amount": {"value": 5.0 + i, "currencyCode": "EUR"}, "category": {"id": "c", "name": "Groceries"}, "accountId": None}


def test_last_record(server):
    url, stored = server
    assert api.last_record(url, {}, sleep=lambda s: None) is None
    stored += [record(i, "2024-01-0" + str(1 + i // 4)) for i in range(9)]
    assert api.last_record(url, {}, sleep=lambda s: None) == ("2024-01-03T10:00:00Z", "008")
    stored += [record(i, "2024-01-03") for i in range(9, 15)]  # more than a page of one date
    assert api.last_record(url, {}, sleep=lambda s: None) == ("2024-01-03T10:00:00Z", "014")


def test_offsets_cut_between_records():
    r = api._StreamReader({"url": "x", "since": "2024-01-01", "slicedays": "10"})
    assert r.initialOffset() == {"date": "2024-01-01", "id": ""}
    parts = r.partitions({"date": "2024-01-05T10:00:00Z", "id": "3"}, {"date": "2024-01-28T10:00:00Z", "id": "9"})
    assert [(p.date_from, p.date_to) for p in parts] == [("2024-01-05", "2024-01-15"), ("2024-01-15", "2024-01-25"), ("2024-01-25", "2024-01-29")]
    assert all(p.after == ("2024-01-05T10:00:00Z", "3") and p.until == ("2024-01-28T10:00:00Z", "9") for p in parts)
    assert r.partitions({"date": "2024-01-05", "id": "3"}, {"date": "2024-01-05", "id": "3"}) == []


def test_rest_stream_is_replayed_after_a_kill(spark, tmp_path, server, monkeypatch):
    url, stored = server
    w = Warehouse(spark, str(tmp_path / "w"))
    w.create()
    run = lambda: ingest.ingest_api(spark, url, w, str(tmp_path / "cp"), since="2024-01-01", name="rest").awaitTermination()
    notes = lambda: sorted(r.description for r in w.read("silver.transactions").collect())
    stored += [record(i, "2024-01-02") for i in range(3)]
    run()
    assert notes() == ["n0", "n1", "n2"]
    stored += [record(3, "2024-01-02"), record(4, "2024-02-01")]  # one later on the same date
    with monkeypatch.context() as m:
        m.setattr(Loader, "refresh", instead(Loader.refresh))  # killed after the commit
        with pytest.raises(Exception, match="Killed"):
            run()
    stored += [record(5, "2024-02-01")]
    run()
    run()
    assert notes() == ["n0", "n1", "n2", "n3", "n4", "n5"] and w.read("bronze.transactions_raw").count() == 6
    assert w.read("gold.transaction_notability").count() == 6
