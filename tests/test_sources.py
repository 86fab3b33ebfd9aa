import io
import json
import urllib.error

import pytest

from txnlake.sources import api, files, records


def flat(spark, *rows):
    return records.flattened(spark.read.schema(records.SCHEMA).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))).collect()


def test_flatten(spark):
    full = {"id": "1", "recordDate": "2026-02-05T00:00:00Z", "amount": {"value": 0.83, "currencyCode": "EUR"}, "baseAmount": {"value": 1.65, "currencyCode": "BGN"}, "category": {"id": "cat-1", "name": "Refunds"}, "labels": [{"name": "tag1"}, {}, {"name": "x"}], "accountId": "a", "recordState": "ok"}
    a, b = flat(spark, full, {"id": "2", "recordDate": "d"})
    assert (a.amount_value, a.amount_currency, a.base_amount_value, a.base_amount_currency, a.category_id, a.category_name, a.labels, a.recordState) == (0.83, "EUR", 1.65, "BGN", "cat-1", "Refunds", "tag1, , x", "ok")
    assert (b.labels, b.base_amount_currency, b.base_amount_value, b.amount_value, b.accountId) == ("", "EUR", None, None, None)


def test_map(spark):
    rows = [("income", -50.0, "cash"), ("expense", 10.0, None), ("transfer", 20.0, "unknown"), ("expenses", 5.0, "web_payment"), (None, 7.0, ""), ("INCOME", 100.0, "voucher")]
    df = spark.createDataFrame([(str(i), "2026-02-05T00:00:00Z", t, a, p, "", "q") for i, (t, a, p) in enumerate(rows)], "id string, recordDate string, recordType string, amount_value double, paymentType string, payee string, payer string")
    got = sorted(tuple(r[c] for c in ("source_record_id", "type", "amount", "payment", "payee", "date")) for r in records.mapped(df).collect())
    assert [g[1] for g in got] == ["Income", "Expenses", "Transfer", "Expenses", "Expenses", "Income"]
    assert [g[2] for g in got] == [50.0, -10.0, 20.0, 5.0, -7.0, 100.0]
    assert [g[3] for g in got] == ["CASH", "", "UNKNOWN", "WEB_PAYMENT", "", "VOUCHER"]
    assert {g[4] for g in got} == {"q"} and {g[5] for g in got} == {"2026-02-05"}
    assert records.mapped(df.limit(0)).count() == 0


def test_lookups(spark):
    cats = spark.createDataFrame([("c1", "Food", None), ("c2", "Bar", "c1")], "id string, name string, parentId string")
    accounts = spark.createDataFrame([("a1", "Cash")], "id string, name string")
    df = spark.createDataFrame([("c2", "a1"), ("c1", "a9"), (None, None)], "category_id string, accountId string")
    got = {(r.category_id, r.account_name, r.category_parent_name) for r in records.with_names(df, accounts, cats).collect()}
    assert got == {("c2", "Cash", "Food"), ("c1", "a9", None), (None, "", None)}


def test_pages_and_retry():
    calls, waits = [], []

    def opener(request):
        calls.append(request.full_url)
        if len(calls) == 2:
            raise urllib.error.HTTPError(request.full_url, 409, "busy", {}, io.BytesIO(b'{"retry_after_minutes": 5}'))
        page = {"records": [{"id": len(calls)}], **({"nextOffset": 200} if len(calls) == 1 else {})}
        return io.BytesIO(json.dumps(page).encode())

    got = list(api.pages("http://x", "2025-01-01", "2025-02-01", {}, opener, waits.append))
    assert [g["id"] for g in got] == [1, 3] and waits == [0.2, 60]
    assert "gte.2025-01-01" in calls[0] and "lt.2025-02-01" in calls[0] and "offset=200" in calls[2]

    def busy(request):
        raise urllib.error.HTTPError(request.full_url, 409, "busy", {}, io.BytesIO(b"{}"))

    with pytest.raises(RuntimeError, match="5 attempts"):
        list(api.pages("http://x", "a", "b", {}, busy, waits.append))


def test_slices():
    r = api.RecordSource({"from": "2025-01-01", "to": "2025-08-01", "url": "http://x"}).reader(None)
    parts = [(p.date_from, p.date_to) for p in r.partitions()]
    assert parts[0][0] == "2025-01-01" and parts[-1][1] == "2025-08-01" and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


def test_scan(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text('date,note\n2024-01-01,"a ""b""\nc"\n')
    assert [tuple(r) for r in files.scan(spark, str(p)).collect()] == [("2024-01-01", 'a "b"\nc')]
    with pytest.raises(FileNotFoundError):
        files.scan(spark, str(tmp_path / "none.csv"))
    (tmp_path / "x.txt").write_text("")
    with pytest.raises(ValueError, match="unsupported"):
        files.scan(spark, str(tmp_path / "x.txt"))


def test_encodings(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes("a\ncafé\n".encode("latin-1"))
    df, name = files.csv_any_encoding(spark, str(tmp_path / "l.csv"))
    assert (df.first()[0], name) == ("café", "latin-1")


def test_presets(tmp_path):
    pytest.importorskip("yaml")
    p = tmp_path / "p.yaml"
    p.write_text("presets:\n  eur:\n    allowed_accounts: [A]\n")
    assert files.presets(str(tmp_path / "none.yaml"), str(p)) == {"eur": {"allowed_accounts": ["A"]}}
    p.write_text("presets: {}")
    with pytest.raises(ValueError):
        files.presets(str(p))


def test_the_data_source_and_lookups(spark):
    """A run through the registered source against a server, with names of accounts and parent categories."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer
    from urllib.parse import parse_qs, urlparse

    record = lambda i, day, account: {"id": str(i), "recordDate": f"{day}T10:00:00Z", "recordType": "expense", "amount": {"value": 5.0 + i, "currencyCode": "EUR"}, "category": {"id": "c2", "name": "Bar"}, "accountId": account}
    stored = [record(0, "2025-01-02", "a1"), record(1, "2025-03-01", "a9"), record(2, "2025-05-30", None)]

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            u = urlparse(self.path)
            q = parse_qs(u.query)
            if u.path == "/records":
                lo, hi = (x.split(".", 1)[1] for x in q["recordDate"])
                body = {"records": [r for r in stored if lo <= r["recordDate"][:10] < hi]}
            elif u.path == "/accounts":
                body = {"accounts": [{"id": "a1", "name": "Cash"}]}
            elif "nextOffset" not in q and q["offset"] == ["0"]:
                body = {"categories": [{"id": "c1", "name": "Food"}], "nextOffset": 1}
            else:
                body = {"categories": [{"id": "c2", "name": "Bar", "parentId": "c1"}, {"id": "c3"}]}
            data = json.dumps(body).encode()
            self.send_response(200 if self.headers["Authorization"] == "Bearer t" else 401)
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        got = api.extract(spark, f"http://127.0.0.1:{server.server_port}", "2025-01-01", "2025-06-01", "t").collect()
    finally:
        server.shutdown()
    assert {(r.source_record_id, r.account, r.category, r.category_parent_name, r.amount) for r in got} == {("0", "Cash", "Bar", "Food", -5.0), ("1", "a9", "Bar", "Food", -6.0), ("2", "", "Bar", "Food", -7.0)}
