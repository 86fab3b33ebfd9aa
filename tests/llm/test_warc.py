import base64
import hashlib
import random

import pyarrow.fs as pafs
import pytest
import zstandard

from txnlake.llm import warc


def expected(rows):
    keep = {}
    for p, _, h in rows:
        if p is not None:
            keep[h] = max(keep.get(h, p), p)
    out = []
    for p, _, h in rows:
        body = (h or "").encode()
        again = len(body) >= 1000 and p is not None and keep[h] != p
        out.append((p, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", keep[h] if again else None))
    return sorted(map(str, out))


def pages(spark, n=400):
    rnd = random.Random(2)
    bodies = ["<p>" + " ".join(rnd.choice(["alpha", "bêta", "gamma", "δ"]) for _ in range(rnd.choice([5, 150, 400]))) + "</p>" for _ in range(n // 3)]
    rows = [(i, f"http://x/{i}", rnd.choice(bodies)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string")


def test_round_trip(spark):
    rows, df = pages(spark)
    got = sorted(str((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in warc.round_trip(df).collect())
    assert got == expected(rows)


@pytest.mark.parametrize("options", [{"small": 0}, {"archive_bytes": 20_000}, {"dict_bytes": 1024, "sample_bytes": 5000}])
def test_options_change_nothing(spark, options):
    rows, df = pages(spark, 150)
    got = sorted(str((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in warc.round_trip(df, **options).collect())
    assert got == expected(rows)


def test_edges(spark):
    big = "x" * 2000
    rows = [(0, "a\nb\x7f", None), (None, None, big), (2, "u", big), (3, "v", big), (3, "v", big), (4, "w", ""), (5, "z", "é" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.round_trip(df).collect()
    assert sorted(str((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == expected(rows)
    assert {r.uri for r in got if r.id == 0} == {"a%0Ab%7F"} and {r.uri for r in got if r.id is None} == {None}
    assert warc.round_trip(df.limit(0)).count() == 0


def test_format(spark, tmp_path):
    """Each record is a frame of its own that opens with the leading dictionary alone."""
    rows, df = pages(spark)
    done = warc.write(df, str(tmp_path / "w")).collect()
    assert sum(r.records for r in done) == len(rows)
    for r in done:
        fs, at = pafs.FileSystem.from_uri(r.archive)
        data = fs.open_input_file(at).read()
        assert data[:4] == bytes.fromhex("5d2a4d18") and len(data) == r.stored_bytes < r.raw_bytes
        size = int.from_bytes(data[4:8], "little")
        d = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        found = list(warc.frames(data))
        assert len(found) == r.records
        for (a, rec), (b, _) in zip(found, found[1:] + [(len(data), b"")]):
            assert zstandard.ZstdDecompressor(dict_data=d).decompress(data[a:b]) == rec
            assert rec.startswith(b"WARC/1.1\r\n") and rec.endswith(b"\r\n\r\n")
            x = warc.parse(rec)
            if x["payload"] is not None:
                assert x["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(x["payload"]).digest()).decode()
    with pytest.raises(ValueError):
        list(warc.frames(b"\0" * 20))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.frames(data[:-3]))
