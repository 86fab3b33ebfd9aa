"""WARC archives compressed record by record with Zstandard and a dictionary of their own.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary; every record follows as a frame of its
own, so any record can be read alone with the archive's head. The dictionary is trained on records of the same archive: evenly
spaced ones, up to ``sample_bytes``. Archives too small to train on use their first records as raw dictionary content.

Of records with equal payloads of at least ``min_revisit`` bytes, that with the largest id is written in full and the others as
revisit records that refer to it. Equal payloads are found by SHA-1 and length. The table of repeated payloads is broadcast only
when it is counted to be small; otherwise it is joined by a shuffle, whose hot keys adaptive execution splits.

Each task writes files under a name of its own to the shared folder and reports them; only reported files are read, so a task that
is run again, or twice, leaves no double records.

Rows: null payload is empty; a null id or URL leaves out its header; rows without id are never a revisit's target; rows repeated
with the largest id are all responses; control characters in URLs are percent-encoded. Empty tables give no rows. Other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.store import new_folder, written

SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = "id long, uri string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, frame_offset long"


def _urn(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}:{digest}')}>"


def _uri(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(page: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit (refers_to given) holds the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if page is not None:
        lines.append(f"X-Page-Id: {page}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    lines += [
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"X-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes], dict_bytes: int, sample_bytes: int) -> zstandard.ZstdCompressionDict:
    """Trained on evenly spaced records of the archive, raw content where there are too few."""
    total = sum(map(len, records))
    step = max(1, -(-total // sample_bytes))
    samples = [r[: sample_bytes // 8] for r in records[::step]]
    if len(samples) >= 16 and sum(map(len, samples)) >= 8 * dict_bytes:
        try:
            return zstandard.train_dictionary(dict_bytes, samples, k=512, d=8)
        except zstandard.ZstdError:
            pass
    return zstandard.ZstdCompressionDict(b"".join(samples)[:dict_bytes] or b"WARC/1.1", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes], level: int, dict_bytes: int, sample_bytes: int) -> bytes:
    """The bytes of one archive."""
    d = dictionary(records, dict_bytes, sample_bytes)
    raw = d.as_bytes()
    c = zstandard.ZstdCompressor(level=level, dict_data=d)
    return b"".join([struct.pack("<II", SKIPPABLE, len(raw)), raw, *map(c.compress, records)])


def frames(data: bytes, piece: int = 1 << 14):
    """(offset, record) for each record of an archive."""
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("the archive doesn't start with a dictionary frame")
    raw = data[8 : 8 + size]
    trained = raw[:4] == b"\x37\xa4\x30\xec"
    d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
    reader = zstandard.ZstdDecompressor(dict_data=d)
    view, at = memoryview(data), 8 + size
    while at < len(data):
        one, out, pos = reader.decompressobj(), [], at
        while not one.eof:
            if pos >= len(data):
                raise ValueError("the archive ends within a record")
            out.append(one.decompress(view[pos : pos + piece]))
            pos += piece
        end = min(pos, len(data)) - len(one.unused_data)
        yield at, b"".join(out)
        at = end


def parse(rec: bytes) -> dict:
    """Headers of a record, and its payload where it has one."""
    head, _, rest = rec.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    fields["payload"] = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
    return fields


def _stored(uri: str):
    return pafs.FileSystem.from_uri(uri)


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = 1000, level: int = 3, dict_bytes: int = 32_768, sample_bytes: int = 2_000_000, archive_bytes: int = 48_000_000, small: int = 100_000, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the archives; returns (archive, records, raw_bytes, stored_bytes), one row each.

    Memory of a task: one archive of at most archive_bytes (or one record, if longer) before compression.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    same = rows.where(F.col("size") >= min_revisit).groupBy("digest", "size").agg(F.max("id").alias("keep"), F.count("*").alias("n"))
    same = written(same.where("n > 1 AND keep IS NOT NULL").select("digest", "size", "keep"), "repeated")
    few = same.limit(small + 1).count() <= small
    rows = rows.join(F.broadcast(same) if few else same, ["digest", "size"], "left")
    # rows without id have no place in the order and stay responses
    target = F.when((F.col("id") < F.col("keep")), F.col("keep"))
    rows = rows.select("id", "url", F.when(target.isNull(), F.col("payload")).alias("payload"), "digest", "size", target.alias("target"))

    def run(batches):
        fs, root = _stored(folder)
        fs.create_dir(root, recursive=True)
        held, total = [], 0

        def close():
            name = f"{uuid.uuid4().hex}.warc.zst"
            data = archive(held, level, dict_bytes, sample_bytes)
            with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            done = pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [len(held)], "raw_bytes": [total], "stored_bytes": [len(data)]})
            held.clear()
            return done

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, digest, size, target = (batch.column(c)[i].as_py() for c in range(6))
                held.append(record(page, url, payload or b"", digest, size, target, date))
                total += len(held[-1])
                if total >= archive_bytes:
                    yield close()
                    total = 0
        if held:
            yield close()

    return written(rows.mapInArrow(run, "archive string, records long, raw_bytes long, stored_bytes long"), "manifest")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """The records of the archives in the manifest (column archive); see READ_SCHEMA. Digest and size of a response come from its payload."""

    def run(batches):
        names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = _stored(path)
                with fs.open_input_file(at) as f:
                    data = f.read()
                cols: list[list] = [[] for _ in names]
                for offset, rec in frames(data):
                    x = parse(rec)
                    body = x["payload"]
                    digest = hashlib.sha1(body).hexdigest() if body is not None else base64.b32decode(x["WARC-Payload-Digest"][5:]).hex()
                    size = len(body) if body is not None else int(x["X-Payload-Length"])
                    page, to = x.get("X-Page-Id"), x.get("X-Refers-To-Page-Id")
                    for c, value in zip(cols, (page and int(page), x.get("WARC-Target-URI"), size, digest, x["WARC-Type"], to and int(to), path, offset)):
                        c.append(value)
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    n = max(1, min(manifest.count(), 4 * spark.sparkContext.defaultParallelism))
    return manifest.select("archive").repartition(n, "archive").mapInArrow(run, READ_SCHEMA)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Archive all pages under the shared folder and read the archives back."""
    spark = pages.sparkSession
    return read(spark, write(pages, new_folder(spark, "warc"), **options))
