import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from txnlake.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text):
            s, d = m.group(), re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in s.split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), k + 1, m.end(), kind))
    return sorted(out)


TEXTS = [
    "a@b.c-d_e@f.gg", "a@b.cd@e.fg x+1@y.z.", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 5 -3", "+1 (222) 333-4444) +49.30-1234567. +1",
    "😀 jé a@b.co 😀", "9" * 3000 + " " + "1 " * 4000, "a" * 5000 + "@", None, "", "+12345678 +1234567890123456", "x@y", "a@b.cc" * 40,
]


def test_base_spans_and_edges(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").withColumn("base", F.lit(1))
    got = {r.doc_id: [tuple(s) for s in r.base] for r in pii.find(df).collect()}
    assert got == {i: plain(t or "") for i, t in enumerate(TEXTS)}


def test_base_against_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in d.collect()}
    for r in pii.find(d).collect():
        assert [tuple(s) for s in r.base] == plain(texts[r.doc_id] or "")


def test_added_spans(spark):
    texts = ["tel: (555) 123-4567, call 555-123-4567.", "joe (at) mail [dot] com", "id 555-123-4567x", "mail a@b.com, ip 1.2.3.4, phone +1 555 123 4567"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.added] for r in pii.find(df).collect()}
    assert got == {0: ["(555) 123-4567", "555-123-4567"], 1: ["joe (at) mail [dot] com"], 2: [], 3: []}


def test_added_spans_of_a_labelled_corpus(spark):
    """Precision and recall of what the method adds, among look-alikes that are no personal data."""
    rnd = random.Random(5)
    digits = lambda n: "".join(rnd.choices("123456789", k=n))

    def card():
        while not luhn(d := "4" + digits(15)):
            pass
        return ".".join(d[i : i + 4] for i in range(0, 16, 4))

    docs, good = [], set()
    for i in range(1500):
        kind, yes = rnd.randrange(4), rnd.random() < 0.6
        octets = ".".join(str(rnd.randrange(1, 223)) for _ in range(4))
        base = [f"mail {digits(3)}x@mail.com", f"host {octets}", f"call +1 555 {digits(3)} {digits(4)}", ""][rnd.randrange(4)]
        if yes:
            s = [f"jo{i} [at] mail [dot] com", octets.replace(".", "[.]"), card(), f"({digits(3)}) {digits(3)}-{digits(4)}"][kind]
            text = f"{base}, {['contact', 'host', 'card', 'phone'][kind]} {s} ."
        else:
            s = [f"look [at] this [dot] {'x' * 12}", f"0[.]0[.]{i % 200}[.]1", f"{digits(4)}.{digits(4)}.{digits(4)}.{digits(3)}", f"{digits(3)}.{digits(3)}.{digits(4)}"][kind]
            text = f"{base}, {['item', 'version', 'order', 'invoice'][kind]} {s}=x"
        docs.append((i, text))
        if yes:
            good.add((i, text.index(s), text.index(s) + len(s)))
    got = {(r.doc_id, s.start, s.end) for r in pii.find(spark.createDataFrame(docs, "doc_id int, text string")).collect() for s in r.added}
    assert len(got & good) >= 0.9 * len(good) and len(got & good) >= 0.95 * len(got), (len(got), len(good), len(got & good))


def test_many_spans_in_one_text(spark):
    """A hundred thousand addresses in a text, in seconds and at their places."""
    text = " ".join(f"a{i}@b.cc" for i in range(100_000))
    start = time.time()
    row = pii.find(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert [(s.start, s.end) for s in row.base] == [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
    assert time.time() - start < 90


def test_many_loose_beside_many_base_spans(spark):
    """Loose spans that meet a base one go, the others stay, in time that grows with their number."""
    text = " ".join(f"a{i}@b.cc 4012.8888.8888.1881 x +1 (555) 123-4567" for i in range(30_000))
    start = time.time()
    row = pii.candidates(spark.createDataFrame([(1, text)], "doc_id int, text string"), "doc_id", "text").first()
    taken = [(s.start, s.end) for s in row.base]
    assert len(taken) == 60_000 and len(row.loose) == 30_000 and time.time() - start < 60
    marked = bytearray(len(text))
    for s, e in taken:
        marked[s:e] = b"1" * (e - s)
    assert not any(any(marked[s.start : s.end]) for s in row.loose)
    # beside each other at every distance from a stretch's ends
    near = [("y" * i + " +1 (555) 123-4567 a@b.cc (555) 123-4567 4012.8888.8888.1881 z@d.ee " + "w" * (150 - i) + " (555) 123-4567") for i in range(140)]
    got = pii.candidates(spark.createDataFrame(list(enumerate(near)), "doc_id int, text string"), "doc_id", "text").collect()
    assert all([(near[r.doc_id][s.start : s.end]) for s in sorted(r.loose)] == ["(555) 123-4567", "4012.8888.8888.1881", "(555) 123-4567"] and len(r.base) == 3 for r in got) and len(got) == 140


def test_empty_and_nulls(spark):
    df = spark.createDataFrame([(None, "a@b.cc"), (None, "a@b.cc")], "doc_id int, text string")
    assert [len(r.base) for r in pii.find(df).collect()] == [1, 1]
    assert pii.find(df.limit(0)).count() == 0
    row = pii.find(df).select(F.sha2(pii.joined(F.col("base")), 256)).first()
    assert row[0] == hashlib.sha256(b"email:0:6").hexdigest()


def test_reliabilities():
    """A labeler that errs half the time ends up less trusted than one that agrees with the others."""
    patterns = [((1, 1, 1), 40), ((1, 1, -1), 40), ((-1, -1, 1), 20), ((-1, -1, -1), 20)]
    prior, tables, post = pii.reliabilities(patterns)
    assert 0.55 < prior < 0.8 and post[1, 1, -1] > 0.9 > 0.1 > post[-1, -1, 1]
    assert tables[0][1, 1] > tables[2][1, 1]
