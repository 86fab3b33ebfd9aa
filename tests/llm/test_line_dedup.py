import random

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from txnlake.llm import line_dedup as L


SPACELESS = regex.compile(r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])")


def norm(s):
    low = s.lower()
    low = SPACELESS.sub(r" \1 ", low) if len(low.encode()) >= 2 * len(low) else low
    return regex.sub(r"[^\p{L}\p{N}]+", " ", low).strip(" ")


def simhash(n):
    """(fingerprint, numbers of words in the blocks): bit by bit."""
    h = [xxhash.xxh64_intdigest(b"0" if w < ":" else w.encode(), 42) for w in n.split(" ")]
    of = [(x >> 48) * 5 >> 16 for x in h]
    m = [of.count(b) for b in range(5)]
    return sum((2 * sum(x >> b & 1 for x, o in zip(h, of) if o == b // 12) > m[b // 12]) << b for b in range(60)), m


def keys(n):
    """The pairs of blocks that hold enough of the line's words, with their bits and numbers of words."""
    fp, m = simhash(n)
    block = [(fp >> 12 * b & 4095, min(m[b], 4095)) for b in range(5)]
    pairs = [(i, j) for i in range(5) for j in range(i + 1, 5)]
    return fp, {(i, j, block[i], block[j]) for i, j in pairs if m[i] + m[j] >= 3 and 4 * (m[i] + m[j]) >= len(n.split())}


def within(a, b, k):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = row
    return prev[-1] <= k


def similar(a, b):
    a, b = a.split(), b.split()
    return within(a, b, int(0.2 * max(len(a), len(b)) + 1e-9))


def brute(rows, candidate=None):
    """The lines kept of each document; candidate: whether two lines may be linked, by default as the operator defines it."""
    first, lines = {}, []
    for doc, text in rows:
        t = xxhash.xxh64_intdigest((text or "").encode(), 42)
        t -= (1 << 64) * (t >> 63)
        for i, line in enumerate((text or "").split("\n")):
            n = norm(line)
            lines.append(((doc, t, i), n))
            if len(n.split()) >= 5:
                first[n] = min(first.get(n, (doc, t, i)), (doc, t, i))
    names = list(first)
    known, parent = [keys(n) for n in names], list(range(len(names)))

    def alike(i, j):
        return known[i][1] & known[j][1] and (known[i][0] ^ known[j][0]).bit_count() <= 14

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(names)):
        for j in range(i + 1, len(names)):
            if (candidate or alike)(i, j) and similar(names[i], names[j]):
                a, b = sorted((find(i), find(j)), key=lambda x: first[names[x]])
                parent[b] = a
    stay = {first[names[find(i)]] for i in range(len(names))}
    out = {}
    for at, n in lines:
        out.setdefault(at[0], [])
        if len(n.split()) < 5 or at in stay:
            out[at[0]].append(at[2])
    return out


def planted():
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    base = [[rnd.choice(words) for _ in range(rnd.choice([6, 30, 60, 127, 128, 300]))] for _ in range(25)]
    docs = []
    for d in range(60):
        lines = []
        for _ in range(4):
            w = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 2])):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            lines.append(rnd.choice([" ".join(w), " ".join(w).upper() + "!", rnd.choice(["", "a b", "-- --"])]))
        docs.append((d, "\n".join(lines)))
    return docs


def test_planted_lines(spark):
    docs = planted()
    got = {r.doc_id: list(r.kept) for r in L.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs)


@pytest.mark.parametrize(("words", "changes", "least"), [(8, 1, 0.7), (12, 1, 0.9), (20, 1, 0.97), (50, 1, 0.97), (30, 2, 0.75), (50, 2, 0.75)])
def test_recall(spark, words, changes, least):
    """Of lines with words replaced, that many are found against edit similarity alone."""
    rnd = random.Random(words)
    vocabulary = [f"w{''.join(rnd.choices('abcdefghij', k=6))}" for _ in range(3000)]
    rows = []
    for i in range(200):
        line = [rnd.choice(vocabulary) for _ in range(words)]
        other = list(line)
        for at in rnd.sample(range(words), changes):
            other[at] = rnd.choice(vocabulary)
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(other))]
    kept = {r.doc_id: len(r.kept) for r in L.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = sum(not kept[2 * i + 1] for i in range(200)) / 200
    assert all(kept[2 * i] for i in range(200)) and found >= least, found


def test_digits_and_scripts(spark):
    """Lines that differ in numbers alone, and lines of scripts without spaces."""
    rows = [(0, "on 12 May 2021 we sold 7 units"), (1, "on 3 May 1999 we sold 12345 units"), (2, "on 3 May 1999 we sold 12346 units"), (3, "这是一个很长的句子没有空格"), (4, "这是一个很长的句子没有空白"), (5, "今天天气很好我们去公园玩")]
    assert {r.doc_id: list(r.kept) for r in L.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == brute(rows) == {0: [0], 1: [0], 2: [], 3: [0], 4: [], 5: [0]}


def test_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    want = brute(rows)
    assert {r.doc_id: list(r.kept) for r in L.report(d).collect()} == want
    texts = dict(rows)
    for r in L.deduplicated(d).collect():
        assert r.text == "\n".join(texts[r.doc_id].split("\n")[i] for i in want[r.doc_id])


def test_edges(spark):
    w300 = "w " * 300
    rows = [(None, "a b c d e f"), (1, None), (2, ""), (3, f"A b, c d e f!\nz\n{w300}"), (3, f"A b, c d e f!\nz\n{w300}"), (4, w300), (5, "x " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("d", "t", "gone", "_d", "_t", "_kept", "first", "line"):
        df = df.withColumn(name, F.lit(name))
    got = sorted((str(r.doc_id), r.n_lines, list(r.kept)) for r in L.report(df).collect())
    assert got == [("1", 1, [0]), ("2", 1, [0]), ("3", 3, [1, 2]), ("3", 3, [1, 2]), ("4", 1, []), ("5", 1, [0]), ("None", 1, [0])]
    assert L.report(df.limit(0)).count() == 0
    out = L.deduplicated(df).collect()
    assert all(r[name] == name for r in out for name in ("d", "t", "gone", "_d", "_t", "_kept", "first", "line"))
    texts = {(r.doc_id, r.text) for r in out}
    assert (1, None) in texts and (2, "") in texts and (4, "") in texts and L.deduplicated(df).columns == df.columns
    named = df.select(F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("name"), "text")
    assert sorted((str(r.name), list(r.kept)) for r in L.report(named, "name").collect()) == [("None", [0]), ("doc 1", [0]), ("doc 2", [0]), ("doc 3", [1, 2]), ("doc 3", [1, 2]), ("doc 4", []), ("doc 5", [0])]


def test_long_blocks(spark):
    """A line of more words than a block's counter holds, with one word changed, beside many variants of one line."""
    rnd = random.Random(3)
    words = [f"v{rnd.randrange(500)}" for _ in range(30_000)]
    rows = [(0, " ".join(words)), (1, " ".join(["other", *words[1:]]))]
    base = [f"b{i}" for i in range(12)]
    rows += [(10 + i, " ".join([*base[:6], f"x{chr(97 + i % 26)}{chr(97 + i // 26)}", *base[7:]])) for i in range(300)]
    kept = {r.doc_id: list(r.kept) for r in L.report(spark.createDataFrame(rows, "doc_id long, text string"), small=20).collect()}
    assert kept[0] == [0] and kept[1] == [] and kept[10] == [0] and not any(kept[10 + i] for i in range(1, 300))


def test_bags_apart(spark):
    """The codes of two counts differ in as many bits as the counts do modulo 16, and short lines and chunks meet at CHUNK words."""
    rows = spark.range(256).selectExpr("id", "shiftleft(id, 56) | shiftleft(id, 8) | id AS c").selectExpr("id", f"{L._johnson('c')} AS code").collect()
    for a in rows:
        for b in rows:
            assert ((a.code ^ b.code) % 2**64).bit_count() == 3 * min((a.id - b.id) % 16, (b.id - a.id) % 16)
    assert L.CHUNK % L.STRIDE == 0 and L.CHUNK <= 127
    # beyond 8000 bytes the JVM never compiles a method: the pair joins' condition stays far below
    assert len(L._bags_apart("a.", "b.")) < 100
