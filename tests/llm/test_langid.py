import math
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from txnlake.llm import ppm_langid as P


def test_code_lengths_and_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    m = P.train(d.where(~held))
    rows = d.collect()
    trees = {x: [defaultdict(lambda: defaultdict(int)) for _ in range(4)] for x in m.langs}
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            b = b"\n\n\n" + r.text.encode()
            for i in range(3, len(b)):
                for k in range(4):
                    trees[r.lang][k][b[i - k : i]][b[i]] += 1

    def bits(lang, text):
        b, total = b"\n\n\n" + text, 0.0
        for i in range(3, len(b)):
            known: set = set()
            for k in (3, 2, 1, 0):
                live = {s: n for s, n in trees[lang][k].get(b[i - k : i], {}).items() if s not in known}
                if not live:
                    continue
                n = sum(live.values()) + len(live)
                if b[i] in live:
                    total -= math.log2(live[b[i]] / n)
                    break
                total -= math.log2(len(live) / n)
                known |= live.keys()
            else:
                total += math.log2(256 - len(known))
        return total

    tests = [r.text.encode()[:200] for r in rows[:8]] + ["Ω≈ç√∫ unseen".encode(), b"", b"\n\n\n\n"]
    for t, got in zip(tests, m.lengths(tests)):
        assert list(got) == pytest.approx([bits(x, t) for x in m.langs], rel=1e-4, abs=1e-3)
    lang = {r.doc_id: r.lang for r in rows}
    out = P.predict(d, m, keep=(held.alias("held"),)).collect()
    own = [r for r in out if r.held and r.lang_pred != "und"]
    assert len(out) == len(rows) and sum(r.lang_pred == lang[r.doc_id] for r in own) / len(own) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_edges(spark):
    df = spark.createDataFrame([(None, "hello there", "en", "q"), (1, None, "en", "z"), (2, "", None, "z"), (3, "12 3", "en", "q"), (4, "b " * 100_000, "fr", "q"), (4, "é", "fr", "q")], "doc_id long, text string, lang string, score string")
    m = P.train(df)
    got = [(r.doc_id, r.lang_pred) for r in P.predict(df, m).collect()]
    assert got == [(None, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "fr"), (4, "fr")]
    none = P.train(df.limit(0))
    assert {r.lang_pred for r in P.predict(df, none).collect()} == {"und"} and P.predict(df.limit(0), m).count() == 0


def test_bounded_model(spark):
    df = spark.createDataFrame([("the quick brown fox", "en"), ("le renard brun", "fr")], "text string, lang string")
    small = P.train(df, max_contexts=5)
    assert small.bits.shape[0] == (small.s**2 + 5) * small.s
    with pytest.raises(ValueError, match="languages"):
        P.train(df, max_languages=1)


def test_contexts_left_out_keep_their_shorter_orders(spark):
    """A small language beside a dominant one: rare contexts still count in orders 0 to 2, and some full ones are its own."""
    big = [("abcdefghij" * 50 + "jihgfedcba" * 50, "en")] * 20
    df = spark.createDataFrame([*big, ("ωψχφυτσ", "el")], "text string, lang string")
    whole, small = P.train(df), P.train(df, max_contexts=8)
    s = whole.s
    assert small.s == s and len(small.bits) == (s * s + 8) * s
    # tables of orders up to 2 are those of the model that leaves nothing out
    assert small.bits[: s**3].ravel() == pytest.approx(whole.bits[: s**3].ravel())
    greek = {int(x) for x in whole.symbol[sorted({*"ωψχφυτσ".encode()})]}
    kept = (small.index >= s * s).nonzero()[0]
    assert sum(int(x) % s in greek for x in kept) >= 3  # and the start of its text
    assert [r.lang_pred for r in P.predict(spark.createDataFrame([(1, "ωψχφ τσ")], "doc_id long, text string"), small).collect()] == ["el"]
