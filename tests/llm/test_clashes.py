"""Columns whose names are those that the operators use inside change nothing."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from txnlake.llm import decontaminate, maxscore, multi_index, packing, ppm_langid, sharding, warc

NAMES = ["id", "d", "t", "g", "h", "h1", "h2", "n", "v", "key", "size", "slot", "shard", "score", "rank", "length", "at", "part", "cell", "digest", "payload", "record_type", "refers_to", "words", "offset", "text_crc32", "doc_tokens", "sequence_id", "query_id", "lang_pred", "_id", "_text"]


def hostile(df):
    return df.withColumns({n: F.lit(f"x{i}") for i, n in enumerate(NAMES) if n not in df.columns})


def listed(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(1)
    words = [f"{a}{b}" for a in ("ba", "ko", "li", "mu") for b in ("ten", "ster", "ung", "ion")]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 40))) for _ in range(60)]
    rows = [(i, t, ["de", "en"][i % 2]) for i, t in enumerate([*texts, *texts[:9], None, "", "wort " * 60_000])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_packing(docs):
    run = lambda df: packing.pack(df, public_tokenizers.path("byte_bpe_50k.json"))
    assert listed(run(hostile(docs))) == listed(run(docs))


def test_language(docs):
    run = lambda df: ppm_langid.predict(df, ppm_langid.train(df)).select("doc_id", "lang_pred", "score")
    assert listed(run(hostile(docs))) == listed(run(docs))


def test_sharding(docs):
    """And texts of many bytes, of which many rows are copies."""
    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]
    long = docs.unionByName(docs.where("doc_id = 71").withColumn("doc_id", F.explode(F.sequence(F.lit(100), F.lit(120)))))
    a, b = (sharding.shard(df).select(*columns) for df in (hostile(long), long))
    assert listed(a) == listed(b) and b.where("size = 300001").count() == 22
    counts = [r["count"] for r in b.groupBy("shard").count().collect()]
    assert max(counts) - min(counts) <= 1


def test_archive(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<p>{i % 7}</p>" * 200) for i in range(40)] + [(50, None, None)], "page_id long, url string, html string")
    columns = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert listed(warc.round_trip(hostile(pages)).select(*columns)) == listed(warc.round_trip(pages).select(*columns))


def test_vectors(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(150)], "vec_id long, embedding array<float>")
    for search in (maxscore.top_k, multi_index.search):
        assert listed(search(hostile(df), F.col("vec_id") % 50 == 0)) == listed(search(df, F.col("vec_id") % 50 == 0))


def test_benchmarks_of_several_blocks_with_long_texts(spark):
    """Items in more than one block, long ones among them, are found in the middle of long texts."""
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([12, 40, 300])))) for i in range(90)]
    rows = [(d, " ".join(rnd.choice(words) for _ in range(3000)) + " " + items[d][1] + " " + " ".join(rnd.choice(words) for _ in range(500))) for d in range(0, 90, 3)]
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block=40).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(d, d) for d in range(0, 90, 3)} and all(r.distance == 0 for r in got if r.doc_id == r.item_id)
