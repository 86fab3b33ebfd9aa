"""The pipeline against its stages in plain Python, and the registered queries."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import test_decontaminate as td
from tests.llm import test_line_dedup as tl
from tests.llm import test_trie as tt
from txnlake.llm import decontaminate, packing, toxicity_mil

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def representatives(docs):
    """The least id of each group connected by five-word shingle sets of Jaccard similarity 0.8 or more, over all pairs."""
    sets = [tt.shingles(t, 5) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i + 1, len(docs)):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [docs[i][0] for i in sorted({find(i) for i in range(len(docs))})]


def test_hostile_documents(spark, tmp_path):
    """All stages over nulls, empty and very long texts, repeated rows and clashing column names, and over an empty table."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(120_000))
    rows = [(1, None), (2, ""), (3, long), (4, long), (4, long), (None, "lone words stand here all by themselves"), (None, None), (7, "\n\n\n")]
    base = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("_d", "_t", "_id", "_key", "id", "key", "gone", "h1", "_leaks"):
        base = base.withColumn(name, F.lit(name))
    want = sorted([("3", long), ("None", None), ("None", rows[5][1])], key=str)
    for empty in (False, True):
        docs = base.limit(0) if empty else base
        for name, stage in corpus_pipeline.STAGES[:-1]:
            path = f"{tmp_path}/{name}-{empty}"
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
            assert docs.columns == base.columns and docs.where("_d <> '_d' OR key <> 'key'").count() == 0, name
        # the long line stays once, and texts without a word are one another's copies, of which the least id (null) stays
        assert sorted(((str(r.doc_id), r.text) for r in docs.collect()), key=str) == ([] if empty else want)
        tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("of")).collect()
        assert all(r.n >= r.of for r in tokens) and len(tokens) == len({r.doc_id for r in docs.collect()})


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    (tox, lines, near, clean, pack) = (f for _, f in corpus_pipeline.STAGES)
    kept = tox(spark, docs, SF).persist()
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("pmod(crc32(cast(cast(doc_id as string) as binary)), 5) <> 0")
    model = toxicity_mil.train(docs, labels)
    rows = {r.doc_id: r.text for r in docs.collect()}
    score = {d: model.scores([toxicity_mil._tokens(t)])[0][0] for d, t in rows.items()}
    rows = {d: t for d, t in rows.items() if score[d] < 0.5}
    assert {r.doc_id for r in kept.collect()} == set(rows) and kept.columns == docs.columns
    want = tl.brute(sorted(rows.items()))
    rows = {d: "\n".join(t.split("\n")[i] for i in want[d]) for d, t in rows.items()}
    cut = lines(spark, kept, SF).persist()
    assert {r.doc_id: r.text for r in cut.collect()} == rows and cut.columns == docs.columns and all(r.n_chars == len(r.text) for r in cut.collect())
    ids = sorted(rows)
    rows = {d: rows[d] for d in representatives([(d, rows[d]) for d in ids])}
    one = near(spark, cut, SF).persist()
    assert {r.doc_id: r.text for r in one.collect()} == rows and one.columns == docs.columns
    bench = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def leaks(text):
        w = decontaminate.words_of(text)
        have = set(w)
        return any(sum(x not in have for x in b) <= int(0.2 * len(b)) and td.distance(b, w) <= int(0.2 * len(b) + 1e-9) for b in bench)

    rows = {d: t for d, t in rows.items() if not leaks(t)}
    fine = clean(spark, one, SF).persist()
    assert {r.doc_id: r.text for r in fine.collect()} == rows and fine.columns == docs.columns
    tok = packing.ids_of(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    n = {d: len(tok.encode(t)) // 4 + 1 for d, t in rows.items()}
    pieces = pack(spark, fine, SF).collect()
    got = Counter()
    for p in pieces:
        got[p.doc_id] += p.length
        assert p.doc_tokens == n[p.doc_id]
    assert got == n
    cuts = lambda rows: sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in rows)
    assert cuts(corpus_pipeline.run(spark, SF).collect()) == cuts(pieces)


def test_queries_are_registered(spark):
    import __spark_entry__ as e

    q = e.queries()
    assert "pipeline" in q and {f"op{n}_" for n in range(1, 11)} <= {k.split("_")[0] + "_" for k in q}
