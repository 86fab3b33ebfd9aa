import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from txnlake.llm import toxicity_mil as T

BAD = ["zorch", "blarg", "snark"]


def corpus(n, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs, labels, marked = [], [], {}
    for d in range(n):
        sentences = [" ".join(rnd.choice(words) for _ in range(rnd.randint(3, 12))) for _ in range(rnd.randint(1, 12))]
        y = int(rnd.random() < 0.3)
        if y:
            at = rnd.randrange(len(sentences))
            sentences[at] += f" {rnd.choice(BAD).title()} {rnd.choice(words)}"
            marked[d] = sentences[at]
        docs.append((d, ". ".join(sentences) + "."))
        labels.append((d, y))
    return docs, labels, marked


def test_learns_and_locates(spark):
    docs, labels, marked = corpus(1200, 1)
    df, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    m = T.train(df, lab.where("doc_id < 800"))
    got = {r.doc_id: r for r in T.predict(df, m).collect()}
    truth = dict(labels)
    test = [d for d in truth if d >= 800]
    assert np.mean([got[d].predicted == truth[d] for d in test]) > 0.98
    text = dict(docs)
    hits = [[text[d][s.start : s.end].rstrip(".") for s in got[d].sentences] for d in test if truth[d]]
    assert np.mean([marked[d] in h for d, h in zip((d for d in test if truth[d]), hits)]) > 0.97
    clean = T.harmless(df, m)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {d for d in got if not got[d].predicted}


def test_scores_are_noisy_or():
    m = T.Model(-3.0, {f: 4.0 for f in T.features("bad")})
    texts = ["bad day.\nfine day. worse", "", "Bad! bad? ok", None]
    p, top = m.scores([T._tokens(t) for t in texts])
    s = lambda z: 1 / (1 + np.exp(-z))
    assert np.allclose(p, [1 - (1 - s(1)) * (1 - s(-3)) ** 2, 0, 1 - (1 - s(1)) ** 2 * (1 - s(-3)), 0])
    assert [(x["start"], x["end"]) for x in m.sentences(texts[0], 0.5)] == [(0, 8)]
    one, lines, blank = (m.scores([T._tokens(t)])[0][0] for t in ("ok. " * 20, "ok.\n" * 20, "\n\n" + "ok.\n\n--\n" * 20 + "\n" * 40))
    assert one == lines == blank


def plain_score(m, text):
    """Sentence by sentence, word by word."""
    quiet = 1.0
    for line in (text or "").lower().split("\n"):
        found = []
        for token in [*line.split(), "."]:
            found += T.features(token)
            if token[-1] in ".!?":
                if found:
                    quiet *= 1 - 1 / (1 + math.exp(-(m.bias + sum(m.weights.get(f, 0.0) for f in found))))
                found = []
    return 1 - quiet


def test_long_sentences_of_weighted_words(spark):
    """Sums of weights beyond any bound, of either sign, never change which words count."""
    m = T.Model(-3.0, {T.features("stupid")[0]: 15.25, T.features("kind")[0]: -9.5})
    texts = [f"{w} " * n + more for w in ("stupid", "kind", "stupid kind") for n in (1, 10, 33, 34, 60, 80, 120, 5000, 100_000) for more in ("", ". stupid day", "\nkind day!")]
    p, _ = m.scores([T._tokens(t) for t in texts])
    sigmoid = lambda z: 1 / (1 + math.exp(-z)) if z > -700 else 0.0

    def plain(text):
        quiet = 1.0
        for part in re.split(r"[.!?\n]", text):
            if found := [f for w in part.split() for f in T.features(w)]:
                quiet *= 1 - sigmoid(m.bias + sum(m.weights.get(f, 0.0) for f in found))
        return 1 - quiet

    assert np.allclose(p, [plain(t) for t in texts], rtol=0, atol=1e-9)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["stupid " * 34, "stupid " * 60, "stupid " * 120, "kind " * 60])], "doc_id long, text string")
    assert [r.doc_id for r in T.harmless(df, m).collect()] == [3]


def test_query_on_the_tables(spark):
    """Every score against plain Python, and held-out labels."""
    from txnlake.llm import queries

    at = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{at}/documents.parquet")
    labels = spark.read.parquet(f"{at}/labels.parquet").where("pmod(crc32(cast(cast(doc_id as string) as binary)), 5) <> 0")
    m = T.train(docs, labels)
    text = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in queries.op5_toxicity_mil(spark, at).collect()}
    assert set(got) == set(text)
    for d, r in got.items():
        assert abs(r.score - plain_score(m, text[d])) < 1e-6 and r.predicted == int(r.score >= 0.5) and r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{at}/labels.parquet").collect()}
    test = [d for d in truth if got[d].held_out]
    assert np.mean([got[d].predicted == truth[d] for d in test]) > 0.9


def test_edges(spark):
    df = spark.createDataFrame([(None, "x"), (1, None), (2, ""), (3, "w " * 200_000), (3, "x y")], "doc_id long, text string").withColumn("score", F.lit("s"))
    lab = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 7)], "doc_id long, toxic int")
    m = T.train(df, lab)
    assert m.weights == {}  # one class only
    got = T.predict(df, m, keep=(F.lit(True).alias("held"),)).collect()
    assert len(got) == 5 and all(r.score < 0.01 + (r.doc_id == 3) and r.held for r in got)
    assert T.predict(df.limit(0), m).count() == 0 and T.train(df, lab.limit(0)).weights == {}


def test_learns_from_the_end_of_long_texts(spark):
    """Offending sentences that stand after some 4,500 words."""
    docs, labels, _ = corpus(240, 2)
    rnd = random.Random(3)
    long = [(d, " ".join(". " * (i % 9 == 8) + f"w{rnd.randrange(400)}" for i in range(4500)) + ". " + t) for d, t in docs]
    df, lab = spark.createDataFrame(long, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    m = T.train(df, lab.where("doc_id < 160"))
    assert set().union(*(T.features(w)[:1] for w in BAD)) <= {f for f, w in m.weights.items() if w > 0}
    got = {r.doc_id: r.predicted for r in T.predict(df, m).collect()}
    assert np.mean([got[d] == y for d, y in labels if d >= 160]) > 0.95
