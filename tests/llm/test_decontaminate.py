import random

import numpy as np
from pyspark.sql import functions as F

from txnlake.llm import decontaminate as D


def items(n=40, seed=3):
    rnd = random.Random(seed)
    return [(i, " ".join(rnd.choice("abcdefghij") * rnd.randint(1, 3) + rnd.choice("klmno") for _ in range(rnd.randint(12, 60)))) for i in range(n)]


def distance(item, words):
    """The least edits of item to any stretch of words."""
    prev = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        row = [i]
        for j, y in enumerate(words, 1):
            row.append(min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = row
    return min(prev)


def test_best_stretch_is_exact():
    rnd = random.Random(1)
    for _ in range(200):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randint(1, 12))] for _ in range(2))
        d, s, e = D.best_stretch(a, b)
        assert d == distance(a, b)
        got = [[*range(e - s + 1)]]
        for i, x in enumerate(a, 1):
            got.append([i])
            for j, y in enumerate(b[s:e], 1):
                got[i].append(min(got[i - 1][j] + 1, got[i][j - 1] + 1, got[i - 1][j - 1] + (x != y)))
        assert got[-1][-1] == d


def test_recall_and_precision():
    bench, rnd = items(), random.Random(7)
    index = D.Index(bench, 0.8, 0.95, 5, 24)
    assert index.reached >= 0.95
    docs, truth = [], []
    for n in range(300):
        i, t = rnd.choice(bench)
        w = t.split()
        for _ in range(rnd.randint(0, int(0.2 * len(w)))):
            at, kind = rnd.randrange(len(w)), rnd.randrange(3)
            w[at : at + (kind != 0)] = ["zz"] if kind != 1 else []
        noise = [f"n{rnd.randrange(999)}" for _ in range(200)]
        at = rnd.randrange(200)
        docs.append(" ".join(noise[:at] + w + noise[at:]))
        truth.append(i)
    found = index.search(docs)
    assert np.mean([any(x[0] == i for x in f) for f, i in zip(found, truth)]) >= 0.95
    by = dict(bench)
    for f, text in zip(found, docs):
        for i, d, s, e in f:
            assert d == distance(by[i].split(), text.split()) <= 0.2 * len(by[i].split()) and d >= 0 and text[s:e]
    assert not any(index.search([" ".join(f"n{rnd.randrange(99)}" for _ in range(400)) for _ in range(50)]))


def test_leaks_against_brute_force(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    b = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.distance for r in D.leaks(d, b).collect()}
    bench = [(r.item_id, D.words_of(r.text)) for r in b.collect()]
    want = {}
    for r in d.collect():
        words = D.words_of(r.text)
        have = set(words)
        for i, w in bench:
            k = int(0.2 * len(w) + 1e-9)
            if sum(x not in have for x in w) <= k and (n := distance(w, words)) <= k:
                want[r.doc_id, i] = n
    assert got == want and want
    gone = {k for k, _ in want}
    kept = D.clean(d, b)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in d.collect()} - gone


def test_edges(spark):
    b = spark.createDataFrame([(1, "one two three four five six"), (None, "uno dos tres cuatro cinco seis"), (3, None), (4, "too short"), (1, "one two three four five six")], "item_id long, text string")
    d = spark.createDataFrame([(1, None), (2, ""), (None, "x One, two; three four five six y"), (3, "uno dos tres cuatro cinco seis"), (3, "uno dos tres cuatro cinco seis"), (4, "w " * 100_000)], "doc_id long, text string").withColumn("item_id", F.lit(0))
    got = sorted((str(r.doc_id), str(r.item_id), r.distance) for r in D.leaks(d, b).collect())
    assert got == [("3", "None", 0), ("3", "None", 0), ("None", "1", 0), ("None", "1", 0)]
    assert D.leaks(d.limit(0), b).count() == 0 and D.leaks(d, b.limit(0)).count() == 0 and D.clean(d, b.limit(0)).count() == 6
    two = sorted((str(r.doc_id), str(r.item_id)) for r in D.leaks(d, b, block=2).collect())
    assert two == [g[:2] for g in got]


def ends_edited(words, kind, rnd):
    """A copy with a fifth of the words missing or replaced at one end."""
    k = int(0.2 * len(words) + 1e-9)
    new = [f"q{rnd.randrange(999)}" for _ in range(k)]
    return {"cut": words[k:], "head": new + words[k:], "tail": words[: len(words) - k] + new}[kind]


def test_long_items_and_edits_at_one_end():
    """Items of any length, with all edits at one end, inside a text and where a document opens with them."""
    rnd = random.Random(5)
    vocab = [f"v{i}" for i in range(2000)]
    for n in (15, 30, 59, 83, 150, 500):
        bench = [(i, " ".join(rnd.choice(vocab) for _ in range(n))) for i in range(20)]
        index = D.Index(bench, 0.8, 0.95, 5, 24)
        assert index.reached >= 0.95
        for kind in ("cut", "head", "tail"):
            docs = [" ".join([*([f"n{rnd.randrange(999)}" for _ in range(70)] if inside else []), *ends_edited(t.split(), kind, rnd), *(f"n{rnd.randrange(999)}" for _ in range(70))]) for _, t in bench for inside in (0, 1)]
            found = index.search(docs)
            assert np.mean([[x[0] for x in f] == [i // 2] for i, f in enumerate(found)]) >= 0.95, (n, kind)


def test_items_of_all_lengths_together():
    rnd = random.Random(6)
    vocab = [f"v{i}" for i in range(500)]
    bench = [(n, " ".join(rnd.choice(vocab) for _ in range(n))) for n in (5, 6, 15, 66, 83, 103, 150, 500, 1500)]
    index = D.Index(bench, 0.8, 0.95, 5, 24)
    assert [[x[:2] for x in f] for f in index.search([t for _, t in bench])] == [[(n, 0)] for n, _ in bench]


def test_whole_classes_are_exact():
    """Where walks don't reach the recall, every window that can match is verified."""
    bench, rnd = items(25, 9), random.Random(8)
    index = D.Index(bench, 0.8, 2.0, 5, 1)
    assert all(c.whole for c in index.classes)
    docs, want = [], []
    for n in range(60):
        w = rnd.choice(bench)[1].split()
        for _ in range(rnd.randint(0, int(0.3 * len(w)))):
            at, kind = rnd.randrange(len(w)), rnd.randrange(3)
            w[at : at + (kind != 0)] = ["zz"] if kind != 1 else []
        noise = [f"n{rnd.randrange(99)}" for _ in range(60)]
        at = rnd.randrange(60)
        docs.append(noise[:at] + w + noise[at:])
        want.append({i: k for i, t in bench if (k := distance(t.split(), docs[-1])) <= int(0.2 * len(t.split()) + 1e-9)})
    assert [{i: k for i, k, _, _ in f} for f in index.search([" ".join(d) for d in docs])] == want and any(want)


def test_scripts_without_spaces_and_places():
    """Characters count as words where there are no spaces; places hold where lower-casing changes lengths."""
    index = D.Index([(1, "这是一个用来检查模型能力的问题"), (2, "one two three four five six")], 0.8, 0.95, 5, 24)
    texts = ["前面有些文字这是一个用来检查模型能力的问题后面也有", "İİ One two three four five six", "今天天气很好我们去公园玩吧"]
    found = index.search(texts)
    assert [[x[:2] for x in f] for f in found] == [[(1, 0)], [(2, 0)], []]
    assert [t[f[0][2] : f[0][3]] for t, f in zip(texts, found) if f] == ["这是一个用来检查模型能力的问题", "One two three four five six"]
