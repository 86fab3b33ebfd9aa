import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from txnlake.llm import simhash_trie as S
from txnlake.llm.components import components


def shingles(text, k):
    """The set of a text's shingles; of fewer words the whole sequence, of none one that all such texts share."""
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}


def fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def roots(values, budget=3):
    v, parent = np.array(values, np.uint64), list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= budget):
            a, b = sorted((find(i), find(int(j))))
            parent[b] = a
    return [find(i) for i in range(len(v))]


@pytest.mark.parametrize(("budget", "max_node"), [(3, 2048), (3, 20), (1, 2048), (0, 2048), (7, 50)])
def test_links(spark, budget, max_node):
    rnd = random.Random(1)
    base = [rnd.getrandbits(64) for _ in range(120)]
    f = {0, 2**64 - 1, *base}
    for b in base[:15]:
        for _ in range(60):
            x = b
            for _ in range(rnd.randint(1, budget + 2)):
                x ^= 1 << rnd.randrange(64)
            f.add(x)
    f = sorted(f)
    df = spark.createDataFrame([(x - (1 << 64) * (x >> 63),) for x in f], "fp long")
    root = {r.node % 2**64: r.root % 2**64 for r in components(S.links(df, budget, max_node), "a", "b").collect()}
    got, want = defaultdict(set), defaultdict(set)
    for x, r in zip(f, roots(f, budget)):
        want[r].add(x)
        got[root.get(x, x)].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in d.collect())
    fp = [fingerprint(t) for _, t in rows]
    want = {d: rows[r][0] for (d, _), r in zip(rows, roots(fp))}
    got = S.near_duplicates(d).collect()
    assert {r.doc_id: r.component for r in got} == want
    assert {r.doc_id: r.fp % 2**64 for r in got} == {d: f for (d, _), f in zip(rows, fp)}
    kept = S.representatives(d)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert S.representatives(d, small=0).count() == len(set(want.values()))


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(70_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a b"), (7, long), (7, long), (None, long + " x"), (8, "É É É")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit(1), "key": F.lit(2)})
    got = S.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.fp % 2**64) for r in got) == sorted((str(d), fingerprint(t)) for d, t in rows)
    comp = {r.doc_id: r.component for r in got}
    assert comp[1] == comp[2] == comp[3] == 1 and comp[4] == comp[5] == 4 and comp[7] == comp[None] == 7
    assert S.near_duplicates(df.limit(0)).count() == 0
    assert sorted(str(r.doc_id) for r in S.representatives(df).collect()) == ["1", "4", "6", "8", "None"]


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 200), (300, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "x long, y long"), "x", "y").collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def test_unlike_finds_what_three_bits_miss(spark):
    """Near copies with a five-word shingle similarity of 0.8 or more go, whatever their fingerprints; others stay."""
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    docs = []
    for d in range(60):
        w = [rnd.choice(words) for _ in range((100, 200, 1000)[d % 3])]
        docs.append((d, " ".join(w)))
        for i in rnd.sample(range(0, len(w), 11), (2, 4, 10)[d % 3]):
            w[i] = "zz"
        docs.append((1000 + d, " ".join(w)))
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for d, t in docs}
    near = {1000 + d for d in range(60) if len(sets[d] & sets[1000 + d]) >= 0.8 * len(sets[d] | sets[1000 + d])}
    assert len(near) > 40
    rows = [*docs, (2000, None), (2001, ""), (2002, docs[0][1]), (2002, docs[0][1]), (None, "lone words here"), (None, "lone words here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = S.unlike(df)
    assert kept.columns == df.columns
    want = [d for d, _ in docs if d not in near]
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted([-1, *want, 2000])
    left = sum(r.doc_id in near for r in S.representatives(df).collect())
    assert left > len(near) // 3
    assert S.unlike(df.limit(0)).count() == 0


def test_nodes_are_opened_until_small(spark):
    """A cluster alike in its first bits, far greater than a node may be: no unit stays too great, and no link is lost."""
    rnd = random.Random(2)
    f = {rnd.getrandbits(22) | 0xABCDE << 44 for _ in range(3000)} | {rnd.getrandbits(64) for _ in range(200)}
    f = sorted(f)
    df = spark.createDataFrame([(x - (1 << 64) * (x >> 63),) for x in f], "fp long")
    units = S.units_of(df, 3, 100, 6)
    assert units.groupBy("trie", "depth", "s", "t").count().where("count > 100 and depth < 64").count() == 0
    assert units.select("depth").distinct().count() > 2
    root = {r.node % 2**64: r.root % 2**64 for r in components(S.links(df, 3, 100), "a", "b").collect()}
    got, want = defaultdict(set), defaultdict(set)
    for x, r in zip(f, roots(f)):
        want[r].add(x)
        got[root.get(x, x)].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_names_that_clash(spark):
    df = spark.createDataFrame([(1, "one two three four five six"), (2, "one two three four five six"), (3, "x")], "doc_id long, text string")
    for name in ("_id", "_key", "id", "key", "fp", "bands"):
        df = df.withColumn(name, F.lit(name))
    for f in (S.representatives, S.unlike):
        out = f(df)
        assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]
        assert {r["_id"] + r["key"] for r in out.collect()} == {"_idkey"}
        assert f(df, small=0).count() == 2
