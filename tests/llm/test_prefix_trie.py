import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from txnlake.llm import prefix_trie, queries

KIND = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    """The nodes as tuples, in plain Python."""
    original = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            original[c].append(((turn is not None, turn or 0, digest(role, text)), role, text))
    original = {c: [(r, t) for _, r, t in sorted(v)] for c, v in original.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        turns = original.get(c - c % 5, [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    n_children, n_leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            n_children[node[:-1]] += 1
    for node, convs in members.items():
        value = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += value
            n_leaves[node[:d]] += node not in n_children
    out = []
    for node, convs in members.items():
        sha = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), n_children[node], n_leaves[node], saved[node], sha))
    return sorted(out, key=str)


def found(spark, rows, block=prefix_trie.BLOCK):
    df = spark.createDataFrame(rows, KIND).withColumns({"conv": F.lit("x"), "pos": F.lit(1), "k1": F.lit(2), "depth": F.lit(3)})
    out = prefix_trie.trie(*prefix_trie.rebuilt(*prefix_trie.numbered(df)), block=block)
    return sorted((tuple(r) for r in out.select(*NAMES).collect()), key=str), out


def random_rows(n, seed, words=3, most=14):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(["é", "bb", "ccc"][:words])) for c in range(n) for t in range(rnd.randrange(1, most))]


@pytest.mark.parametrize("block", [2, prefix_trie.BLOCK])
def test_against_brute_force(spark, block):
    rows = random_rows(120, 1)
    assert found(spark, rows, block)[0] == brute(rows)


def test_hot_turns_copies_and_long_conversations(spark):
    """A first turn that a third share, many equal conversations, one very long conversation."""
    rows = [(c, 0, "user", "hello") for c in range(0, 300, 3)]
    rows += [(1000 + c, t, "user", "same") for c in range(150) for t in range(12)]
    rows += [(5, t, "user", f"{t // 2}") for t in range(700)] + [(7, t, "user", f"{t // 2}") for t in range(500)]
    rows += random_rows(30, 2)
    assert found(spark, rows, 64)[0] == brute(rows)


def test_hostile_rows(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (1, None, None, None), (1, 2, "u", None), (2, 0, "ab", "c"), (3, 0, "a", "bc"), (None, 0, "u", "x"), (-4, 1, "u", "z"), (-5, 0, "u", "y"), (-(2**63), 0, "u", "q"), (2**63 - 1, 5, "u", "x" * 100_000), (11, None, "", ""), (10, 0, "u", "a"), (12, 0, "u", "w")]
    assert found(spark, rows)[0] == brute(rows)
    assert found(spark, [])[0] == []
    lone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    assert found(spark, [(lone, 0, "u", "a")])[0] == brute([(lone, 0, "u", "a")])  # turnless: a root alone
    assert found(spark, [(0, 0, "u", "a")])[0] == brute([(0, 0, "u", "a")])


def test_paths_and_levels(spark):
    """Every path is an unbroken array of nodes from its top to a childless node, and a level halves the members at least."""
    _, out = found(spark, random_rows(200, 3, words=2))
    paths = defaultdict(list)
    for r in out.collect():
        paths[r.path].append(r)
    assert len(paths) == sum(r.n_children == 0 for p in paths.values() for r in p)
    for p in paths.values():
        p.sort(key=lambda r: r.depth)
        assert [r.depth for r in p] == list(range(p[0].depth, p[0].depth + len(p))) and p[-1].n_children == 0 and len({r.level for r in p}) == 1
        assert p[0].n_convs * 2 ** p[0].level <= 200
    assert max(r.level for p in paths.values() for r in p) >= 2


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op11_prefix_trie"](spark, sf)
    assert got.columns == NAMES and {t for c, t in got.dtypes if c != "ends_sha256"} == {"bigint"}
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
