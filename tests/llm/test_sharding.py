import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from txnlake.llm import sharding


def look(df, shards=8):
    out, rows = sharding.shard(df, shards).collect(), df.collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in rows)
    n = Counter(r.shard for r in out)
    assert not out or max(n.values()) - min(n[i] for i in range(shards)) <= 1
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    have = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == have
    groups = defaultdict(Counter)
    for r in out:
        groups[r.g][r.shard] += 1
    links = sum(sum(g.values()) ** 2 - sum(g.values()) for g in groups.values())
    return 1 - sum(v * v - v for g in groups.values() for v in g.values()) / max(1, links)


def test_small_groups_stay_whole(spark):
    df = spark.createDataFrame([(i, f"u{i // 3 if i < 300 else i}") for i in range(1000)], "doc_id long, text string")
    assert look(df) == 0


def test_documents(spark):
    assert look(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")) <= 0.05


def test_great_group(spark):
    """A third of all rows alike can't fit in one shard; what is cut is near the least."""
    df = spark.createDataFrame([(i, None if i % 3 == 0 else f"u{i // 2}") for i in range(1200)], "doc_id long, text string")
    parts = [150, 150, 100]
    assert look(df) < 1 - sum(p * p - p for p in parts) / (400 * 399) + 0.15


@pytest.mark.parametrize("rows", [[], [(1, "a"), (2, "a"), (None, None)], [(1, "")] * 20, [(None, "x")] * 9])
def test_edges(spark, rows):
    look(spark.createDataFrame(rows, "doc_id long, text string"))


def test_quotas():
    want = np.array([[0, 30, 0], [10, 0, 0], [0, 50, 0]])
    take = sharding.quotas(want, np.array([5.0, 20.0, 0.0]))
    assert (take <= want + 1e-9).all() and take.sum(axis=0)[1] <= 20 + take.sum(axis=1)[1] + 1e-6
