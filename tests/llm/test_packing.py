import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from txnlake.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a  b", None, "", "x\n\n y \t z  q  ", " lead", "a <|endoftext|> b", "it's we'll  x\n", "12 34　 5 don't  e \x1c f", "é" * 9000, "naïve, café.\nBar ... (x)", "\n", " ", "a b  c"]


def ids(text):
    return packing.ids_of(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(spark, rows, most_waste=None, **options):
    from collections import Counter

    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = packing.pack(df, PATH, **options).collect()
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        seqs[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(Counter)
    times = Counter(d for d, _ in rows)
    for d, t in rows:
        data = np.array(ids(t), "<u4").tobytes()
        got = sorted(set(pieces[d])) if times[d] > 1 else sorted(pieces[d])
        if times[d] > 1:
            assert sum(p[1] for p in pieces[d]) == sum(len(ids(x)) for e, x in rows if e == d)
            continue
        at = 0
        for start, length, crc, n in got:
            assert start == at and n == len(data) // 4 and crc == zlib.crc32(data[4 * start : 4 * (start + length)])
            at += length
        assert at == len(data) // 4
    waste = used = 0
    window = options.get("window", 2048)
    for v in seqs.values():
        at = 0
        for a, n in sorted(v):
            assert a == at
            at += n
        assert at <= window
        used += at
        waste += 0 if at & (at - 1) == 0 else window - at
    assert most_waste is None or waste <= most_waste
    return want


def test_pieces_of_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(spark, [(r.doc_id, r.text) for r in d.collect()], 2047)


def test_odd_texts(spark):
    check(spark, list(enumerate(ODD)), 2047)
    for t in ODD:
        assert packing.ids_of(PATH).encode(t or "") == np.array(ids(t)[:-1], "<u4").tobytes()


@pytest.mark.parametrize("small", [50_000, 0])
def test_equal_lengths_are_cut(spark, small):
    """Lengths that no combination fills go to the stream, whose cut pieces are summed again by either join."""
    check(spark, [(i, "word " * 29 + str(i % 10)) for i in range(100)], 63, window=64, small=small)


def test_repeats_nulls_and_empty(spark):
    check(spark, [(None, "x"), (1, "y z " * 50), (1, "y z " * 50), (1, "q"), (2, None)], window=64)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, PATH).count() == 0


def test_plan():
    rng = np.random.default_rng(0)
    hist = rng.integers(0, 40, 256)
    hist[0] = 9
    combos, counts = packing.plan(hist, 256)
    assert (combos.sum(axis=1) == 256).all() and (counts >= 0).all()
    used = Counter()
    for c, n in zip(combos, counts):
        for x in c[c > 0]:
            used[int(x)] += int(n)
    assert all(used[x] <= hist[x] for x in used)
    left = sum((hist[x] - used[x]) * x for x in range(256))
    assert left < 0.3 * (hist * np.arange(256)).sum()  # long tails lack partners; the stream takes them


def test_nnls_finds_an_exact_solution():
    combos = np.array([[3, 5, 0], [2, 6, 0], [1, 2, 5], [4, 4, 0]])
    truth = np.array([10.0, 20.0, 5.0, 7.0])
    hist = np.zeros(8)
    for c, n in zip(combos, truth):
        for x in c[c > 0]:
            hist[x] += n
    assert packing.nnls(combos, hist, 3000) == pytest.approx(truth, rel=1e-2)
