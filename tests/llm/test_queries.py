"""The ten registered queries over whole tables, each against plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex

from tests.llm import test_decontaminate as td
from tests.llm import test_line_dedup as tl
from tests.llm import test_pii as tp
from tests.llm import test_trie as tt
from txnlake.llm import decontaminate, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def test_op1(spark, texts):
    got = {r.doc_id: r for r in rows(spark, "op1_pii")}
    assert set(got) == set(texts)
    for d, t in texts.items():
        base = [f"{kind}:{a}:{b}" for a, _, b, kind in tp.plain(t or "")]
        n = Counter(x.split(":")[0] for x in base)
        r = got[d]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in ("email", "ip", "card", "phone"))
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(base) <= set(spans) and len(spans) == len(base) + r.n_added
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), ("email", "ip", "card", "phone").index(s.split(":")[0])))


def test_op2(spark, texts):
    bench = [(r.item_id, decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = set()
    for d, t in texts.items():
        words = decontaminate.words_of(t)
        have = set(words)
        for i, w in bench:
            k = int(0.2 * len(w) + 1e-9)
            if sum(x not in have for x in w) <= k and (n := td.distance(w, words)) <= k:
                want.add((d, i, n))
    assert {(r.doc_id, r.item_id, r.distance) for r in rows(spark, "op2_cgk_decontamination")} == want


def test_op3(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in rows(spark, "op3_ppm_langid")}
    assert set(got) == set(texts)
    for d, t in texts.items():
        assert got[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= got[d].score <= 1
        assert (got[d].lang_pred == "und") == (t is None or not regex.search(r"\p{L}", t))
    known = [r for r in docs if r.lang and got[r.doc_id].held_out and got[r.doc_id].lang_pred != "und"]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in known]) > 0.9


def test_op4(spark, texts):
    want = tl.brute(sorted(texts.items()))
    got = {r.doc_id: r for r in rows(spark, "op4_line_dedup")}
    assert {d: [int(x) for x in r.kept_lines.split(",") if x] for d, r in got.items()} == want
    assert all(r.n_kept == len(want[d]) and r.n_lines == (texts[d] or "").count("\n") + 1 for d, r in got.items())


def test_op6(spark):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    best = {}
    for p, body in pages.items():
        if len(body) >= 1000:
            best[body] = max(p, best.get(body, p))
    want = {(p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if best.get(b, p) != p else "response", best[b] if best.get(b, p) != p else None) for p, b in pages.items()}
    assert {tuple(r) for r in rows(spark, "op6_warc_dictionary")} == want


def test_op7(spark, texts):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path("byte_bpe_50k.json"))
    got = rows(spark, "op7_nnls_packing")
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for d, parts in by_doc.items():
        ids = np.array([*tok.encode(texts[d] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(by_seq) == -(-sum(r.length for r in got) // 2048)


def test_op8(spark, texts):
    got = rows(spark, "op8_label_propagation")
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts.items()}
    slots = defaultdict(list)
    for r in got:
        assert r.law == "rows" and 0 <= r.shard < 8 and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_op9(spark, texts):
    ids = sorted(texts)
    fp = [tt.fingerprint(texts[d]) for d in ids]
    want = {(d, f"{f:016x}", ids[r]) for d, f, r in zip(ids, fp, tt.roots(fp))}
    assert {tuple(r) for r in rows(spark, "op9_simhash_trie")} == want


def test_op10(spark):
    v = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    q = {i: [int(np.floor(256 * np.float64(x))) for x in e] for i, e in v.items() if e is not None and all(x is not None and np.isfinite(x) for x in e)}
    want = set()
    for i, a in q.items():
        if i % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in q.items() if j != i)[:5]
            want |= {(i, n, j, -s) for n, (s, j) in enumerate(best, 1)}
    assert {tuple(r) for r in rows(spark, "op10_maxscore")} == want
