"""SimHash near-duplicates: fingerprints joined with themselves over a binary trie.

A fingerprint is 64 bits of majority votes over the XXH64 hashes of a text's word shingles. The self-join walks pairs of trie
nodes together, adds up the bits in which their paths differ, and drops a pair as soon as that sum exceeds the budget.

How it spreads: with a budget of k, two linked fingerprints agree on at least one of k + 1 blocks. So there are k + 1 tries, each
over the bits rotated so that another block comes first, and the traversal starts at the nodes below that block, where nothing
differs yet. Each such node is a unit of work. A unit of more than ``max_node`` fingerprints (a great group of near copies) is
opened: its pairs of descendants ``open_bits`` below, within the budget, become units of their own, and those are opened in turn as
long as they are too great. So no task holds an unbounded node.
Work is on distinct fingerprints; exact copies are one fingerprint and never expanded into pairs. A task returns a star for
each group it found instead of all pairs; connectivity is what the links are for, and it is kept whole.

Rows: null text counts as empty (fingerprint zero, linked like any other); rows repeated or with a null id keep their own row;
an empty table gives no rows; columns other than id and text are ignored.

``unlike`` is for corpora, where texts are alike whose sets of five-word shingles have a Jaccard similarity of 0.8 or more. The trie
gives the pairs within the budget; of the others at 0.8 most are further apart (README has figures), and a budget wide enough for them
would visit most pairs of nodes. So candidates are added that share a band of minima (MinHash, a pair at 0.8 with probability 0.9996),
and every pair's similarity, of either source, is computed exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.components import components
from txnlake.llm.store import fresh, release, written

BITS = 64
LANES = np.uint64(0x0101010101010101)


def _majorities(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint for each run of counts[i] hashes; 0 for an empty run.

    Votes are added in eight words of eight byte-wide counters, over runs of at most 255 hashes.
    """
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full].astype(np.int64)
    first = np.cumsum(n) - n
    parts = -(-n // 255)
    owner = np.repeat(np.arange(len(full)), parts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    cuts = first[owner] + 255 * within
    heads = np.cumsum(parts) - parts
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & LANES, cuts)
        votes = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        votes = np.add.reduceat(votes, heads, axis=0)
        bits = (2 * votes > n[:, None]).astype(np.uint64)
        for j in range(8):
            out[full] |= bits[:, j] << np.uint64(8 * j + k)
    return out


def _shingle_hashes(text: bytes | None, shingle: int, seed: int) -> list[int]:
    words = (text or b"").lower().split()  # of bytes: A-Z only, and runs of \x20 \x09-\x0D
    if not words:
        return []
    if len(words) < shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    h = xxhash.xxh64_intdigest
    return [h(s, seed) for s in map(b" ".join, zip(*(words[i:] for i in range(shingle))))]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(id_col, key, fp): the SimHash of each row's whole text as a signed long; key tells texts apart."""

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            hashes, counts, out, held = [], [], [], 0
            for t in texts:
                h = _shingle_hashes(t, shingle, seed)
                hashes.append(np.array(h, np.uint64))
                counts.append(len(h))
                held += len(h)
                if held > 2_000_000:
                    out.append(_majorities(np.concatenate(hashes), np.array(counts)))
                    hashes, counts, held = [], [], 0
            if counts:
                out.append(_majorities(np.concatenate(hashes), np.array(counts)))
            fp = np.concatenate(out) if out else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp.view(np.int64))], names=[id_col, "key", "fp"])

    kind = dict(docs.select(id_col).dtypes)[id_col]
    rows = docs.select(F.col(id_col), F.xxhash64(text_col).alias("key"), F.col(text_col).cast("binary").alias("_text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, key long, fp long")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class _Forest:
    """Groups the leaves of many tries, traversed together."""

    def __init__(self, leaves: np.ndarray, budget: int, chunk: int = 400_000):
        self.v, self.budget, self.chunk = leaves, budget, chunk
        self.label = np.arange(len(leaves))
        self.ones: dict[int, np.ndarray] = {}

    def _below(self, depth: int) -> np.ndarray:
        if depth not in self.ones:
            bit = (self.v >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            self.ones[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        return self.ones[depth]

    def _link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up

    def traverse(self, depth: int, alo, ahi, blo, bhi, err) -> None:
        """Visit node pairs [alo, ahi) x [blo, bhi) that have depth bits behind them and differ in err of those."""
        stack = [(depth, np.stack([alo, ahi, blo, bhi, err]))]
        while stack:
            depth, p = stack.pop()
            if p.shape[1] > self.chunk:
                stack += [(depth, p[:, i : i + self.chunk]) for i in range(0, p.shape[1], self.chunk)]
                continue
            leaf = (p[1] - p[0] == 1) & (p[3] - p[2] == 1)
            a, b = p[0][leaf], p[2][leaf]
            apart = a != b
            a, b = a[apart], b[apart]
            near = _popcount(self.v[a] ^ self.v[b]) <= self.budget
            self._link(a[near], b[near])
            p = p[:, ~leaf]
            if not p.shape[1] or depth == BITS:
                continue
            c = self._below(depth)
            alo, ahi, blo, bhi, err = p
            am, bm = ahi - (c[ahi] - c[alo]), bhi - (c[bhi] - c[blo])
            same = alo == blo
            kids = [np.stack([alo, am, blo, bm, err]), np.stack([am, ahi, bm, bhi, err]), np.stack([alo, am, bm, bhi, err + 1])]
            kids.append(np.stack([am, ahi, blo, bm, err + 1])[:, ~same])
            q = np.concatenate(kids, axis=1)
            q = q[:, (q[0] < q[1]) & (q[2] < q[3]) & (q[4] <= self.budget)]
            if q.shape[1]:
                stack.append((depth + 1, q))


def _rotated(v: np.ndarray, by: np.ndarray) -> np.ndarray:
    by = by.astype(np.uint64)
    back = (np.uint64(BITS) - by) % np.uint64(BITS)
    return np.where(by == 0, v, (v << by) | (v >> back))


def _opened(units: DataFrame, depth: int, budget: int, bits: int) -> DataFrame:
    """Units (trie, v, s, t) of node pairs at depth, each replaced by the pairs of their descendants `bits` below within the budget.

    A fingerprint goes to every pair that its own descendant is in. s <= t, and a pair of one node with itself has s = t.
    """
    mine = F.expr(f"shiftrightunsigned(v, {BITS - depth - bits})")
    tail = F.expr(f"shiftrightunsigned(shiftleft(v, {depth}), {BITS - bits})")
    left = F.expr(f"shiftrightunsigned(v, {BITS - depth}) = s")
    by = F.array(*[F.lit(x) for x in sorted(range(1 << bits), key=int.bit_count) if x.bit_count() <= budget])
    rows = units.select("trie", "v", "s", "t", mine.alias("mine"), tail.alias("tail"), left.alias("left"), F.explode(by).alias("x"))
    rows = rows.where(F.bit_count(F.col("s").bitwiseXOR(F.col("t"))) + F.bit_count("x") <= budget)
    other = F.shiftleft(F.when(F.col("left"), F.col("t")).otherwise(F.col("s")), bits).bitwiseOR(F.col("tail").bitwiseXOR(F.col("x")))
    return rows.select("trie", "v", F.least("mine", other).alias("s"), F.greatest("mine", other).alias("t"))


def units_of(fps: DataFrame, budget: int, max_node: int, open_bits: int) -> DataFrame:
    """(trie, depth, v, s, t): the rotated fingerprints v of each unit, a pair of nodes s, t at that depth."""
    blocks = budget + 1
    width = BITS // blocks
    tries = fps.select("fp", F.posexplode(F.array(*[F.lit(r * width) for r in range(blocks)])).alias("trie", "turn"))
    turned = F.when(F.col("turn") == 0, F.col("fp")).otherwise(F.expr("shiftleft(fp, turn) | shiftrightunsigned(fp, 64 - turn)"))
    top = F.expr(f"shiftrightunsigned(v, {BITS - width})")
    units, depth, done = tries.withColumn("v", turned).select("trie", "v", top.alias("s"), top.alias("t")), width, None
    while True:
        great = written(units.groupBy("trie", "s", "t").count().where(F.col("count") > max_node).select("trie", "s", "t"), "great")
        if depth >= BITS or great.isEmpty():
            small = units.withColumn("depth", F.lit(depth))
            return small if done is None else done.unionByName(small)
        small = units.join(great, ["trie", "s", "t"], "left_anti").withColumn("depth", F.lit(depth))
        done = small if done is None else done.unionByName(small)
        bits = min(open_bits, BITS - depth)
        units = written(_opened(units.join(great, ["trie", "s", "t"], "left_semi"), depth, budget, bits), "opened")
        depth += bits


def links(fps: DataFrame, budget: int = 3, max_node: int = 2048, open_bits: int = 6) -> DataFrame:
    """(a, b) over distinct fingerprints (column fp): stars whose components are those of all pairs within the budget."""
    width = BITS // (budget + 1)
    units = units_of(fps, budget, max_node, open_bits)
    units = units.repartition("trie", "depth", "s", "t").sortWithinPartitions("depth", "trie", "s", "t", "v")

    def solve(trie, depth, v, s, t):
        cut = np.flatnonzero((trie[1:] != trie[:-1]) | (depth[1:] != depth[:-1]) | (s[1:] != s[:-1]) | (t[1:] != t[:-1])) + 1
        lo = np.concatenate([[0], cut])
        hi = np.append(lo[1:], len(v))
        forest = _Forest(v, budget)
        su, tu, du = s[lo], t[lo], depth[lo]
        # the fingerprints below s come first
        left = np.concatenate([[0], np.cumsum((v >> (BITS - depth).astype(np.uint64)) == s.astype(np.uint64))])
        mid, same = lo + (left[hi] - left[lo]), su == tu
        ahi, blo = np.where(same, hi, mid), np.where(same, lo, mid)
        ok = (lo < ahi) & (blo < hi)
        for d in np.unique(du):
            of = ok & (du == d)
            if of.any():
                forest.traverse(int(d), lo[of], ahi[of], blo[of], hi[of], np.bitwise_count((su ^ tu)[of]).astype(np.int64))
        found = np.flatnonzero(forest.label != np.arange(len(v)))
        back = _rotated(v, (BITS - trie * width) % BITS)
        return pa.RecordBatch.from_arrays([pa.array(back[found].view(np.int64)), pa.array(back[forest.label[found]].view(np.int64))], names=["a", "b"])

    def run(batches):
        held, size = [], 0

        def flush(final: bool):
            cols = [np.concatenate(c) for c in zip(*held)]
            # the last unit may go on in the next batch
            last = np.flatnonzero(np.any([c[1:] != c[:-1] for c in (cols[0], cols[1], cols[3], cols[4])], axis=0))
            end = len(cols[0]) if final else int(last[-1]) + 1 if len(last) else 0
            held[:] = [[c[end:] for c in cols]]
            if end:
                yield solve(*(c[:end] for c in cols))

        for batch in batches:
            if not batch.num_rows:
                continue
            trie, depth, v, s, t = (batch.column(i).to_numpy() for i in range(5))
            held.append([trie.astype(np.int64), depth.astype(np.int64), v.view(np.uint64), s, t])
            size += batch.num_rows
            if size >= 500_000:
                yield from flush(False)
                size = len(held[0][0])
        if held:
            yield from flush(True)

    return units.select("trie", "depth", "v", "s", "t").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, budget: int = 3, max_node: int = 2048) -> DataFrame:
    """(id_col, key, fp, component): one row for each row of docs; component is the least id reachable over links."""
    fp = written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    least = written(fp.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct")
    roots = components(links(least, budget, max_node), "a", "b").withColumnRenamed("node", "fp")
    of = least.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    top = of.groupBy("root").agg(F.min("least").alias("component"))
    of = of.join(top, "root").select("fp", "component")
    return fp.join(of, "fp").select(id_col, "key", "fp", "component")


def _without(docs: DataFrame, gone: DataFrame, repeated: bool, id_col: str, text_col: str, small: int) -> DataFrame:
    """docs without the rows in gone (id, key), broadcast where they are counted to be few; of repeated rows one stays."""
    i, k = fresh(docs, "id", "key")
    gone = gone.select(F.col("id").alias(i), F.col("key").alias(k))
    few = gone.limit(small + 1).count() <= small
    match = F.col(id_col).eqNullSafe(F.col(i)) & F.xxhash64(text_col).eqNullSafe(F.col(k))
    rest = docs.join(F.broadcast(gone) if few else gone, match, "left_anti")
    return rest.withColumn(k, F.xxhash64(text_col)).dropDuplicates([id_col, k]).drop(k) if repeated else rest


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", small: int = 200_000, **options) -> DataFrame:
    """The rows of docs without those that have a near duplicate with a lesser (id, hash of text).

    A null id comes first. Of rows with equal id and text one stays. The rows to drop are broadcast where they are counted to be
    few, otherwise joined by a shuffle.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fp = written(fingerprints(own, "id", "text", options.get("shingle", 3), options.get("seed", 42)), "fingerprints")
    place = F.struct("id", "key")
    least = written(fp.groupBy("fp").agg(F.min(place).alias("least")), "distinct")
    roots = components(links(least, options.get("budget", 3), options.get("max_node", 2048)), "a", "b").withColumnRenamed("node", "fp")
    of = least.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    stay = of.groupBy("root").agg(F.min("least").alias("stay"))
    of = of.join(stay, "root").select("fp", "stay")
    gone = written(fp.join(of, "fp").where(~place.eqNullSafe(F.col("stay"))).select("id", "key").distinct(), "gone")
    repeated = fp.groupBy("id", "key").count().where("count > 1").limit(1).count() > 0
    return _without(docs, gone, repeated, id_col, text_col, small)


def _sketches(docs: DataFrame, shingle: int, seed: int, bands: int, rows: int) -> DataFrame:
    """(id, key, fp, bands) of docs (id, text): SimHash and, for each band, a hash of its minima; texts without words share theirs."""
    turns = np.random.default_rng(seed).integers(0, 1 << 63, (bands * rows, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def minima(h: np.ndarray) -> np.ndarray:
        least = np.full(len(turns), np.iinfo(np.uint64).max, np.uint64)
        for a in range(0, len(h), 4096):
            least = np.minimum(least, ((h[None, a : a + 4096] ^ turns[:, :1]) * turns[:, 1:]).min(axis=1))
        return np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in least.reshape(bands, rows)], np.uint64)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                hashes = [np.array(_shingle_hashes(t.as_py(), shingle, seed), np.uint64) for t in part.column(2)]
                fp = _majorities(np.concatenate(hashes), np.array([len(h) for h in hashes]))
                every = np.concatenate([minima(h if len(h) else np.zeros(1, np.uint64)) for h in hashes])
                found = pa.ListArray.from_arrays(pa.array(np.arange(0, len(every) + 1, bands), pa.int32()), pa.array(every.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp.view(np.int64)), found], names=["id", "key", "fp", "bands"])

    laid = docs.select("id", F.xxhash64("text").alias("key"), F.col("text").cast("binary").alias("text"))
    return laid.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, key long, fp long, bands array<long>")


def _similar(pairs: DataFrame, docs: DataFrame, shingle: int, seed: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of text hashes whose texts have that Jaccard similarity of shingles (by 32 bits of their hashes)."""
    members = written(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "members")
    texts = docs.select(F.xxhash64("text").alias("key"), F.col("text").cast("binary").alias("text")).join(members, "key", "left_semi").dropDuplicates(["key"])

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                own = [np.unique(np.array(_shingle_hashes(t.as_py(), shingle, seed) or [0], np.uint64).astype(np.uint32)).view(np.int32) for t in part.column(1)]
                ends = np.cumsum([0, *map(len, own)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(own)))], names=["key", "h"])

    sets = written(texts.mapInArrow(run, "key long, h array<int>"), "shingles")
    # sizes alone rule out pairs before the sets are joined
    size = sets.select("key", F.size("h").alias("n"))
    fit = pairs.join(size.withColumnsRenamed({"key": "a", "n": "na"}), "a").join(size.withColumnsRenamed({"key": "b", "n": "nb"}), "b")
    fit = fit.where(F.least("na", "nb") >= similarity * F.greatest("na", "nb") - 1e-9).select("a", "b")
    both = fit.join(sets.withColumnsRenamed({"key": "a", "h": "ha"}), "a").join(sets.withColumnsRenamed({"key": "b", "h": "hb"}), "b")
    common = F.size(F.array_intersect("ha", "hb"))
    out = written(both.where(common >= similarity * (F.size("ha") + F.size("hb") - common) - 1e-9).select("a", "b"), "similar")
    release(members, sets)
    return out


def unlike(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, seed: int = 42, budget: int = 3, bands: int = 20, rows: int = 5, small: int = 200_000) -> DataFrame:
    """The rows of docs without those connected by similar texts to one with a lesser (id, hash of text).

    A null id comes first. Of rows with equal id and text one stays. The trie's groups and each band's bucket are first compared with
    one of their texts; then all pairs of a bucket that this has not connected.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    laid = written(_sketches(own, shingle, seed, bands, rows), "sketches")
    least = written(laid.groupBy("key").agg(F.min(F.struct("id", "key")).alias("least"), F.min("fp").alias("fp")), "texts")
    # texts by their fingerprint, and fingerprints by the trie
    heads = written(least.groupBy("fp").agg(F.min("key").alias("head"), F.count("*").alias("n")), "distinct")
    near = links(heads.select("fp"), budget).join(heads.selectExpr("fp a", "head x"), "a").join(heads.selectExpr("fp b", "head y"), "b").select("x", "y")
    same = least.join(heads.where("n > 1"), "fp").where("key <> head").select(F.col("head").alias("x"), F.col("key").alias("y"))
    buckets = laid.select("key", F.posexplode("bands").alias("band", "value")).distinct()
    shared = buckets.groupBy("band", "value").agg(F.count("*").alias("n"), F.min("key").alias("first")).where("n > 1")
    buckets = written(buckets.join(shared, ["band", "value"]).select("band", "value", "key", "first"), "buckets")
    tried = near.unionByName(same).unionByName(buckets.where("key <> first").select(F.col("first").alias("x"), F.col("key").alias("y")))
    tried = written(tried.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "stars")
    linked = _similar(tried, own, shingle, seed, similarity)
    groups = components(linked, "a", "b").withColumnsRenamed({"node": "key", "root": "g"})
    known = buckets.join(groups, "key", "left").select("band", "value", "key", F.coalesce("g", "key").alias("g"))
    mixed = known.groupBy("band", "value").agg(F.min("g").alias("x"), F.max("g").alias("y")).where("x <> y").select("band", "value")
    known = written(known.join(mixed, ["band", "value"], "left_semi"), "mixed")
    a, b = known.alias("a"), known.alias("b")
    rest = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.value") == F.col("b.value")) & (F.col("a.key") < F.col("b.key")) & (F.col("a.g") != F.col("b.g")))
    rest = written(rest.select(F.col("a.key").alias("a"), F.col("b.key").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"), "rest")
    release(buckets, known)
    if not rest.isEmpty():
        linked = linked.unionByName(_similar(rest, own, shingle, seed, similarity))
        groups = components(linked, "a", "b").withColumnsRenamed({"node": "key", "root": "g"})
    of = least.join(groups, "key", "left").select("key", "least", F.coalesce("g", "key").alias("g"))
    stay = of.groupBy("g").agg(F.min("least").alias("stay"))
    gone = laid.select("id", "key").join(of.join(stay, "g").select("key", "stay"), "key")
    gone = written(gone.where(~F.struct("id", "key").eqNullSafe(F.col("stay"))).select("id", "key").distinct(), "gone")
    repeated = laid.groupBy("id", "key").count().where("count > 1").limit(1).count() > 0
    return _without(docs, gone, repeated, id_col, text_col, small)
