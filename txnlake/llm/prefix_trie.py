"""Prefix trie of conversations, with subtree sums by heavy-path decomposition.

A node is a distinct sequence of first turns. It is known by a key of 128 bits: a hash of running sums over hashes of (place, turn), so
that a conversation's nodes come from sums along it and no text is shuffled, only a digest of 16 bytes and a length for each turn.

Every node's largest child (most members, then the smallest conversation) is heavy. A path of heavy edges ends at a childless node, and
that node's smallest conversation runs through the whole path; the path begins below the last light edge of that conversation. So one
aggregate over such conversations gives every path its nodes, its top and its level, the number of light edges above it, without
following pointers. A light child has at most half of its parent's members, so there are at most log2(conversations) levels.
From the deepest level up, subtree sums are suffix sums along the path arrays; the tops of a level's paths are then attached to their
parents by a join, and the next level follows. A round touches the nodes of its level only.

Skew: turns are numbered by a range-partitioned sort, sums along a conversation or path are taken in blocks with an offset for each
block, and counts are aggregated before they are shuffled; so one long conversation, one common first turn or one node with a third of
all conversations is spread over tasks. Conversations that end at a node are joined in sorted pieces and hashed as a stream. Every
intermediate table is written to the shared folder.

Rows: null role or text is empty; a null turn comes first; equal turns of a conversation are ordered by a digest of role and text;
repeated rows are turns like any other. Rows without conversation id are left out. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm.store import new_folder, release, written

BLOCK = 4096
KEY = ["k1", "k2"]
SUMS = ["s1", "s2", "s3", "s4"]
NOTHING = hashlib.sha256(b"").hexdigest()


def numbered(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv, pos, digest, bytes) of every turn with its place from 0 on, and (conv, n) of every conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    slim = df.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))
    slim, order = written(slim, "turns"), ["conv", "turn", "digest", "row"]
    placed = written(slim.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "digest", "bytes", F.monotonically_increasing_id().alias("at")), "placed")
    release(slim)
    placed = placed.withColumn("part", F.shiftright("at", 33))
    # as many rows for a conversation as partitions that hold some of it
    parts = placed.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("conv", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    out = placed.join(starts, ["conv", "part"]).select("conv", (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "digest", "bytes")
    return written(out, "numbered"), written(parts.groupBy("conv").agg(F.sum("n").alias("n")), "conversations")


def rebuilt(turns: DataFrame, convs: DataFrame, family: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h = crc32(conv) % heads turns are those of the first of their family, conv - conv % family.

    Remainders are not negative. Returns (conv, depth, digest, bytes, last), depth from 1, and (conv) of conversations without turns.
    """
    c = F.col("conv")
    h = (F.crc32(c.cast("string").cast("binary")) % heads).alias("h")
    first = F.try_subtract(c, F.pmod(c, F.lit(family)))
    kept = turns.where((F.pmod(c, F.lit(family)) == 0) & (F.col("pos") < heads - 1))
    starts = kept.groupBy(c.alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("start"))  # heads - 1 at most
    wide = convs.select("conv", "n", h, first.alias("base")).join(starts, "base", "left")
    cut = F.least("h", F.when(F.col("start").isNull(), 0).otherwise(F.size("start")))
    wide = written(wide.select("conv", "n", "h", cut.cast("long").alias("cut"), "start").withColumn("length", F.col("cut") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "heads")
    shared = wide.where("cut > 0").select("conv", "length", F.explode(F.slice("start", F.lit(1), F.col("cut").cast("int"))).alias("t"))
    shared = shared.select("conv", (F.col("t.pos") + 1).alias("depth"), "t.digest", "t.bytes", "length")
    own = turns.join(wide.select("conv", "h", "cut", "length"), "conv").where("pos >= h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("cut") + 1).alias("depth"), "digest", "bytes", "length")
    every = shared.unionByName(own)
    return every.select("conv", "depth", "digest", "bytes", (F.col("depth") == F.col("length")).alias("last")), wide.where("length = 0").select("conv")


def running(df: DataFrame, group: str, at: str, sums: list[str], block: int = BLOCK) -> DataFrame:
    """df with its columns `sums` replaced by their sums up to and with the row, by `at` (0, 1, ...) in each group.

    Sums run within blocks, and each block starts from the total of those before it. df is read twice: a written table.
    """
    rows = df.withColumn("b", F.floor(F.col(at) / block))
    inner = Window.partitionBy(group, "b").orderBy(at)
    before = Window.partitionBy(group).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(group, "b").agg(*[F.sum(c).alias(f"t_{c}") for c in sums])
    offsets = totals.select(group, "b", *[F.sum(f"t_{c}").over(before).alias(f"o_{c}") for c in sums]).where("b > 0")
    summed = rows.withColumns({c: F.sum(c).over(inner) for c in sums}).join(offsets, [group, "b"], "left")
    return summed.withColumns({c: F.col(c) + F.coalesce(f"o_{c}", F.lit(0)) for c in sums}).select(*df.columns)


def _key(depth: Column, sums: list[Column]) -> list[Column]:
    return [F.xxhash64(F.lit(n), depth.cast("long"), *[s.cast("long") for s in sums]) for n in (1, 2)]


def chains(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv, depth, k1, k2, p1, p2, bytes, last): every conversation's nodes with their own and their parents' keys."""
    x = [F.xxhash64(F.lit(n), F.col("depth"), F.col("digest")) for n in (1, 2)]
    halves = [h for y in x for h in (F.shiftrightunsigned(y, 32), y.bitwiseAND((1 << 32) - 1))]
    terms = written(turns.select("conv", "depth", *[h.alias(s) for h, s in zip(halves, SUMS)], *[h.alias(f"own_{s}") for h, s in zip(halves, SUMS)], "bytes", "last", (F.col("depth") - 1).alias("at")), "terms")
    r = running(terms, "conv", "at", SUMS, block)
    own = _key(F.col("depth"), [F.col(s) for s in SUMS])
    parent = _key(F.col("depth") - 1, [F.col(s) - F.col(f"own_{s}") for s in SUMS])
    out = written(r.select("conv", "depth", own[0].alias("k1"), own[1].alias("k2"), parent[0].alias("p1"), parent[1].alias("p2"), "bytes", "last"), "chains")
    release(terms)
    return out


def _pieces(batches):
    """Runs of one key's conversations, which come sorted, as comma-joined bytes."""
    for b in batches:
        if not b.num_rows:
            continue
        k1, k2, conv = (b.column(c).to_numpy() for c in ("k1", "k2", "conv"))
        at = [0, *(np.flatnonzero((np.diff(k1) != 0) | (np.diff(k2) != 0)) + 1).tolist()]
        text = [",".join(map(str, conv[s:e].tolist())) for s, e in zip(at, [*at[1:], b.num_rows])]
        yield pa.RecordBatch.from_arrays([pa.array(k1[at]), pa.array(k2[at]), pa.array(conv[at]), pa.array(text)], names=["k1", "k2", "first", "piece"])


def _hashed(batches):
    """The SHA-256 of each key's pieces, which come in order; one key's state is held."""
    key, sha = None, None
    for b in batches:
        done = []
        for k1, k2, piece in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "piece"))):
            if (k1, k2) == key:
                sha.update(b"," + piece.encode())
                continue
            if key:
                done.append((*key, sha.hexdigest()))
            key, sha = (k1, k2), hashlib.sha256(piece.encode())
        yield _batch(done)
    if key:
        yield _batch([(*key, sha.hexdigest())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=["k1", "k2", "ends"])


def endings(chain: DataFrame, empty: DataFrame, root: list[Column]) -> DataFrame:
    """(k1, k2, ends): for nodes where conversations end, the hash of those in ascending order."""
    ends = chain.where("last").select(*KEY, "conv").unionByName(empty.select(root[0].alias("k1"), root[1].alias("k2"), "conv"))
    pieces = ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv").mapInArrow(_pieces, "k1 long, k2 long, first long, piece string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_hashed, "k1 long, k2 long, ends string")


def _by_level(df: DataFrame) -> str:
    path = new_folder(df.sparkSession, "paths")
    df.write.partitionBy("level").option("compression", "zstd").parquet(path)
    return path


def trie(turns: DataFrame, empty: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of conversations given as (conv, depth, digest, bytes, last), and of those without turns as (conv).

    (k1, k2, path, level, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256); path is the
    conversation that runs through the node's heavy path.
    """
    spark = turns.sparkSession
    chain, empty = chains(turns, block), written(empty, "empty")
    zero = [F.lit(0)] * len(SUMS)
    root = _key(F.lit(0), zero)
    convs = chain.where("depth = 1").select("conv").unionByName(empty).agg(F.min("conv").alias("conv"), F.count("*").alias("n")).first()
    if not convs.n:
        return spark.createDataFrame([], "k1 long, k2 long, path long, level int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    own = ((F.col("n_convs") - 1) * F.col("bytes")).alias("own")
    below = chain.groupBy(*KEY).agg(F.min("depth").alias("depth"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"))
    top = spark.range(1).select(root[0].alias("k1"), root[1].alias("k2"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), F.lit(convs.conv).cast("long").alias("conv"), F.lit(convs.n).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("bytes"))
    nodes = written(below.unionByName(top).select(*KEY, "depth", "p1", "p2", "conv", "n_convs", own), "nodes")

    largest = F.max(F.struct("n_convs", F.bitwise_not("conv").alias("least"), *KEY)).alias("heavy")
    children = written(nodes.where("depth > 0").groupBy("p1", "p2").agg(F.count("*").alias("n_children"), largest), "children")
    marks = children.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "n_children", F.lit(0).alias("heavy")).unionByName(children.select("heavy.k1", "heavy.k2", F.lit(0).cast("long").alias("n_children"), F.lit(1).alias("heavy")))
    marks = marks.groupBy(*KEY).agg(F.sum("n_children").alias("n_children"), F.max("heavy").alias("heavy"))
    nodes = written(nodes.join(marks, KEY, "left").fillna(0, ["n_children", "heavy"]), "marked")

    leaves = nodes.where("n_children = 0").select(F.col("conv").alias("path"))
    along = chain.select(F.col("conv").alias("path"), *KEY).join(leaves, "path", "left_semi")
    wanted = [*KEY, "depth", "p1", "p2", "own", "n_children", "heavy"]
    first = nodes.where("depth = 0").select(*wanted).first()
    kinds = dict(nodes.dtypes)
    along = along.join(nodes.select(*wanted), KEY).select("path", *wanted)
    along = written(along.unionByName(leaves.select("path", *[F.lit(first[c]).cast(kinds[c]).alias(c) for c in wanted])), "along")
    light = F.when(F.col("heavy") == 0, F.col("depth"))
    tops = along.groupBy("path").agg(F.max(light).alias("top"), (F.count(light) - 1).cast("int").alias("level"), F.max("depth").alias("end"))
    tops = written(tops, "tops")
    arrays = along.join(tops, "path").where("depth >= top").select("level", "path", (F.col("end") - F.col("depth")).alias("at"), *KEY, "p1", "p2", (F.col("depth") == F.col("top")).alias("is_top"), F.col("own").alias("saved"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"))
    folder = _by_level(arrays)
    deepest = tops.agg(F.max("level")).first()[0]

    sums, inbox = [], None
    for level in range(deepest, -1, -1):
        rows = spark.read.schema("path long, at long, k1 long, k2 long, p1 long, p2 long, is_top boolean, saved long, n_leaves long").parquet(f"{folder}/level={level}")
        if inbox is not None:
            rows = rows.join(inbox, KEY, "left").withColumns({c: F.col(c) + F.coalesce(f"in_{c}", F.lit(0)) for c in ("saved", "n_leaves")}).drop("in_saved", "in_n_leaves")
            rows = written(rows, "level")
        done = written(running(rows, "path", "at", ["saved", "n_leaves"], block), "sums")
        inbox = done.where("is_top").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.sum("saved").alias("in_saved"), F.sum("n_leaves").alias("in_n_leaves"))
        sums.append(done.select(*KEY, "path", F.lit(level).alias("level"), "saved", "n_leaves"))
    every = sums[0]
    for s in sums[1:]:
        every = every.unionByName(s)

    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent"))
    deep = nodes.where("depth > 1").join(parents, ["p1", "p2"])
    flat = nodes.where("depth <= 1").withColumn("parent", F.when(F.col("depth") == 1, F.lit(convs.conv).cast("long")))
    both = deep.unionByName(flat).join(every, KEY).join(endings(chain, empty, root), KEY, "left")
    return both.select(
        *KEY, "path", "level", F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )


def shared_heads_trie(df: DataFrame, **columns: str) -> DataFrame:
    """The trie of all conversations, rebuilt on the first turns of their families."""
    return trie(*rebuilt(*numbered(df, **columns)))
