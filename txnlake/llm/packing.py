"""Token packing: whole windows, then length combinations solved by non-negative least squares, then a cut stream.

1. Every text is tokenized once. Its tokens (and the end id) give whole windows, each a sequence of its own, and a tail shorter
   than the window.
2. The histogram of tail lengths (at most window - 1 bins, whatever the input) is the right-hand side of a non-negative least
   squares problem whose columns are shallow combinations: two or three lengths that fill a window exactly. Multiplicative
   updates solve it; the repeat counts are rounded down, held to what the histogram has, and topped up greedily.
3. Tails beyond those counts are packed greedily end to end and cut at window ends, so one sequence at most has padding.

A tail finds its place by its rank within its length alone. Ranks come from a range-partitioned, sorted table in which a row's
place is written down (partition and position), plus one offset for each partition; no length is ever gathered in one task. Of a
cut tail, only the two checksums need its tokens again: those few texts are joined back.

Ids: the tokenizer's model is asked once for each piece that the byte-level split makes; a worker keeps pieces, and words between
single spaces (where byte-level BPE splits as well), in bounded caches. Texts with special token strings are encoded whole.

Rows: null text is empty, so only the end id is left; repeated rows are packed one by one; rows with a null id keep it. An empty
table gives no rows. Columns other than id and text are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.store import written

END_ID = 1
#: Fixed value: how byte-level BPE splits a text before its merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PROBE = "It's  a probe,\n\n 12 of\tthem\x1c \u3000é—ß!? x\u00a0y 'll  "
PIECES_KEPT, WORDS_KEPT = 700_000, 400_000
_tokenizers: dict[str, "Ids"] = {}


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level BPE: printable Latin-1 for itself, the others from U+0100 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Loose(Exception):
    """A part of a text with white space at an end: its split depends on its neighbours."""


class _Words(dict):
    """Ids of what stands between a single space and the next, learned when first asked for."""

    def __init__(self, piece, split):
        self.piece, self.split = piece, split

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            ids = self.piece(" " + word)
        elif not word or word[0].isspace() or word[-1].isspace():
            raise _Loose
        elif word[-1] in ",." and word[:-1].isalpha():
            ids = self.piece(" " + word[:-1]) + self.piece(word[-1])
        else:
            ids = b"".join(map(self.piece, self.split(" " + word)))
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = ids
        return ids


class _Pieces(dict):
    """Ids of the pieces that the merges work on."""

    def __init__(self, model):
        self.model, self.letters = model, _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        tokens = self.model.tokenize(piece.encode("utf-8").decode("latin-1").translate(self.letters))
        ids = np.array([t.id for t in tokens], "<u4").tobytes()
        if len(self) >= PIECES_KEPT:
            self.clear()
        self[piece] = ids
        return ids


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile(SPLIT).findall
        self.pieces = _Pieces(self.tokenizer.model)
        self.words = _Words(self.pieces.__getitem__, self.split)
        # a tokenizer of another kind encodes whole texts
        self.by_words = self._whole(PROBE) == self._by_words(PROBE)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _by_words(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        try:
            if rest and first[-1:].isspace():
                raise _Loose
            return b"".join([*map(self.pieces.__getitem__, self.split(first)), *map(self.words.__getitem__, rest)])
        except _Loose:
            return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        if not self.by_words or any(s in text for s in self.special):
            return self._whole(text)
        return self._by_words(text)


def ids_of(path: str) -> Ids:
    if path not in _tokenizers:
        _tokenizers[path] = Ids(path)
    return _tokenizers[path]


def _encoded(texts: list, path: str):
    """Bytes of ids with the end id for each text."""
    ids, end = ids_of(path), np.array([END_ID], "<u4").tobytes()
    return (ids.encode(t or "") + end for t in texts)


def token_table(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, window: int) -> DataFrame:
    """(id_col, key, n, full, tail, rest): key tells texts apart; full has the checksum of each whole window, tail that of the rest."""

    def run(batches):
        for batch in batches:
            n, full, tail = [], [], []
            for x in _encoded(batch.column(2).to_pylist(), tokenizer):
                n.append(len(x) // 4)
                whole = len(x) // (4 * window)
                full.append([zlib.crc32(x[4 * window * i : 4 * window * (i + 1)]) for i in range(whole)])
                tail.append(zlib.crc32(x[4 * window * whole :]))
            n = np.array(n, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), pa.array(full, pa.list_(pa.int64())), pa.array(tail, pa.int64()), pa.array(n % window)],
                names=[id_col, "key", "n", "full", "tail", "rest"],
            )

    kind = dict(docs.select(id_col).dtypes)[id_col]
    rows = docs.select(F.col(id_col), F.xxhash64(text_col).alias("key"), F.col(text_col))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, key long, n long, full array<long>, tail long, rest long")


def combinations(hist: np.ndarray, window: int, triples: int) -> np.ndarray:
    """Rows of three lengths (0: none) that fill the window: all pairs and the best supplied triples."""
    a = np.arange(1, window // 2 + 1)
    pairs = np.stack([a, window - a, np.zeros_like(a)], axis=1)
    pairs = pairs[(hist[pairs[:, 0]] > 0) & (hist[pairs[:, 1]] > 0)]
    have = 1 + np.flatnonzero(hist[1:])
    x, y = np.meshgrid(have, have, indexing="ij")
    z = window - x - y
    ok = (x <= y) & (y <= z)
    x, y, z = x[ok], y[ok], z[ok]
    ok = hist[z] > 0
    x, y, z = x[ok], y[ok], z[ok]
    supply = np.minimum(np.minimum(hist[x], hist[y]), hist[z])
    if len(x) > triples:
        top = np.argpartition(-supply, triples)[:triples]
        x, y, z = x[top], y[top], z[top]
    return np.concatenate([pairs, np.stack([x, y, z], axis=1)])


def nnls(combos: np.ndarray, hist: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Non-negative least squares by multiplicative updates: repeat counts x with A x near hist."""
    if not len(combos):
        return np.zeros(0)
    used = combos > 0

    def forward(x):
        out = np.zeros(len(hist))
        for j in range(combos.shape[1]):
            np.add.at(out, combos[used[:, j], j], x[used[:, j]])
        return out

    back = lambda v: np.where(used, v[combos], 0.0).sum(axis=1)
    goal = back(hist.astype(float))
    x = np.minimum.reduce(np.where(used, hist[combos], hist.max()), axis=1).astype(float) / 4 + 1e-9
    for _ in range(rounds):
        x *= goal / np.maximum(back(forward(x)), 1e-12)
    return x


def plan(hist: np.ndarray, window: int, triples: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """(combos, counts): whole counts that the histogram covers."""
    combos = combinations(hist, window, triples)
    x = nnls(combos, hist)
    left = hist.astype(np.int64).copy()
    counts = np.zeros(len(combos), np.int64)
    order = np.argsort(-x, kind="stable")
    for goal in (np.floor(x).astype(np.int64), None):  # rounded down; then greedily what is left
        for p in order:
            lengths, times = np.unique(combos[p][combos[p] > 0], return_counts=True)
            room = int((left[lengths] // times).min())
            take = room if goal is None else min(room, int(goal[p]))
            if take > 0:
                counts[p] += take
                left[lengths] -= take * times
    return combos, counts


def _segments(hist: np.ndarray, combos: np.ndarray, counts: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Where the tails of a length go, by rank: runs of one slot of a combination, and the run of the stream.

    start is over ranks of all lengths laid end to end. base is the first sequence, or for the stream the first token.
    """
    runs: list[list[tuple]] = [[] for _ in range(window)]
    used = np.zeros(window, np.int64)
    seq = 0
    for c, n in zip(combos, counts):
        if not n:
            continue
        at = 0
        for length in c[c > 0]:
            runs[length].append((int(used[length]), 0, seq, at))
            used[length] += n
            at += int(length)
        seq += int(n)
    stream = 0
    for length in range(1, window):
        if hist[length] > used[length]:
            runs[length].append((int(used[length]), 1, stream, 0))
            stream += int(hist[length] - used[length]) * length
    first = np.cumsum(hist) - hist
    rows = [(int(first[length]) + s, kind, base, at) for length in range(window) for s, kind, base, at in runs[length] or [(0, 2, 0, 0)] if hist[length]]
    start, kind, base, at = (np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 4
    return {"start": start, "kind": kind, "base": base, "at": at, "combined": seq, "streamed": -(-stream // window)}


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, triples: int = 8192, small: int = 50_000) -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row for each piece."""
    # written before the sort, which reads its input twice
    table = written(token_table(docs, tokenizer, id_col, text_col, window), "encoded")
    order = ["rest", id_col, "key"]
    table = written(table.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "tokens")
    stats = table.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("n"), F.max(F.size("full")).alias("most"))
    parts = sorted(tuple(r) for r in stats.collect())  # a row for each partition
    hist = np.zeros(window, np.int64)
    for r in table.groupBy("rest").count().collect():  # window rows at most
        hist[r[0]] = r[1]
    seg = _segments(hist, *plan(hist, window, triples), window)
    most = max((p[2] for p in parts), default=0)
    part_ids = np.array([p[0] for p in parts], np.int64)
    part_first = np.cumsum([0, *(p[1] for p in parts)])[:-1]
    first_full = seg["combined"] + seg["streamed"]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column(6).to_numpy()
            rank = part_first[np.searchsorted(part_ids, place >> 33)] + (place & ((1 << 33) - 1))
            n, rest, tail = (batch.column(i).to_numpy() for i in (2, 5, 4))
            full = batch.column(3)
            sizes = np.diff(full.offsets.to_numpy())
            row = np.repeat(np.arange(len(n)), sizes)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            out = [(row, nth * window, np.full(len(row), window), full.flatten().to_numpy(), first_full + rank[row] * most + nth, np.zeros(len(row), np.int64))]
            s = np.searchsorted(seg["start"], rank, "right") - 1
            kind, base, at, by = seg["kind"][s], seg["base"][s], seg["at"][s], rank - seg["start"][s]
            i = np.flatnonzero((kind == 0) & (rest > 0))
            out.append((i, n[i] - rest[i], rest[i], tail[i], base[i] + by[i], at[i]))
            i = np.flatnonzero((kind == 1) & (rest > 0))
            token = base[i] + by[i] * rest[i]
            seq, offset = seg["combined"] + token // window, token % window
            here = np.minimum(rest[i], window - offset)
            cut = here < rest[i]
            out.append((i, n[i] - rest[i], here, np.where(cut, -1, tail[i]), seq, offset))
            j = i[cut]
            out.append((j, n[j] - rest[j] + here[cut], rest[j] - here[cut], np.full(len(j), -1), seq[cut] + 1, np.zeros(len(j), np.int64)))
            row, start, length, crc, seq, offset = (np.concatenate(c).astype(np.int64) for c in zip(*out))
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *map(pa.array, (start, length, crc, n[row], seq, offset))],
                names=[id_col, "key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    kind = dict(docs.select(id_col).dtypes)[id_col]
    schema = f"`{id_col}` {kind}, key long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    pieces = written(table.select(id_col, "key", "n", "full", "tail", "rest", "place").mapInArrow(run, schema), "pieces")
    done = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    cut = pieces.where("ids_crc32 < 0")
    keys = cut.select(F.col(id_col).alias("_id"), F.col("key").alias("_key")).distinct()
    few = keys.limit(small + 1).count()
    if not few:
        return pieces.select(*done)
    texts = docs.select(F.col(id_col).alias("_of"), F.xxhash64(text_col).alias("_text_key"), F.col(text_col).alias("_text"))
    match = F.col("_of").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    texts = texts.join(F.broadcast(keys) if few <= small else keys, match, "left_semi").dropDuplicates(["_of", "_text_key"])
    again = cut.join(texts, F.col(id_col).eqNullSafe(F.col("_of")) & (F.col("key") == F.col("_text_key")))

    def sums(batches):
        for batch in batches:
            start, length = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            crc = [zlib.crc32(x[4 * a : 4 * (a + k)]) for x, a, k in zip(_encoded(batch.column(6).to_pylist(), tokenizer), start.tolist(), length.tolist())]
            cols = [batch.column(i) for i in range(6)]
            yield pa.RecordBatch.from_arrays([*cols[:3], pa.array(crc, pa.int64()), *cols[3:]], names=done)

    mended = again.select(id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "_text").mapInArrow(sums, schema.replace(" key long,", ""))
    return pieces.where("ids_crc32 >= 0").select(*done).unionByName(mended)
