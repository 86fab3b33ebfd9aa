"""Language identification by prediction by partial matching.

Each language has a variable-order tree of byte contexts. A byte is coded in the longest context seen in training; if it is new
there, an escape (method C: as likely as the number of different bytes seen) leads to the next shorter context, in which the bytes
that the longer one knows are excluded; below the empty context all bytes are equally likely. The code length of a text under the
frozen trees is the sum of its bytes' code lengths, and the language with the least code length is predicted.

Under frozen statistics a byte's code length depends on its context alone, so the trees are compiled to tables: contexts up to two
bytes by number, contexts of the full order through an index of those that the model keeps. A text is then scored by table lookups
for all languages at once.

Training counts every n-gram of order + 1 bytes of every training text; tasks add up their own counts before the shuffle. The model
keeps at most ``max_contexts`` full-order contexts, and all shorter ones (at most 256**2) with the counts of every text, so its size is
bounded. The languages take turns at choosing the full ones, each its own most frequent first, so a small language keeps its own.

Rows: null texts and texts without a letter are ``und`` with score 0. Texts are scored whole. Ties go to the language that sorts
first. With no training text, every text is ``und``. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LETTER = regex.compile(r"\p{L}")
ORDER = 3
START = 10  # a text is coded as if it stood after newlines


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the four-byte windows that end at each byte of the texts, and the texts' lengths."""
    lead = bytes([START]) * ORDER
    joined = np.frombuffer(lead + lead.join(texts), np.uint8).astype(np.uint32) if texts else np.zeros(0, np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    if not len(joined):
        return joined, lengths
    g = (joined[:-3] << np.uint32(24)) | (joined[1:-2] << np.uint32(16)) | (joined[2:-1] << np.uint32(8)) | joined[3:]
    # windows that end in a separator are not of any text
    ends = np.cumsum(lengths + ORDER)[:-1] - ORDER
    keep = np.ones(len(g), bool)
    for j in range(ORDER):
        keep[(ends + j)[ends + j < len(g)]] = False
    return g[keep], lengths


def _pieces(values: list, most: int = 4_000_000):
    """Runs of rows of about `most` bytes; a longer text is a run of its own."""
    first, size = 0, 0
    for i, v in enumerate(values):
        size += len(v or b"")
        if size >= most:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(values):
        yield first, len(values)


def count(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) over all texts of docs that have a language."""

    def run(batches):
        held: dict[str, list] = {}

        def merged(parts):
            g = np.concatenate([p[0] for p in parts])
            n = np.concatenate([p[1] for p in parts])
            u, at = np.unique(g, return_inverse=True)
            return u, np.bincount(at, n, len(u)).astype(np.int64)

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in _pieces(texts):
                for lang in {*langs[a:b]}:
                    g, _ = _grams([t for t, own in zip(texts[a:b], langs[a:b]) if own == lang and t])
                    if len(g):
                        parts = held.setdefault(lang, [])
                        parts.append(np.unique(g, return_counts=True))
                        if len(parts) > 8:
                            held[lang] = [merged(parts)]
        for lang, parts in held.items():
            u, n = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _costs(counts: list[np.ndarray]) -> np.ndarray:
    """Code lengths in bits for every last symbol. counts[k]: (contexts, symbols) of order k, longest context first for each row.

    All arrays have the same shape: row i is one full context, counts[k][i] those of its suffix of length k.
    """
    rows, symbols = counts[0].shape
    bits = np.zeros((rows, symbols))
    todo = np.ones((rows, symbols), bool)  # not yet coded
    for c in reversed(counts):
        live = c * todo
        n, kinds = live.sum(axis=1, keepdims=True), (live > 0).sum(axis=1, keepdims=True)
        known = (live > 0) & todo
        total = np.maximum(n + kinds, 1)
        with np.errstate(divide="ignore"):
            here = -np.log2(np.where(live > 0, live, 1) / total)
            escape = np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / total), 0.0)
        bits = np.where(known, bits + here, np.where(todo, bits + escape, bits))
        todo &= ~known
    return bits, todo


class Model:
    """Frozen trees of all languages as lookup tables."""

    def __init__(self, langs: list[str], rows: list[tuple[np.ndarray, np.ndarray]], lower: list[tuple[np.ndarray, np.ndarray]]):
        """Of langs[i], (grams, counts): rows[i] of the full contexts that are kept, lower[i] of the last three bytes of all grams."""
        self.langs = langs
        seen = np.zeros(256, bool)
        for g, _ in lower:
            for shift in (0, 8, 16):
                seen[(g >> shift) & 255] = True
        seen[START] = True
        # bytes of no training text share symbol 0: they follow no context and are equally likely
        self.symbol = np.where(seen, np.cumsum(seen), 0).astype(np.int64)
        s = self.s = int(seen.sum()) + 1
        unseen = 256 - int(seen.sum())
        four, three = [self._symbols(g) for g, _ in rows], [self._symbols(g) for g, _ in lower]
        every = np.concatenate([f[:, 0] * s * s + f[:, 1] * s + f[:, 2] for f in four]) if rows else np.zeros(0, np.int64)
        kept = np.unique(every)
        # contexts that are not kept fall back to their last two bytes
        self.index = np.zeros(s**3, np.int32)
        self.index[:] = np.tile(np.arange(s * s, dtype=np.int32), s)
        self.index[kept] = s * s + np.arange(len(kept), dtype=np.int32)
        self.bits = np.zeros(((s * s + len(kept)) * s, len(langs)), np.float32)
        last = np.concatenate([np.arange(s * s), kept % (s * s)])
        for li, (f, (_, n), t, (_, m)) in enumerate(zip(four, rows, three, lower)):
            c0 = np.bincount(t[:, 3], m, s)
            c1 = np.bincount(t[:, 2] * s + t[:, 3], m, s * s).reshape(s, s)
            c2 = np.bincount((t[:, 1] * s + t[:, 2]) * s + t[:, 3], m, s**3).reshape(s * s, s)
            row = self.index[f[:, 0] * s * s + f[:, 1] * s + f[:, 2]].astype(np.int64) - s * s
            c3 = np.bincount(row * s + f[:, 3], n, max(1, len(kept)) * s).reshape(-1, s)[: len(kept)]
            for a in range(0, len(last), 4096):
                b = min(a + 4096, len(last))
                ctx = last[a:b]
                top = np.zeros((b - a, s))
                is_full = np.arange(a, b) >= s * s
                top[is_full] = c3[np.arange(a, b)[is_full] - s * s]
                bits, todo = _costs([np.broadcast_to(c0, (b - a, s)), c1[ctx % s], c2[ctx], top])
                # below the empty context: the bytes that no context knew
                left = todo[:, 1:].sum(axis=1, keepdims=True) + unseen
                bits = np.where(todo, bits + np.log2(np.maximum(left, 1)), bits)
                self.bits[a * s : b * s, li] = bits.reshape(-1)

    def _symbols(self, grams: np.ndarray) -> np.ndarray:
        return np.stack([self.symbol[(grams >> shift) & 255] for shift in (24, 16, 8, 0)], axis=1)

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths in bits: a row for each text, a column for each language."""
        out = np.zeros((len(texts), len(self.langs)))
        g, n = _grams(texts)
        some = np.flatnonzero(n)
        if not len(some):
            return out
        s = self.symbol
        x = s[(g >> 24)] * self.s
        x += s[(g >> 16) & 255]
        x *= self.s
        x += s[(g >> 8) & 255]
        at = self.index[x].astype(np.int64) * self.s
        at += s[g & 255]
        starts = (np.cumsum(n) - n)[some]
        for li in range(len(self.langs)):
            out[some, li] = np.add.reduceat(self.bits[:, li][at], starts, dtype=np.float64)
        return out


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_contexts: int = 20_000, max_languages: int = 256) -> Model:
    """The model of all texts of docs that have a language.

    The driver gets at most max_languages * 256 * max_contexts counts of full contexts, and of each language all of the shorter ones.
    """
    from txnlake.llm.store import written

    counts = written(count(docs, text_col, lang_col), "grams")
    langs = sorted(r[0] for r in counts.select("lang").distinct().limit(max_languages + 1).collect())
    if len(langs) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    shorter = counts.groupBy("lang", F.col("gram").bitwiseAND(F.lit(0xFFFFFF)).alias("gram")).agg(F.sum("n").alias("n"))
    top = counts.groupBy("lang", F.shiftright("gram", 8).alias("ctx")).agg(F.sum("n").alias("total"))
    if top.select("ctx").distinct().limit(max_contexts + 1).count() > max_contexts:
        # of each language its own most frequent, by turns; there are at most 256**3
        turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("total"), "ctx"))
        turns = top.withColumn("turn", turn).where(F.col("turn") <= max_contexts).groupBy("ctx").agg(F.min("turn").alias("turn"), F.sum("total").alias("total"))
        best = turns.orderBy("turn", F.desc("total"), "ctx").limit(max_contexts).select("ctx")
        counts = counts.withColumn("ctx", F.shiftright("gram", 8)).join(F.broadcast(best), "ctx", "left_semi").drop("ctx")

    def by_language(df: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
        table = df.select("lang", "gram", "n").toArrow()
        lang, gram, n = (table.column(c).to_numpy() for c in ("lang", "gram", "n"))
        return [(gram[lang == x], n[lang == x]) for x in langs]

    return Model(langs, by_language(counts), by_language(shorter))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[Column, ...] = ()) -> DataFrame:
    """(id_col, *keep, lang_pred, score, bits_per_byte): score is the language's posterior under even priors, tempered by length."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of bounded size
    names = [docs.select(c).columns[0] for c in keep]

    def run(batches):
        m = shared.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            preds, scores, rates = [], [], []
            for a, b in _pieces(texts):
                part = texts[a:b]
                bits = m.lengths([t or b"" for t in part])
                for t, row in zip(part, bits):
                    if t is None or not m.langs or not LETTER.search(t.decode("utf-8", "replace")):
                        preds.append("und")
                        scores.append(0.0)
                        rates.append(None)
                        continue
                    best = int(row.argmin())
                    preds.append(m.langs[best])
                    scores.append(float(1.0 / np.exp2(np.maximum(row[best] - row, -1000.0) / max(1.0, len(t) / 64)).sum()))
                    rates.append(float(row[best] / len(t)))
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())], names=[id_col, *names, "lang_pred", "score", "bits_per_byte"])

    rows = docs.select(F.col(id_col), *keep, F.col(text_col).cast("binary").alias("_text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double, bits_per_byte double")
