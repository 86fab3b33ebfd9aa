"""Benchmark decontamination: CGK random-walk embedding, bit-sampling LSH over item-sized windows, exact verification.

Items and documents are sequences of lower-case words. The CGK embedding copies a sequence while a random walk, driven by a hash of
the step and the word, decides where to advance; sequences at a small edit distance get embeddings at a small Hamming distance.
Bit-sampling then hashes a few coordinates of the embedding; windows of a document that share a hash with an item are candidates.
The number of walks is set by trial: items are edited at ``1 - similarity`` of their words, spread out or gathered at either end, and
walks are added until of each kind the share of edited copies that share a hash with their item reaches ``recall``. Items of a size
that ``max_walks`` walks don't bring there are all candidates of every window that passes the exact test below (``SizeClass.whole``).
A candidate is verified by the exact edit distance in words of the whole item to the best stretch around the window (bit-parallel
dynamic programming).

Words are runs of letters, digits and underscores; characters of scripts written without spaces are words of their own.

Items are walked part by part: from the first word of each of q parts in a row, from the middle of each, and from the last place
where a whole part is left. So every item is covered to its end, however long, and edits gathered in one place, or a document that
opens or ends inside an item, leave other parts whole.

Windows start at every word. Before the walks those are left out that cannot match a part: of q parts in a row one has at most the
q-th share of the edits, and a stretch within k edits has at most k words that no item of the class has. One part at least passes
that test, which is exact.

Items are sent to the executors in blocks of at most ``block`` rows; documents are never joined or shuffled.

Rows: items that are null or have fewer than ``min_words`` words are left out, being too short to tell; null and empty texts have no
leaks; repeated rows are reported one by one; repeated items each; null item ids are kept. Empty tables give no leaks. Texts are
searched whole. Other columns are ignored (leaks) or passed on (clean).
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranges of Thai to Burmese, Khmer, and Chinese and Japanese scripts.
SPACELESS = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0002ebef"
WORD = re.compile(rf"[^\W{SPACELESS}]+|[{SPACELESS}]")
STEPS = 64
PART = 15  # least words of a part where an item has several
OFFSET = 24
MULT = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    text = text or ""
    low = text.lower()
    # where lower-casing changes lengths, words keep their places in the original
    return WORD.findall(low) if len(low) == len(text) else [w.lower() for w in WORD.findall(text)]


def best_stretch(item: list[int], words: list[int]) -> tuple[int, int, int]:
    """(distance, start, end): the stretch of words nearest to item in edits; the first end that is least, then the longest stretch."""

    def ends(pattern, text):
        m = len(pattern)
        masks: dict[int, int] = {}
        for i, w in enumerate(pattern):
            masks[w] = masks.get(w, 0) | 1 << i
        full, top = (1 << m) - 1, 1 << (m - 1)
        pv, mv, score, best, at = full, 0, m, m, 0
        for j, w in enumerate(text, 1):
            eq = masks.get(w, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (~(xh | pv) & full)
            mh = pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            if score < best:
                best, at = score, j
            ph <<= 1
            mh <<= 1
            pv = (mh | ~(xv | ph)) & full
            mv = ph & xv & full
        return best, at

    distance, end = ends(item, words)
    if not end:
        return distance, 0, 0
    _, back = ends(item[::-1], words[:end][::-1])
    return distance, end - back, end


@dataclass
class SizeClass:
    items: list[int]
    size: int  # words of a part
    span: int  # words from a window's start that are looked at
    budget: int  # of those, so many may be unknown to the class
    steps: int
    known: np.ndarray  # by word number
    turns: np.ndarray  # (walks, words): bit j says whether the walk advances at step j
    samples: list[np.ndarray]  # of each walk: (samples, coordinates), steps in order
    keys: np.ndarray
    owner: np.ndarray  # item << OFFSET | the part's first word
    bitmap: np.ndarray
    whole: bool = False  # the walks don't reach the recall: every window is a candidate of every item


class Index:
    """Items of one block, ready to be looked up."""

    def __init__(self, items: list[tuple], similarity: float, recall: float, min_words: int, max_walks: int, seed: int = 7, samples: int = 6, coordinates: int = 3, trials: int = 400):
        self.similarity = similarity
        rng = np.random.default_rng(seed)
        kept = [(i, w) for i, w in ((i, words_of(t)) for i, t in items) if len(w) >= min_words]
        self.ids = [i for i, _ in kept]
        self.vocab = {w: n for n, w in enumerate(sorted({w for _, ws in kept for w in ws}), 1)}
        self.items = [[self.vocab[w] for w in ws] for _, ws in kept]
        self.kinds = [frozenset(x) for x in self.items]
        self.classes: list[SizeClass] = []
        self.reached = 1.0
        todo = sorted(range(len(kept)), key=lambda i: len(self.items[i]))
        while todo:
            least = len(self.items[todo[0]])
            own = [i for i in todo if len(self.items[i]) <= max(least + 1, least * 1.25)]
            todo = todo[len(own) :]
            self.classes.append(self._class(own, rng, recall, max_walks, samples, coordinates, trials))
        self.most = max((len(x) for x in self.items), default=0)
        self.pad = max((c.budget for c in self.classes), default=0) + 1

    def edits(self, n: int) -> int:
        return int((1 - self.similarity) * n + 1e-9)

    def _class(self, own, rng, recall, max_walks, samples, coordinates, trials) -> SizeClass:
        least, most = len(self.items[own[0]]), len(self.items[own[-1]])
        parts = max(1, least // PART)
        size = least // parts if parts > 1 else max(1, least - self.edits(least))
        budget = max(self.edits(len(self.items[i])) // max(1, len(self.items[i]) // size) for i in own)
        steps = min(STEPS, 2 * size)
        words = len(self.vocab) + 1
        known = np.zeros(words, bool)
        for i in own:
            known[self.items[i]] = True
        c = SizeClass(own, size, max(0, size - budget), budget, steps, known, np.zeros((0, words), np.uint64), [], np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1 << 20, bool))
        flat, starts = self._laid([self.items[i] for i in own])
        offsets = [self._offsets(len(self.items[i]), size) for i in own]
        windows = np.concatenate([a + o for a, o in zip(starts, offsets)])
        label = np.concatenate([(i << OFFSET) + o for i, o in zip(own, offsets)])
        head = np.cumsum([0, *map(len, offsets)])
        # edited copies, walked from where the parts have come to lie
        picked = rng.integers(0, len(own), min(trials, 40 * len(own)))
        kind = np.arange(len(picked)) % 3
        edited = [self._edited(self.items[own[n]], rng, k) for n, k in zip(picked, kind)]
        trial, trial_starts = self._laid([[w for w, _ in e] for e in edited])
        strange = np.concatenate([[0], np.cumsum(~known[trial])])
        place = np.concatenate([np.arange(head[n], head[n + 1]) for n in picked])
        laid = np.concatenate([a + self._moved(e, offsets[n]) for a, e, n in zip(trial_starts, edited, picked)])
        passes = strange[np.minimum(laid + c.span, len(trial))] - strange[laid] <= budget
        of = np.repeat(np.arange(len(picked)), [len(offsets[n]) for n in picked])
        hit, keys, owner = np.zeros(len(picked), bool), [], []
        reached = 0.0
        # unknown words of edited copies are numbered 0, as in documents
        while len(c.samples) < max_walks and (reached < recall or len(c.samples) < 4):
            c.turns = np.concatenate([c.turns, rng.integers(0, 1 << 63, (1, words), dtype=np.uint64) << np.uint64(1) | rng.integers(0, 2, (1, words), dtype=np.uint64)])
            early = np.stack([np.sort(rng.choice(max(coordinates + 1, int(steps * f)), coordinates, replace=False)) for f in np.linspace(0.3, 1.0, samples)])
            c.samples.append(early)
            k = self._walk(c, len(c.samples) - 1, flat, windows)
            t = self._walk(c, len(c.samples) - 1, trial, laid)
            hit[of[(k[:, place] == t).any(axis=0) & passes]] = True
            reached = min(float(hit[kind == x].mean()) for x in np.unique(kind))
            keys.append(k.reshape(-1))
            owner.append(np.tile(label, samples))
        c.whole = reached < recall
        self.reached = min(self.reached, 1.0 if c.whole else reached)
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(keys, kind="stable")
        c.keys, c.owner = keys[order], owner[order]
        c.bitmap[(c.keys >> np.uint64(44)).astype(np.int64)] = True
        return c

    @staticmethod
    def _offsets(n: int, size: int) -> np.ndarray:
        """The first words of the parts of an item of n words."""
        rows = np.arange(0, n - size + 1, size)
        mid = rows + size // 2
        return np.unique(np.concatenate([rows, mid[mid <= n - size], [n - size]]))

    def _edited(self, item: list[int], rng, kind: int) -> list[tuple[int, int]]:
        """(word, its place in the item, or -1) of a copy with all edits allowed: spread out, at the head or at the tail."""
        out = [(w, n) for n, w in enumerate(item)]
        k = self.edits(len(item))
        if not kind:
            for _ in range(k):
                at, how = int(rng.integers(0, max(1, len(out)))), int(rng.integers(0, 3))
                out[at : at + (how != 0)] = [(0, out[at][1] if how else -1)] if how != 1 else []
            return out
        new = []
        for w, n in out[:k] if kind == 1 else out[len(out) - k :]:
            new += [[(0, -1), (w, n)], [], [(0, n)]][int(rng.integers(0, 3))]
        return new + out[k:] if kind == 1 else out[: len(out) - k] + new

    @staticmethod
    def _moved(edited: list[tuple[int, int]], offsets: np.ndarray) -> np.ndarray:
        """Where in the copy the item's words at offsets, or the next ones left, stand."""
        own = np.array([(at, n) for at, (_, n) in enumerate(edited) if n >= 0], np.int64).reshape(-1, 2)
        return np.append(own[:, 0], len(edited))[np.searchsorted(own[:, 1], offsets)]

    def _laid(self, seqs: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Sequences one after the other with room for a walk's length between them."""
        gap = [0] * (STEPS + 1)
        starts = np.cumsum([0, *(len(s) + len(gap) for s in seqs)])[:-1]
        return np.array([w for s in seqs for w in (*s, *gap)], np.int64), starts

    def _walk(self, c: SizeClass, walk: int, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(samples, windows): the hashes of the sampled coordinates."""
        turns, sample = c.turns[walk], c.samples[walk]
        out = np.empty((len(sample), len(starts)), np.uint64)
        out[:] = (np.arange(len(sample), dtype=np.uint64) + np.uint64(1 + walk * 64))[:, None] * MULT
        at = starts.copy()
        for j in range(c.steps):
            w = flat[at]
            mixed = None
            for s in np.flatnonzero((sample == j).any(axis=1)):
                if mixed is None:
                    mixed = (w.astype(np.uint64) + np.uint64(j << 32)) * MULT
                    mixed ^= mixed >> np.uint64(29)
                out[s] = (out[s] ^ mixed) * MULT
                out[s] ^= out[s] >> np.uint64(31)
            at += ((turns[w] >> np.uint64(j)) & np.uint64(1)).astype(np.int64)
        return out * MULT

    def candidates(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window starts, items, first words of parts) whose hashes meet; flat ends with room for a walk."""
        found = []
        n = len(flat) - STEPS - 1
        for c in self.classes:
            strange = np.concatenate([[0], np.cumsum(~c.known[flat])])
            starts = np.flatnonzero(strange[c.span : n + c.span][:n] - strange[:n] <= c.budget) if n > 0 else np.zeros(0, np.int64)
            if c.whole:
                found += [np.stack([starts, np.full(len(starts), i << OFFSET)]) for i in c.items]
                continue
            for a in range(0, len(starts), 200_000):
                part = starts[a : a + 200_000]
                for walk in range(len(c.samples)):
                    keys = self._walk(c, walk, flat, part)
                    s, w = np.nonzero(c.bitmap[(keys >> np.uint64(44)).astype(np.int64)])
                    k = keys[s, w]
                    lo, hi = np.searchsorted(c.keys, k, "left"), np.searchsorted(c.keys, k, "right")
                    some = np.flatnonzero(hi > lo)
                    if len(some):
                        lo, hi, w = lo[some], hi[some], w[some]
                        size = hi - lo
                        pick = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                        found.append(np.unique(np.stack([part[np.repeat(w, size)], c.owner[pick]]), axis=1))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique(np.concatenate(found, axis=1), axis=1)
        return both[0], both[1] >> OFFSET, both[1] & ((1 << OFFSET) - 1)

    def search(self, texts: list[str | None]) -> list[list[tuple]]:
        """For each text its leaks: (item id, distance, start, end), places in code points."""
        out: list[list[tuple]] = [[] for _ in texts]
        if not self.items:
            return out
        get, none = self.vocab.get, itertools.repeat(0)
        words = [words_of(t) for t in texts]
        size = np.array([len(w) + self.pad for w in words])
        first = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()) + STEPS + self.most + 2, np.int64)
        for w, a in zip(words, first):
            flat[a : a + len(w)] = np.fromiter(map(get, w, none), np.int64, len(w))
        starts, items, offsets = self.candidates(flat)
        docs = np.searchsorted(first, starts, "right") - 1
        kinds = self.kinds
        best: dict[tuple[int, int], tuple] = {}
        seen: set[tuple[int, int, int]] = set()
        for start, item, doc in zip((starts - offsets).tolist(), items.tolist(), docs.tolist()):
            pattern = self.items[item]
            k = self.edits(len(pattern))
            # neighbouring windows share one stretch
            cell = (start - int(first[doc])) // max(1, len(pattern) // 2)
            if (doc, item, cell) in seen or best.get((doc, item), (1,))[0] == 0:
                continue
            a = max(0, cell * max(1, len(pattern) // 2) - len(pattern) - k)
            b = min(len(words[doc]), (cell + 1) * max(1, len(pattern) // 2) + 2 * len(pattern) + 2 * k)
            seen.add((doc, item, cell))
            near = flat[first[doc] + a : first[doc] + b].tolist()
            # every different word that is missing costs an edit
            if len(kinds[item].difference(near)) > k:
                continue
            d, s, e = best_stretch(pattern, near)
            if d <= k and ((doc, item) not in best or (d, a + s) < best[doc, item][:2]):
                best[doc, item] = (d, a + s, a + e)
        spans: dict[int, list] = {}
        for (doc, item), (d, s, e) in sorted(best.items()):
            if doc not in spans:
                text = texts[doc]
                low = text.lower()
                spans[doc] = [m.span() for m in WORD.finditer(low if len(low) == len(text) else text)]
            at = spans[doc]
            out[doc].append((self.ids[item], d, at[s][0], at[e - 1][1] if e > s else at[s][0]))
        return out


LEAK = "array<struct<item_id: long, distance: long, start: long, end: long>>"


def indexes(items: DataFrame, item_id: str, text_col: str, similarity: float, recall: float, min_words: int, max_walks: int, block: int) -> list[Index]:
    n = items.count()
    blocks = max(1, -(-n // block))
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.col(text_col).alias("t")).where(F.col("t").isNotNull())
    out = []
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b) if blocks > 1 else rows
        out.append(Index(sorted(((r.i, r.t) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])), similarity, recall, min_words, max_walks))
    return out


def annotated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", similarity: float = 0.8, recall: float = 0.95, min_words: int = 5, max_walks: int = 24, block: int = 20_000, only_clean: bool = False, name: str = "_leaks") -> DataFrame:
    """docs with a column of leaks; with only_clean, the rows without any, in the columns of docs."""
    columns = docs.columns
    at = columns.index(text_col)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
    out = docs
    for n, index in enumerate(indexes(items, item_id, item_text, similarity, recall, min_words, max_walks, block)):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # at most `block` items

        def run(batches, shared=shared, n=n):
            for batch in batches:
                texts = batch.column(at).to_pylist()
                leaks, held, size = [], [], 0
                for t in texts:
                    held.append(t)
                    size += len(t or "")
                    if size > 3_000_000:
                        leaks += shared.value.search(held)
                        held, size = [], 0
                leaks += shared.value.search(held)
                if only_clean:
                    yield batch.take(pa.array([i for i, x in enumerate(leaks) if not x], pa.int64()))
                    continue
                found = [[dict(zip(("item_id", "distance", "start", "end"), x)) for x in own] for own in leaks]
                if n:
                    found = [a + b for a, b in zip(batch.column(batch.num_columns - 1).to_pylist(), found)]
                cols = list(batch.columns)[: len(columns)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(found, kind)], names=[*columns, name])

        schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
        out = out.mapInArrow(run, schema if only_clean else f"{schema}, `{name}` {LEAK}")
    return out


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id_col, item_id, distance, start, end): one row for each document and item that it holds."""
    found = annotated(docs.select(id_col, text_col), items, text_col, **options)
    return found.select(id_col, F.explode("_leaks").alias("x")).select(id_col, "x.item_id", "x.distance", "x.start", "x.end")


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that hold no item."""
    return annotated(docs, items, text_col, only_clean=True, **options)
