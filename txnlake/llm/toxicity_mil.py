"""Toxicity by multiple-instance learning: documents are bags of sentences, labels are known for bags only.

A sentence's probability is logistic in the weights of its words and their first four letters; a document's is the noisy-or of its
sentences, 1 - prod(1 - p). Weights are fitted to document labels by the gradient of the documents' log loss through the noisy-or,
so blame settles on the sentences that set toxic documents apart, and those are reported with their places.

The classifier is fitted on the whole texts of at most ``max_train`` labelled documents for each class, chosen by a hash of the id. One
task fits it, whose memory grows with their words. Scoring reads whole texts.

Sentences end at a line break or at a word that ends with . ! or ?. Words are split at white space, lower-cased and stripped of
punctuation. What holds no word is no sentence, so blank lines, rules and the layout of a text change nothing.

Rows: null and empty texts have no sentence and score 0; repeated rows are scored alike; labels for one id that differ count as the
largest; labels that are null or not 0 or 1 are ignored. With no labels of both classes, scores are near 0. An empty table gives no
rows. Columns other than id and text are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENDS = (".", "!", "?")
EDGES = re.compile(r"^\W+|\W+$")
PIECES = re.compile(r"\n|\S+")
SIZE = 1 << 30  # so wide that words rarely share a feature with one that counts
CACHE_ENTRIES = 400_000
NO_BIAS = -12.0


def features(token: str) -> list[int]:
    """Hashed features of a lower-case token: its word and the word's first four letters."""
    word = EDGES.sub("", token)
    if not word:
        return []
    out = [zlib.crc32(word.encode("utf-8", "replace")) % SIZE]
    if len(word) > 4:
        out.append(zlib.crc32(f"^{word[:4]}".encode("utf-8", "replace")) % SIZE)
    return out


def _tokens(text: str | None) -> list[str]:
    return (text or "").lower().replace("\n", " . ").split() or ["."]


@dataclass
class Model:
    bias: float
    weights: dict[int, float]

    def __post_init__(self):
        self.known: dict[str, int] = {}  # a token's place in `facts`
        self.facts = np.zeros((3, 0))

    def _remember(self, tokens: set[str]) -> None:
        """Weight, whether it is a word, and whether a sentence ends with it, for each token."""
        rows = []
        for t in tokens:
            found = features(t)
            rows.append((sum(self.weights.get(f, 0.0) for f in found), float(bool(found)), float(t.endswith(ENDS))))
        at = len(self.known)
        if at + len(rows) > self.facts.shape[1]:
            self.facts = np.concatenate([self.facts[:, :at], np.zeros((3, at + 2 * len(rows)))], axis=1)
        self.facts[:, at : at + len(rows)] = np.array(rows).reshape(-1, 3).T
        self.known.update(zip(tokens, range(at, at + len(rows))))

    def values(self, docs: list[list[str]]) -> np.ndarray:
        """Those facts of all tokens in a row."""
        new = {t for d in docs for t in d} - self.known.keys()
        if len(self.known) + len(new) > CACHE_ENTRIES:
            self.known, self.facts = {}, np.zeros((3, 0))
            new = {t for d in docs for t in d}
        self._remember(new)
        get = self.known.__getitem__
        return self.facts[:, np.fromiter((v for d in docs for v in map(get, d)), np.int64, sum(map(len, docs)))]

    def scores(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Noisy-or of each document, and its largest sentence probability. Every document has a token."""
        weight, word, ends = self.values(docs)
        stop = np.cumsum([len(d) for d in docs])
        ends = ends > 0
        ends[stop - 1] = True
        last = np.flatnonzero(ends)
        starts = np.concatenate([[0], last[:-1] + 1])
        z = np.where(np.add.reduceat(word, starts) > 0, self.bias + np.add.reduceat(weight, starts), -np.inf)
        first = np.searchsorted(last, np.concatenate([[0], stop[:-1]]))
        quiet = np.add.reduceat(-np.logaddexp(0, z), first)  # sum of log(1 - p)
        top = np.maximum.reduceat(z, first)
        return 0.0 - np.expm1(quiet), 1 / (1 + np.exp(-np.clip(top, -500, 500)))

    def sentences(self, text: str, least: float) -> list[dict]:
        """The sentences with at least that probability: places in code points, end exclusive."""
        out, start, end, z, words = [], None, 0, self.bias, 0

        def close():
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            if words and p >= least:
                out.append({"start": start, "end": end, "score": float(p)})

        for m in PIECES.finditer(text):
            token = m.group().lower()
            if token == "\n":
                close()
                start, z, words = None, self.bias, 0
                continue
            start, end = m.start() if start is None else start, m.end()
            found = features(token)
            words += len(found)
            z += sum(self.weights.get(f, 0.0) for f in found)
            if token.endswith(ENDS):
                close()
                start, z, words = None, self.bias, 0
        close()
        return out


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_train: int) -> DataFrame:
    """(id, y, f, s): label, features and sentence starts of the chosen documents, of which there are at most max_train for each class."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    parts = [known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(max_train) for y in (0, 1)]
    own = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    rows = own.join(F.broadcast(parts[0].unionByName(parts[1])), F.col("_doc") == F.col("_id")).select("_id", "_y", "_text")

    def run(batches):
        for batch in batches:
            feats, starts = [], []
            for text in batch.column(2).to_pylist():
                f, s, new = [], [], True
                for t in _tokens(text):
                    found = features(t)
                    if new and found:
                        s.append(len(f))
                        new = False
                    f += found
                    new = new or t.endswith(ENDS)
                feats.append(f)
                starts.append(s)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(feats, kind), pa.array(starts, kind)], names=["id", "y", "f", "s"])

    kind = dict(rows.dtypes)["_id"]
    return rows.mapInArrow(run, f"id {kind}, y int, f array<int>, s array<int>")


def fit(bags: list[tuple[int, np.ndarray, np.ndarray]], rounds: int = 200, rate: float = 0.3, l1: float = 1e-3, least_count: int = 4, least_evidence: float = 16.0) -> Model:
    """Noisy-or loss minimised by Adam with soft thresholds.

    Features need least_count different sentences of toxic documents and a likelihood-ratio statistic of least_evidence against chance.
    """
    y = np.array([b[0] for b in bags])
    if not len(y) or y.min() == y.max():
        return Model(NO_BIAS, {})
    names = np.unique(np.concatenate([b[1] for b in bags]))
    bags = [(y_, np.searchsorted(names, f), s) for y_, f, s in bags]
    # in how many different sentences of each class a feature stands: copies of a document are no further evidence
    found: list[set] = [set(), set()]
    for label, feats, starts in bags:
        for part in np.split(feats, starts[1:]):
            found[label].add(np.unique(part).tobytes())
    both = [[np.frombuffer(x, feats.dtype) for x in f] for f in found]
    df = [np.bincount(np.concatenate([*f, feats[:0]]).astype(np.int64), minlength=len(names)) for f in both]
    n = [max(1, len(f)) for f in both]
    odds = np.log((df[1] + 0.5) / (n[1] + 1)) - np.log((df[0] + 0.5) / (n[0] + 1))
    share = (df[0] + df[1]) / sum(n)
    with np.errstate(divide="ignore", invalid="ignore"):
        evidence = sum(np.where(d > 0, d * np.log(d / (share * k)), 0.0) for d, k in zip(df, n))
    use = np.flatnonzero((df[1] >= least_count) & (odds > 1) & (2 * evidence > least_evidence))
    slot = np.full(len(names), -1)
    slot[use] = np.arange(len(use))
    # entries (sentence, feature) of the features in use; sentences of all bags in a row
    count = np.array([len(b[2]) for b in bags])
    base = np.cumsum(count) - count
    rows, cols = [], []
    for b, first in zip(bags, base):
        at = slot[b[1]]
        hit = np.flatnonzero(at >= 0)
        rows.append(first + np.searchsorted(b[2], hit, "right") - 1)
        cols.append(at[hit])
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    total, bag = int(count.sum()), np.repeat(np.arange(len(bags)), count)
    w, bias = np.zeros(len(use)), -4.0
    w += np.clip(odds[use], 0, 3)
    m, v = np.zeros(len(use) + 1), np.zeros(len(use) + 1)
    for k in range(1, rounds + 1):
        z = bias + np.bincount(rows, w[cols], total)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        quiet = np.bincount(bag, np.log1p(-np.minimum(p, 1 - 1e-12)), len(bags))
        prob = np.maximum(-np.expm1(quiet), 1e-9)
        pull = np.where(y == 1, -(1 - prob) / prob, 1.0) / len(bags)
        dz = pull[bag] * p
        g = np.append(np.bincount(cols, dz[rows], len(use)), dz.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        w -= step[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1 * 10, 0)
        bias = float(np.clip(bias - step[-1], -12, 0))
    return Model(bias, {int(names[use[i]]): float(w[i]) for i in np.flatnonzero(w)})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_train: int = 3000) -> Model:
    """The model of a bounded sample, fitted in one task; the driver gets the weights alone."""

    def run(batches):
        parts = list(batches)
        bags = []
        if parts:
            table = pa.Table.from_batches(parts).sort_by([("id", "ascending")])
            bags = [(y.as_py(), f.values.to_numpy(), s.values.to_numpy()) for y, f, s in zip(table.column("y"), table.column("f"), table.column("s"))]
        m = fit(bags)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *m.weights], pa.int64()), pa.array([m.bias, *m.weights.values()], pa.float64())], names=["feature", "weight"])

    rows = sample(docs, labels, id_col, text_col, label_col, max_train)
    found = {r.feature: r.weight for r in rows.repartition(1).mapInArrow(run, "feature long, weight double").collect()}
    return Model(found.pop(-1, NO_BIAS), found)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[Column, ...] = (), least: float = 0.5) -> DataFrame:
    """(id_col, *keep, score, predicted, sentences): sentences with a probability of at least `least`, of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # weights of what the bounded sample has
    names = [docs.select(c).columns[0] for c in keep]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            scores, spans = [], []
            held, size, first = [], 0, 0

            def flush():
                p, top = model.scores(held)
                scores.extend(p.tolist())
                spans.extend(model.sentences(t or "", least) if s >= least * 0.999 else [] for t, s in zip(texts[first : first + len(held)], top))

            for i, t in enumerate(texts):
                held.append(_tokens(t))
                size += len(held[-1])
                if size > 400_000 or i == len(texts) - 1:
                    flush()
                    first, held, size = i + 1, [], 0
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            predicted = pa.array([int(s >= 0.5) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(scores, pa.float64()), predicted, pa.array(spans, kind)], names=[id_col, *names, "score", "predicted", "sentences"])

    rows = docs.select(F.col(id_col), *keep, F.col(text_col).alias("_text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"{schema}, score double, predicted int, sentences array<struct<start: long, end: long, score: double>>")


def harmless(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs whose score is below 0.5, in the columns of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # weights of what the bounded sample has
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            keep, held, rows, size = [], [], [], 0
            for i, t in enumerate(batch.column(at).to_pylist()):
                held.append(_tokens(t))
                rows.append(i)
                size += len(held[-1])
                if size > 400_000 or i == batch.num_rows - 1:
                    keep += np.array(rows)[shared.value.scores(held)[0] < 0.5].tolist()
                    held, rows, size = [], [], 0
            yield batch.take(pa.array(keep, pa.int64()))

    return docs.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes))
