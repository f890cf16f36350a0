"""Quality classifier: a generalised additive model with pairwise terms.

Each feature of a text has a lookup table over its bins and a few chosen pairs
of features have two-dimensional tables.  The tables are learnt by cyclic
boosting: one feature at a time, a tree of few leaves is fitted to the
gradients summed per bin and added at a small rate.  A score is the sigmoid of
the added table entries.

Fitting uses at most ``TRAIN_ROWS`` labelled rows, taken in hash order of their
id (the documented bound); only ids, labels and features of these rows reach
the driver.  Scores are computed for all rows inside the scan.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from .common import per_batch

TRAIN_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE, LEAVES = 150, 60, 0.1, 3
FOLDS, HELD_FOLD = 3, 1

#: Byte classes whose share of a text is a feature.
CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789",
    "stop": b".?", "comma": b",;:", "shout": b"!", "bar": b"|", "mark": b"#$%&*+=@^~\\_", "bracket": b"<>{}[]()/",
    "space": b" \t", "line": b"\n\r", "high": bytes(range(128, 256)),
}
_CLASS = np.zeros((256, len(CLASSES)))
for _k, _v in enumerate(CLASSES.values()):
    _CLASS[list(_v), _k] = 1
FEATURES = [f"share_{c}" for c in CLASSES] + [
    "log_bytes", "log_words", "word_length", "distinct_words", "repeated_next", "repeated_second",
    "log_lines", "distinct_lines", "line_words", "long_words", "capital_words", "marked_words"]


def features(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` per text; an empty text gives zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    k = len(CLASSES)
    for row, text in zip(out, texts):
        if not text:
            continue
        raw = np.frombuffer(text.encode(), np.uint8)
        row[:k] = np.bincount(raw, minlength=256) @ _CLASS / len(raw)
        row[k] = np.log1p(len(raw))
        words = text.split()
        n = len(words)
        if not n:
            continue
        lines = text.split("\n")
        lengths = np.fromiter(map(len, words), np.int64, n)
        row[k + 1:] = (
            np.log1p(n), lengths.mean(), len(set(words)) / n,
            sum(map(operator.eq, words, words[1:])) / n, sum(map(operator.eq, words, words[2:])) / n,
            np.log1p(len(lines)), len(set(lines)) / len(lines), n / len(lines), (lengths > 20).mean(),
            sum(map(str.isupper, words)) / n, 1 - sum(map(str.isalpha, words)) / n)
    return out


def _leaves(grad: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """Step per bin of a tree of at most ``leaves`` leaves over ordered bins."""
    parts = [(0, len(grad))]
    g, w = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(weight)])
    value = lambda a, b: (g[b] - g[a]) ** 2 / (w[b] - w[a] + 1.0)
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for p, (a, b) in enumerate(parts):
            if b - a > 1:
                cut = np.arange(a + 1, b)
                gain = ((g[cut] - g[a]) ** 2 / (w[cut] - w[a] + 1.0) + (g[b] - g[cut]) ** 2 / (w[b] - w[cut] + 1.0)) - value(a, b)
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], p, int(cut[at]))
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    step = np.zeros(len(grad))
    for a, b in parts:
        step[a:b] = (g[b] - g[a]) / (w[b] - w[a] + 1.0)
    return step


def _quadrants(grad: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree of one cut on each side over a square of bins: gain, step per cell."""
    cg, cw = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (grad, weight))
    n, m = grad.shape
    best = (-1.0, np.zeros_like(grad))
    for a in range(1, n):
        for b in range(1, m):
            gain, step = 0.0, np.zeros_like(grad)
            for r, s in ((slice(0, a), (0, a)), (slice(a, n), (a, n))):
                for c, t in ((slice(0, b), (0, b)), (slice(b, m), (b, m))):
                    gs = cg[s[1], t[1]] - cg[s[0], t[1]] - cg[s[1], t[0]] + cg[s[0], t[0]]
                    ws = cw[s[1], t[1]] - cw[s[0], t[1]] - cw[s[1], t[0]] + cw[s[0], t[0]]
                    gain += gs * gs / (ws + 1.0)
                    step[r, c] = gs / (ws + 1.0)
            if gain > best[0]:
                best = (gain, step)
    return best


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; ``score`` adds the entries of a row's bins."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def coarse(self, bins: np.ndarray, j: int) -> np.ndarray:
        return bins[:, j] * PAIR_BINS // (len(self.edges[j]) + 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.edges and len(x):
            b = self.bins(x)
            for j, table in enumerate(self.tables):
                total += table[b[:, j]]
            for i, j, table in self.pairs:
                total += table[self.coarse(b, i), self.coarse(b, j)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(x), -500, 500)))


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting on features ``x`` and labels ``y`` (0 or 1).  Without
    rows every score is 0.5; with one class it is the smoothed share."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    model = AdditiveModel(base=float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    b = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in sizes]
    total = np.full(len(y), model.base)

    def gradient():
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, size in enumerate(sizes):
            if size > 1:
                g, w = gradient()
                step = RATE * _leaves(np.bincount(b[:, j], g, size), np.bincount(b[:, j], w, size), LEAVES)
                model.tables[j] += step
                total += step[b[:, j]]
    # pairs whose best two-cut tree explains most of what is left
    coarse = [model.coarse(b, j) for j in range(len(sizes))]
    square = lambda v, i, j: np.bincount(coarse[i] * PAIR_BINS + coarse[j], v, PAIR_BINS ** 2).reshape(PAIR_BINS, PAIR_BINS)
    g, w = gradient()
    ranked = sorted(((_quadrants(square(g, i, j), square(w, i, j))[0], i, j)
                     for i in range(len(sizes)) for j in range(i) if sizes[i] > 1 and sizes[j] > 1), reverse=True)[:PAIRS]
    model.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in ranked]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            g, w = gradient()
            step = RATE * _quadrants(square(g, i, j), square(w, i, j))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return model


def held_out(id_col: str = "doc_id"):
    """Rows never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", most: int = TRAIN_ROWS) -> DataFrame:
    """``(text, y)`` of at most ``most`` labelled rows outside the held-out fold."""
    label = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).cast("long").alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y")))
    ids = docs.select(F.col(id_col).cast("long").alias("_id"))
    picked = label.join(ids, "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(most)
    # at most `most` rows of two numbers: safe to broadcast at any input size
    return (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(picked), "_id").dropDuplicates(["_id"]).select("_id", "text", "y"))


def fit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> AdditiveModel:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features([t or "" for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array(list(x), pa.list_(pa.float64())), batch.column("y")], ["_id", "x", "y"])

    label_docs = training_rows(docs, labels, id_col, text_col, label_col)
    rows = sorted(label_docs.mapInArrow(per_batch(run), "_id long, x array<double>, y int").collect())
    return fit(np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES)), np.array([r.y for r in rows], float))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``.

    Labels, source, language and id are no inputs of a score.  Null and empty
    texts are scored like any other (all features zero); rows repeat as they
    come; a null id is not held out.
    """
    model = fit_documents(docs, labels, id_col, text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = model.score(features([t or "" for t in batch.column("text").to_pylist()]))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        held_out(id_col).alias("held_out"))
            .mapInArrow(per_batch(run), "doc_id long, held_out boolean, score double, predicted int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted good, all columns kept."""
    model = fit_documents(docs, labels, id_col, text_col)

    @pandas_udf("boolean")
    def good(texts):
        import pandas as pd

        return pd.Series(model.score(features([t or "" for t in texts])) >= 0.5)

    return docs.where(good(F.col(text_col)))
