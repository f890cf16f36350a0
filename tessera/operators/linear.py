"""Ridge regression on dense features.

Objective ``F(b) = 1/n * sum (y - <x, b>)^2 + lam * |b|^2`` (no intercept),
minimised by gradient descent with backtracking line search.

One pass collects the sufficient statistics (n, X'X, X'y, y'y), whatever the
number of features; every later step (objective, gradient, line search, the
whole lambda sweep) is exact arithmetic on that d x d summary, so training costs
one Spark job however many iterations run.  The summary is made of long-form
cells: tasks multiply blocks of columns of their rows (``gram_cells``), and the
cells are summed by key.  ``train_ridge_passes`` is there for data so wide that
the driver cannot hold d x d numbers: two aggregate passes per iteration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import share_code

#: Columns of one block of the cross product.
BLOCK = 64
#: Bytes of cells that a task sums up at a time; wider data is read once per slab of that size.
SLAB_BYTES = 256 << 20
#: Columns up to which the products are columns of one generated aggregate,
#: which needs no Python workers; the cells are the same.
GENERATED = 4
LINE_SEARCH_A = 0.2
LINE_SEARCH_B = 0.6


def _sum(terms: list[Column]) -> Column:
    """Sum as a balanced tree: hundreds of terms stay shallow."""
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def predict(x_cols: list[str], beta) -> Column:
    """``<x, beta>`` as a Column (beta is a short driver-side vector)."""
    return _sum([F.col(c) * F.lit(float(b)) for c, b in zip(x_cols, beta)])


def squared_error(x_cols, y: str, beta) -> Column:
    r = F.col(y) - predict(x_cols, beta)
    return r * r


def ridge_objective(df: DataFrame, x_cols, y: str, beta, lam: float) -> DataFrame:
    """One row ``objective`` = mean squared error + lam * |beta|^2."""
    reg = lam * float(np.dot(beta, beta))
    return df.agg((F.avg(squared_error(x_cols, y, beta)) + F.lit(reg)).alias("objective"))


def ridge_gradient(df: DataFrame, x_cols, y: str, beta, lam: float) -> DataFrame:
    """``(idx, gradient)``: mean of -2 (y - <x,b>) x_i, plus 2 lam b_i."""
    r = F.col("_r")  # computed once a row, below the aggregate
    aggs = [(F.avg(F.lit(-2.0) * r * F.col(c)) + F.lit(2.0 * lam * float(b))).alias(f"g{i}")
            for i, (c, b) in enumerate(zip(x_cols, beta))]
    wide = df.select(*x_cols, (F.col(y) - predict(x_cols, beta)).alias("_r")).agg(*aggs)
    stack = ", ".join(f"{i}, g{i}" for i in range(len(x_cols)))
    return wide.selectExpr(f"stack({len(x_cols)}, {stack}) AS (idx, gradient)")


def mse(df: DataFrame, x_cols, y: str, beta) -> DataFrame:
    """One row ``mse``: the objective with lam = 0."""
    return df.agg(F.avg(squared_error(x_cols, y, beta)).alias("mse"))


# --------------------------------------------------------------------------
# sufficient statistics

def moments(df: DataFrame, x_cols, y: str, by: tuple[str, ...] = ()) -> DataFrame:
    """One aggregate pass: n and all sums of products of [x..., y]."""
    cols = list(x_cols) + [y]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(F.sum(F.col(a) * F.col(b)).alias(f"m__{a}__{b}"))
    return df.groupBy(*by).agg(*aggs)


def gram_cells(df: DataFrame, x_cols, y: str, by: str | None = None, block: int = BLOCK,
               slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """Cells of the cross product of ``[x..., y]``: ``(by?, i_block, j_block,
    i, j, s, n)`` for i <= j, with ``s = sum z_i z_j`` and ``n`` the rows.

    Tasks multiply column blocks of their Arrow batches, add up and give one
    row per cell; those rows are summed by key, so only cells move.  Columns
    are taken in slabs of ``slab_bytes`` of cells, each a pass over the data.
    A null counts as 0 in the products and its row in ``n``, as in ``moments``.
    """
    cols = [*x_cols, y]
    d = len(cols)
    keys = [by] if by else []
    if d <= GENERATED:
        row = moments(df, x_cols, y, by=tuple(keys))
        cells = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"m__{a}__{cols[j]}").alias("s"))
                 for i, a in enumerate(cols) for j in range(i, d)]
        flat = row.select(*keys, "n", F.explode(F.array(*cells)).alias("c"))
        return flat.select(*keys, *[F.floor(F.col(f"c.{c}") / block).cast("int").alias(f"{c}_block") for c in "ij"], "c.i", "c.j", "c.s", "n")

    share_code(df.sparkSession)
    rows = df.select(*keys, *[F.col(c).cast("double").alias(f"z{k}") for k, c in enumerate(cols)])
    key_type = f"{by} {df.schema[by].dataType.simpleString()}, " if by else ""
    schema = f"{key_type}i_block int, j_block int, i int, j int, s double, n long"
    blocks = list(range(0, d, block))
    per_slab = max(1, slab_bytes // (8 * d * block))
    slabs = [blocks[k:k + per_slab] for k in range(0, len(blocks), per_slab)]
    parts = [rows.mapInArrow(_products(slab, d, block, by is not None), schema) for slab in slabs]
    cells = parts[0]
    for more in parts[1:]:
        cells = cells.unionByName(more)
    return cells.groupBy(*keys, "i_block", "j_block", "i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def _products(slab: list[int], d: int, block: int, keyed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        kind = None
        for batch in batches:
            first = batch.column(0) if keyed else None
            kind = first.type if keyed else None
            for key in (pc.unique(first).to_pylist() if keyed else [None]):
                part = batch
                if keyed:
                    part = batch.filter(pc.is_null(first) if key is None else pc.fill_null(pc.equal(first, pa.scalar(key, kind)), False))
                z = np.stack([c.fill_null(0.0).to_numpy() for c in part.columns[int(keyed):]], axis=1)
                held = sums.setdefault(key, {"n": 0})
                held["n"] += len(z)
                for at in slab:
                    for other in range(at, d, block):
                        product = z[:, at:at + block].T @ z[:, other:other + block]
                        held[at, other] = held[at, other] + product if (at, other) in held else product
        for key, held in sums.items():
            n = held.pop("n")
            for (at, other), cells in held.items():
                i, j = (x.ravel() for x in np.indices(cells.shape))
                keep = at + i <= other + j
                i, j = (at + i)[keep], (other + j)[keep]
                cols = [pa.array(x.astype(np.int32)) for x in (i // block, j // block, i, j)]
                cols += [pa.array(cells.ravel()[keep]), pa.array(np.full(len(i), n, np.int64))]
                names = ["i_block", "j_block", "i", "j", "s", "n"]
                if keyed:
                    cols, names = [pa.array([key] * len(i), kind), *cols], ["key", *names]
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


@dataclass
class Gram:
    """Second moments divided by n: ``xx = X'X/n``, ``xy = X'y/n``, ``yy = y'y/n``."""
    n: int
    xx: np.ndarray
    xy: np.ndarray
    yy: float

    @classmethod
    def from_cells(cls, cells, d: int) -> "Gram":
        """From the rows of ``gram_cells`` over ``d`` features."""
        z = np.zeros((d + 1, d + 1))
        n = 0
        for r in cells:
            n = int(r["n"])
            z[r["i"], r["j"]] = z[r["j"], r["i"]] = (r["s"] or 0.0) / n
        return cls(n, z[:d, :d], z[:d, d], float(z[d, d]))

    def objective(self, beta, lam: float) -> float:
        beta = np.asarray(beta, float)
        return float(self.yy - 2 * beta @ self.xy + beta @ self.xx @ beta + lam * beta @ beta)

    def gradient(self, beta, lam: float) -> np.ndarray:
        beta = np.asarray(beta, float)
        return -2 * self.xy + 2 * self.xx @ beta + 2 * lam * beta


def gram(df: DataFrame, x_cols, y: str) -> Gram:
    """Collects the d x d summary, whose size does not depend on the rows."""
    return Gram.from_cells(gram_cells(df, x_cols, y).collect(), len(x_cols))


def backtracking(f0: float, grad_sq: float, f_of_t, a: float = LINE_SEARCH_A,
                 b: float = LINE_SEARCH_B) -> tuple[float, int]:
    """First ``t = b^k`` with ``f(t) <= f0 - a t |g|^2``.

    The trials have no bound; they end by themselves, at the latest where
    ``t`` is so small that ``beta - t g`` is ``beta``.  Not-a-number values,
    which pass no test, end with the step 0.0.
    """
    k = 0
    while (t := b ** k) > 0.0:
        if f_of_t(t) <= f0 - a * t * grad_sq:
            return t, k
        k += 1
    return 0.0, k


def backtracking_step(g: Gram, beta, lam: float) -> dict:
    beta = np.asarray(beta, float)
    grad = g.gradient(beta, lam)
    f0 = g.objective(beta, lam)
    t, k = backtracking(f0, float(grad @ grad), lambda t: g.objective(beta - t * grad, lam))
    return {"step": t, "k": k, "objective_before": f0,
            "objective_after": g.objective(beta - t * grad, lam)}


@dataclass
class RidgeFit:
    beta: np.ndarray
    grad_norm: float
    iterations: int
    converged: bool
    history: list = field(default_factory=list)


def train_ridge_gram(g: Gram, lam: float, max_iter: int = 100, eps: float = 0.01,
                     beta0=None) -> RidgeFit:
    """Gradient descent on the summary: at most ``max_iter`` updates; the
    reported gradient norm belongs to the returned beta."""
    d = g.xx.shape[0]
    beta = np.zeros(d) if beta0 is None else np.asarray(beta0, float)
    history = []
    k = 0
    while True:
        grad = g.gradient(beta, lam)
        norm = float(np.sqrt(grad @ grad))
        f0 = g.objective(beta, lam)
        history.append((k, f0, norm))
        if norm < eps or k >= max_iter:
            break
        t, _ = backtracking(f0, norm * norm, lambda t: g.objective(beta - t * grad, lam))
        if t == 0.0 or g.objective(beta - t * grad, lam) >= f0:  # no further descent in double precision
            break
        beta = beta - t * grad
        k += 1
    return RidgeFit(beta, norm, k, norm < eps, history)


def train_ridge_passes(df: DataFrame, x_cols, y: str, lam: float, max_iter: int = 100,
                       eps: float = 0.01, beta0=None) -> RidgeFit:
    """Gradient descent for wide data: two aggregate passes per iteration."""
    d = len(x_cols)
    beta = np.zeros(d) if beta0 is None else np.asarray(beta0, float)
    history = []
    k = 0
    while True:
        r = F.col(y) - predict(x_cols, beta)
        row = df.agg(F.avg(r * r).alias("f"),
                     *[F.avg(F.lit(-2.0) * r * F.col(c)).alias(f"g{i}") for i, c in enumerate(x_cols)]).first()
        grad = np.array([row[f"g{i}"] for i in range(d)]) + 2 * lam * beta
        f0 = row["f"] + lam * float(beta @ beta)
        norm = float(np.sqrt(grad @ grad))
        history.append((k, f0, norm))
        if norm < eps or k >= max_iter:
            break
        h = predict(x_cols, grad)
        q = df.agg(F.avg(r * r).alias("rr"), F.avg(r * h).alias("rh"), F.avg(h * h).alias("hh")).first()
        bb, bg, gg = float(beta @ beta), float(beta @ grad), float(grad @ grad)

        def f_of_t(t):  # mean (r + t h)^2 + lam |beta - t grad|^2
            return (q["rr"] + 2 * t * q["rh"] + t * t * q["hh"]
                    + lam * (bb - 2 * t * bg + t * t * gg))
        t, _ = backtracking(f0, norm * norm, f_of_t)
        if t == 0.0 or f_of_t(t) >= f0:  # no further descent in double precision
            break
        beta = beta - t * grad
        k += 1
    return RidgeFit(beta, norm, k, norm < eps, history)


def train_ridge(df: DataFrame, x_cols, y: str, lam: float, max_iter: int = 100,
                eps: float = 0.01, beta0=None) -> RidgeFit:
    return train_ridge_gram(gram(df, x_cols, y), lam, max_iter, eps, beta0)


def beta_frame(spark, beta) -> DataFrame:
    """A model as ``(idx, value)`` rows."""
    return spark.createDataFrame([(i, float(b)) for i, b in enumerate(beta)], "idx int, value double")


def lambda_sweep(df: DataFrame, x_cols, y: str, split: str, lams, max_iter: int = 100,
                 eps: float = 0.01) -> list[dict]:
    """Train per lambda on rows with ``split`` false, test on rows with it true.

    One pass keyed by the split column yields both summaries; every lambda is then solved and scored from them.  Rows with a null split
    belong to neither side.
    """
    known = df.where(F.col(split).isNotNull())
    cells: dict[bool, list] = {False: [], True: []}
    for r in gram_cells(known, x_cols, y, split).collect():
        cells[bool(r[split])].append(r)
    train = Gram.from_cells(cells[False], len(x_cols))
    test = Gram.from_cells(cells[True], len(x_cols)) if cells[True] else None
    out = []
    for lam in lams:
        fit = train_ridge_gram(train, float(lam), max_iter, eps)
        out.append({"lam": float(lam), "iterations": fit.iterations, "grad_norm": fit.grad_norm,
                    "train_objective": train.objective(fit.beta, float(lam)),
                    "test_mse": test.objective(fit.beta, 0.0) if test else None,
                    "beta": fit.beta})
    return out


def numeric_gradient(df: DataFrame, x_cols, y: str, beta, lam: float, delta: float) -> DataFrame:
    """Forward difference ``(F(b + delta e_i) - F(b)) / delta`` for every i.

    With r = y - <x,b>, ``F(b + delta e_i) - F(b)`` expands to
    ``(-2 delta sum r x_i + delta^2 sum x_i^2) / n + lam (2 delta b_i + delta^2)``,
    so all coordinates come from one aggregate pass without cancellation.
    """
    r = F.col("_r")
    aggs = []
    for i, (c, b) in enumerate(zip(x_cols, beta)):
        diff = (F.avg(F.lit(-2.0 * delta) * r * F.col(c) + F.lit(delta * delta) * F.col(c) * F.col(c))
                + F.lit(lam * (2 * delta * float(b) + delta * delta)))
        aggs.append((diff / F.lit(delta)).alias(f"g{i}"))
    wide = df.select(*x_cols, (F.col(y) - predict(x_cols, beta)).alias("_r")).agg(*aggs)
    stack = ", ".join(f"{i}, g{i}" for i in range(len(x_cols)))
    return wide.selectExpr(f"stack({len(x_cols)}, {stack}) AS (idx, gradient)")
