"""Sparse logistic regression on long-form examples.

Data: ``(row_id, label, feature, value)`` plus a rows table ``(row_id, label)``
(so that examples without features still count), labels in {-1, +1}.
Model and gradient: ``(feature, value)`` DataFrames -- they grow with the
vocabulary, so they are never collected.  Single passes leave joins with them
to AQE (broadcast below the measured-size threshold, skew-split otherwise).
Training broadcasts the model and the per-row coefficients while their exact
counts are bounded, and beyond that deals the examples once into a grid of row
blocks and feature blocks (``GridProducts``).

Objective ``L(b) = sum ln(1 + exp(-y <b, x>)) + lam |b|^2`` (a sum).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import log1p_exp_neg, logistic_coefficient
from ..plans.grid import COL, ROW, PackedGrid
from ..plans.iterate import Materializer
from ..plans.joins import broadcast_if_bounded, measured
from .linear import LINE_SEARCH_A, LINE_SEARCH_B


def feature_universe(data: DataFrame) -> DataFrame:
    return data.select("feature").distinct()


def dataset_summary(data: DataFrame, rows: DataFrame) -> DataFrame:
    n_features = data.agg(F.count_distinct("feature")).scalar()
    return rows.agg(F.count(F.lit(1)).alias("n_points"), n_features.alias("n_features"))


def margins(data: DataFrame, rows: DataFrame, beta: DataFrame, name: str = "z",
            n_features: int | None = None) -> DataFrame:
    """``(row_id, label, z)`` with ``z = <beta, x>``; 0.0 when nothing is shared.

    The model is broadcast when an exact bound on its rows is given."""
    b = broadcast_if_bounded(beta.select("feature", F.col("value").alias("_b")), n_features, row_bytes=48)
    partial = (data.select("row_id", "feature", "value").join(b, "feature")
               .groupBy("row_id").agg(F.sum(F.col("value") * F.col("_b")).alias("_z")))
    return (rows.select("row_id", "label").join(partial, "row_id", "left")
            .select("row_id", "label", F.coalesce(F.col("_z"), F.lit(0.0)).alias(name)))


def row_loss(label: str = "label", z: str = "z"):
    return log1p_exp_neg(F.col(label).cast("double") * F.col(z))


def logistic_loss(data, rows, beta) -> DataFrame:
    """Per-row loss ``(row_id, label, loss)``."""
    return margins(data, rows, beta).select("row_id", "label", row_loss().alias("loss"))


def _norms(beta: DataFrame) -> DataFrame:
    return beta.agg(F.coalesce(F.sum(F.col("value") * F.col("value")), F.lit(0.0)).alias("bb"))


def total_logistic_loss(data, rows, beta, lam: float) -> DataFrame:
    bb = _norms(beta).scalar()
    return margins(data, rows, beta).agg((F.sum(row_loss()) + F.lit(lam) * bb).alias("loss"))


def gradient_from_margins(data: DataFrame, z: DataFrame, beta: DataFrame, lam: float,
                          n_rows: int | None = None) -> DataFrame:
    """``(feature, b, g)``: b = current value (0.0 if absent), g = gradient.

    Keys are the union of data features and model features.  The per-row
    coefficients are broadcast when an exact bound on rows is given.
    """
    coef = z.select("row_id", logistic_coefficient(F.col("label").cast("double"), F.col("z")).alias("_c"))
    coef = broadcast_if_bounded(coef, n_rows, row_bytes=16)
    gsum = (data.select("row_id", "feature", "value").join(coef, "row_id")
            .groupBy("feature").agg(F.sum(F.col("_c") * F.col("value")).alias("_g")))
    b = beta.select("feature", F.col("value").alias("_b"))
    j = gsum.join(b, "feature", "full_outer")
    bcol = F.coalesce(F.col("_b"), F.lit(0.0))
    return j.select("feature", bcol.alias("b"),
                    (F.coalesce(F.col("_g"), F.lit(0.0)) + F.lit(2.0 * lam) * bcol).alias("g"))


def logistic_gradient(data, rows, beta, lam: float) -> DataFrame:
    g = gradient_from_margins(data, margins(data, rows, beta), beta, lam)
    return g.select("feature", F.col("g").alias("gradient"))


def with_direction(data: DataFrame, z: DataFrame, grad: DataFrame,
                   n_features: int | None = None) -> DataFrame:
    """``(row_id, label, z, h)`` with ``h = <grad, x>`` per row."""
    hz = margins(data, z.select("row_id", "label"),
                 grad.select("feature", F.col("g").alias("value")), "h", n_features)
    return z.join(hz.select("row_id", "h"), "row_id")


LINE_SEARCH_BATCH = 10


def line_search_frame(zh: DataFrame, grad: DataFrame, lam: float, first: int = 0,
                      count: int = LINE_SEARCH_BATCH, a: float = LINE_SEARCH_A,
                      b: float = LINE_SEARCH_B) -> DataFrame:
    """Backtracking trials ``t = b^k`` for ``first <= k < first + count`` in
    one aggregate pass over ``zh`` (no grid join).

    The objective at ``beta - t grad`` is
    ``sum l(y (z - t h)) + lam (|b|^2 - 2 t <b,g> + t^2 |g|^2)``.  The row
    holds ``(objective, grad_norm_sq, step, k, objective_after)``; ``k`` is
    the first passing trial of the batch, or NULL if none passes (then
    ``step`` is 0.0 and ``objective_after`` the objective).
    """
    y = F.col("label").cast("double")
    ks = list(range(first, first + count))
    ts = [b ** k for k in ks]
    sums = [F.sum(log1p_exp_neg(y * F.col("z"))).alias("l0")]
    sums += [F.sum(log1p_exp_neg(y * (F.col("z") - F.lit(t) * F.col("h")))).alias(f"l{k}_")
             for k, t in zip(ks, ts)]
    norms = grad.agg(F.struct(F.sum(F.col("b") * F.col("b")).alias("bb"),
                              F.sum(F.col("b") * F.col("g")).alias("bg"),
                              F.sum(F.col("g") * F.col("g")).alias("gg"))).scalar()
    agg = zh.agg(*sums).select("*", norms.alias("_nrm"))
    bb, bg, gg = F.col("_nrm.bb"), F.col("_nrm.bg"), F.col("_nrm.gg")
    f0 = F.col("l0") + F.lit(lam) * bb
    trial = {k: F.col(f"l{k}_") + F.lit(lam) * (bb - F.lit(2 * t) * bg + F.lit(t * t) * gg)
             for k, t in zip(ks, ts)}
    s1 = agg.select(f0.alias("objective"), gg.alias("grad_norm_sq"),
                    *[tr.alias(f"f{k}") for k, tr in trial.items()])
    passed = [F.when(F.col(f"f{k}") <= F.col("objective") - F.lit(a * t) * F.col("grad_norm_sq"), F.lit(k))
              for k, t in zip(ks, ts)]
    s2 = s1.select("*", F.coalesce(*passed).alias("k"))
    step = F.coalesce(*[F.when(F.col("k") == k, F.lit(t)) for k, t in zip(ks, ts)], F.lit(0.0))
    after = F.coalesce(*[F.when(F.col("k") == k, F.col(f"f{k}")) for k in ks], F.col("objective"))
    return s2.select("objective", "grad_norm_sq", step.alias("step"), F.col("k").cast("int").alias("k"),
                     after.alias("objective_after"))


def line_search(zh: DataFrame, grad: DataFrame, lam: float,
                b: float = LINE_SEARCH_B) -> tuple[DataFrame, dict]:
    """First passing backtracking step: batches of trials until one passes.

    Returns the deciding one-row frame and its values.  The trials have no
    bound: a step too small to change the sums passes.  Without any rows, or
    with values that are not numbers, no trial can pass; then the step is 0.0
    once ``b^k`` is zero.
    """
    first = 0
    while True:
        frame = line_search_frame(zh, grad, lam, first, b=b)
        row = frame.first().asDict()
        first += LINE_SEARCH_BATCH
        value, norm = row["objective"], row["grad_norm_sq"]
        hopeless = value is None or norm is None or value != value or norm != norm
        if row["k"] is not None:
            return frame, row
        if hopeless or b ** first == 0.0:
            row["k"] = first
            return frame.select("objective", "grad_norm_sq", "step", F.lit(first).cast("int").alias("k"),
                                "objective_after"), row


def logistic_step(data, rows, beta, lam: float) -> DataFrame:
    """One-row frame ``(objective, grad_norm_sq, step, k, objective_after)``.

    The gradient and directions are checkpointed once, then the batches of
    trials are read from them."""
    mat = Materializer(data.sparkSession)
    z = margins(data, rows, beta)
    grad = mat(gradient_from_margins(data, z, beta, lam))
    zh = mat(with_direction(data, z, grad))
    frame, _ = line_search(zh, grad, lam)
    return frame


class BroadcastProducts:
    """The two products of an iteration as joins with broadcast tables, whose
    row counts are known: the model by feature and the coefficients by row."""

    def __init__(self, data: DataFrame, rows: DataFrame, beta: DataFrame, mat: Materializer, n_rows: int, n_features: int):
        self.data, self.mat, self.n_rows, self.n_features = data, mat, n_rows, n_features
        self.rows = rows
        self.z = mat(margins(data, rows, beta, n_features=n_features))
        self.beta = beta
        self.held = (data, rows)

    def gradient(self, lam: float) -> DataFrame:
        return self.mat(gradient_from_margins(self.data, self.z, self.beta, lam, self.n_rows))

    def direction(self, grad: DataFrame) -> DataFrame:
        return self.mat(with_direction(self.data, self.z, grad, self.n_features))

    def move(self, zh: DataFrame, grad: DataFrame, t: float) -> None:
        # one narrow projection over each checkpoint
        self.z = zh.select("row_id", "label", (F.col("z") - F.lit(t) * F.col("h")).alias("z"))
        self.beta = grad.select("feature", (F.col("b") - F.lit(t) * F.col("g")).alias("value"))

    def model(self) -> DataFrame:
        return self.beta

    def model_margins(self) -> DataFrame:
        """``(row_id, label, z)`` of the examples by the present model, from the model itself."""
        return margins(self.data, self.rows, self.beta, n_features=self.n_features)

    def close(self) -> None:
        pass


class GridProducts:
    """The two products of an iteration over examples in a packed grid.

    The data is stored once, by cell.  An iteration sends the coefficient of
    each row, or the value of each feature, to the cells that hold it, and sums
    what the cells answer per feature, or per row; the data itself does not
    move.  Very frequent features and very long rows are dealt over many cells.
    Row ids are longs; features are numbered by a checked hash.
    """

    def __init__(self, data: DataFrame, rows: DataFrame, beta: DataFrame, mat: Materializer,
                 side: int | None = None, hot_entries: int | None = None, features: DataFrame | None = None):
        self.mat = mat
        seed, self.names = self._number(feature_counts(data, beta) if features is None else features)
        code = F.xxhash64("feature", F.lit(seed))
        entries = data.where("row_id is not null").select(F.col("row_id").cast("long").alias("row"), code.alias("col"), "value")
        size = self.names.agg(F.count(F.lit(1)).alias("cols"), F.coalesce(F.sum("n"), F.lit(0)).alias("entries")).first()
        self.grid = PackedGrid(entries, size["entries"], self.names.select(F.col("id").alias("col"), "n"), size["cols"], side, hot_entries)
        of_rows = self.grid.routes(ROW)
        known = rows.select(F.col("row_id").cast("long").alias("row_id"), "label")
        self.rows = mat(known.join(of_rows, known["row_id"] == of_rows["id"], "left").select("row_id", "label", "mask"))
        start = beta.groupBy(code.alias("id")).agg(F.sum("value").alias("b"))
        self.cols = mat(self.names.select("id").join(self.grid.routes(COL), "id", "left").join(start, "id", "left")
                        .select("id", "mask", F.coalesce("b", F.lit(0.0)).alias("b")))
        self.state = self.rows.select("row_id", "label", "mask", F.lit(0.0).alias("z"))
        if beta.take(1):
            self.state = mat(self.model_margins("mask"))
        self.held = (self.names, self.rows)

    def _number(self, features: DataFrame) -> tuple[int, DataFrame]:
        """A hash seed under which no two features share a number, and their names and counts by number."""
        seed = 0
        while True:
            names = self.mat(features.select(F.xxhash64("feature", F.lit(seed)).alias("id"), "feature", "n"))
            if not names.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1):
                return seed, names
            seed += 1

    def _product(self, values: DataFrame, kind: int) -> DataFrame:
        """``(id, s)``: the data times ``v`` of columns (per row), or of rows (per column)."""
        return self.grid.product(values, kind)

    @staticmethod
    def _by_row(rows: DataFrame, sums: DataFrame, name: str) -> DataFrame:
        met = rows.join(sums, rows["row_id"] == sums["id"], "left")
        return met.select(*rows.columns, F.coalesce("s", F.lit(0.0)).alias(name))

    def gradient(self, lam: float) -> DataFrame:
        coef = self.state.select(F.col("row_id").alias("id"), "mask", logistic_coefficient(F.col("label").cast("double"), F.col("z")).alias("v"))
        sums = self._product(coef, ROW)
        met = self.cols.join(sums, "id", "left")
        return self.mat(met.select("id", "mask", "b", (F.coalesce("s", F.lit(0.0)) + F.lit(2.0 * lam) * F.col("b")).alias("g")))

    def direction(self, grad: DataFrame) -> DataFrame:
        sums = self._product(grad.select("id", "mask", F.col("g").alias("v")), COL)
        return self.mat(self._by_row(self.state, sums, "h"))

    def move(self, zh: DataFrame, grad: DataFrame, t: float) -> None:
        self.state = zh.select("row_id", "label", "mask", (F.col("z") - F.lit(t) * F.col("h")).alias("z"))
        self.cols = grad.select("id", "mask", (F.col("b") - F.lit(t) * F.col("g")).alias("b"))

    def model(self) -> DataFrame:
        return self.cols.join(self.names, "id").select("feature", F.col("b").alias("value"))

    def model_margins(self, *keep: str) -> DataFrame:
        """``(row_id, label, *keep, z)`` of the examples by the present model, from the model itself."""
        sums = self._product(self.cols.select("id", "mask", F.col("b").alias("v")), COL)
        return self._by_row(self.rows.select("row_id", "label", *keep), sums, "z")

    def close(self) -> None:
        self.grid.close()


@dataclass
class LogisticFit:
    beta: DataFrame
    grad_norm: float
    iterations: int
    converged: bool
    history: list = field(default_factory=list)

    def history_df(self, spark) -> DataFrame:
        return spark.createDataFrame(
            self.history, "iteration int, objective double, grad_norm double, step double, "
                          "accuracy double, precision double, recall double, elapsed_s double")


def empty_model(data: DataFrame) -> DataFrame:
    """The all-zero model: no ``(feature, value)`` rows."""
    return data.sparkSession.range(0).select(F.lit("").alias("feature"), F.lit(0.0).alias("value"))


#: Measured bytes of a model row beside its feature's name.
MODEL_ROW_BYTES = 24


#: Entries beyond which examples are packed in a grid whatever a broadcast would take.
BROADCAST_ENTRIES = 2_000_000


def feature_counts(data: DataFrame, beta: DataFrame) -> DataFrame:
    """``(feature, n)``: the features of data and model and how many entries each has."""
    both = data.select("feature", F.lit(1).alias("_n")).unionByName(beta.select("feature", F.lit(0).alias("_n")))
    return both.groupBy("feature").agg(F.sum("_n").alias("n"))


def _bounded(features: DataFrame, n_rows: int, broadcast_rows: int | None) -> tuple[bool, int]:
    """Whether model and coefficients may be broadcast, by the counted features,
    the bytes of their names and their entries; and the number of features."""
    n, width = measured(features.select("feature"))
    model = broadcast_if_bounded(features, n, broadcast_rows, row_bytes=width + MODEL_ROW_BYTES) is not features
    few = features.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] <= BROADCAST_ENTRIES
    return few and model and broadcast_if_bounded(features, n_rows, broadcast_rows, row_bytes=16) is not features, n


def train_logistic(data: DataFrame, rows: DataFrame, lam: float, max_iter: int = 100,
                   eps: float = 0.1, beta0: DataFrame | None = None,
                   test: tuple[DataFrame, DataFrame] | None = None, broadcast_rows: int | None = None,
                   beta_path: str | None = None, side: int | None = None, hot_entries: int | None = None) -> LogisticFit:
    """Gradient descent with backtracking, from an empty model by default.

    Each iteration stores two states: the gradient (data times per-row
    coefficients, summed per feature, carrying the current model) and the
    per-row directions h = <grad, x> (carrying the margins).  The line search
    reads them in one aggregate per batch of trials; the new model
    ``beta - t grad`` and margins ``z - t h`` stay projections of those
    states.  As in the reference, the update is applied before the loop
    checks the gradient norm of the pre-update model.

    More than ``broadcast_rows`` features or rows (default: the library's
    bound) or ``BROADCAST_ENTRIES`` entries are trained in a grid, whose shape ``side`` and ``hot_entries`` set.
    With ``beta_path`` the model after each iteration is kept there (see
    ``sources.models``).
    """
    import time

    from ..sources.models import append_version

    spark = data.sparkSession
    mat = Materializer(spark, columnar=True)
    given = (data, rows)
    data = mat(data.select("row_id", "feature", F.col("value").cast("double").alias("value")))
    beta = mat(beta0 if beta0 is not None else empty_model(data))
    rows = mat(rows.select("row_id", "label"))
    n_rows = rows.count()
    # model and gradient keys: the data's features plus the start model's
    features = mat(feature_counts(data, beta))
    bounded, n_features = _bounded(features, n_rows, broadcast_rows)
    if bounded:
        products = BroadcastProducts(data, rows, beta, mat, n_rows, n_features)
    else:
        products = GridProducts(data, rows, beta, mat, side, hot_entries, features)
    history = []
    k, norm = 0, float("inf")  # not measured yet
    own_test = test is not None and test[0] is given[0] and test[1] is given[1]
    if test is not None and not own_test:
        test = (data if test[0] is given[0] else mat(test[0].select("row_id", "feature", F.col("value").cast("double").alias("value"))),
                rows if test[1] is given[1] else mat(test[1].select("row_id", "label")))
    # the training examples as test set are stored already, as the products have them
    held = (() if test is None or own_test else test) + products.held
    start = time.time()
    try:
        while k < max_iter and norm > eps:
            grad = products.gradient(lam)
            zh = products.direction(grad)
            # model and margins of the previous step were projections of the previous
            # checkpoints; both are now folded into grad and zh
            mat.release_all_but(*held, grad, zh)
            _, ls = line_search(zh, grad, lam)
            norm = float(ls["grad_norm_sq"]) ** 0.5
            t = float(ls["step"])
            products.move(zh, grad, t)
            acc = pre = rec = None
            if test is not None:
                z = products.model_margins() if own_test else margins(test[0], test[1], products.model())
                m = margin_metrics(z).first()
                acc, pre, rec = m["accuracy"], m["precision"], m["recall"]
            if beta_path:
                append_version(products.model(), beta_path, k)
            history.append((k, float(ls["objective"]), norm, t, acc, pre, rec, time.time() - start))
            k += 1
            if t == 0.0 or ls["objective_after"] >= ls["objective"]:  # no further descent in double precision
                break
    finally:
        products.close()
    return LogisticFit(products.model(), norm, k, norm <= eps, history)


def binary_metrics(data, rows, beta) -> DataFrame:
    """Accuracy, precision, recall with positive iff ``<beta, x> > 0``;
    NULL where a denominator is zero.  One conditional aggregate."""
    return margin_metrics(margins(data, rows, beta))


def margin_metrics(z: DataFrame) -> DataFrame:
    """``binary_metrics`` of ``(row_id, label, z)``."""
    pos = F.col("z") > 0
    agg = z.agg(F.count_if(pos & (F.col("label") == 1)).alias("tp"),
                F.count_if(pos & (F.col("label") != 1)).alias("fp"),
                F.count_if(~pos & (F.col("label") != 1)).alias("tn"),
                F.count_if(~pos & (F.col("label") == 1)).alias("fn"))
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    return agg.select(F.try_divide(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                      F.try_divide(tp, tp + fp).alias("precision"),
                      F.try_divide(tp, tp + fn).alias("recall"))


def numeric_gradient(data, rows, beta, lam: float, delta: float) -> DataFrame:
    """Forward difference ``(L(b + delta e_f) - L(b)) / delta`` for every key f of b.

    Only rows holding f change, so the difference is summed over the
    (row, f) entries: ``l(y (z + delta x_f)) - l(y z)``, plus
    ``lam (2 delta b_f + delta^2)``.
    """
    z = margins(data, rows, beta)
    y = F.col("label").cast("double")
    per = (data.select("row_id", "feature", "value").join(z, "row_id")
           .select("feature", (log1p_exp_neg(y * (F.col("z") + F.lit(delta) * F.col("value")))
                               - log1p_exp_neg(y * F.col("z"))).alias("_d")))
    dsum = per.groupBy("feature").agg(F.sum("_d").alias("_s"))
    b = beta.select("feature", F.col("value").alias("_b"))
    return (b.join(dsum, "feature", "left")
            .select("feature", ((F.coalesce(F.col("_s"), F.lit(0.0))
                                 + F.lit(lam) * (F.lit(2 * delta) * F.col("_b") + F.lit(delta * delta)))
                                / F.lit(delta)).alias("gradient")))
