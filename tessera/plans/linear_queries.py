"""Registered ridge-regression queries (R1-R11) over the ``dense`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import linear as L
from . import fixtures as fx
from .oracle_sql import DENSE, DENSE_WIDE, r6 as s6
from .registry import r6, register

X = ["x1", "x2"]
Y = "y"
BETA = [1.0, 0.5]          # fixed probe model for the single-pass queries
LAM = 1.0
DELTA = 1e-4
FIT_EPS = 1e-7
FIT_MAX_ITER = 100_000
SWEEP = list(range(0, 11))
LONG_SWEEP = list(range(0, 21))

_D = f"""d AS ({DENSE}),
tr AS (SELECT x1, x2, y FROM d WHERE NOT is_test),
te AS (SELECT x1, x2, y FROM d WHERE is_test)"""
_PRED = "(x1 * 1.0::DOUBLE + x2 * 0.5::DOUBLE)"
_GRAM = """g AS (SELECT avg(x1 * x1) AS a11, avg(x1 * x2) AS a12, avg(x2 * x2) AS a22,
                avg(x1 * y) AS b1, avg(x2 * y) AS b2, avg(y * y) AS c FROM tr)"""


@register("linear_predict", f"""WITH {_D}
SELECT {s6('x1')} AS x1, {s6('x2')} AS x2, {s6('y')} AS y, {s6(_PRED)} AS yhat FROM d""")
def linear_predict(spark, sf_dir):
    rows = fx.dense(spark, sf_dir)
    return rows.select(r6("x1").alias("x1"), r6("x2").alias("x2"), r6("y").alias("y"),
                     r6(L.predict(X, BETA)).alias("yhat"))


@register("ridge_objective", f"""WITH {_D}
SELECT {s6(f'avg((y - {_PRED}) * (y - {_PRED})) + 1.0 * (1.0 + 0.25)')} AS objective FROM tr""")
def ridge_objective(spark, sf_dir):
    out = L.ridge_objective(fx.dense_train(spark, sf_dir), X, Y, BETA, LAM)
    return out.select(r6("objective").alias("objective"))


@register("ridge_gradient", f"""WITH {_D}
SELECT 0 AS idx, {s6(f'avg(-2.0 * (y - {_PRED}) * x1) + 2.0 * 1.0 * 1.0')} AS gradient FROM tr
UNION ALL
SELECT 1, {s6(f'avg(-2.0 * (y - {_PRED}) * x2) + 2.0 * 1.0 * 0.5')} FROM tr""")
def ridge_gradient(spark, sf_dir):
    out = L.ridge_gradient(fx.dense_train(spark, sf_dir), X, Y, BETA, LAM)
    return out.select(F.col("idx").cast("int").alias("idx"), r6("gradient").alias("gradient"))


@register("gram_matrix", f"""WITH {_D}
""" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {s6(f'avg({a} * {b})')} AS moment, count(*) AS n FROM tr"
    for i, a in enumerate(X + [Y]) for b in (X + [Y])[i:]))
def gram_matrix(spark, sf_dir):
    cols = X + [Y]
    m = L.moments(fx.dense_train(spark, sf_dir), X, Y)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    stack = ", ".join(f"'{a}', '{b}', m__{a}__{b} / n" for a, b in pairs)
    long = m.selectExpr("n", f"stack({len(pairs)}, {stack}) AS (a, b, moment)")
    return long.select("a", "b", r6("moment").alias("moment"), "n")


def _rows_df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@register("ridge_step", f"""WITH {_D}, {_GRAM},
grad AS (SELECT -2.0 * b1 AS g1, -2.0 * b2 AS g2 FROM g),
f0 AS (SELECT avg(y * y) AS f FROM tr),
grid AS (SELECT range AS k, pow(0.6, range) AS t FROM range(60)),
trial AS (SELECT k, t, avg((y + t * (g1 * x1 + g2 * x2)) * (y + t * (g1 * x1 + g2 * x2)))
                 + 1.0 * t * t * (g1 * g1 + g2 * g2) AS f
          FROM grid, grad, tr GROUP BY k, t, g1, g2),
ok AS (SELECT min(k) AS k FROM trial, f0, grad
       WHERE trial.f <= f0.f - 0.2 * trial.t * (g1 * g1 + g2 * g2))
SELECT {s6('trial.t')} AS step, CAST(trial.k AS INTEGER) AS k, {s6('f0.f')} AS objective_before,
       {s6('trial.f')} AS objective_after
FROM trial JOIN ok USING (k), f0""")
def ridge_step(spark, sf_dir):
    """Backtracking step from beta = 0 with lambda = 1."""
    g = L.gram(fx.dense_train(spark, sf_dir), X, Y)
    s = L.backtracking_step(g, [0.0, 0.0], LAM)
    row = (float(s["step"]), int(s["k"]), float(s["objective_before"]), float(s["objective_after"]))
    df = _rows_df(spark, [row], "step double, k int, objective_before double, objective_after double")
    return df.select(r6("step").alias("step"), "k", r6("objective_before").alias("objective_before"),
                     r6("objective_after").alias("objective_after"))


def _cramer(lam: str) -> str:
    det = f"((a11 + {lam}) * (a22 + {lam}) - a12 * a12)"
    return (f"(b1 * (a22 + {lam}) - a12 * b2) / {det}", f"((a11 + {lam}) * b2 - a12 * b1) / {det}")


_B1, _B2 = _cramer("1.0")


@register("ridge_fit", f"""WITH {_D}, {_GRAM}
SELECT 0 AS idx, {s6(_B1, 4)} AS beta FROM g UNION ALL SELECT 1, {s6(_B2, 4)} FROM g""")
def ridge_fit(spark, sf_dir):
    fit = L.train_ridge(fx.dense_train(spark, sf_dir), X, Y, LAM, FIT_MAX_ITER, FIT_EPS)
    df = L.beta_frame(spark, fit.beta)
    return df.select("idx", r6("value", 4).alias("beta"))


@register("ridge_mse", f"""WITH {_D}
SELECT {s6(f'avg((y - {_PRED}) * (y - {_PRED}))')} AS mse FROM te""")
def ridge_mse(spark, sf_dir):
    return L.mse(fx.dense_test(spark, sf_dir), X, Y, BETA).select(r6("mse").alias("mse"))


_SB1, _SB2 = _cramer("lam")


def _sweep_sql(lams) -> str:
    return f"""WITH {_D}, {_GRAM},
tg AS (SELECT avg(x1 * x1) AS t11, avg(x1 * x2) AS t12, avg(x2 * x2) AS t22,
              avg(x1 * y) AS u1, avg(x2 * y) AS u2, avg(y * y) AS tc FROM te),
lams AS (SELECT range::DOUBLE AS lam FROM range({lams[0]}, {lams[-1] + 1})),
b AS (SELECT lam, {_SB1} AS beta_1, {_SB2} AS beta_2, g.* FROM lams, g)
SELECT lam, {s6('beta_1', 4)} AS beta_1, {s6('beta_2', 4)} AS beta_2,
       {s6('c - 2 * (beta_1 * b1 + beta_2 * b2) + beta_1 * beta_1 * a11 + 2 * beta_1 * beta_2 * a12 + beta_2 * beta_2 * a22 + lam * (beta_1 * beta_1 + beta_2 * beta_2)', 4)} AS train_objective,
       {s6('tc - 2 * (beta_1 * u1 + beta_2 * u2) + beta_1 * beta_1 * t11 + 2 * beta_1 * beta_2 * t12 + beta_2 * beta_2 * t22', 4)} AS test_mse
FROM b, tg"""


def _sweep(spark, sf_dir, lams):
    res = L.lambda_sweep(fx.dense(spark, sf_dir), X, Y, "is_test", lams, FIT_MAX_ITER, FIT_EPS)
    rows = [(r["lam"], float(r["beta"][0]), float(r["beta"][1]), r["train_objective"], r["test_mse"])
            for r in res]
    df = _rows_df(spark, rows, "lam double, beta_1 double, beta_2 double, train_objective double, test_mse double")
    return df.select("lam", *[r6(c, 4).alias(c) for c in ("beta_1", "beta_2", "train_objective", "test_mse")])


@register("ridge_sweep", _sweep_sql(SWEEP))
def ridge_sweep(spark, sf_dir):
    return _sweep(spark, sf_dir, SWEEP)


@register("ridge_sweep_21", _sweep_sql(LONG_SWEEP))
def ridge_sweep_21(spark, sf_dir):
    """Lambdas 0 to 20."""
    return _sweep(spark, sf_dir, LONG_SWEEP)


# Wide data: two measures and an indicator per group.  The SQL twins use that
# indicators of different groups are never both 1, so the normal equations
# shrink to two unknowns; the Spark side knows nothing of it.
GROUPS = fx.PART_GROUPS
WIDE = ["x1", "x2", *fx.group_columns()]
WIDE_LAMS = list(range(1, 21))

_W = f"""w AS ({DENSE_WIDE}),
tr AS (SELECT * FROM w WHERE NOT is_test), te AS (SELECT * FROM w WHERE is_test),
n AS (SELECT count(*)::DOUBLE AS n FROM tr),
grp AS (SELECT r.range AS g, count(tr.y) / (SELECT n FROM n) AS a, coalesce(sum(x1), 0) / (SELECT n FROM n) AS c1,
               coalesce(sum(x2), 0) / (SELECT n FROM n) AS c2, coalesce(sum(y), 0) / (SELECT n FROM n) AS d
        FROM range({GROUPS}) r LEFT JOIN tr ON tr.g = r.range GROUP BY r.range)"""


def _wide_gram_sql() -> str:
    dense = ["x1", "x2", "y"]
    rows = [f"SELECT '{a}' AS a, '{b}' AS b, avg({a} * {b}) AS m FROM tr" for i, a in enumerate(dense) for b in dense[i:]]
    rows += ["SELECT 'x1', 'c' || g, c1 FROM grp", "SELECT 'x2', 'c' || g, c2 FROM grp", "SELECT 'c' || g, 'y', d FROM grp",
             "SELECT 'c' || l.g, 'c' || h.g, CASE WHEN l.g = h.g THEN l.a ELSE 0.0 END FROM grp l JOIN grp h ON l.g <= h.g"]
    return (f"WITH {_W}, m AS (" + " UNION ALL ".join(rows) + f") SELECT a, b, {s6('m')} AS moment, "
            "(SELECT n FROM n)::BIGINT AS n FROM m")


@register("gram_wide", _wide_gram_sql())
def gram_wide(spark, sf_dir):
    """All second moments of 112 features and the target."""
    cells = L.gram_cells(fx.dense_wide(spark, sf_dir).where(~F.col("is_test")), WIDE, Y)
    name = F.array(*[F.lit(c) for c in [*WIDE, Y]])
    return cells.select(F.get(name, "i").alias("a"), F.get(name, "j").alias("b"), r6(F.col("s") / F.col("n")).alias("moment"), "n")


# beta of the two measures with the groups eliminated, then the groups' own
_WIDE_FIT = f"""lams AS (SELECT range::DOUBLE AS lam FROM range({WIDE_LAMS[0]}, {WIDE_LAMS[-1] + 1})),
den AS (SELECT avg(x1 * x1) AS a11, avg(x1 * x2) AS a12, avg(x2 * x2) AS a22, avg(x1 * y) AS b1, avg(x2 * y) AS b2, avg(y * y) AS c FROM tr),
red AS (SELECT lam, a11 + lam - sum(c1 * c1 / (a + lam)) AS s11, a12 - sum(c1 * c2 / (a + lam)) AS s12,
               a22 + lam - sum(c2 * c2 / (a + lam)) AS s22, b1 - sum(c1 * d / (a + lam)) AS r1, b2 - sum(c2 * d / (a + lam)) AS r2,
               b1, b2, c FROM lams, den, grp GROUP BY lam, a11, a12, a22, b1, b2, c),
num AS (SELECT *, (r1 * s22 - s12 * r2) / (s11 * s22 - s12 * s12) AS beta_1, (s11 * r2 - s12 * r1) / (s11 * s22 - s12 * s12) AS beta_2 FROM red),
fit AS (SELECT num.lam, g, beta_1, beta_2, b1, b2, c, d, (d - c1 * beta_1 - c2 * beta_2) / (a + num.lam) AS beta_g FROM num, grp)"""


@register("ridge_wide_fit", f"""WITH {_W}, {_WIDE_FIT}
SELECT 0 AS idx, {s6('any_value(beta_1)', 4)} AS beta FROM fit WHERE lam = {LAM!r}
UNION ALL SELECT 1, {s6('any_value(beta_2)', 4)} FROM fit WHERE lam = {LAM!r}
UNION ALL SELECT CAST(2 + g AS INTEGER), {s6('beta_g', 4)} FROM fit WHERE lam = {LAM!r}""")
def ridge_wide_fit(spark, sf_dir):
    """Gradient descent over 112 features, on the summary of one pass."""
    train = fx.dense_wide(spark, sf_dir).where(~F.col("is_test"))
    fit = L.train_ridge(train, WIDE, Y, LAM, FIT_MAX_ITER, FIT_EPS)
    return L.beta_frame(spark, fit.beta).select("idx", r6("value", 4).alias("beta"))


@register("ridge_sweep_wide", f"""WITH {_W}, {_WIDE_FIT},
obj AS (SELECT lam, any_value(beta_1) AS beta_1, any_value(beta_2) AS beta_2, sum(beta_g) AS beta_groups,
               any_value(c) - any_value(beta_1 * b1 + beta_2 * b2) - sum(beta_g * d) AS train_objective FROM fit GROUP BY lam),
err AS (SELECT lam, avg((y - x1 * beta_1 - x2 * beta_2 - beta_g) * (y - x1 * beta_1 - x2 * beta_2 - beta_g)) AS test_mse
        FROM te JOIN fit USING (g) GROUP BY lam)
SELECT lam, {s6('beta_1', 4)} AS beta_1, {s6('beta_2', 4)} AS beta_2, {s6('beta_groups', 4)} AS beta_groups,
       {s6('train_objective', 4)} AS train_objective, {s6('test_mse', 4)} AS test_mse FROM obj JOIN err USING (lam)""")
def ridge_sweep_wide(spark, sf_dir):
    """The sweep over 112 features: one pass for both splits and all lambdas."""
    res = L.lambda_sweep(fx.dense_wide(spark, sf_dir), WIDE, Y, "is_test", WIDE_LAMS, FIT_MAX_ITER, FIT_EPS)
    rows = [(r["lam"], float(r["beta"][0]), float(r["beta"][1]), float(r["beta"][2:].sum()), r["train_objective"], r["test_mse"]) for r in res]
    names = ("beta_1", "beta_2", "beta_groups", "train_objective", "test_mse")
    df = _rows_df(spark, rows, "lam double, " + ", ".join(f"{n} double" for n in names))
    return df.select("lam", *[r6(c, 4).alias(c) for c in names])


def _fd_sql(i: int) -> str:
    b = list(BETA)
    b[i] += DELTA
    pert = f"(x1 * {b[0]!r}::DOUBLE + x2 * {b[1]!r}::DOUBLE)"
    reg_p = LAM * (b[0] ** 2 + b[1] ** 2)
    reg_0 = LAM * (BETA[0] ** 2 + BETA[1] ** 2)
    return (f"SELECT {i} AS idx, {s6(f'((avg((y - {pert}) * (y - {pert})) + {reg_p!r}) - (avg((y - {_PRED}) * (y - {_PRED})) + {reg_0!r})) / {DELTA!r}')} AS gradient FROM tr")


@register("numeric_gradient", f"WITH {_D}\n" + "\nUNION ALL\n".join(_fd_sql(i) for i in range(len(X))))
def numeric_gradient(spark, sf_dir):
    out = L.numeric_gradient(fx.dense_train(spark, sf_dir), X, Y, BETA, LAM, DELTA)
    return out.select(F.col("idx").cast("int").alias("idx"), r6("gradient").alias("gradient"))
