"""The lasso from sums, against coordinate descent on the rows themselves."""

import numpy as np
import pytest

from applens.operators import encoding as enc
from applens.operators import lasso
from applens.plans import catalog_jobs as cj
from applens.sources import proxies

from conftest import SF_SMALL


def descend(x, y, alpha, sweeps=60_000):
    """Plain coordinate descent on the rows of a dense matrix; base and weights."""
    xc, yc = x - x.mean(0), y - y.mean()
    var, sd = (xc ** 2).mean(0), xc.std(0, ddof=1)
    w, rest = np.zeros(x.shape[1]), yc.copy()
    for _ in range(sweeps):
        moved = 0.0
        for j in np.flatnonzero(var > 1e-14):
            g = xc[:, j] @ rest / len(y) + var[j] * w[j]
            new = np.sign(g) * max(abs(g) - alpha * sd[j], 0) / var[j]
            rest -= xc[:, j] * (new - w[j])
            moved, w[j] = max(moved, abs(new - w[j]) * sd[j]), new
        if moved < 1e-10:
            break
    return y.mean() - x.mean(0) @ w, w


def dense(rows, levels):
    return np.array([[r[0], r[1], *(float(r[2] == v) for v in levels)] for r in rows]), np.array([r[3] for r in rows])


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(3)
    out = []
    for i in range(240):
        a, b, level = r.normal(5, 2), r.normal(1000, 300), ["p", "q", "r", "s", None][i % 5 if i % 7 else 0]
        out.append((a, b, level, 1 + 0.3 * a - 0.002 * b + {"p": 1, "q": -1}.get(level, 0) + r.normal(0, 0.3), i % 4))
    return out


def test_grid_against_descent_on_rows(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "a double, b double, l string, y double, fold int, _lasso_level string").repartition(5)
    grid = lasso.LassoGrid(df.drop("_lasso_level"), ["a", "b"], "l", "y", "fold")
    alphas = [1e-3, 0.05, 0.3, 10.0]
    got = {(a, f): r2 for a, f, r2 in grid.scores(alphas)}
    for fold in range(4):
        x, y = dense([r for r in rows if r[4] != fold], ["p", "q", "r", "s", None])
        tx, ty = dense([r for r in rows if r[4] == fold], ["p", "q", "r", "s", None])
        for alpha in alphas:
            base, w = descend(x, y, alpha)
            want = 1 - ((ty - base - tx @ w) ** 2).sum() / ((ty - ty.mean()) ** 2).sum()
            assert abs(got[alpha, fold] - want) < 1e-6, (alpha, fold)
    assert lasso.best(grid.scores(alphas)) in (1e-3, 0.05)


def test_refit_and_predictions(spark, rows):
    df = spark.createDataFrame([r[:4] + (0,) for r in rows], "a double, b double, l string, y double, fold int")
    grid = lasso.LassoGrid(df, ["a", "b"], "l", "y", "fold")
    m = grid.fit(0.05)
    x, y = dense(rows, ["p", "q", "r", "s", None])
    base, w = descend(x, y, 0.05)
    assert np.allclose(m.numbers, w[:2], atol=1e-6) and m.numbers[0] > 0.2
    got = [r.prediction for r in grid.predict(df.coalesce(1), m).collect()]
    assert np.allclose(sorted(got), sorted(base + x @ w), atol=1e-5)
    new = spark.createDataFrame([(1.0, 2.0, "unseen", 0.0, 0)], df.schema)
    assert abs(grid.predict(new, m).first().prediction - (m.base + m.numbers @ [1.0, 2.0])) < 1e-9


def test_large_numbers_constants_and_one_fold(spark):
    rows = [(1e9 + i, 7.0, "only", 3.0 + 2.0 * i, 0) for i in range(30)]
    grid = lasso.LassoGrid(spark.createDataFrame(rows, "a double, b double, l string, y double, fold int"), ["a", "b"], "l", "y", "fold")
    m = grid.fit(1e-6)
    assert abs(m.numbers[0] - 2.0) < 1e-3 and m.numbers[1] == 0.0
    assert grid.scores([0.1]) == []  # nothing to train on without its only fold


def test_tuned_on_the_catalogue(spark):
    clean, _ = cj.clean_catalog(proxies.apps_raw(spark, SF_SMALL))
    feats, _ = cj.build_features(clean)
    out = cj.tune_lasso(feats)
    grid = out["grid"].collect()
    assert len(grid) == len(cj.ALPHAS) * len({r.fold for r in grid})
    held = clean.where(enc.is_held_out(clean["App"], 0.2, 42)).count()
    assert out["tuned_predictions"].count() == held and out["tuned_r2"].first().r2 is not None
    # A penalty above all correlations leaves the mean: no held-out score above zero.
    assert all(r.r2 <= 1e-9 for r in grid if r.alpha == 1e4 and r.r2 is not None)
