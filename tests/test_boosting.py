"""Histogram boosting against boosting by exhaustive splits of the rows."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from applens.operators import boosting as bo




def exhaustive(x, levels, y, s, sample):
    """Predictions of a booster that tries every split of every feature on the rows; x has NaN where missing."""
    f = np.full(len(y), s.base)
    names = sorted({v for v in levels if v is not None})
    every = [(i, None) for i in range(x.shape[1])] + [(x.shape[1], v) for v in names]

    def grow(rows, depth, allowed, g):
        total = -s.rate * bo.soft(g[rows].sum(), s.l1) / (len(rows) + s.l2)
        if depth == 0 or not len(rows):
            return total
        score = lambda r: bo.soft(g[r].sum(), s.l1) ** 2 / (len(r) + s.l2)
        best = None
        for i, v in every:
            if (i, v) not in allowed:
                continue
            if v is None:
                col = x[rows, i]
                gone = np.isnan(col)
                cuts = [(c, side) for side in ([False, True] if gone.any() else [False])
                        for c in ([-math.inf] + sorted(set(col[~gone])))]
                sides = [(c, side, np.where(gone, side, col <= c)) for c, side in cuts]
            else:
                sides = [(v, False, np.array([levels[r] != v for r in rows]))]
            found = []
            for c, side, left in sides:
                a, b = rows[left], rows[~left]
                if len(a) < max(1, s.least_rows) or len(b) < max(1, s.least_rows):
                    continue
                found.append(((score(a) + score(b) - score(rows)) / 2 - s.gamma, (i, v), c, side))
            # The order of the library: per side, first of the greatest; then features in turn.
            for side in (False, True):
                own = [q for q in found if q[3] is side]
                if own and max(q[0] for q in own) > 0:
                    top = max(q[0] for q in own)
                    first = next(q for q in own if q[0] >= top * (1 - bo.TIE))
                    if best is None or first[0] > best[0] * (1 + bo.TIE):
                        best = first
        if best is None or best[0] <= bo.TIE * max(1.0, abs(g[rows].sum())):
            return total
        _, (i, v), c, side = best
        go = (np.where(np.isnan(x[rows, i]), side, x[rows, i] <= c) if v is None
              else np.array([levels[r] != v for r in rows])).astype(bool)
        return (i, v, c, side, grow(rows[go], depth - 1, allowed, g), grow(rows[~go], depth - 1, allowed, g))

    def leaf(node, r):
        while isinstance(node, tuple):
            i, v, c, side, a, b = node
            left = (side if np.isnan(x[r, i]) else x[r, i] <= c) if v is None else levels[r] != v
            node = a if left else b
        return node

    booster = bo.Booster(["n"] * x.shape[1], "level", s)
    for t in range(s.trees):
        g = f - y
        rows = np.array([r for r in range(len(y)) if sample(t, r)])
        tree = grow(rows, s.depth, booster._columns(t, names), g)
        f = f + np.array([leaf(tree, r) for r in range(len(y))])
    return f


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(8)
    out = []
    for i in range(230):
        a = [None, float("nan"), 1.0][i % 3] if i % 6 == 0 else float(r.integers(0, 40)) / 4
        b, c, level = float(r.normal(0, 3)), float(i % 2), int(r.integers(0, 6))
        y = (2.0 if a in (None, 1.0) or (a is not None and math.isnan(a)) else 0.3 * a) + (b > 0.5) - 0.8 * (level == 3) + r.normal(0, 0.2)
        out.append((f"k{i}", a, b, c, level if i % 17 else None, float(y)))
    return out


def dense(rows, missing):
    x = np.array([[math.nan if v is None or v == missing else v for v in r[1:4]] for r in rows], float)
    return x, [r[4] for r in rows], np.array([r[5] for r in rows])


@pytest.mark.parametrize("settings", [
    bo.Settings(trees=4), bo.Settings(trees=3, l1=2.0, l2=0.5, gamma=0.2, least_rows=9, base=0.0, missing=None, rate=0.7),
    bo.Settings(trees=12, depth=1, rate=0.3, columns=0.5, seed=3), bo.Settings(trees=3, depth=2, rows=0.6, rate=0.5)])
def test_against_exhaustive_splits(spark, rows, settings, monkeypatch):
    monkeypatch.setattr(bo, "KEPT", 5)
    df = spark.createDataFrame(rows, "k string, a double, b double, c double, level int, y double")
    drawn = {r.k: r.h for r in df.select("k", F.array(*[
        F.abs(F.xxhash64(F.lit(settings.seed), F.lit(t), F.col("k")) % 1_000_000) for t in range(settings.trees)]).alias("h")).collect()}
    sample = lambda t, r: settings.rows >= 1 or drawn[rows[r][0]][t] < settings.rows * 1_000_000
    want = exhaustive(*dense(rows, settings.missing), settings, sample)
    model = bo.fit(df.repartition(4), ["a", "b", "c"], "level", "y", "k", settings)
    got = {r.k: r.prediction for r in model.predict(df).collect()}
    assert np.allclose([got[r[0]] for r in rows], want, atol=1e-9)
    assert len(model.trees) == settings.trees and np.corrcoef(want, [r[5] for r in rows])[0, 1] > 0.5


def test_one_aggregate_a_level(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, "k string, a double, b double, c double, level int, y double")
    asked = []
    real = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: asked.append(self) or real(self))
    bo.fit(df, ["a", "b"], "level", "y", "k", bo.Settings(trees=3, depth=2))
    assert len(asked) == 1 + 3 * 2  # the cuts, then one a level
    plan = asked[-1]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan and "Join" not in plan


def test_unsplittable_and_empty(spark):
    schema = "k string, a double, level int, y double"
    same = spark.createDataFrame([("a", 2.0, 1, 3.0), ("b", 2.0, 1, 5.0)], schema)
    model = bo.fit(same, ["a"], "level", "y", "k", replace(bo.Settings(), trees=2, rate=1.0, l2=0.0, base=1.0))
    assert [r.prediction for r in model.predict(same).collect()] == [4.0, 4.0]
    empty = bo.fit(same.limit(0), ["a"], "level", "y", "k", bo.Settings(trees=2))
    assert all(r.prediction == 0.5 for r in empty.predict(same).collect())


def test_new_levels_and_missing_go_their_way(spark):
    df = spark.createDataFrame([(str(i), 5.0 if i % 2 else None, i % 3, float(i % 2)) for i in range(60)],
                               "k string, a double, level int, y double")
    model = bo.fit(df, ["a"], "level", "y", "k", bo.Settings(trees=30, rate=0.5, missing=None))
    got = model.predict(spark.createDataFrame([("x", None, 9, 0.0), ("y", float("nan"), None, 0.0), ("z", 5.0, 9, 0.0)], df.schema))
    low, nan, high = [r.prediction for r in got.collect()]
    assert low == nan and low < 0.1 and high > 0.9


def test_tuned_settings():
    t = bo.TUNED
    assert (t.trees, t.depth, t.rate, t.rows, t.columns) == (1000, 1, 0.01, 0.8, 0.7)
    assert (bo.Settings().trees, bo.Settings().depth, bo.Settings().base, bo.Settings().missing) == (100, 3, 0.5, 1.0)
