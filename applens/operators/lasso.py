"""Lasso over numbers and one level column, from sums alone: grid, folds and scores in one aggregate.

The model is y = b + w.x + v[level], fitted by least squares with an L1 penalty:
minimise  mean squared error / 2 + alpha * sum of |weight| * (its column's sample deviation).

What a fit needs are sums of products. They are taken once, per fold and level, with the numbers scaled by
their overall mean and deviation. A dummy column's products with numbers are its level's sums, and
those of two dummies their counts, so the dummy block is never made. Training without a fold is the
total less that fold's sums; coordinate descent runs on them, from the greatest penalty to the least, and a
held-out fold is scored from its own sums. No fit reads the data again: driver memory
is folds * levels * numbers, as large as the models themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.functions.names import quoted, unused
from applens.session import kept_table

SWEEPS, CLOSE = 5_000, 1e-9


@dataclass
class Sums:
    """Sums over some rows: of numbers (P), of their products, of y, and per level (K) counts, numbers and y."""

    xx: np.ndarray  # P x P
    xy: np.ndarray  # P
    yy: float
    n: np.ndarray   # K
    x: np.ndarray   # K x P
    y: np.ndarray   # K

    def __sub__(self, o: Sums) -> Sums:
        return Sums(self.xx - o.xx, self.xy - o.xy, self.yy - o.yy, self.n - o.n, self.x - o.x, self.y - o.y)

    def __add__(self, o: Sums) -> Sums:
        return Sums(self.xx + o.xx, self.xy + o.xy, self.yy + o.yy, self.n + o.n, self.x + o.x, self.y + o.y)


@dataclass
class Weights:
    base: float
    numbers: np.ndarray
    levels: np.ndarray


class _Problem:
    """Centred moments of the training rows and coordinate descent on them."""

    def __init__(self, s: Sums):
        self.rows = s.n.sum()
        self.mean, self.ymean = s.x.sum(0) / self.rows, s.y.sum() / self.rows
        self.p = s.n / self.rows
        self.xx = s.xx / self.rows - np.outer(self.mean, self.mean)
        self.xd = s.x / self.rows - np.outer(self.p, self.mean)
        self.cx = s.xy / self.rows - self.mean * self.ymean
        self.cd = s.y / self.rows - self.p * self.ymean
        sample = self.rows / max(1.0, self.rows - 1)
        self.sx = np.sqrt(np.maximum(np.diag(self.xx), 0) * sample)
        self.sd = np.sqrt(self.p * (1 - self.p) * sample)
        self.close = CLOSE * max(np.sqrt(max(s.yy / self.rows - self.ymean ** 2, 0.0)), 1e-300)

    def solve(self, alpha: float, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, v = w.copy(), v.copy()
        numbers = [i for i in range(len(w)) if self.xx[i, i] > 1e-15]
        levels = [k for k in range(len(v)) if 0 < self.p[k] < 1]
        p, sd, var = self.p.tolist(), self.sd.tolist(), (self.p * (1 - self.p)).tolist()
        for _ in range(SWEEPS):
            moved = 0.0
            pull = self.xd.T @ v
            for i in numbers:
                g = self.cx[i] - self.xx[i] @ w - pull[i] + self.xx[i, i] * w[i]
                new = np.sign(g) * max(abs(g) - alpha * self.sx[i], 0.0) / self.xx[i, i]
                moved, w[i] = max(moved, abs(new - w[i]) * self.sx[i]), new
            # Plain numbers: level by level, their arithmetic is several times faster than that of array entries.
            free, held_v, total = (self.cd - self.xd @ w).tolist(), v.tolist(), float(self.p @ v)
            for k in levels:
                was, share = held_v[k], p[k]
                g = free[k] - share * (was - total) + var[k] * was
                reach = abs(g) - alpha * sd[k]
                new = 0.0 if reach <= 0 else (reach if g > 0 else -reach) / var[k]
                if new != was:
                    total += share * (new - was)
                    moved, held_v[k] = max(moved, abs(new - was) * sd[k]), new
            v = np.array(held_v)
            if levels:
                # All levels moved alike change only the base: take the shift of the least penalty.
                held = np.array(levels)
                order = held[np.argsort(v[held], kind="stable")]
                middle = order[np.searchsorted(np.cumsum(self.sd[order]), self.sd[order].sum() / 2)]
                if len(held) == (self.p > 0).sum() and v[middle]:
                    moved = max(moved, abs(v[middle]) * self.sd[middle] * 1e-3)
                    v[held] -= v[middle]
            if moved <= self.close:
                break
        return w, v

    def weights(self, w: np.ndarray, v: np.ndarray) -> Weights:
        return Weights(float(self.ymean - self.mean @ w - self.p @ v), w, v)


def path(s: Sums, alphas: list[float]) -> dict[float, Weights]:
    """The weights for every penalty, each started from those of the next greater one."""
    problem = _Problem(s)
    w, v = np.zeros(len(s.xy)), np.zeros(len(s.n))
    out = {}
    for alpha in sorted(alphas, reverse=True):
        w, v = problem.solve(alpha, w, v)
        out[alpha] = problem.weights(w, v)
    return out


def r2_of(s: Sums, m: Weights) -> float | None:
    """R^2 of a model on rows known by their sums; None where y does not vary."""
    rows, y = s.n.sum(), s.y.sum()
    if rows == 0:
        return None
    by_level = s.n @ m.levels
    sse = (s.yy - 2 * m.base * y - 2 * m.numbers @ s.xy - 2 * m.levels @ s.y + rows * m.base ** 2
           + 2 * m.base * (m.numbers @ s.x.sum(0) + by_level) + m.numbers @ s.xx @ m.numbers
           + m.levels ** 2 @ s.n + 2 * m.levels @ (s.x @ m.numbers))
    sst = s.yy - y * y / rows
    return float(1 - sse / sst) if sst > 1e-12 * max(s.yy, 1e-300) else None


class LassoGrid:
    """Sums of a training table per fold, and the fits that follow from them."""

    def __init__(self, train: DataFrame, numbers: list[str], level: str, label: str, fold: str):
        self.numbers, self.level, self.label = numbers, level, label
        cols = [F.col(quoted(c)).cast("double") for c in numbers]
        y = F.col(quoted(label)).cast("double")
        seen = train.agg(F.avg(y).alias("y"), *[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(f"x{i}")
                                                for i, c in enumerate(cols)]).first()
        self.shift = np.array([seen[f"x{i}"].m or 0.0 for i in range(len(cols))])
        self.scale = np.array([seen[f"x{i}"].s or 1.0 for i in range(len(cols))])
        self.yshift = seen.y or 0.0
        scaled = train.select(
            F.col(quoted(fold)).alias("fold"), F.col(quoted(level)).alias("level"), (y - F.lit(self.yshift)).alias("y"),
            *[((c - F.lit(float(m))) / F.lit(float(s))).alias(f"x{i}") for i, (c, m, s) in enumerate(zip(cols, self.shift, self.scale))])
        p = len(cols)
        pairs = [(i, j) for i in range(p) for j in range(i, p)]
        products = ([F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"x{i}x{j}") for i, j in pairs]
                    + [F.sum(F.col(f"x{i}") * F.col("y")).alias(f"x{i}y") for i in range(p)] + [F.sum(F.col("y") * F.col("y")).alias("yy")])
        own = [F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), *[F.sum(f"x{i}").alias(f"x{i}") for i in range(p)]]
        # One pass over the rows; the products need no level, so they are added up per fold on Spark.
        cells = kept_table(scaled.groupBy("fold", "level").agg(*own, *products), "lasso-sums")
        totals = cells.groupBy("fold").agg(*[F.sum(c).alias(c) for c in cells.columns if c not in ("fold", "level", "n", "y", *[f"x{i}" for i in range(p)])])
        rows = cells.select("fold", "level", "n", "y", *[f"x{i}" for i in range(p)]).collect()
        self.levels = sorted({r["level"] for r in rows}, key=lambda v: (v is None, v))
        at = {v: k for k, v in enumerate(self.levels)}
        self.folds = {}
        for r in totals.collect():
            xx = np.zeros((p, p))
            for i, j in pairs:
                xx[i, j] = xx[j, i] = r[f"x{i}x{j}"]
            k = len(self.levels)
            self.folds[r["fold"]] = Sums(xx, np.array([r[f"x{i}y"] for i in range(p)]), r["yy"], np.zeros(k), np.zeros((k, p)), np.zeros(k))
        for r in rows:
            s, k = self.folds[r["fold"]], at[r["level"]]
            s.n[k], s.y[k], s.x[k] = r["n"], r["y"], [r[f"x{i}"] for i in range(p)]
        self.total = sum(self.folds.values(), Sums(np.zeros((p, p)), np.zeros(p), 0.0, np.zeros(len(at)), np.zeros((len(at), p)), np.zeros(len(at))))

    def scores(self, alphas: list[float]) -> list[tuple[float, int, float | None]]:
        """(alpha, fold, R^2 of the fold by the model of the others)."""
        out = []
        for fold, held in sorted(self.folds.items()):
            rest = self.total - held
            if rest.n.sum() == 0:
                continue
            models = path(rest, alphas)
            out += [(a, fold, r2_of(held, models[a])) for a in alphas]
        return out

    def fit(self, alpha: float) -> Weights:
        """The model of all rows, in the units of the columns."""
        m = path(self.total, [alpha])[alpha]
        w = m.numbers / self.scale
        return Weights(float(m.base + self.yshift - w @ self.shift), w, m.levels)

    def predict(self, df: DataFrame, m: Weights, out: str = "prediction") -> DataFrame:
        """Add the model's predictions; a level that was not seen adds nothing."""
        number = sum((F.col(quoted(c)).cast("double") * F.lit(float(w)) for c, w in zip(self.numbers, m.numbers)), F.lit(m.base))
        own, weight = unused(["level", "weight"], df)
        kind = df.schema[self.level].dataType.simpleString()
        table = df.sparkSession.createDataFrame(
            [(v, float(w)) for v, w in zip(self.levels, m.levels) if w], f"{own} {kind}, {weight} double")
        return (df.join(table, F.col(quoted(self.level)).eqNullSafe(F.col(own)), "left")
                .withColumn(out, number + F.coalesce(weight, F.lit(0.0))).drop(own, weight))


def best(scores: list[tuple[float, int, float | None]]) -> float:
    """The penalty with the greatest mean R^2 over the folds (the first one of equals)."""
    found: dict[float, list[float]] = {}
    for alpha, _, r2 in scores:
        found.setdefault(alpha, [])
        if r2 is not None:
            found[alpha].append(r2)
    return max(found, key=lambda a: np.mean(found[a]) if found[a] else -np.inf)
