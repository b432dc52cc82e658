"""Boosted regression trees on histograms, with regularised gains: one aggregate a level.

Squared error. A leaf over rows with gradient sum G (prediction - label) and count H weighs
-soft(G, l1) / (H + l2), where soft moves G towards 0 by l1; a split gains
(score(left) + score(right) - score(both)) / 2 - gamma with score = soft(G, l1)^2 / (H + l2), and is made if
that is above 0 and either side has at least `least_rows`. Missing values (NULL, NaN and the value
named `missing`) go to the side of the greater gain.

Numbers are cut into at most `bins` bins at approximate quantiles (exactly the distinct values if these
are few). An indexed column gives one 0/1 feature a level without being spread out: its histogram by level holds
every such split. A level of a tree takes one aggregate over (node, feature, bin), combined before the
shuffle; nodes * (features * bins + levels) sums reach the driver, whatever the number of rows. Splits
of equal gain (to nine digits, as sums have no fixed order): the first feature, then the lowest cut.

Rows and columns are sampled per tree by hash, so that a fit depends on keys and the seed, not on partitions.
Predictions are carried with the rows and written to the checkpoint folder every KEPT trees.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applens.functions.names import quoted
from applens.session import kept_table

KEPT = 10
TIE = 1e-9


@dataclass(frozen=True)
class Settings:
    """Defaults are those of the model whose scores are shown; see ``TUNED`` for the tuned one."""

    trees: int = 100
    depth: int = 3
    rate: float = 0.1
    l1: float = 0.0
    l2: float = 1.0
    gamma: float = 0.0
    least_rows: float = 1.0
    base: float = 0.5
    missing: float | None = 1.0
    rows: float = 1.0
    columns: float = 1.0
    bins: int = 256
    seed: int = 0


# The tuned variant (its L1 penalty comes from the grid).
TUNED = Settings(trees=1000, depth=1, rate=0.01, rows=0.8, columns=0.7, missing=None)


@dataclass
class Node:
    """A leaf, or a split: feature number, cut (numbers: up to it goes left; a level: it goes right), side of missing ones."""

    weight: float = 0.0
    feature: int | None = None
    cut: float | int | None = None
    missing_left: bool = False
    left: Node | None = None
    right: Node | None = None


def soft(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def _score(g, h, s: Settings):
    with np.errstate(invalid="ignore", divide="ignore"):  # sides without rows are no options
        return soft(g, s.l1) ** 2 / (h + s.l2)


@dataclass
class Booster:
    """Fitted trees; `numbers` are columns, `level` an indexed column (or None)."""

    numbers: list[str]
    level: str | None
    settings: Settings
    cuts: list[list[float]] = field(default_factory=list)
    trees: list[Node] = field(default_factory=list)

    def _is_missing(self, x: Column) -> Column:
        gone = x.isNull() | F.isnan(x)
        return gone if self.settings.missing is None else gone | (x == F.lit(float(self.settings.missing)))

    def _walk(self, node: Node, goes_left, leaf) -> Column:
        if node.feature is None:
            return leaf(node)
        return F.when(goes_left(node), self._walk(node.left, goes_left, leaf)).otherwise(self._walk(node.right, goes_left, leaf))

    def _flat(self) -> Column:
        """The trees as one literal: an array of trees, each an array of its nodes, the root first."""
        def nodes(root: Node) -> list[Column]:
            order = [root]
            for n in order:
                order += [c for c in (n.left, n.right) if c is not None]
            place = {id(n): i for i, n in enumerate(order)}
            return [F.struct(F.lit(-1 if n.feature is None else n.feature).alias("feature"), F.lit(float(n.cut or 0.0)).alias("cut"),
                             F.lit(n.missing_left).alias("missing_left"), F.lit(place.get(id(n.left), 0)).alias("left"),
                             F.lit(place.get(id(n.right), 0)).alias("right"), F.lit(float(n.weight)).alias("weight")) for n in order]

        return F.array(*[F.array(*nodes(t)) for t in self.trees])

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Add the model's predictions: every tree is walked from its root, `depth` steps at most."""
        if not self.trees:
            return df.withColumn(out, F.lit(float(self.settings.base)))
        cols = [F.col(quoted(c)).cast("double") for c in self.numbers]
        values = F.array(*[F.when(~self._is_missing(x), x) for x in cols]) if cols else F.array().cast("array<double>")
        level = F.col(quoted(self.level)).cast("double") if self.level else F.lit(None).cast("double")
        row = F.struct(values.alias("x"), level.alias("level"))

        def step(at, tree, r):
            def move(n):
                x = F.get(r["x"], n["feature"])
                by_number = F.when(x.isNull(), n["missing_left"]).otherwise(x <= n["cut"])
                by_level = F.coalesce(r["level"] != n["cut"], F.lit(True))
                left = F.when(n["feature"] < len(cols), by_number).otherwise(by_level)
                return F.when(n["feature"] < 0, at).when(left, n["left"]).otherwise(n["right"])
            return F.transform(F.array(F.get(tree, at)), move)[0]

        def total(r):
            def one(tree):
                end = F.aggregate(F.sequence(F.lit(1), F.lit(self.settings.depth)), F.lit(0), lambda at, _: step(at, tree, r))
                return F.get(tree, end)["weight"]
            return F.aggregate(self._flat(), F.lit(float(self.settings.base)), lambda sum_, tree: sum_ + one(tree))

        return df.withColumn(out, F.transform(F.array(row), total)[0])

    # ------------------------------------------------------------ fitting

    def _binned(self, train: DataFrame, label: str, key: str) -> DataFrame:
        s = self.settings
        cols = [F.col(quoted(c)).cast("double") for c in self.numbers]
        present = [F.when(~self._is_missing(x), x) for x in cols]
        probs = F.array(*[F.lit(k / s.bins) for k in range(1, s.bins)])
        ask = [F.percentile_approx(x, probs, 10_000).alias(f"q{i}") for i, x in enumerate(present)]
        tops = [F.max(x).alias(f"m{i}") for i, x in enumerate(present)]
        found = train.agg(F.count(F.lit(1)).alias("n"), *ask, *tops).first()
        self.cuts = [sorted({c for c in found[f"q{i}"] or [] if c < found[f"m{i}"]}) for i in range(len(cols))]
        bins = [F.when(x.isNull(), F.lit(-1)).otherwise(_bin_of(x, c)).cast("int").alias(f"b{i}")
                for i, (x, c) in enumerate(zip(present, self.cuts))]
        level = [F.coalesce(F.col(quoted(self.level)).cast("int"), F.lit(-1)).alias(f"b{len(cols)}")] if self.level else []
        y = F.col(quoted(label)).cast("double")
        return train.select(F.col(quoted(key)).cast("string").alias("key"), y.alias("y"), *bins, *level,
                            F.lit(float(s.base)).alias("f")).where(y.isNotNull())

    def fit(self, train: DataFrame, label: str, key: str) -> Booster:
        s = self.settings
        rows = kept_table(self._binned(train, label, key), "boosting-rows")
        shown = [F.struct(F.lit(i).alias("feature"), F.col(f"b{i}").alias("bin")) for i in range(len(self.numbers) + bool(self.level))]
        binned = lambda n: (
            F.when(F.col(f"b{n.feature}") < 0, F.lit(n.missing_left)).otherwise(F.col(f"b{n.feature}") <= F.lit(self._bin(n)))
            if n.feature < len(self.numbers) else F.col(f"b{n.feature}") != F.lit(n.cut))
        levels = None
        for t in range(s.trees):
            sample = rows
            if s.rows < 1:
                drawn = F.xxhash64(F.lit(s.seed), F.lit(t), F.col("key")) % 1_000_000
                sample = rows.where(F.abs(drawn) < int(s.rows * 1_000_000))
            root = Node()
            leaves = [root]
            for depth in range(s.depth):
                open_ = {id(n): i for i, n in enumerate(leaves)}
                node = self._walk(root, binned, lambda n: F.lit(open_.get(id(n), -1)))
                cells = (sample.select(node.alias("node"), (F.col("f") - F.col("y")).alias("g"), F.array(*shown).alias("cells"))
                         .where("node >= 0").select("node", "g", F.inline("cells")))
                found = cells.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("h")).collect()
                if levels is None:
                    levels = sorted({r.bin for r in found if self.level and r.feature == len(self.numbers) and r.bin >= 0})
                allowed = self._columns(t, levels)
                hist: list[dict[int, dict[int, tuple[float, float]]]] = [{} for _ in leaves]
                for r in found:
                    hist[r.node].setdefault(r.feature, {})[r.bin] = (r.g, float(r.h))
                if depth == 0 and not found:
                    break
                leaves = [child for n, h in zip(leaves, hist) for child in self._split(n, h, allowed)]
                if not leaves:
                    break
            self.trees.append(root)
            step = self._walk(root, binned, lambda n: F.lit(float(n.weight)))
            rows = rows.withColumn("f", F.col("f") + step)
            if (t + 1) % KEPT == 0 and t + 1 < s.trees:
                rows = kept_table(rows, "boosting-rows")
        return self

    def _bin(self, n: Node) -> int:
        return self.cuts[n.feature].index(n.cut) if n.cut != math.inf else len(self.cuts[n.feature])

    def _columns(self, tree: int, levels: list[int]) -> set[tuple[int, int | None]]:
        """The features of a tree: numbers, and one for every level."""
        every = [(i, None) for i in range(len(self.numbers))] + [(len(self.numbers), v) for v in levels]
        if self.settings.columns >= 1:
            return set(every)
        n = max(1, int(self.settings.columns * len(every)))
        return set(random.Random(f"{self.settings.seed}:{tree}").sample(every, n))

    def _split(self, node: Node, hist: dict[int, dict[int, tuple[float, float]]], allowed) -> list[Node]:
        """Give the node its weight, or the best split; the new nodes."""
        s = self.settings
        if not hist:
            return []
        cells = next(iter(hist.values())).values()
        g, h = sum(c[0] for c in cells), sum(c[1] for c in cells)
        node.weight = float(-s.rate * soft(g, s.l1) / (h + s.l2))
        best: tuple | None = None
        for f, cells in sorted(hist.items()):
            gone = cells.get(-1, (0.0, 0.0))
            if f < len(self.numbers):
                if (f, None) not in allowed:
                    continue
                bins = sorted(b for b in cells if b >= 0)
                gl = np.cumsum([0.0] + [cells[b][0] for b in bins])
                hl = np.cumsum([0.0] + [cells[b][1] for b in bins])
                at = [-math.inf] + [self.cuts[f][b] if b < len(self.cuts[f]) else math.inf for b in bins]
                options = [(gl, hl, False)] + ([(gl + gone[0], hl + gone[1], True)] if gone[1] else [])
            else:
                at = [b for b in sorted(cells) if (f, b) in allowed]
                options = [(np.array([g - cells[b][0] for b in at]), np.array([h - cells[b][1] for b in at]), False)]
            for left_g, left_h, side in options:
                ok = (left_h >= max(s.least_rows, 0.5)) & (h - left_h >= max(s.least_rows, 0.5))
                gain = np.where(ok, (_score(left_g, left_h, s) + _score(g - left_g, h - left_h, s) - _score(g, h, s)) / 2 - s.gamma, -np.inf)
                if not len(gain) or not gain.max() > 0:
                    continue
                i = int(np.argmax(gain >= gain.max() * (1 - TIE)))
                if best is None or gain[i] > best[0] * (1 + TIE):
                    best = (gain[i], f, at[i], side, left_g[i], left_h[i])
        if best is None or best[0] <= TIE * max(1.0, abs(g)):
            return []
        _, node.feature, node.cut, node.missing_left, left_g, left_h = best
        node.left = Node(float(-s.rate * soft(left_g, s.l1) / (left_h + s.l2)))
        node.right = Node(float(-s.rate * soft(g - left_g, s.l1) / (h - left_h + s.l2)))
        return [node.left, node.right]


def _bin_of(x: Column, cuts: list[float]) -> Column:
    """How many cuts lie below x."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < x))


def fit(train: DataFrame, numbers: list[str], level: str | None, label: str, key: str,
        settings: Settings = Settings()) -> Booster:
    """Fit the booster on numeric columns and the levels of one indexed column; `key` names a row for sampling."""
    return Booster(list(numbers), level, settings).fit(train, label, key)
