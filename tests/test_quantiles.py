"""Exact quantiles: brackets by sketches, ranks by counts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from applens.operators import quantiles as qt

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def columns(n=20_000):
    r = np.random.default_rng(5)
    return {
        "normal": r.normal(0, 1, n), "heavy": np.where(r.random(n) < 0.45, -1.0, np.where(r.random(n) < 0.8, 2.0, r.random(n))),
        "few": r.integers(0, 3, n).astype(float), "far": np.r_[r.random(n - 2), 1e300, -1e300], "same": np.full(n, 7.5),
        "gaps": np.where(r.random(n) < 0.3, np.nan, r.exponential(1e6, n)),
    }


@pytest.fixture(scope="module")
def table(spark):
    data = columns()
    rows = list(zip(*[v.tolist() for v in data.values()]))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(6)
    return df.withColumn("none", F.lit(None).cast("double")).withColumn("a b", F.col("few").cast("int"))


@pytest.mark.parametrize("few", [100_000, 300, 40])
def test_equal_to_sorted_values(spark, table, monkeypatch, few):
    monkeypatch.setattr(qt, "FEW", few)
    monkeypatch.setattr(qt, "SKETCH", 200)
    monkeypatch.setattr(qt, "MARGIN", 0.02)
    asked = []
    real = qt._look
    monkeypatch.setattr(qt, "_look", lambda df, a: asked.append(len(a)) or real(df, a))
    got = {(r.column, r.p): r.value for r in qt.exact_quantiles(table, [*columns(), "none", "a b"], PROBS).collect()}
    assert len(got) == 7 * len(PROBS) and not any(c == "none" for c, _ in got)
    for c, v in columns().items():
        want = np.quantile(v[~np.isnan(v)], PROBS)
        assert np.allclose([got[c, p] for p in PROBS], want, rtol=1e-12, atol=1e-12), c
    assert [got["a b", p] for p in PROBS] == [got["few", p] for p in PROBS]
    assert (len(asked) > 0) == (few < 20_000) and len(asked) < 12


def test_missed_brackets_are_widened(spark, table, monkeypatch):
    monkeypatch.setattr(qt, "FEW", 50)
    monkeypatch.setattr(qt, "SKETCH", 8)
    monkeypatch.setattr(qt, "MARGIN", 0.0005)  # far below the sketch's error
    got = {r.p: r.value for r in qt.exact_quantiles(table, ["normal"], [0.25, 0.5]).collect()}
    assert np.allclose([got[0.25], got[0.5]], np.quantile(columns()["normal"], [0.25, 0.5]), rtol=1e-12)


def test_no_sort_of_the_column(table):
    plan = qt.exact_quantiles(table, ["normal", "far"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("Exchange hashpartitioning") <= 3
