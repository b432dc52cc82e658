"""Profiles, aggregates and report tables."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from applens.operators import aggregates as agg
from applens.operators import profiling as prof

from conftest import SF_SMALL


def part(spark):
    return spark.read.parquet(f"{SF_SMALL}/part.parquet")


def test_describe_matches_pandas(spark):
    df = part(spark)
    got = {r.column: r for r in prof.describe_exact(df, ["p_size", "p_retailprice"]).collect()}
    pdf = df.toPandas()
    for c in ["p_size", "p_retailprice"]:
        d = pdf[c].astype(float).describe()
        r = got[c]
        assert r["count"] == d["count"]
        for ours, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                             ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert math.isclose(r[ours], d[theirs], rel_tol=1e-9), (c, ours)


def test_profile_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    got = {r.column: r for r in prof.profile(df).collect()}
    assert (got["x"].non_null, got["x"].nulls, got["x"].dtype) == (1, 2, "double")
    assert (got["s"].non_null, got["s"].nulls, got["s"].position) == (2, 1, 1)


def test_corr_matrix(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0), (None, 1.0, 5.0)],
                               "x double, y double, k double")
    got = {(r.a, r.b): r.r for r in prof.corr_matrix(df, ["x", "y", "k"]).collect()}
    pdf = pd.DataFrame({"x": [1, 2, 3, None], "y": [2, 4.1, 5.9, 1.0]})
    assert math.isclose(got[("x", "y")], pdf.corr().loc["x", "y"], rel_tol=1e-12)
    assert got[("x", "y")] == got[("y", "x")]
    assert got[("k", "x")] is None and got[("k", "k")] is None
    assert math.isclose(got[("x", "x")], 1.0)


def test_histogram_last_bin_closed_and_empty_bins(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 1.0, 1.0, 10.0]], "x double")
    rows = prof.histogram(df, "x", 10).orderBy("bin").collect()
    counts = [r["count"] for r in rows]
    assert counts == list(np.histogram([0, 1, 1, 10], bins=10)[0])
    assert len(rows) == 10 and rows[-1]["hi"] == 10.0


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    counts = [r["count"] for r in prof.histogram(df, "x", 10).orderBy("bin").collect()]
    assert counts == list(np.histogram([3.0, 3.0], bins=10)[0])


def test_kde_integrates_to_one(spark):
    df = part(spark)
    rows = prof.kde(df, "p_size", 200).orderBy("point").collect()
    xs = np.array([r.x for r in rows])
    ys = np.array([r.density for r in rows])
    assert len(rows) == 200
    assert abs(np.trapezoid(ys, xs) - 1.0) < 0.01
    vals = df.toPandas()["p_size"].astype(float).to_numpy()
    bw = vals.std(ddof=1) * len(vals) ** -0.2
    direct = np.exp(-0.5 * ((xs[:, None] - vals[None, :]) / bw) ** 2).sum(1) / (len(vals) * bw * math.sqrt(2 * math.pi))
    assert np.allclose(ys, direct, rtol=1e-9, atol=1e-15)


def test_pair_bins_total(spark):
    df = part(spark)
    out = prof.pair_bins(df, "p_size", "p_retailprice", hue="p_type", bins=5)
    assert out.agg(F.sum("count")).first()[0] == df.count()
    assert out.agg(F.max("bx"), F.max("by")).first() == (5, 5)


def test_value_counts_and_share(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("c",)], "k string")
    vc = [(r.k, r["count"]) for r in agg.value_counts(df, "k").collect()]
    assert vc == [("a", 2), ("b", 1), ("c", 1)]
    shares = {r.k: r.share for r in agg.class_share(df, "k").collect()}
    assert shares == {"a": 50.0, "b": 25.0, "c": 25.0}


def test_polarity_by_app(spark):
    df = spark.createDataFrame([("com.x.a", 0.0), ("com.x.a", -0.5), ("b", 0.2)], "App string, Polarity double")
    got = {r.App: r for r in agg.polarity_by_app(df).collect()}
    assert (got["com.x.a"].non_negative, got["com.x.a"].negative, got["com.x.a"].short) == (1, 1, "x-a")
    assert (got["b"].non_negative, got["b"].short) == (1, "b")


def test_genre_rollup_text_installs(spark):
    df = spark.createDataFrame([("G1", "10,000+", 4.0), ("G1", "500+", None), ("G2", "0", 3.0),
                                (None, "1+", 5.0)], "Genres string, Installs string, Rating double")
    got = {r.Genres: r for r in agg.genre_rollup(df, top=None).collect()}
    assert set(got) == {"G1", "G2"}
    assert (got["G1"].Count, got["G1"].Installs, got["G1"].Rating) == (2, 10500, 4.0)


def test_exact_quantiles_match_percentile(spark):
    import random

    from applens.operators.quantiles import exact_quantiles

    rnd = random.Random(3)
    rows = [(rnd.choice([1.0, 2.0, 2.0, 3.5]) if i % 3 else rnd.random() * 100, float(i),
             None if i % 5 else 7.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r.column, r.q): r.value for r in exact_quantiles(df, ["a", "b", "c"], probs).collect()}
    ref = df.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c)
                   for c in ["a", "b", "c"]]).first()
    for c in ["a", "b", "c"]:
        for i in range(len(probs)):
            assert math.isclose(got[(c, i)], ref[c][i], rel_tol=1e-12), (c, probs[i])


def test_exact_quantiles_empty_column(spark):
    from applens.operators.quantiles import exact_quantiles

    df = spark.createDataFrame([(None,), (float("nan"),)], "a double")
    assert exact_quantiles(df, ["a"], [0.5]).count() == 0


def test_kde_by_group_matches_per_group(spark):
    df = part(spark)
    grouped = {(r.p_type, r.point): r.density for r in prof.kde(df, "p_size", 50, by="p_type").collect()}
    for t in [r.p_type for r in df.select("p_type").distinct().limit(2).collect()]:
        one = prof.kde(df.where(F.col("p_type") == t), "p_size", 50).collect()
        for r in one:
            a, b = grouped[(t, r.point)], r.density
            assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-15)


def test_pair_grid_counts(spark):
    df = spark.createDataFrame([(1.0, 2.0, None, "a"), (2.0, 4.0, 1.0, "b"), (3.0, 8.0, 2.0, "a")],
                               "x double, y double, z double, h string")
    out = prof.pair_grid(df, ["x", "y", "z"], hue="h", bins=4)
    totals = {(r.x_col, r.y_col): r.n for r in out.groupBy("x_col", "y_col").agg(F.sum("count").alias("n")).collect()}
    assert totals == {("x", "y"): 3, ("x", "z"): 2, ("y", "z"): 2}


def test_corr_all_equals_pairwise(spark):
    import random

    rnd = random.Random(2)
    rows = [(rnd.random(), rnd.random() * 5, float(i % 3), 7.0) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, t double, k double").repartition(3)
    got = {(r.a, r.b): r.r for r in prof.corr_all(df, dummies={"t": [0.0, 1.0, 9.0]}).collect()}
    ref = {(r.a, r.b): r.r for r in prof.corr_matrix(df, ["a", "b", "t", "k"]).collect()}
    assert len(got) == 49
    for k, v in ref.items():
        assert (got[k] is None) == (v is None) and (v is None or math.isclose(got[k], v, abs_tol=1e-12))
    one = {(r.a, r.b): r.r for r in prof.corr_matrix(df.withColumn("d", (F.col("t") == 1).cast("double")), ["a", "d"]).collect()}
    assert math.isclose(got["a", "t_1.0"], one["a", "d"], abs_tol=1e-12) and got["a", "t_9.0"] is None
    assert all(r.r is None for r in prof.corr_all(df.limit(0)).collect())


def test_corr_all_with_levels_from_the_data(spark):
    rows = [(float(i * 7 % 13), "abcdd"[i % 5], None if i % 4 == 0 else i % 3, 2.0) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, s string, `k-2` int, one double").repartition(5)
    got = {(r.a, r.b): r.r for r in prof.corr_all(df, ["x", "one"], {"s": None, "k-2": [0, 1, 7]}).collect()}
    wide = pd.DataFrame(rows, columns=["x", "s", "k-2", "one"])
    made = wide[["x", "one"]].assign(**{f"s_{v}": wide.s == v for v in "abcd"},
                                     **{f"k-2_{v}": wide["k-2"] == v for v in (0, 1, 7)}).astype(float)
    want = made.corr()
    assert len(got) == made.shape[1] ** 2
    for (a, b), r in got.items():
        w = want.loc[a, b]
        assert (r is None) == math.isnan(w) and (r is None or math.isclose(r, w, abs_tol=1e-12)), (a, b, r, w)


def test_corr_all_of_dummies_alone_or_of_nothing(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    got = {(r.a, r.b): r.r for r in prof.corr_all(df, [], {"s": None}).collect()}
    assert math.isclose(got["s_a", "s_a"], 1.0) and math.isclose(got["s_a", "s_b"], -0.5) and len(got) == 4
    assert prof.corr_all(df.limit(0), [], {"s": None}).collect() == []


def direct_density(vals, xs, bw):
    return np.exp(-0.5 * ((xs[:, None] - vals[None, :]) / bw) ** 2).sum(1) / (len(vals) * bw * math.sqrt(2 * math.pi))


def test_kde_by_group_within_its_bound(spark):
    r = np.random.default_rng(4)
    groups = {"hot": r.normal(0, 1, 4000), "far": np.r_[r.normal(0, 1, 300), 1e4, -3e5], "few": np.array([1.0, 2.0, 2.0]),
              "one": np.array([5.0]), "two": r.exponential(3.0, 500)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("few", None), ("two", float("nan")), (None, 1.0)]
    out = prof.kde(spark.createDataFrame(rows, "`the group` string, x double").repartition(6), "x", 200, by="the group").collect()
    assert len(out) == 5 * 200
    for g, vals in groups.items():
        own = sorted((p.point, p.x, p.density) for p in out if p["the group"] == g)
        assert [p for p, _, _ in own] == list(range(200))
        if g == "one":
            assert all(d is None for _, _, d in own)
            continue
        bw = vals.std(ddof=1) * len(vals) ** -0.2
        xs, ys = np.array([x for _, x, _ in own]), np.array([d for _, _, d in own])
        assert np.abs(ys - direct_density(vals, xs, bw)).max() < 2e-12 / bw


def test_kde_spreads_bins_not_values(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003 / 200_003.0).alias("x"))
    plan = prof.kde(df, "x")
    plan.collect()
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    # The only rows that are multiplied are the grid's points and the bins (about four a bandwidth).
    assert text.count("Generate explode") == 2 and "Aggregate [x#" not in text


def test_kde_constant_group_is_null_not_error(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 0.0), ("b", 1.0), ("b", 3.0)], "g string, x double")
    rows = prof.kde(df, "x", 20, by="g").collect()
    assert all(r.density is None for r in rows if r.g == "a")
    assert all(r.density is not None for r in rows if r.g == "b")
