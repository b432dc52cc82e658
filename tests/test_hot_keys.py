"""Hot values: found by the sketch, spread by salts, without a change of results."""

import pytest
from pyspark.sql import functions as F

from applens.functions.names import unused
from applens.operators import encoding as enc
from applens.operators import hot_keys as hk
from applens.operators import windows as win
from applens.plans import catalog_jobs as cj
from applens.sources import proxies

from conftest import SF_SMALL


@pytest.fixture()
def skewed(spark):
    # A third of the rows has one value, a third has none, the rest 500 values.
    i = F.col("id")
    return spark.range(9000).select(
        i, F.when(i % 3 == 0, F.lit("held out")).when(i % 3 == 1, F.lit(None)).otherwise((i % 500).cast("string")).alias("v"),
        (i % 2).alias("w"), F.lit("x").alias("_salt"), F.lit(1).alias("_key"), F.lit(2).alias("_hot"), F.lit(3).alias("__index"))


def test_hot_values_by_share(skewed):
    hot = hk.hot_values(skewed, ["v", "w"], tasks=12)
    assert hot == {"v": {"held out": 4, None: 4}, "w": {"0": 6, "1": 6}}
    assert hk.hot_values(skewed, ["v"], tasks=2) == {"v": {}}
    assert hk.hot_values(skewed.limit(0), ["v"]) == {"v": {}}


def test_salts_reach_their_key_rows(skewed):
    hot = {"held out": 4, None: 2}
    rows = hk.salted_rows(skewed, "v", hot, "s")
    per = {(r.v, r.s): r["count"] for r in rows.where("v = 'held out' OR v IS NULL OR v = '8'").groupBy("v", "s").count().collect()}
    assert {k for k in per if k[0] == "held out"} == {("held out", s) for s in range(4)}
    assert {k for k in per if k[0] is None} == {(None, 0), (None, 1)} and {k for k in per if k[0] == "8"} == {("8", 0)}
    assert max(per[k] for k in per if k[0] == "held out") < 900
    keys = hk.salted_keys(skewed.select("v").distinct(), "v", hot, "s")
    assert keys.where("v = 'held out'").count() == 4 and keys.where("v = '8'").count() == 1


@pytest.mark.parametrize("given", [None, {}, {"held out": 3}])
def test_index_join_gives_the_same_with_any_salts(spark, skewed, given):
    idx = enc.frequency_index(skewed.where("v <> 'held out'"), "v", "i")
    want = {r.v: float(r.i) for r in idx.collect()}
    out = enc.apply_index(skewed, idx, "v", "i", hot=given)
    assert set(out.columns) == {*skewed.columns, "i"}
    got = out.collect()
    assert len(got) == 9000
    assert all(r.i == want.get(r.v, float(len(want))) and (r._salt, r._key, r._hot, r["__index"]) == ("x", 1, 2, 3) for r in got)


def test_only_hot_values_are_sent_more_than_once(spark, skewed):
    idx = enc.frequency_index(skewed, "v", "i")
    hot = hk.hot_values(skewed, ["v"], 8)["v"]
    sent = hk.salted_keys(idx.select("v"), "v", hot, "s").count()
    assert sent == idx.count() + hot["held out"] - 1


def test_positions_keep_columns_of_any_name(spark):
    df = spark.range(50).select("id", F.lit(1).alias("_part"), F.lit(2).alias("_ROW"), F.lit(3).alias("__size"))
    out = win.with_positions(df, F.desc("id"))
    assert sorted((49 - r.id, 1, 2, 3) for r in out.collect()) == sorted(
        (r.position, r._part, r._ROW, r["__size"]) for r in out.collect())
    assert unused(["part"], df) == ["__part"]


def test_feature_plan_is_a_join_a_column(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        clean, _ = cj.clean_catalog(proxies.apps_raw(spark, SF_SMALL))
        feats, model = cj.build_features(clean)
        plan = feats._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 2 * len(cj.INDEXED)
        assert model.labels["Type"] == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
