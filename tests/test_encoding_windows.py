"""Encoders, split/folds, windows and joins."""

from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from applens.operators import encoding as enc
from applens.operators import joins as jn
from applens.operators import windows as win

from conftest import SF_SMALL


def test_frequency_index_equals_string_indexer(spark):
    rows = [(v,) for v in ["b", "a", "c", "a", "b", "d", "a", None, "e", "e"]]
    df = spark.createDataFrame(rows, "v string").repartition(3)
    ours = {r.v: r["index"] for r in enc.frequency_index(df, "v").collect()}
    model = StringIndexer(inputCol="v", outputCol="i", handleInvalid="skip").fit(df)
    assert ours == {label: i for i, label in enumerate(model.labels)}
    assert sorted(ours.values()) == list(range(len(ours)))


def test_frequency_index_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") % 997).cast("string").alias("v")).repartition(7)
    ours = enc.frequency_index(df, "v")
    assert sorted(r["index"] for r in ours.collect()) == list(range(997))
    model = StringIndexer(inputCol="v", outputCol="i").fit(df)
    assert {r.v: r["index"] for r in ours.collect()} == {label: i for i, label in enumerate(model.labels)}


def test_apply_index_unseen(spark):
    idx = spark.createDataFrame([("a", 0), ("b", 1)], "v string, index long")
    df = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    got = sorted((r.v or "", r["index"]) for r in enc.apply_index(df, idx, "v", "index").collect())
    assert got == [("", 2.0), ("a", 0.0), ("z", 2.0)]


def test_held_out_ignores_partitioning(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    held = lambda d: {r.p_partkey for r in d.where(enc.is_held_out(F.col("p_partkey"))).collect()}
    a = held(part)
    assert a == held(part.repartition(5)) and 0 < len(a) < part.count()


def test_with_dummies(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, c string")
    out = enc.with_dummies(df, "c", "cat")
    assert out.columns == ["k", "c", "cat_x", "cat_y"]
    got = {r.k: (r.cat_x, r.cat_y) for r in out.collect()}
    assert got == {1: (1, 0), 2: (0, 1), 3: (0, 0)}


def test_many_dummies(spark):
    df = spark.range(1200).select(F.col("id"), F.col("id").cast("string").alias("c"))
    wide = enc.with_dummies(df, "c")
    assert len(wide.columns) == 1202
    long = enc.dummies_long(df.unionByName(spark.createDataFrame([(5, None)], "id long, c string")), ["id"], "c")
    assert sorted((r.id, r.dummy) for r in long.collect()) == sorted((i, f"cat_{i}") for i in range(1200))


def test_positions_are_the_global_order(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3001).alias("k")).repartition(6)
    got = {r.k: r.position for r in win.with_positions(df, F.desc("k")).collect()}
    assert [got[k] for k in sorted(got, reverse=True)] == list(range(3000))


def test_frequency_indexes_of_several_columns(spark):
    rows = [("a", "x"), ("a", "y"), ("b", "y"), (None, "y"), ("c", None), ("b", "z")]
    df = spark.createDataFrame(rows, "p string, q string").repartition(4)
    got = {(r.column, r.value): (r["index"], r["count"]) for r in enc.frequency_indexes(df, ["p", "q"]).collect()}
    assert got == {("p", "a"): (0, 2), ("p", "b"): (1, 2), ("p", "c"): (2, 1),
                   ("q", "y"): (0, 3), ("q", "x"): (1, 1), ("q", "z"): (2, 1)}


def test_top_n_per_group_ties(spark):
    df = spark.createDataFrame([("g", "b", 1.0), ("g", "a", 1.0), ("g", "c", 0.5), ("h", "d", None),
                                (None, "e", 9.0)], "g string, k string, v double")
    got = [(r.g, r.k) for r in win.top_n_per_group(df, "g", "v", 2, "k").orderBy("g", "k").collect()]
    assert got == [("g", "a"), ("g", "b"), ("h", "d")]


def test_preview_and_sort(spark):
    df = spark.createDataFrame([(3, 1.0), (1, None), (2, 2.0)], "k int, v double")
    assert [r.k for r in win.preview(df, 2, "k").collect()] == [1, 2]
    assert [r.k for r in win.sort_desc(df, "v", "k").collect()] == [2, 3, 1]


def test_keep_top_keys(spark):
    rows = [("a",)] * 3 + [("b",)] * 2 + [("c",)] * 2 + [(None,)]
    df = spark.createDataFrame(rows, "App string")
    got = sorted((r.App or "") for r in jn.keep_top_keys(df, "App", 2).collect())
    assert got == ["", "a", "a", "a", "b", "b"]
    got = sorted(r.App for r in jn.keep_top_keys(df, "App", 2, keep_nulls=False).collect())
    assert got == ["a", "a", "a", "b", "b"]


def test_apply_index_spreads_hot_keys_seen_or_not(spark):
    # A third of the rows has a held-out key, another third is NULL.
    rest = spark.range(3000).select((F.col("id") % 500).cast("string").alias("v"))
    hot = spark.range(3000).select(F.lit("held out").alias("v"))
    nulls = spark.range(3000).select(F.lit(None).cast("string").alias("v"))
    idx = enc.frequency_index(rest, "v", "i")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = enc.apply_index(rest.unionByName(hot).unionByName(nulls), idx, "v", "i")
        counts = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert out.where("v = 'held out' OR v IS NULL").select("i").distinct().collect()[0].i == 500.0
        assert out.count() == 9000 and out.where("v = '7'").first().i is not None
        assert counts[-1] < 5000  # not one task with a key's 3,000 rows and its share of the rest
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(min_size=1, max_size=6), min_size=1, max_size=40), st.integers(1, 6))
def test_hash_split_property(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    flag = enc.is_held_out(F.col("k"))
    a = sorted(r.k for r in df.where(flag).collect())
    b = sorted(r.k for r in df.repartition(parts).where(flag).collect())
    assert a == b
    # Equal keys always land on the same side: every copy of a held-out key
    # is held out.
    held = set(a)
    assert len(a) == sum(k in held for k in keys)
