"""Splits of exact size, point samples of cells, sparse dummies."""

import math

import pytest
from pyspark.sql import functions as F

from applens.operators import encoding as enc
from applens.operators import profiling as prof
from applens.operators import windows as win

from conftest import SF_SMALL


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.333, 0.9, 1.0])
def test_size_is_exact_whatever_the_partitions(spark, fraction):
    rows = [(i % 37 if i % 3 else 7, i // 5, None if i % 4 else "x") for i in range(1000)] + [(None, 1, "n")] * 40 + [(7, 0, "copy")] * 300
    df = spark.createDataFrame(rows, "k int, v int, _digest string")
    found = []
    for parts in (1, 6):
        out = enc.exact_split(df.repartition(parts), F.col("k"), fraction, 1)
        assert out.columns == [*df.columns, "held_out"]
        found.append(sorted(map(str, out.collect())))
        assert out.where("held_out").count() == math.ceil(fraction * len(rows)) and out.count() == len(rows)
    assert found[0] == found[1]


def test_all_alike_and_empty(spark):
    df = spark.range(200).select(F.lit("same").alias("k"))
    out = enc.exact_split(df.repartition(5), F.col("k"), 0.2)
    assert out.where("held_out").count() == 40
    assert enc.exact_split(df.limit(0), F.col("k")).collect() == []


def test_keys_are_split_as_by_the_threshold(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    held = {r.k for r in enc.exact_split(df, F.col("k"), 0.2, 42).where("held_out").collect()}
    byhash = {r.k for r in df.where(enc.is_held_out(F.col("k"), 0.2, 42)).collect()}
    assert len(held) == 1000 and (held <= byhash or byhash <= held)


def test_numbers_without_an_order(spark):
    out = win.with_positions(spark.range(100).repartition(7))
    assert sorted(r.position for r in out.collect()) == list(range(100))


def test_points_of_cells(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    counts = {(r.p_type, r.bx, r["by"]): r["count"] for r in prof.pair_bins(part, "p_size", "p_retailprice", hue="p_type", bins=4).collect()}
    a = prof.scatter_sample(part, "p_size", "p_retailprice", "p_partkey", hue="p_type", bins=4, k=6)
    b = prof.scatter_sample(part.repartition(9), "p_size", "p_retailprice", "p_partkey", hue="p_type", bins=4, k=6)
    got = sorted(map(tuple, a.collect()))
    assert got == sorted(map(tuple, b.collect()))
    per = {}
    for r in got:
        per[r[:3]] = per.get(r[:3], 0) + 1
    assert per == {c: min(6, n) for c, n in counts.items()}
    assert "WindowGroupLimit" in a._jdf.queryExecution().executedPlan().toString()


def test_sparse_dummies_equal_the_wide_ones(spark):
    df = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, None, 3), (4, "x", 4), (5, "new", 5)], "k int, c string, _place int")
    index = enc.frequency_index(df.where("c <> 'new'"), "c")
    wide = {r.k: (r.cat_x, r.cat_y) for r in enc.with_dummies(df, "c", levels=["x", "y"]).collect()}
    out = enc.dummy_vectors(df, index, "c", "d")
    assert set(out.columns) == {"k", "c", "_place", "d"}
    for r in out.collect():
        assert r.d.size == 2 and tuple(int(v) for v in r.d.toArray()) == wide[r.k] and r.d.numNonzeros() <= 1


def test_wide_dummies_have_a_limit(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="dummy_vectors"):
        enc.dummy_levels(df, "c", most=49)
    assert len(enc.dummy_levels(df, "c", most=50)) == 50
