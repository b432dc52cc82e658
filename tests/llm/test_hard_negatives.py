import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from applens.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, v int, heap int"


def brute(rows):
    live = []
    for i, v, label in rows:
        if i is None or label is None or v is None or not all(c is not None and math.isfinite(c) for c in v):
            continue
        x = [math.floor(256 * c) if abs(c) < 1e30 else int(c) * 256 for c in [float(np.float32(c)) for c in v]]
        live.append((i, v, (label + 1) % 10 if i % 7 == 0 else label, x))
    clip = lambda s: max(-hn.LARGEST, min(hn.LARGEST, s))
    out = []
    for a in sorted({r[0] for r in live if r[0] % 100 == 0}):
        _, label, x = min((r[2], r[1], r[3]) for r in live if r[0] == a)[1], *min((r[2], r[1], r[3]) for r in live if r[0] == a)[::2]
        scored = sorted((-clip(sum(p * q for p, q in zip(x, r[3]))), r[0], r[2]) for r in live if r[0] != a)
        for s, positive, _ in [r for r in scored if r[2] == label][:5]:
            found = [r for r in scored if r[2] != label and 30 * -s <= 100 * -r[0] <= 90 * -s][:10]
            out += [(a, positive, n + 1, i, -s, -t) for n, (t, i, _) in enumerate(found)]
    return sorted(out)


def compare(spark, rows):
    table = spark.createDataFrame([(i, v, x, "c", 1, 2) for i, v, x in rows], SCHEMA)
    got = sorted(map(tuple, hn.negatives(table.repartition(3)).collect()))
    assert got == brute(rows)
    return got


@pytest.mark.parametrize("shard, block, tile", [(1 << 25, 512, 2048), (4000, 2, 16)])
def test_against_brute_force(spark, monkeypatch, shard, block, tile):
    monkeypatch.setattr(hn, "SHARD_BYTES", shard)
    monkeypatch.setattr(hn, "BLOCK_ROWS", block)
    monkeypatch.setattr(hn, "TILE_ROWS", tile)
    r = random.Random(2)
    rows = [(i, [round(r.uniform(-0.2, 1) * 64) / 64 for _ in range(7)], r.randrange(3)) for i in range(420)]
    rows += [(500 + 3 * i, [0.5] * 7, 1) for i in range(90)]                        # one very common vector
    rows += [(17, rows[17][1], 1), (200, [0.25] * 7, 2), (33, [0.5] * 7, 0)]        # repeated ids, an anchor's too
    rows += [(1000, None, 1), (1100, [1.0, None], 1), (1200, [float("nan")], 1), (1300, [float("inf")], 1), (1400, [1.0], None),
             (None, [9.0] * 7, 1), (1500, [], 1), (1600, [1.0, 2.0], 2), (1700, [0.0] * 7, 1), (1800, [-1.0] * 7, 2)]
    assert len(compare(spark, rows)) > 100


def test_components_of_any_size(spark):
    r = random.Random(3)
    rows = [(50 * i, [10.0 ** r.choice([0, 4, 9, 30]) * r.random() for _ in range(3)], r.randrange(2)) for i in range(40)]
    rows += [(100 * i + 1, [300000.0 + i, 1.0, 2.0], i % 2) for i in range(12)]
    compare(spark, rows)


def test_few_rows_and_none(spark):
    assert compare(spark, []) == []
    assert compare(spark, [(100, [1.0], 1)]) == []
    assert compare(spark, [(100, [1.0], 1), (1, [1.0], 1)]) == []                   # no other label
    assert compare(spark, [(3, [1.0], 1), (1, [0.5], 2)]) == []                     # no anchor
    assert compare(spark, [(100, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]) == [(100, 1, 1, 2, 65536, 32768)]


def test_other_anchors_and_counts(spark):
    table = spark.createDataFrame([(i, [i / 8.0, 1.0], i % 2, "", 0, 0) for i in range(40)], SCHEMA)
    out = hn.mine(table, F.col("vec_id") == 3, positives=2, negatives=3, low=0, high=100).collect()
    assert {r.positive_id for r in out} == {39, 37} and {r["rank"] for r in out} == {1, 2, 3}


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 40), st.integers(1, 9), st.integers(0, 99), st.booleans())
def test_strassen_is_exact(m, k, n, leaf, seed, big):
    r = np.random.default_rng(seed)
    a, b = r.integers(-2 ** 28, 2 ** 28, (m, k)), r.integers(-2 ** 28, 2 ** 28, (k, n))
    if big:
        a, b = a.astype(object) * 2 ** 60, b.astype(object)
    got = hn.strassen(a, b, leaf)
    assert got.shape == (m, n) and (got == a.dot(b)).all()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_oracle_on_driver_table(spark, sf):
    path = f"/root/testdata/{sf}/embeddings.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    got = sorted(map(tuple, hn.negatives(spark.read.parquet(path)).collect()))
    assert got == sorted(con.execute(hn.oracle()).fetchall())
