import math
import random
import struct

import duckdb
import numpy as np
import pytest

from applens.llm import topk_search as tk
from applens.llm.exact import LARGEST


def brute(rows, k=5):
    live = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            f = [float(np.float32(x)) for x in v]
            live.append((i, [int(x) * 256 if abs(x) > 2 ** 53 else math.floor(256 * x) for x in f], struct.pack(f"<{len(f)}d", *f)))
    out = []
    clip = lambda x: max(-LARGEST, min(LARGEST, x))
    for q in sorted({i for i, *_ in live if i % 50 == 0}):
        qv = min((p, v) for i, v, p in live if i == q)[1]
        s = sorted((-clip(sum(a * b for a, b in zip(qv, v))), i) for i, v, _ in live if i != q)[:k]
        out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    return out


def run(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    v = tk.integer_vectors(df)
    return sorted(map(tuple, tk.search(v, v.filter("vec_id % 50 = 0"), k).collect()))


@pytest.mark.parametrize("shard", [10_000, 40])
def test_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(tk, "SHARD_ROWS", shard)
    monkeypatch.setattr(tk, "QUERY_ROWS", 3)
    r = random.Random(1)
    rows = [(i, [round(r.uniform(-1, 1) * 64) / 64 for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(150)]                        # one very common vector
    rows += [(1500, None), (1550, [1.0, None]), (1600, [float("nan")]), (1650, [float("inf"), 1.0]), (None, [9.0] * 6),
             (1700, [1e6] * 6), (1750, []), (1800, [1.0, 2.0]), (50, rows[50][1])]
    assert run(spark, rows) == sorted(brute(rows))


def test_components_of_any_size(spark):
    assert run(spark, [(50, [1.0, 2.0]), (1, [300000.0, 1.0]), (2, [1.0, 1.0])])[0] == (50, 1, 1, 256 * 256 * 300002)
    r = random.Random(4)
    rows = [(25 * i, [r.choice([-1, 1]) * 10.0 ** r.choice([0, 5, 12, 30, 38]) * r.random() for _ in range(3)]) for i in range(60)]
    rows += [(7 + 100 * i, [2.0 ** 40, float(i), 2.0 ** -8]) for i in range(9)]
    assert run(spark, rows) == sorted(brute(rows))


def test_few_rows_and_none(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []


def test_oracle_on_driver_table(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    v = tk.integer_vectors(spark.read.parquet(f"{small}/embeddings.parquet"))
    got = sorted(map(tuple, tk.search(v, v.filter("vec_id % 50 = 0")).collect()))
    assert got == sorted(con.execute(tk.oracle()).fetchall())
