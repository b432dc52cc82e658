import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from applens.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, error string, codes int"


def brute(rows, parts=4, entries=256, rounds=4):
    """[(vec_id, code, error, label)] and the codebooks' hash, in Python integers."""
    live = [(i, v, x) for i, v, x in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    if not live:
        return [], None
    width = -(-max(len(v) for _, v, _ in live) // parts)
    live.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = []
    for _, v, _ in live:
        full = [math.floor(1024 * np.float64(np.float32(c))) if abs(c) < 1e30 else int(np.float32(c)) * 1024 for c in v]
        full += [0] * (parts * width - len(v))
        cut.append([full[p * width:(p + 1) * width] for p in range(parts)])
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for c in cut:
                of.setdefault(near(c[p], books[p])[0], []).append(c[p])
            books[p] = [[sum(k) // len(of[e]) for k in zip(*of[e])] if e in of else b for e, b in enumerate(books[p])]
    out = []
    for (i, _, label), c in zip(live, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e, _ in found), min(sum(d for _, d in found), vc.LARGEST), label))
    flat = ",".join(str(v) for book in books for e in book for v in e)
    return out, hashlib.sha256(flat.encode()).hexdigest()


def compare(spark, rows, **kind):
    table = spark.createDataFrame([(i, v, x, "e", 1) for i, v, x in rows], SCHEMA)
    want, digest = brute(rows)
    total = {}
    for _, _, e, label in want:
        total[label] = min(total.get(label, 0) + e, vc.LARGEST)
    got = sorted((tuple(r) for r in vc.codes(table.repartition(3)).collect()), key=str)
    assert got == sorted(((i, c, e, total[x], digest) for i, c, e, x in want), key=str)
    return got


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vc, "CHUNK", 50)
    r = random.Random(5)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(8)], r.choice([None, 1, 2, 3])) for i in range(330)]
    rows += [(1000 + i, [0.25] * 8, 9) for i in range(60)]                          # one very common vector
    rows += [(3, [0.5] * 8, 1), (None, [1.0] * 8, 2), (5, rows[5][1], 3)]           # repeated and NULL ids
    rows += [(2000, None, 1), (2001, [1.0, None], 1), (2002, [float("nan")] * 8, 1), (2003, [float("inf")] * 8, 1)]
    rows += [(2004, [], 4), (2005, [1.0, -2.0], 4)]                                 # shorter ones end in zeros
    compare(spark, rows)


def test_components_of_any_size(spark):
    r = random.Random(6)
    rows = [(i, [float(np.float32(r.gauss(0, 10.0 ** r.choice([0, 0, 3, 8])))) for _ in range(4)], i % 2) for i in range(40)]
    rows += [(100, [3e38, -3e38, 1e20, 0.5], 7), (101, [2.9e38, -3e38, 1e20, 0.75], 7), (102, [1e15, 1.0, 1e10, 0.0], 8)]
    compare(spark, rows)


def test_width_that_parts_do_not_divide_few_rows_and_none(spark):
    compare(spark, [(2, [1.0, 2.0, 3.0, 4.0, 5.0], 1), (1, [0.5, 0.1, 3.0, 4.0, 5.0], None)])
    compare(spark, [(1, [], 1)])
    assert compare(spark, []) == [] and compare(spark, [(1, None, 1)]) == []


def test_products_are_exact():
    r = np.random.default_rng(1)
    for bits in (10, 25, 29):
        x, c = r.integers(-2 ** bits, 2 ** bits, (40, 13)), r.integers(-2 ** bits, 2 ** bits, (30, 13))
        assert (vc.products(x, c) == x @ c.T).all()
    a, b = x.astype(object), c.astype(object)
    want = ((a[:, None] - b[None]) ** 2).sum(2)
    at, d = vc.nearest(x, c)
    assert (at == [list(row).index(min(row)) for row in want]).all() and (d == want.min(1)).all()


def test_encode_keeps_other_columns(spark):
    table = spark.createDataFrame([(i, [i / 7.0] * 4, i, "x", 5) for i in range(9)], SCHEMA)
    out = vc.encode(table, vc.fit(table, entries=3))
    assert out.columns == ["vec_id", "label", "codes", "error"]
    assert all(len(r.codes) == 4 and max(r.codes) < 3 for r in out.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_oracle_on_driver_table(spark, sf):
    path = f"/root/testdata/{sf}/embeddings.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    got = sorted(map(tuple, vc.codes(spark.read.parquet(path)).collect()))
    assert got == sorted(con.execute(vc.oracle()).fetchall())
