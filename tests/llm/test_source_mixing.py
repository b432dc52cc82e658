import random
import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from applens.llm import source_mixing as sm

SCHEMA = "doc_id bigint, text string, source string, size string, target int, copies int, _place int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, 2, 3) for i, t, s in rows], SCHEMA)


def spark_hash(*values):
    """Spark's xxhash64: each value's hash is the next one's seed; NULL leaves it."""
    h = 42
    for v, form in values:
        if v is not None:
            h = xxhash.xxh64(struct.pack(form, v), seed=h).intdigest()
    return h - (1 << 64) if h >= 1 << 63 else h


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_of(rows):
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += words(t)
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, above, level = sum(size.values()), set(), 0.0
    while total:
        left = sum(weight[s] for s in names if s not in above)
        if not left:
            break
        level = (total - sum(3 * size[s] for s in above)) / left
        more = {s for s in names if 3 * size[s] < level * weight[s]}
        if more == above:
            break
        above = more
    return size, {s: 3.0 * size[s] if s in above else min(3.0 * size[s], level * weight[s]) for s in names}


def brute(rows, seed=13):
    """{(doc_id, source, size): copies of all its rows}, by the documented draws."""
    size, target = targets_of(rows)
    units = Counter((i, s, words(t)) for i, t, s in rows)
    out = {}
    for source in size:
        own = [(k, n) for k, n in units.items() if k[1] == source]
        blocks = -(-len(own) // sm.BLOCK)
        open_ = defaultdict(list)
        for (i, _, z), n in own:
            expected = n * (target[source] / size[source] if size[source] else 0.0)
            copies = int(expected // 1)
            out[i, source, z] = copies
            mass = (expected - copies) * z
            if mass > 0:
                draw = spark_hash((seed, "<i"), (i, "<q"), (z, "<q"))
                open_[draw % blocks].append(dict(key=(i, source, z), draw=draw, size=z, mass=mass, order=(-z, draw, (i is not None, i), n)))
        level = 0
        while open_:
            held = {}
            for block, items in open_.items():
                items.sort(key=lambda u: u["order"])
                y = items[0]
                for x in items[1:]:
                    rise, fall = min(x["size"] - x["mass"], y["mass"]), min(x["mass"], y["size"] - y["mass"])
                    u = (spark_hash((seed * 64 + level, "<i"), (y["draw"], "<q"), (x["draw"], "<q")) % 2 ** 64 >> 11) * 2.0 ** -53
                    if u * (rise + fall) < fall:
                        if x["size"] - x["mass"] <= y["mass"]:
                            out[x["key"]] += 1
                            y["mass"] -= x["size"] - x["mass"]
                        else:
                            x["mass"] += y["mass"]
                            y = x
                    elif x["mass"] <= y["size"] - y["mass"]:
                        y["mass"] += x["mass"]
                    else:
                        out[y["key"]] += 1
                        x["mass"] -= y["size"] - y["mass"]
                        y = x
                held[block] = y
            if blocks <= 1:
                y = held[0]
                u = (spark_hash((seed * 64 + 63, "<i"), (y["draw"], "<q")) % 2 ** 64 >> 11) * 2.0 ** -53
                out[y["key"]] += u * y["size"] < y["mass"]
                break
            level, blocks, open_ = level + 1, -(-blocks // sm.BLOCK), defaultdict(list)
            for block, y in held.items():
                open_[block // sm.BLOCK].append(y)
    return out


def make(n, seed=1):
    r = random.Random(seed)
    rows = [(i, " ".join("w" * r.randrange(1, 4) for _ in range(int(r.paretovariate(1.1) * 5))),
             "hot" if r.random() < 0.4 else r.choice(["a", "b", "\U0001f600", "￮", "zz", None])) for i in range(n)]
    rows += [(n, None, "a"), (n + 1, "", "b"), (n + 2, " \t\n", "c"), (None, "null id", "a"), (n + 3, "a b c\x0bd\x85e", "a")]
    rows += [(7, "the same row", "hot")] * 50 + [(7, "the same id, other size", "hot"), (8, "a b c", "a")] + [(9, "x y", "tiny")] * 3
    return rows


@pytest.mark.parametrize("block", [256, 8])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(sm, "BLOCK", block)
    monkeypatch.setattr(sm, "ROWS_AT_ONCE", 16)
    rows = make(700)
    got = sm.copies(table(spark, rows).repartition(5)).collect()
    assert len(got) == len(rows)
    size, target = targets_of(rows)
    assert all(r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6 for r in got)
    sums, per = Counter(), defaultdict(list)
    for r in got:
        sums[r.doc_id, r.source, r.size] += r.copies
        per[r.doc_id, r.source, r.size].append(r.copies)
    assert sums == Counter(brute(rows))
    # Rows that are alike differ by one copy at most, and none is taken more than three times.
    assert all(max(c) - min(c) <= 1 and max(c) <= 3 for c in per.values())
    # A source misses its target by less than one document.
    for s in size:
        taken = sum(r.copies * r.size for r in got if r.source == s)
        assert abs(taken - target[s]) < max(1, max(r.size for r in got if r.source == s))


def test_same_rows_whatever_the_partitions(spark):
    rows = make(300, 4)
    a = sorted((tuple(r) for r in sm.mix(table(spark, rows).repartition(7)).collect()), key=str)
    random.Random(2).shuffle(rows)
    assert a == sorted((tuple(r) for r in sm.mix(table(spark, rows).coalesce(1)).collect()), key=str)


def test_expected_copies_are_kept(spark):
    rows = [(i, "w " * (3 + i % 5), s) for i, s in enumerate("aab" * 8)]
    size, target = targets_of(rows)
    mean, runs = Counter(), 60
    for seed in range(runs):
        for i, copies in ((k[0], c) for k, c in brute(rows, seed).items()):
            mean[i] += copies / runs
    for i, _, s in rows:
        assert abs(mean[i] - target[s] / size[s]) < 0.25


def test_empty_and_wordless(spark):
    assert sm.mix(table(spark, [])).collect() == []
    got = sm.mix(table(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 2


def test_targets_stop_at_three_times_the_size(spark):
    rows = [(1, "w " * 10, "a"), (2, "w " * 1000, "b"), (3, "w " * 5, "c"), (4, "w " * 2, "d")]
    got = {r.source: r.target for r in sm.copies(table(spark, rows)).collect()}
    assert got == {"a": 30.0, "b": 1017 - 30 - 15 - 6, "c": 15.0, "d": 6.0}


def test_no_python_in_the_plan(spark, small):
    plan = sm.mix(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))


def test_driver_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "source")
    rows = [tuple(r) for r in docs.collect()]
    got = {(r.doc_id, r.source, r.size): r.copies for r in sm.copies(docs).collect()}
    assert got == brute(rows)
