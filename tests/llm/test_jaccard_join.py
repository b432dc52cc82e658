import random
import re

from applens.llm import jaccard_join as jj
from applens.llm.common import documents
from applens.llm.components import components


def shingles(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    live = [(i, s) for i, s in sets if i is not None and s]
    for k, (i, s) in enumerate(live):
        for j, t in live[:k]:
            c = len(s & t)
            if 100 * c >= 80 * (len(s) + len(t) - c):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def cases(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    prose = lambda n: [r.choice(words) for _ in range(n)]
    rows, at = [], 1

    def add(w):
        nonlocal at
        rows.append((at, " ".join(w)))
        at += 1

    for n in [1, 3, 5, 8, 9, 12, 30, 60, 200]:
        for _ in range(3):
            base = prose(n)
            add(base)
            add(base)
            for _ in range(4):      # chains of near copies
                k = r.randrange(n)
                base = base[:k] + prose(r.choice([0, 1])) + base[k + r.choice([0, 1]):]
                add(base)
                add(base + prose(r.randint(0, max(1, n // 5))))
    passage = prose(40)
    for _ in range(12):             # a passage that unlike documents share
        add(prose(r.randint(1, 60)) + passage + prose(r.randint(1, 30)))
    for n in range(40, 56):         # a set grows through both sides of the threshold
        add((passage + words)[:n])
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "ONE Two"), (904, "one\ttwo"), (None, "one two"),
             (903, "one two"), (905, "a " * 300), (906, "a " * 200), (907, "é É \x1c x y z")]
    return rows


def test_against_brute_force(spark, docs_of):
    for seed in (1, 2, 3):
        rows = cases(seed)
        assert got(jj.jaccard_groups(docs_of(rows))) == brute(rows)


def test_every_boundary(spark, docs_of, monkeypatch):
    rows = cases(4)
    for limit in (2, 10, 60):
        monkeypatch.setattr(jj, "boundary", lambda sizes, limit=limit: limit)
        monkeypatch.setattr(jj, "PAIRS_AT_ONCE", 2)
        assert got(jj.jaccard_groups(docs_of(rows))) == brute(rows)


def test_driver_table(spark, small):
    docs = documents(spark, small)
    assert got(jj.jaccard_groups(docs)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_empty(spark, docs_of):
    assert jj.jaccard_groups(docs_of([])).collect() == []


def test_components_of_a_long_chain(spark):
    r = random.Random(1)
    ids = r.sample(range(10_000), 300)
    rows = list(zip(ids[:200], ids[1:200])) + list(zip(ids[200:], ids[201:]))
    got = dict(components(spark.createDataFrame(rows, "a bigint, b bigint")).collect())
    assert set(got) == set(ids) and {got[i] for i in ids[:200]} == {min(ids[:200])} and {got[i] for i in ids[200:]} == {min(ids[200:])}
