import random
import re
from collections import Counter

import duckdb

from applens.llm import quality_rules as qr
from applens.llm.common import documents

COLUMNS = ["doc_id", *qr.COUNTS, "base_failed", "kept"]


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if c[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_counts_against_brute_force(spark, docs_of):
    r = random.Random(1)
    pieces = ["a", "b", "é", "a b c", "\n", " ", "\t", "\x0b", "\x1c", "\x85", "#", "$|", "<b>", "\n\n", "a b c d e", "中", "\U0001F600"]
    rows = [(i, "".join(r.choice(pieces) for _ in range(r.randint(0, 60)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "a a a a a"), (903, "a b a b a b"), (904, " \n \n"), (None, "x y"), (902, "a a a a a")]
    got = qr.quality(docs_of(rows)).select(*COLUMNS[:-1]).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)


def test_oracle_on_driver_table(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    rel = con.execute(qr.oracle())
    assert [d[0] for d in rel.description] == COLUMNS
    assert sorted(rel.fetchall()) == sorted(map(tuple, qr.quality(documents(spark, small)).select(*COLUMNS).collect()))


def test_lines_and_verdict(spark, docs_of):
    prose = "\n".join(" ".join(f"word{i}x{j}" for j in range(12)) + "." for i in range(8))
    rows = [(1, prose), (2, prose + "\nHome | About | News | Contact"), (3, prose + "\nCopyright 2020"),
            (4, "\n".join(f"w{i}###$$$ x{i}%%%&&&" for i in range(60))), (5, prose[:200] + "\n" + "a | b | c | d " * 40)]
    got = {r.doc_id: r for r in qr.quality(docs_of(rows)).collect()}
    assert [got[i].kept for i in range(1, 6)] == [True, True, True, False, False]
    assert got[1].clean_text == got[2].clean_text == got[3].clean_text == prose


def test_plan_is_native_and_columns_pass(spark, docs_of):
    df = docs_of([(1, "x " * 60_000), (2, None)]).selectExpr("*", "1 AS n_words", "2 AS `a.b`", "3 AS full", "4 AS w")
    out = qr.quality(df)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].n_words == 60_000 and rows[1]["a.b"] == 2 and rows[1].full == 3 and rows[1].w == 4 and rows[1].base_failed
    assert rows[2].n_words == 0 and rows[2].clean_text is None and not rows[2].kept
    assert qr.quality(docs_of([])).collect() == []
