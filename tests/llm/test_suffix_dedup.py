import hashlib
import random

from applens.llm import suffix_dedup as sd
from applens.llm.common import documents


def brute(rows, w=50):
    least = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        if i is not None:
            for s in range(len(b) - w + 1):
                k = b[s:s + w]
                least[k] = min(least.get(k, i), i)
    out = []
    for i, b in texts:
        cov = bytearray(len(b))
        if i is not None:
            for s in range(len(b) - w + 1):
                if least[b[s:s + w]] < i:
                    cov[s:s + w] = b"\1" * w
        kept = bytes(x for x, c in zip(b, cov) if not c)
        spans = sum(1 for j in range(len(b)) if cov[j] and (j == 0 or not cov[j - 1]))
        out.append((i, len(b), sum(cov), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def cases(seed=1):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(60)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, other = prose(30), prose(14)
    rows = [(i, prose(r.randint(0, 40)) + passage[r.randint(0, 20):] + prose(3) + other) for i in range(20)]
    rows += [(30 + i, rows[i][1]) for i in range(6)]                       # copies
    rows += [(50, None), (51, ""), (52, "x" * 400), (53, "x" * 49), (54, "yx" * 200), (55, "x" * 50)]
    rows += [(60, "ab" * 30 + passage), (60, "ab" * 30 + passage)]         # a repeated row
    rows += [(None, passage), (70, passage * 3), (71, passage[:49]), (72, passage[:50]), (73, passage[1:51])]
    return rows


def test_against_brute_force(spark, docs_of, monkeypatch):
    for seed in (1, 2):
        assert got(sd.remove_repeats(docs_of(cases(seed)))) == brute(cases(seed))
    monkeypatch.setattr(sd, "BLOCK_BYTES", 900)
    monkeypatch.setattr(sd, "BUCKET_ENTRIES", 50)
    assert got(sd.remove_repeats(docs_of(cases(3)), with_text=False)) == brute(cases(3))


def test_driver_table(spark, small):
    docs = documents(spark, small)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(sd.remove_repeats(docs)) == brute(rows)


def test_text_spans_and_other_columns(spark, docs_of):
    df = docs_of([(1, "é" * 60), (2, "ab " + "é" * 40)]).selectExpr("*", "1 AS n_bytes", "doc_id AS `a.b`", "'k' AS block")
    rows = {r.doc_id: r for r in sd.remove_repeats(df).collect()}
    assert rows[2].kept_text == "ab " and [tuple(s) for s in rows[2].spans] == [(3, 83)]
    assert rows[1].kept_text == "é" * 60 and rows[1]["a.b"] == 1 and rows[2].n_bytes == 83


def test_empty_table(spark, docs_of):
    assert sd.remove_repeats(docs_of([])).collect() == []
