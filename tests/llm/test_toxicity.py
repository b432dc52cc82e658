import zlib

import numpy as np

from applens.llm import toxicity as tx
from applens.llm.common import documents


def brute_kernel(w, v):
    def feats(s):
        out = {}
        for i in range(len(s)):
            for g, h in tx.GAPS:
                if i + g + h < len(s):
                    k = s[i] + s[i + g] + s[i + g + h]
                    out[k] = out.get(k, 0) + tx.DECAY ** (g + h - 2)
        return out
    a, b = feats(w), feats(v)
    return sum(x * b.get(k, 0) for k, x in a.items())


def test_kernel_of_best_word():
    texts = ["you moron and idiot", "nothing here", "an idiiot xx", None, "", "i d i o t", "x" * 500]
    toxic = [1, 0, 1, 0, 0, 1, 0]
    model = tx.train(texts * 3, toxic * 3)
    marks = ["".join(chr(96 + c) for c in s)  # chr(159): a word's start
             for s in tx._landmark_strings(texts * 3, np.array(toxic * 3) == 1)]
    got = model.features(texts)
    for j, m in enumerate(marks):
        norm = brute_kernel(m, m)
        for i, t in enumerate(texts[:5]):
            best = max([brute_kernel("\x9f" + w, m) for w in (t or "").split()] or [0])
            assert abs(got[i, j] - min(1, best / norm) ** tx.DEGREE) < 1e-4
            assert (got[i, len(marks) + j] > 0) == (best / norm >= tx.WHOLE)
    assert model.features(["i d i o t"]).tolist() == model.features(["idiot"]).tolist()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    scored = tx.add_scores(docs, tx.fit(docs, labels)).select("doc_id", "text", "toxicity")
    truth = dict(labels.select("doc_id", "toxic").collect())
    out = [(truth[r.doc_id], r.toxicity) for r in scored.collect()
           if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    hits = sum((s >= 0.5) == (t == 1) for t, s in out)
    caught = sum(s >= 0.5 for t, s in out if t == 1) / sum(t == 1 for t, _ in out)
    assert hits / len(out) > 0.97 and caught > 0.9


def test_inserted_and_gapped(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    model = tx.fit(docs, labels)
    frame = "the thing of {} and the other ones."
    clean, whole = model.score([frame.format("words")])[0], model.score([frame.format("idiot")])[0]
    assert clean < 0.5 < whole
    for bad in ("id-iot", "i d i o t", "IDIOT", "idiotish", "i.d.iot"):
        assert model.score([frame.format(bad)])[0] >= 0.5
    for bad in ("idxiot", "idiqot"):
        assert model.score([frame.format(bad)])[0] > clean


def test_edge_rows_and_columns(spark, docs_of):
    df = docs_of([(1, None), (2, ""), (3, "x " * 50_000), (None, "you idiot"), (3, "x")]).selectExpr("*", "1.5 AS score", "2 AS toxicity", "3 AS `a.b`")
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (2, None, None)], "doc_id bigint, quality int, toxic int")
    rows = tx.add_scores(df, tx.fit(df, labels)).collect()
    assert len(rows) == 5 and all(0 <= r.toxicity <= 1 for r in rows) and rows[0]["a.b"] == 3
    assert tx.add_scores(docs_of([]), tx.fit(docs_of([]), labels.limit(0))).collect() == []
