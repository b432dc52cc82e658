import importlib.util

import corpus_pipeline as cp
from applens.llm import packing as pk
from applens.llm import pii, toxicity
from applens.llm.common import documents


def sibling(name):
    """Another test module of this folder, for its brute-force version."""
    path = __file__.replace("test_pipeline", name)
    spec = importlib.util.spec_from_file_location(name, path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def cut(rows):
    """Bytes of 50-byte strings of a smaller id cut out, in plain Python."""
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - 49):
            least[b[s:s + 50]] = min(least.get(b[s:s + 50], i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = {p for s in range(len(b) - 49) if least[b[s:s + 50]] < i for p in range(s, s + 50)}
        out.append((i, bytes(x for p, x in enumerate(b) if p not in gone).decode("utf-8", "ignore")))
    return out


def test_every_stage_against_brute_force(spark, small):
    docs = documents(spark, small)
    stages = dict(cp.STAGES)
    assert list(stages) == ["toxicity", "jaccard", "suffix_array", "pii", "packing"]
    rows = sorted(tuple(r) for r in docs.select("doc_id", "text").collect())

    model = toxicity.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))
    rows = [r for r, s in zip(rows, model.score([t for _, t in rows])) if s < 0.5]
    docs = stages["toxicity"](spark, docs, small)
    assert docs.columns == documents(spark, small).columns
    assert sorted(tuple(r) for r in docs.select("doc_id", "text").collect()) == rows

    groups = {i: c for i, _, c in sibling("test_jaccard_join").brute(rows)}
    rows = [r for r in rows if groups[r[0]] == r[0]]
    docs = stages["jaccard"](spark, docs, small)
    assert sorted(tuple(r) for r in docs.select("doc_id", "text").collect()) == rows

    rows = cut(rows)
    docs = stages["suffix_array"](spark, docs, small)
    got = sorted(docs.collect())
    assert [(r.doc_id, r.text) for r in got] == rows and all(r.n_chars == len(r.text) for r in got)

    tagger = pii.fit(docs)
    texts = [t for _, t in rows]
    base = [pii.base_spans(t) for t in texts]
    rows = [(i, pii.masked(t, b + a)) for (i, t), b, a in zip(rows, base, pii.added_spans(tagger, texts, base))]
    docs = stages["pii"](spark, docs, small)
    assert docs.columns == documents(spark, small).columns
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == rows

    encode = pk.encoder(cp.public_tokenizers.path("byte_bpe_50k.json"))
    pieces = [(i, n, s, m) for i, t in rows for n, (s, m) in enumerate(pk.cut(len(encode(t)) + 1))]
    packed = stages["packing"](spark, docs, small).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length) for r in packed) == pieces

    whole = cp.run(spark, small).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.sequence_id, r.offset)
    assert sorted(map(key, whole)) == sorted(map(key, packed))


def test_toxic_fold_and_edge_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c d e f", None, None, 11), (3, "the word " * 50_000, "en", "s", 7),
            (4, "the word " * 50_000, "en", None, 7), (5, "mail a.b@c.de now", "x", "y", 17), (5, "mail a.b@c.de now", "x", "y", 17)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint") \
        .selectExpr("*", "1 AS score", "2 AS block", "3 AS spans", "4 AS label", "5 AS length")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(1, 4)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = docs
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, out, str(tmp_path))
        assert out.columns == docs.columns, name
    got = out.collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "3", "5", "5", "None"]
    assert {r.text for r in got if r.doc_id == 5} == {"mail <email> now"} and all(r.spans == 3 for r in got)
    assert len(cp.run(spark, str(tmp_path)).collect()) >= 6
    empty = str(tmp_path / "none")
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert cp.run(spark, empty).collect() == []


