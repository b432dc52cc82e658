"""Review records, lexicon scoring and the report."""

import os

import pytest
from pyspark.sql import functions as F

from applens.operators import sentiment as sent
from applens.plans import review_jobs as rj
from applens.sources import proxies
from applens.sources.reviews import read_reviews, split_records

from conftest import SF_SMALL


def test_split_records_rules(spark):
    df = spark.createDataFrame([(1, " com.a.x @ good\nline #bad#b @ c @ d# com.b @ ok ")],
                               "rid long, t string")
    got = [(r.seq, r.App, r.Review) for r in split_records(df, "t", keys=["rid"]).orderBy("seq").collect()]
    assert got == [(0, "com.a.x", "good line"), (3, "com.b", "ok")]
    joined = split_records(df, "t", keys=["rid"], newline="").orderBy("seq").first()
    assert joined.Review == "goodline"
    counts = {r.n_fields: r["count"] for r in split_records(df, "t", with_rejected=True)
              .groupBy("n_fields").count().collect()}
    assert counts == {2: 2, 1: 1, 3: 1}


def test_read_reviews_wholetext(spark, tmp_dir):
    p = os.path.join(tmp_dir, "r.txt")
    with open(p, "w") as f:
        f.write("com.a.b @ the first\nreview#com.c.d @ und")
    recs = read_reviews(spark, p, wholetext=True)
    assert sorted((r.App, r.Review) for r in recs.collect()) == [
        ("com.a.b", "the first review"), ("com.c.d", "und")]


TEXTS = {
    "lines.txt": "com.a.b @ the first\nreview#com.c.d @ und\r\nso on#\r\ncom.e @ last\n",
    "ends.txt": "com.a.b @ x##bad#b @ c @ d#com.f @ y#",
    "one.txt": "com.solo @ no separator at all",
    "empty.txt": "",
    "sep.txt": "#",
    "words.txt": "#".join(f"com.app{i % 7} @ review {i} \u00e9\u4e2d\n of {'words ' * (i % 11)}" for i in range(300)),
}


@pytest.mark.parametrize("block", [None, 400])
def test_record_scan_equals_whole_text(spark, tmp_dir, block):
    for name, text in TEXTS.items():
        with open(os.path.join(tmp_dir, name), "w", newline="") as f:
            f.write(text)
    if block:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for kind in ({}, {"newline": ""}, {"with_rejected": True}):
            got = read_reviews(spark, tmp_dir, **kind)
            if block:
                assert spark.read.option("lineSep", "#").text(tmp_dir).rdd.getNumPartitions() > 15
            plain = read_reviews(spark, tmp_dir, wholetext=True, **kind)
            assert got.columns == plain.columns and got.schema["seq"].dataType == plain.schema["seq"].dataType
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_record_scan_is_split_by_blocks(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "big.txt"), "w") as f:
        f.write("#".join(f"com.a{i} @ text {i}\nmore" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        got = read_reviews(spark, tmp_dir)
        assert {(r.seq, r.App, r.Review) for r in got.collect()} == {(i, f"com.a{i}", f"text {i} more") for i in range(20_000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_scores_are_exact_means(spark):
    lex = proxies.lexicon(spark)
    df = spark.createDataFrame([(1, "The cat and the dog"), (2, "nothing here"), (3, "OF of-of"), (4, None),
                                (5, "la le"), (6, "the and and of the the le la le la of of and and")], "k int, Review string")
    for keys in (["k"], None):
        a = {r.k: (r.Polarity, r.Subjectivity) for r in sent.score_sentiment(df, "Review", lex, keys=keys).collect()}
        assert a[1] == (0.75 / 3, 1.6 / 3) and a[2] == (0.0, 0.0) and a[4] == (0.0, 0.0) and a[3] == (-1.8 / 3, 0.3 / 3)
        assert a[5] == (0.0, 1.1 / 2)  # opposite scores cancel
        # Nine tenths up and down in another order: 3 * 0.5 - 4 * 0.25 - 3 * 0.6 + 0 = -1.3 of 14 words.
        assert a[6][0] == -1.3 / 14


def modified(spark, texts, rows, **kind):
    lex = spark.createDataFrame(rows, "word string, polarity double, subjectivity double, modifier double")
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    return [(r.Polarity, r.Subjectivity) for r in sent.score_sentiment(df, "t", lex, keys=["k"], **kind).orderBy("k").collect()]


LEX = [("good", 0.6, 0.5, None), ("awful", -0.9, 0.9, None), ("not", None, None, -0.5), ("very", None, None, 1.3), ("slightly", None, None, 0.5)]


def test_modifiers_change_the_next_scored_word(spark):
    got = modified(spark, ["good", "not good", "VERY good!", "not very good", "very very awful", "not a good", "not at all good",
                           "very. Good good", "slightly good not", "not very", None, "", "not not good", "not awful and good"], LEX)
    want = [(0.6, 0.5), (-0.3, 0.5), (0.78, 0.65), (-0.39, 0.65), (-1.0, 1.0), (-0.3, 0.5), (0.6, 0.5),
            (1.38 / 2, 1.15 / 2), (0.3, 0.25), (0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.15, 0.5), (1.05 / 2, 1.4 / 2)]
    assert [tuple(round(v, 10) for v in r) for r in got] == [tuple(round(v, 10) for v in r) for r in want]
    assert modified(spark, ["not at all good", "not a good"], LEX, reach=2)[0][0] == -0.3
    assert modified(spark, ["not a good"], LEX, reach=0)[0][0] == 0.6


def test_without_modifiers_the_scan_equals_the_sums(spark):
    recs = split_records(proxies.review_records(spark, SF_SMALL), "record", keys=["rid"])
    lex = proxies.lexicon(spark)
    plain = sent.score_sentiment(recs, "Review", lex, keys=["rid", "seq"])
    scan = sent.score_sentiment(recs, "Review", lex.withColumn("modifier", F.lit(None).cast("double")), keys=["rid", "seq"])
    key = lambda df: sorted((r.rid, r.seq, r.Polarity, r.Subjectivity) for r in df.collect())
    assert key(plain) == key(scan)


def test_labels_do_not_depend_on_the_lexicon_size(spark):
    import time

    words = [(w, p, s) for w, p, s in proxies.LEXICON_ROWS]
    padded = words + [("zzq" + "".join(chr(97 + int(d)) for d in str(i)), 0.1, 0.1) for i in range(50_000)]
    scored = []
    for rows in (words, padded):
        lex = spark.createDataFrame(rows, proxies.lexicon(spark).schema)
        recs = proxies.review_records(spark, SF_SMALL)
        start = time.time()
        scored.append((sorted((r.rid, r.seq, r.Polarity, r.Sentiment) for r in rj.review_sentiment(recs, lex, keys=["rid"]).collect()),
                       time.time() - start))
    assert scored[0][0] == scored[1][0]
    assert scored[1][1] < 20 + 3 * scored[0][1]
    assert any(p == 0 and label == "Neutral" for _, _, p, label in scored[0][0])


def test_planted_chunks_hold_several_records(spark):
    recs = split_records(proxies.review_records(spark, SF_SMALL), "record", keys=["rid"])
    assert recs.agg(F.max("seq")).first()[0] > 0
    many = split_records(proxies.review_records(spark, SF_SMALL), "record", keys=["rid"], with_rejected=True)
    assert {r.n_fields for r in many.select("n_fields").distinct().collect()} >= {1, 2, 3}


def test_review_report(spark):
    scored = rj.review_sentiment(proxies.review_records(spark, SF_SMALL), proxies.lexicon(spark),
                                 keys=["rid"])
    assert scored.select("App").distinct().count() <= rj.TOP_APPS
    rep = rj.sentiment_report(scored)
    n = scored.count()
    assert abs(rep["shares"].agg(F.sum("share")).first()[0] - 100.0) < 0.05
    assert rep["subjectivity_hist"].agg(F.sum("count")).first()[0] == n
    assert rep["abs_scatter"].agg(F.sum("count")).first()[0] == n
    by_app = rep["by_app"].agg(F.sum(F.col("non_negative") + F.col("negative"))).first()[0]
    assert by_app == n
