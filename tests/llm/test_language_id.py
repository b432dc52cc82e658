import zlib
from collections import Counter

from applens.llm import language_id as li
from applens.llm.common import documents


def brute_ranked(text, size=li.PROFILE):
    folded = "".join(c if c.isalpha() else " " for c in text.lower())
    if not folded.strip():
        return []
    s = " " + " ".join(folded.split()) + " "
    counts = Counter(s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i:i + n] != " ")
    code = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))
    return sorted(map(code, counts), key=lambda c: (-counts[decode(c)], c))[:size]


def decode(code):
    out = ""
    while code:
        out, code = chr(code & (1 << 21) - 1) + out, code >> 21
    return out


def test_ranks_against_brute_force(monkeypatch):
    texts = ["Éa b!!c\n\n d", "", "123 ..", "aaa", "Straße 12 über\tß", "中文 文", "x" * 50 + " y" * 40]
    for chunk in (1 << 20, 7):
        monkeypatch.setattr(li, "CHUNK", chunk)
        for t in texts:
            assert list(li.ranked(t)) == brute_ranked(t), t


def test_distance_against_brute_force(spark, small):
    docs = documents(spark, small)
    p = li.trained_on_folds(docs, 5)
    ranks = {lang: {int(c): int(r) for c, r in zip(p.codes, p.places[:, j]) if r < li.PROFILE} for j, lang in enumerate(p.languages)}
    for row in docs.limit(40).collect():
        own = brute_ranked(row.text)
        d = {lang: sum(abs(r[c] - i) if c in r else li.PROFILE for i, c in enumerate(own)) for lang, r in ranks.items()}
        assert p.predict(row.text)[0] == min(sorted(d), key=d.get)


def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    rows = li.add_language(docs, li.trained_on_folds(docs)).select("doc_id", "lang", "lang_pred", "score").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)


def test_edge_rows_and_columns(spark, docs_of):
    df = docs_of([(1, None), (2, ""), (3, "12 --"), (None, "the and"), (4, "the " * 300_000), (4, "le la")])
    df = df.selectExpr("doc_id", "text", "CASE WHEN doc_id = 4 THEN 'en' END AS lang", "1 AS score", "2 AS `a.b`")
    rows = li.add_language(df, li.learn(df)).collect()
    assert [r.lang_pred for r in rows] == ["und"] * 3 + ["en"] * 3 and rows[0].score == 0 and rows[4]["a.b"] == 2
    assert li.add_language(df, li.learn(df.limit(0))).first().lang_pred == "und"
    assert li.add_language(df.limit(0), li.learn(df)).collect() == []
