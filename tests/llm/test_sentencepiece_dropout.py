import random

import public_tokenizers
import pytest
import sentencepiece

from applens.llm import sentencepiece_dropout as sd
from applens.llm.common import documents

PATH = public_tokenizers.path("piece_bpe_32k.model")


def texts():
    r = random.Random(1)
    pieces = ["a", "the ", "ing", " ", "  ", "é", "中", "\U0001F600", "\n", "\t", "1", "#", "Hello", "x" * 20, "\x00", "internationalization ", "thinking", "der Vorstand "]
    return ["", " ", "a", " a  b ", "\n\n", "Hello world", "x" * 300] + ["".join(r.choice(pieces) for _ in range(30)) for _ in range(200)]


def test_without_dropout_equals_the_library():
    v, lib = sd.Vocabulary(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for t in texts():
        if "\x00" not in t:
            assert v.encode(t) == lib.encode(t), repr(t)


def brute_chunk(v, chunk, seed, variant, rate):
    """The best candidate that is not dropped, again and again."""
    symbols = list(chunk)
    while True:
        best = min(((-v.score[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
                    if a + b in v.score and not (rate > 0 and sd.skipped(seed, variant, a, b, rate))), default=None)
        if best is None:
            break
        i = best[1]
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
    return tuple(x for s in symbols for x in ([v.id[s]] if s in v.id else [v.byte_id[c] for c in s.encode()]))


def test_dropout_against_brute_force_and_round_trip(monkeypatch):
    v = sd.Vocabulary(PATH)
    changed = 0
    for t in texts() + ["▁ a▁b ▁▁", "a▁"]:
        for variant, rate in ((0, 0.1), (3, 0.5), (1, 1.0)):
            ids = v.encode(t, 7, variant, rate)
            assert v.decode(ids) == t and ids == v.encode(t, 7, variant, rate)
            changed += ids != v.encode(t, 8, variant, rate)
    assert changed > 200
    words = ["▁thering", "▁internationalization", "ééaa", "▁▁▁x", "▁" + "thinkingly" * 6]
    for short in (100, 0):
        monkeypatch.setattr(sd, "SHORT", short)
        for w in words:
            for rate in (0.0, 0.2, 0.6):
                assert v.chunk(w, sd.Merges(v.score, 5, 2, rate)) == brute_chunk(v, w, 5, 2, rate)


@pytest.mark.parametrize("slots, chars", [(20, 1 << 20), (9, 100)])
def test_texts_together_equal_each_by_itself(monkeypatch, slots, chars):
    monkeypatch.setattr(sd, "SLOTS", slots)
    monkeypatch.setattr(sd, "SLICE_CHARS", chars)
    v = sd.Vocabulary(PATH)
    given = texts() + ["▁ a▁b ▁▁", "a▁", "▁" * 70, "é" * 65 + " " + "thinking" * 9, "", "internationalization " * 40]
    for rate in (0.0, 0.1, 0.6, 1.0):
        for first in (0, 5):
            keys = [f"3:{first + i % 11}" for i in range(len(given))]
            got = [list(x) for x in v.encode_all(given, keys, rate)]
            assert got == [v.encode(t, 3, first + i % 11, rate) for i, t in enumerate(given)]


def test_share_of_skipped_merges_is_the_rate():
    n = sum(sd.skipped(3, 1, f"a{i}", f"b{i % 7}", 0.1) for i in range(20_000))
    assert 0.09 < n / 20_000 < 0.11


def test_driver_table(spark, small):
    docs = documents(spark, small)
    rows = sd.encode(docs, PATH, with_ids=False).collect()
    assert len(rows) == 200 and all(r.lossless for r in rows)
    plain = sentencepiece.SentencePieceProcessor(model_file=PATH)
    given = dict(docs.select("doc_id", "text").collect())
    assert all(r.n_pieces >= len(plain.encode(given[r.doc_id])) for r in rows)


def test_edge_rows_and_columns(spark, docs_of):
    df = docs_of([(1, None), (2, ""), (None, "a b"), (3, "the thing " * 30_000), (3, "x" * 20_000)]).selectExpr("*", "1 AS n_pieces", "2 AS `a.b`", "3 AS decoded")
    rows = sd.decode(sd.encode(df, PATH), PATH).collect()
    assert len(rows) == 5 and all(r.decoded == r.text for r in rows) and rows[0].n_pieces == 0 and rows[0].lossless is None
    assert rows[3]["a.b"] == 2 and all(r.lossless for r in rows[1:])
    assert sd.encode(docs_of([]), PATH).collect() == []


def test_documents_drop_merges_of_their_own(spark, docs_of):
    rows = sd.encode(docs_of([(i, "internationalization thinking") for i in range(300)]), PATH, 1, 0.1).collect()
    assert len({tuple(r.ids) for r in rows}) > 20
    v = sd.Vocabulary(PATH)
    for r in rows[:50]:
        variant = sd.variant_of(r.doc_id, 1)
        want = [x for c in ("▁internationalization", "▁thinking") for x in brute_chunk(v, c, 1, variant, 0.1)]
        assert r.ids == want
