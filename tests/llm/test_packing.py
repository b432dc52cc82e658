import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from applens.llm import packing as pk
from applens.llm.common import documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library():
    t, encode = library(), pk.encoder(PATH)
    r = random.Random(1)
    texts = ["", " ", "a", "Hello world's", "<|endoftext|> x", "a <|endoftext|> b", "x  <|endoftext|><|endoftext|>  \n", "<|endoftext|", "<|endoftext|>", "é▁\U0001F600\x00\r\n\t  x", "٣42 don't I'LL", "x" * 5000, "1" * 999, " " * 3000 + "a"]
    texts += ["".join(r.choice("ab é1.,\n'中́ T-") for _ in range(80)) for _ in range(300)]
    for x in texts:
        assert encode(x) == t.encode(x, add_special_tokens=False).ids


def test_added_tokens_keep_their_ids():
    assert pk.encoder(PATH)("a <|endoftext|> b") == [64, 220, 50256, 275]


def check(rows, texts, capacity=1024):
    t = library()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            assert r.piece == 0 or r.length == capacity
            at += r.length
        assert at == len(ids) and len(own) == -(-len(ids) // capacity)
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    total = sum(r.length for r in rows)
    return len(by_sequence), -(-total // capacity)


def test_driver_table(spark, small):
    docs = documents(spark, small)
    n, bound = check(pk.pack(docs, PATH).collect(), dict(docs.select("doc_id", "text").collect()))
    assert n <= 1.05 * bound + 1


def test_edge_rows(spark, docs_of, monkeypatch):
    monkeypatch.setattr(pk, "PIECES_PER_SALT", 2)
    texts = {1: None, 2: "", 3: "word " * 1022, 4: "word " * 1023, 5: "word " * 1024, 6: "the and " * 4000} | {10 + i: "a b c" for i in range(30)}
    df = docs_of(list(texts.items())).selectExpr("*", "1 AS salt", "2 AS `rank`", "3 AS length")
    n, bound = check(pk.pack(df, PATH).collect(), texts)
    assert n == bound
    assert pk.pack(docs_of([]), PATH).collect() == []
    twice = pk.pack(docs_of([(1, "a b"), (1, "a b"), (None, "a")]), PATH).collect()
    assert Counter(r.doc_id for r in twice) == {1: 2, None: 1} and len({(r.sequence_id, r.offset) for r in twice}) == 3
    with_ids = pk.pack(docs_of([(7, "a b c")]), PATH, with_ids=True).first()
    assert with_ids.ids == [*library().encode("a b c").ids, 2]


def test_plan_holds_exactly_the_histogram_and_is_near_the_bound():
    r = np.random.default_rng(1)
    for lengths in (r.integers(1, 1025, 5000), r.integers(300, 700, 5000), np.full(50, 513), r.integers(1, 40, 400), [1024] * 7):
        histogram = Counter(int(x) for x in lengths)
        chosen = pk.plan(dict(histogram))
        got = Counter()
        for copies, many in chosen:
            assert int(copies @ np.arange(1025)) <= 1024 and many > 0
            got.update({int(k): int(copies[k]) * many for k in np.flatnonzero(copies)})
        assert got == histogram
        bound = max(-(-sum(k * v for k, v in histogram.items()) // 1024), sum(v for k, v in histogram.items() if k > 512))
        assert sum(m for _, m in chosen) <= 1.02 * bound + 1
    assert pk.plan({}) == []


def test_dearest_against_brute_force():
    r = np.random.default_rng(2)
    for _ in range(20):
        price = np.r_[0, r.random(12)]
        best = [0.0] * 13
        for w in range(1, 13):
            best[w] = max(best[w - 1], *(best[w - k] + price[k] for k in range(1, w + 1)))
        copies = pk.dearest(price, 12)
        assert copies @ np.arange(13) <= 12 and abs(copies @ price - best[12]) < 1e-9
