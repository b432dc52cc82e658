import hashlib
import random
import re

import numpy as np

from applens.llm import pii
from applens.llm.common import documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    s = 0
    for i, c in enumerate(d[::-1]):
        v = int(c) * (1 + i % 2)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def brute(text):
    n = lambda s: re.sub("[^0-9]", "", s)
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if 13 <= len(n(m.group())) <= 19 and luhn(n(m.group()))]
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(n(m.group())) <= 15]
    return out


def test_base_spans_against_the_patterns():
    r = random.Random(1)
    pieces = ["a", "é", "1", "0", "25", "@", ".", "-", "+", " ", "(", ")", "a.b@c.de", "@x.y", "1.2.3.4", "300.1.1.1.7.8",
              "4111111111111111", "4111 1111-1111 1111", "+1 (23) 456-7890", "+", "\n", "٣", "%"]
    for _ in range(4000):
        t = "".join(r.choice(pieces) for _ in range(r.randint(0, 14)))
        assert pii.base_spans(t) == brute(t), repr(t)


def test_long_runs_are_linear():
    for t in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1(" * 50_000, "a@" * 50_000, "1 " * 100_000):
        pii.base_spans(t)


def test_query_on_driver_table(spark, small):
    docs = documents(spark, small)
    found = pii.find(docs, pii.fit(docs), with_text=False).collect()
    texts = dict(docs.select("doc_id", "text").collect())
    assert len(found) == len(texts)
    for r in found:
        b = brute(texts[r.doc_id])
        line = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in b)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for k, _, _ in b) for j in range(4)]
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def planted():
    r = random.Random(4)
    filler = lambda: " ".join(r.choice(["the", "and", "of 12", "room 7", "in 1999", "er"]) for _ in range(12))
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    out = []
    for _ in range(300):
        card = d(15)
        card += next(c for c in "0123456789" if luhn(card + c))
        x = r.choice([f"u{d(2)}.x@mail{d(1)}.example.com", f"{r.randint(1, 255)}.{r.randint(0, 255)}.1.{r.randint(0, 9)}",
                      card, f"+1 ({d(3)}) 555-{d(4)}"])
        out.append(f"{filler()} {x} {filler()}")
    return out


def test_tagger_finds_what_the_patterns_miss_and_leaves_the_rest():
    tagger = pii.train(*pii._examples(planted()))
    t = "the room 7 and card 4111.1111.1111.1111 of 12 and in 1999 er the"
    found = pii.added_spans(tagger, [t], [pii.base_spans(t)])[0]
    assert [(k, t[s:e]) for k, s, e in found] == [(2, "4111.1111.1111.1111")]
    clean = ["the and of 12 er room 7 in 1999 and the"] * 3 + ["no digits here at all"]
    assert pii.added_spans(tagger, clean, [[]] * 4) == [[]] * 4
    # Skipping windows without a digit or an at sign changes nothing: decode everything.
    x = pii.classes(("the and of er " * 30)[:384])
    tags, _ = tagger.decode(np.ascontiguousarray(np.stack([x[:128], x[64:192], x[128:256]]).T))
    assert not any(pii._needed((int(v) - 1) // 2, "the and", 0, 7) for v in np.unique(tags) if v)


def variants(clean, r):
    """Clean texts, each with one thing planted that the patterns miss, and its span."""
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    w = lambda: "".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randint(3, 8)))
    for x in clean:
        kind = r.choice((0, 2, 3))
        card = d(15)
        card += next(c for c in "0123456789" if luhn(card + c))
        new = {0: f"{w()}{r.choice(['.' + w(), '', d(2)])}{r.choice([' @ ', ' @', '@ '])}{w()}.{r.choice(['com', 'org', 'net', 'example.com'])}",
               2: ".".join(card[i:i + 4] for i in range(0, 16, 4)),
               3: r.choice([f"1 {d(3)} {d(3)} {d(4)}", f"1 ({d(3)}) {d(3)}-{d(4)}", f"44 20 {d(4)} {d(4)}", f"1-{d(3)}-{d(3)}-{d(4)}"])}[kind]
        words = x.split(" ")
        at = r.randrange(len(words))
        before = " ".join(words[:at]) + " " * bool(at)
        yield f"{before}{new} {' '.join(words[at:])}", (kind, len(before), len(before) + len(new))


def test_fitted_on_the_table_it_finds_planted_variants(spark, docs_of):
    docs = documents(spark, "/root/testdata/sf0.01")
    tagger = pii.fit(docs)
    clean = [t for _, t in sorted(docs.select("doc_id", "text").filter("text != ''").collect()) if len(t) < 6000 and not pii.base_spans(t)][:300]
    made = list(variants(clean, random.Random(9)))
    texts, want = [x for x, _ in made], [w for _, w in made]
    got = pii.added_spans(tagger, texts, [pii.base_spans(x) for x in texts])
    hit, added = sum(w in g for w, g in zip(want, got)), sum(map(len, got))
    assert hit >= 0.9 * len(want) and hit >= 0.9 * added
    for kind in (0, 2, 3):
        assert sum(w in g for w, g in zip(want, got) if w[0] == kind) >= 0.85 * sum(w[0] == kind for w in want)
    assert sum(map(len, pii.added_spans(tagger, clean, [[]] * len(clean)))) <= 3
    # The whole query carries what is added, beside the base spans.
    rows = pii.find(docs_of(list(enumerate(texts[:60]))), tagger).collect()
    assert sum(pii.written([want[r.doc_id]]) in r.spans.split(",") for r in rows) >= 54
    near = ["in 1999 2000 2001 and", "on 2024-03-05 at 12:30", "costs 1,234,567 or 3.14", "room 555-0123", "at @ 12 and @ home"]
    assert pii.added_spans(tagger, near, [[]] * len(near)) == [[]] * len(near)


class Runs:
    """Tags every run of digits and hyphens as a phone."""

    def decode(self, x):
        inside = (x == 1) | (x == 6 + pii._OWN.index("-"))
        begin = inside & ~np.concatenate([np.zeros((1, x.shape[1]), bool), inside[:-1]])
        return np.where(begin, 7, np.where(inside, 8, 0)).astype(np.uint8), inside.astype(np.float32)


def test_spans_of_any_length_and_place_are_kept():
    for length in (12, 63, 64, 65, 127, 128, 129, 500, 3000):
        for start in (0, 1, 63, 64, 128, 200):
            phone = "123" + "-" * (length - 9) + "456789"
            for tail in ("", " and more of the text" * 9):
                text = "x " * (start // 2) + " " * (start % 2) + phone + tail
                assert pii.added_spans(Runs(), [text, "none"], [[], []]) == [[(3, start, start + length)], []]


def test_gradient_matches_differences():
    r = np.random.default_rng(0)
    x = r.integers(0, pii.CLASSES, (6, 3)).astype(np.uint8)
    tags = np.zeros((6, 3), np.uint8)
    tags[2, 0], tags[3, 0], tags[1, 1] = 1, 2, 3
    tagger = pii.train(np.zeros((0, 6)), np.zeros((0, 6)))
    tagger.w = {k: r.normal(0, 0.3, v.shape).astype(np.float64) for k, v in tagger.w.items()}

    def loss():
        em = tagger.emissions(x)[0].astype(float)
        move = tagger.w["move"] + pii._BLOCK
        a = em[0] + pii._BLOCK[0]
        gold = a[np.arange(3), tags[0]]
        for t in range(1, 6):
            s = a[:, :, None] + move[None]
            m = s.max(1)
            a = m + np.log(np.exp(s - m[:, None]).sum(1)) + em[t]
            gold = gold + move[tags[t - 1], tags[t]] + em[t][np.arange(3), tags[t]]
        m = a.max(1)
        return (m + np.log(np.exp(a - m[:, None]).sum(1)) - gold).mean()

    grad = pii._step(tagger, x, tags)
    for k in ("wxf", "uhb", "bf", "out", "bias", "move"):
        w = tagger.w[k]
        for at in [tuple(r.integers(0, n) for n in w.shape) for _ in range(4)]:
            if k == "move" and pii._BLOCK[at] < 0:
                continue
            old = w[at]
            w[at] = old + 1e-2
            up = loss()
            w[at] = old - 1e-2
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-2 - grad[k][at]) < 5e-3


def test_reconcile_takes_the_best_sum():
    assert pii.reconcile([(3.0, 0, 0, 10), (2.0, 1, 0, 5), (2.0, 2, 5, 10), (2.0, 2, 5, 10)]) == [(1, 0, 5), (2, 5, 10)]


def test_edge_rows_and_columns(spark, docs_of):
    df = docs_of([(1, None), (2, ""), (3, "x " * 200_000 + "a@b.co"), (None, "a@b.co, a@b.co"), (3, "é 1.2.3.4")]).selectExpr("*", "1 AS spans", "2 AS `a.b`")
    rows = pii.find(df, pii.fit(df)).collect()
    by = {r.n_chars or i: r for i, r in enumerate(rows)}
    assert len(by) == 5 and rows[0].masked_text is None and rows[1].spans == ""
    assert rows[2].spans == "email:400000:400006" and rows[3].masked_text == "<email>, <email>"
    assert rows[4].spans == "ip:2:9" and rows[4]["a.b"] == 2 and rows[4].masked_text == "é <ip>"
    assert pii.find(docs_of([]), pii.fit(docs_of([]))).collect() == []
