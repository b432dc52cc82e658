"""Operator 4: personal data by a character BiLSTM with CRF transitions.

Base spans follow fixed patterns (email, ip, card, phone); the tagger adds
spans and never removes one. It is a bidirectional LSTM over character classes
with a linear-chain CRF over begin/inside tags, written and trained in numpy on
windows around the base spans of a bounded sample of documents (the SAMPLE rows
with the smallest hash of doc_id among those with an at sign or four digits in a
row, texts of up to SAMPLE_CHARS characters). Most windows hold what the patterns miss, planted at word edges of
those texts: a phone without its plus, a card with other separators, blanks around an email's at sign; or
near misses, which stay outside: years, dates, amounts, short numbers.

Whole texts are cut into windows of WINDOW characters that overlap by half. Each
window is decoded by Viterbi; a span that touches a window's edge is left to the
window that holds it whole; where no window does, one twice as wide is decoded around it, until
it lies inside or the text ends. The spans of all windows of a text are then
reconciled together: the set without overlaps (and beside the base spans) whose
summed score is greatest is kept. A span is accepted only with what its kind
needs (an at sign and a dot, or its number of digits; a card's check digit, too), so windows with neither a digit nor
an at sign can add nothing and are not decoded; the result is the same.

Offsets are code points, ends exclusive. A NULL text is empty. Repeated rows are each tagged on their own; an empty table,
or one without base spans, trains a tagger that adds nothing. Texts of any length are tagged whole.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.llm.common import quoted, release_memory

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)            # 0: outside; 1 + 2k: begin; 2 + 2k: inside
HIDDEN, WINDOW, STRIDE = 10, 128, 64
SAMPLE, SAMPLE_CHARS = 1500, 20_000
STEPS, BATCH, TRAIN_WINDOW = 600, 128, 64
PLANTED = 3000                       # training windows with something planted

# ------------------------------------------------------------- base patterns

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str):
    """Every at sign with the run of local characters before it (after the last match) and a domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str):
    """The parts of a dotted chain, four by four."""
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        start = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in the order of kinds, then by start."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    out += [(1, s, e) for s, e in _ips(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m.group())
            if 13 <= len(d) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


# ------------------------------------------------------------- the tagger

_OWN = "@.-+()_%/: ,\n"              # characters that are a class of their own
CLASSES = 6 + len(_OWN)


def _class_table() -> np.ndarray:
    table = np.full(256, 4, np.uint8)  # other ASCII and Latin marks
    for c in range(256):
        ch = chr(c)
        if "0" <= ch <= "9":
            table[c] = 1
        elif ch.isalpha():
            table[c] = 2 if ch.islower() else 3
        elif ch in _OWN:
            table[c] = 6 + _OWN.index(ch)
    return table


_CLASS = _class_table()              # 0: beyond the text, 5: other characters


def classes(text: str) -> np.ndarray:
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(cps < 256, _CLASS[np.minimum(cps, 255)], 5).astype(np.uint8)


def _sigmoid(x):
    return np.float32(1) / (np.float32(1) + np.exp(-x))


def _allowed() -> np.ndarray:
    """Transitions from a tag (row) to a tag: inside only after its own begin or inside."""
    ok = np.ones((TAGS, TAGS), bool)
    for k in range(len(KINDS)):
        ok[:, 2 + 2 * k] = False
        ok[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return ok


_BLOCK = np.where(_allowed(), 0, -1e4).astype(np.float32)


@dataclass
class Tagger:
    """Weights by name: wx, uh, b of both directions, out, bias, move (transitions)."""

    w: dict[str, np.ndarray]

    def _run(self, x: np.ndarray, side: str, keep: bool):
        """The hidden states of one direction; x: (steps, lanes) classes."""
        table, u = self.w["wx" + side] + self.w["b" + side], self.w["uh" + side]
        steps, lanes = x.shape
        h = np.zeros((lanes, HIDDEN), np.float32)
        c = np.zeros((lanes, HIDDEN), np.float32)
        out = np.empty((steps, lanes, HIDDEN), np.float32)
        tape = []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = table[x[t]] + h @ u
            gates = _sigmoid(z[:, :3 * HIDDEN])
            g = np.tanh(z[:, 3 * HIDDEN:])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            before = c
            c = f * c + i * g
            th = np.tanh(c)
            if keep:
                tape.append((t, i, f, o, g, before, th, h))
            h = o * th
            out[t] = h
        return out, tape

    def emissions(self, x: np.ndarray, keep: bool = False):
        hf, tf = self._run(x, "f", keep)
        hb, tb = self._run(x, "b", keep)
        h = np.concatenate([hf, hb], 2)
        return h @ self.w["out"] + self.w["bias"], h, tf, tb

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (steps, lanes), and each step's score, transition included, against tag 0 all along."""
        em, _, _, _ = self.emissions(x)
        move = self.w["move"] + _BLOCK
        steps, lanes = x.shape
        best = em[0] + _BLOCK[0]
        back = np.empty((steps, lanes, TAGS), np.uint8)
        for t in range(1, steps):
            s = best[:, None, :] + move.T[None]      # (lanes, to, from)
            back[t] = s.argmax(2)
            best = s.max(2) + em[t]
        tags = np.empty((steps, lanes), np.uint8)
        tags[-1] = best.argmax(1)
        lane = np.arange(lanes)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t, lane, tags[t]]
        gain = np.take_along_axis(em, tags[:, :, None].astype(np.int64), 2)[:, :, 0] - em[:, :, 0]
        gain[1:] += move[tags[:-1], tags[1:]] - move[0, 0]
        return tags, gain


def _crf_gradient(em: np.ndarray, tags: np.ndarray, move: np.ndarray):
    """Negative log likelihood's gradients by emissions and transitions (forward-backward)."""
    steps, lanes, n = em.shape
    a = np.empty_like(em)
    a[0] = em[0] + _BLOCK[0]

    def lse(s, axis):
        m = s.max(axis, keepdims=True)
        return np.squeeze(m, axis) + np.log(np.exp(s - m).sum(axis))

    for t in range(1, steps):
        a[t] = lse(a[t - 1][:, :, None] + move[None], 1) + em[t]
    b = np.zeros_like(em)
    for t in range(steps - 2, -1, -1):
        b[t] = lse(move[None] + (em[t + 1] + b[t + 1])[:, None, :], 2)
    log_z = lse(a[-1], 1)
    d_em = np.exp(a + b - log_z[None, :, None])
    d_move = np.zeros_like(move)
    for t in range(1, steps):
        d_move += np.exp(a[t - 1][:, :, None] + move[None] + (em[t] + b[t])[:, None, :] - log_z[:, None, None]).sum(0)
    d_em -= np.eye(n, dtype=np.float32)[tags]
    np.add.at(d_move, (tags[:-1].ravel(), tags[1:].ravel()), -1)
    return d_em / lanes, d_move / lanes


def _step(tagger: Tagger, x: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of one batch, by backpropagation through both directions."""
    w = tagger.w
    em, h, tape_f, tape_b = tagger.emissions(x, keep=True)
    d_em, d_move = _crf_gradient(em, tags, w["move"] + _BLOCK)
    grad = {"out": np.tensordot(h, d_em, ((0, 1), (0, 1))), "bias": d_em.sum((0, 1)), "move": d_move}
    d_h = d_em @ w["out"].T
    for side, tape, part in (("f", tape_f, d_h[..., :HIDDEN]), ("b", tape_b, d_h[..., HIDDEN:])):
        u = w["uh" + side]
        g_wx, g_u, g_b = (np.zeros_like(w[k + side]) for k in ("wx", "uh", "b"))
        dh_next, dc_next = np.float32(0), np.float32(0)
        for t, i, f, o, g, before, th, h_before in reversed(tape):
            dh = part[t] + dh_next
            dc = dh * o * (1 - th * th) + dc_next
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)], 1)
            g_u += h_before.T @ dz
            np.add.at(g_wx, x[t], dz)
            g_b += dz.sum(0)
            dh_next, dc_next = dz @ u.T, dc * f
        grad |= {"wx" + side: g_wx, "uh" + side: g_u, "b" + side: g_b}
    return grad


def train(windows: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = 5) -> Tagger:
    """Adam over batches of windows (rows of classes) and their tags."""
    r = np.random.default_rng(seed)
    draw = lambda *shape: r.normal(0, 0.3, shape).astype(np.float32)
    w = {"out": draw(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32), "move": np.zeros((TAGS, TAGS), np.float32)}
    w["bias"][0] = 1
    for side in "fb":
        w |= {"wx" + side: draw(CLASSES, 4 * HIDDEN), "uh" + side: draw(HIDDEN, 4 * HIDDEN), "b" + side: np.zeros(4 * HIDDEN, np.float32)}
        w["b" + side][HIDDEN:2 * HIDDEN] = 1
    tagger = Tagger(w)
    if not len(windows):
        w["bias"][0] = 20
        return tagger
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v2 = {k: np.zeros_like(v) for k, v in w.items()}
    for t in range(1, steps + 1):
        pick = r.integers(0, len(windows), BATCH)
        grad = _step(tagger, windows[pick].T, tags[pick].T)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = 0.03 * min(1, 2 * (1 - t / (steps + 1))) * min(1, 5 / (norm + 1e-9))
        for k, g in grad.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v2[k] = 0.99 * v2[k] + 0.01 * g * g
            w[k] = (w[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v2[k] / (1 - 0.99 ** t)) + 1e-6)).astype(np.float32)
    return tagger


def _examples(texts: list[str], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows around base spans and other digits, and PLANTED ones with rewritten spans (which the patterns miss) and near misses."""
    r = np.random.default_rng(seed)
    rows, marks = [], []

    def add(text, spans, centre):
        start = int(np.clip(centre - r.integers(8, TRAIN_WINDOW - 8), 0, max(0, len(text) - 8)))
        x, y = np.zeros(TRAIN_WINDOW, np.uint8), np.zeros(TRAIN_WINDOW, np.uint8)
        piece = classes(text[start:start + TRAIN_WINDOW])
        x[:len(piece)] = piece
        for k, s, e in spans:
            if start <= s and e <= start + TRAIN_WINDOW:
                y[s - start:e - start] = 2 + 2 * k
                y[s - start] = 1 + 2 * k
            elif s < start + TRAIN_WINDOW and e > start:
                x[max(0, s - start):max(0, e - start)] = 0  # a cut span teaches nothing
        rows.append(x)
        marks.append(y)

    def group(digits, sizes, sep):
        at = np.cumsum([0, *sizes])
        return sep.join(p for p in (digits[i:j] for i, j in zip(at, [*at[1:], len(digits)], strict=True)) if p)

    def rewritten(kind, s):
        """What the patterns miss: the same data, written otherwise."""
        d = _digits(s)
        if kind == 0:
            local, domain = s.split("@")
            if words and r.random() < 0.7:
                local = r.choice(words) + r.choice([".", "_", "-", ""]) + r.choice([r.choice(words), *local.split(".")])
                domain = r.choice(words) + r.choice(["", "." + r.choice(words)]) + domain[domain.rindex("."):]
            return local + r.choice([" @ ", " @", "@ "]) + domain
        if kind == 2:
            return group(d, [4] * (len(d) // 4), r.choice([".", "/", ":", "_"]))
        sizes = [[1, 3, 3], [2, 2, 4], [2, 3, 3], [3, 3], [1, 3, 4]][r.integers(5)]
        phone = group(d, sizes, r.choice([" ", "-", "."]))
        return phone if r.random() < 0.6 else f"{d[:1]} ({d[1:4]}) {group(d[4:], [3], r.choice(['-', ' ']))}"

    def near_miss():
        year, n = (lambda: str(r.integers(1900, 2100))), lambda k: str(r.integers(10 ** (k - 1), 10 ** k))
        return [lambda: year(), lambda: f"{year()}-{n(2)}-{n(2)}", lambda: f"{n(2)}.{n(2)}.{year()}", lambda: f"{n(2)}:{n(2)}",
                lambda: " ".join(year() for _ in range(r.integers(2, 5))), lambda: f"{n(1)},{n(3)},{n(3)}", lambda: n(r.integers(1, 9)),
                lambda: f"{n(1)}.{n(1)}.", lambda: " ".join(n(2) for _ in range(r.integers(2, 8))), lambda: f"{n(3)}-{n(4)}",
                lambda: f"@{r.choice(words) if words else ''}", lambda: f" @ {n(2)}"][r.integers(12)]()

    found = []
    words = []
    for text in texts:
        words += [w for w in text.split() if w.isalpha() and w.isascii()][:20]
        spans = base_spans(text)
        taken = [(s, e) for _, s, e in spans]
        found += [(k, text[s:e]) for k, s, e in spans[:8]]
        for _, s, _ in spans[:8]:
            add(text, spans, s)
        for m in list(re.finditer(r"[0-9@]+", text))[:8]:
            if not any(s < m.end() and e > m.start() for s, e in taken):
                add(text, spans, m.start())
    by_kind = [[x for k, x in found if k == kind] for kind in range(len(KINDS))]
    open_kinds = [k for k in (0, 2, 3) if by_kind[k]]
    for _ in range(PLANTED if found else 0):
        text = texts[r.integers(len(texts))]
        at = text.find(" ", int(r.integers(len(text)))) + 1
        draw = r.random()
        kind = None if draw < 0.25 or not open_kinds else open_kinds[r.integers(len(open_kinds))]
        own = near_miss() if kind is None else by_kind[kind][r.integers(len(by_kind[kind]))]
        new = rewritten(kind, own) if kind is not None and draw < 0.85 else own
        before, after = text[max(0, at - 60):at], text[at:at + 60]
        mark = r.choice(["", "", "", ",", ".", ":"])
        around = f"{before}{new}{mark} {after}"
        at = len(before)
        # What is planted has its kind; base spans are found as in any text.
        near = [(k, a, b) for k, a, b in base_spans(around) if kind is None or b <= at or a >= at + len(new)]
        add(around, [*near, (kind, at, at + len(new))] if kind is not None else near, at)
    return (np.array(rows, np.uint8).reshape(-1, TRAIN_WINDOW), np.array(marks, np.uint8).reshape(-1, TRAIN_WINDOW))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Tagger:
    """Train on the base spans of a bounded sample of `docs`."""
    some = docs.select("doc_id", "text").filter(F.col("text").rlike("[0-9]{4}|@") & (F.length("text") <= SAMPLE_CHARS))
    # Tasks send ids alone, and then the sample's texts.
    ids = [(r[0],) for r in some.select("doc_id").filter("doc_id IS NOT NULL")
           .orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(sample).collect()]
    picked = F.broadcast(docs.sparkSession.createDataFrame(sorted(set(ids)), "doc_id bigint"))
    rows = some.join(picked, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()
    tagger = train(*_examples([r.text for r in sorted(rows)]))
    release_memory()
    return tagger


# ------------------------------------------------------------- whole texts

def _needed(kind: int, text: str, start: int, end: int) -> bool:
    """What an added span must hold, whatever its score; it starts and ends at a word's edge."""
    s = text[start:end]
    if start and text[start - 1].isalnum() or text[end:end + 1].isalnum():
        return False
    n = len(_digits(s))
    if kind == 0:
        return s.count("@") == 1 and "." in s.split("@")[1].strip(" .") and not s.startswith(("@", " "))
    if kind == 1:
        return s.count(".") == 3 and all(p.isdigit() and len(p) <= 3 for p in s.split("."))
    return 13 <= n <= 19 and luhn(_digits(s)) if kind == 2 else 9 <= n <= 15


def reconcile(spans: list[tuple[float, int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans (score, kind, start, end) without overlaps whose summed score is greatest."""
    spans = sorted(set(spans), key=lambda x: (x[3], x[2], x[1]))
    ends = [s[3] for s in spans]
    best, take = [0.0], []
    for i, (score, _, start, _) in enumerate(spans):
        j = bisect.bisect_right(ends, start, 0, i)
        take.append((best[j] + score > best[i], j))
        best.append(max(best[i], best[j] + score))
    out, i = [], len(spans)
    while i:
        chosen, j = take[i - 1]
        if chosen:
            out.append(spans[i - 1][1:])
            i = j
        else:
            i -= 1
    return out[::-1]


LANES = 1024


def added_spans(tagger: Tagger, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """For each text the tagger's spans beside the base ones."""
    jobs: list[tuple[int, int]] = []
    rows = []
    for n, text in enumerate(texts):
        x = classes(text)
        hot = np.flatnonzero((x == 1) | (x == 6))
        if not len(hot):
            continue
        # Windows start at multiples of the stride; each hot place lies in two of them.
        first = np.unique(np.concatenate([hot // STRIDE, hot // STRIDE - 1]))
        first = first[first >= 0]
        padded = np.zeros((int(first[-1]) + 2) * STRIDE, np.uint8)
        padded[:min(len(x), len(padded))] = x[:len(padded)]
        rows.append(np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[first * STRIDE])
        jobs += [(n, int(f) * STRIDE) for f in first]
    found: list[list[tuple[float, int, int, int]]] = [[] for _ in texts]
    if not jobs:
        return [[] for _ in texts]
    every = np.concatenate(rows)
    whole: list[list[tuple[int, int]]] = [[] for _ in texts]
    cut: list[set[tuple[int, int]]] = [set() for _ in texts]

    def keep(n, kind, start, end, score):
        if score > 0 and _needed(kind, texts[n], start, end) and not any(s < end and b > start for _, s, b in base[n]):
            found[n].append((round(score, 3), kind, start, end))

    for at in range(0, len(every), LANES):
        # Equal windows (copies, boilerplate) are decoded once.
        unique, back = np.unique(every[at:at + LANES], axis=0, return_inverse=True)
        runs = _runs(tagger, unique)
        for lane, (n, offset) in zip(back.ravel(), jobs[at:at + LANES], strict=True):
            for kind, t, e, score in runs.get(int(lane), ()):
                start, end = offset + t, min(offset + e, len(texts[n]))
                if (t > 0 or offset == 0) and (e < WINDOW or offset + e >= len(texts[n])):
                    whole[n].append((start, end))
                    keep(n, kind, start, end, score)
                else:
                    cut[n].add((start, end))
    # Spans that no window holds whole: wider windows around them.
    todo = [(n, s, e) for n in range(len(texts)) for s, e in sorted(cut[n]) if not any(a < e and b > s for a, b in whole[n])]
    width = WINDOW
    while todo:
        width *= 2
        left = []
        for at in range(0, len(todo), step := max(1, LANES * WINDOW // width)):
            some = todo[at:at + step]
            x = np.zeros((len(some), width), np.uint8)
            first = [max(0, (s + e) // 2 - width // 2) for _, s, e in some]
            for row, (n, _, _), f in zip(x, some, first, strict=True):
                piece = classes(texts[n][f:f + width])
                row[:len(piece)] = piece
            runs = _runs(tagger, x)
            for lane, ((n, s, e), f) in enumerate(zip(some, first, strict=True)):
                for kind, a, b, score in runs.get(lane, ()):
                    start, end = f + a, min(f + b, len(texts[n]))
                    if start >= e or end <= s:
                        continue
                    if (a > 0 or f == 0) and (b < width or f + b >= len(texts[n])):
                        keep(n, kind, start, end, score)
                    else:
                        left.append((n, start, end))
        todo = left
    return [reconcile(f) if f else [] for f in found]


def _runs(tagger: Tagger, windows: np.ndarray) -> dict[int, list[tuple[int, int, int, float]]]:
    """For each window (a row of classes) with spans: their kind, start, end and score against leaving them out."""
    width = windows.shape[1]
    tags, gain = tagger.decode(np.ascontiguousarray(windows.T))
    tags, sums = tags.T, np.cumsum(gain.T, 1)
    out: dict[int, list[tuple[int, int, int, float]]] = {}
    for lane, t in zip(*(x.tolist() for x in np.nonzero(tags % 2 == 1)), strict=True):
        kind = (int(tags[lane, t]) - 1) // 2
        e = t + 1
        while e < width and tags[lane, e] == 2 + 2 * kind:
            e += 1
        after = e if e < width and tags[lane, e] == 0 else e - 1  # the way back to tag 0 counts
        out.setdefault(lane, []).append((kind, t, e, float(sums[lane, after] - (sums[lane, t - 1] if t else 0))))
    return out


SLICE = 256
COLUMNS = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "masked_text")


def find(docs: DataFrame, tagger: Tagger, with_text: bool = True) -> DataFrame:
    """The personal data of every whole text.

    With `with_text` the result is every column of `docs` (those named as the result's are
    replaced), then n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all spans,
    kind:start:end by kind, then start) and masked_text (each span replaced by its kind in angle
    brackets; NULL stays NULL). Otherwise it is doc_id and the columns up to spans.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    kept = [c for c in docs.columns if c not in COLUMNS] if with_text else ["doc_id", "text"]
    names = [c if c in ("doc_id", "text") else f"other_{i}" for i, c in enumerate(kept)]
    types = [pa.int64()] * 4 + [pa.string()] * (3 if with_text else 2)
    result = COLUMNS if with_text else COLUMNS[:-1]

    def run(batches):
        for batch in batches:
            column = batch.column(names.index("text"))
            out: list[list] = [[] for _ in result]
            for at in range(0, batch.num_rows, SLICE):
                given = column.slice(at, SLICE).to_pylist()
                texts = [t or "" for t in given]
                base = [base_spans(t) for t in texts]
                for t, text, b, more in zip(given, texts, base, added_spans(shared.value, texts, base), strict=True):
                    row = [sum(k == kind for k, _, _ in b) for kind in range(4)]
                    row += [hashlib.sha256(written(b).encode()).hexdigest(), written(b + more)]
                    if with_text:
                        row.append(None if t is None else masked(text, b + more))
                    for o, v in zip(out, row, strict=True):
                        o.append(v)
            columns = list(batch.columns) if with_text else [batch.column(0)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(o, k) for o, k in zip(out, types, strict=True)],
                                             names=[*(names if with_text else names[:1]), *result])
            release_memory()

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    head = ", ".join(f"{n} {kinds[c]}" for n, c in zip(names, kept, strict=True)) if with_text else "doc_id bigint"
    schema = head + ", n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string" + ", masked_text string" * with_text
    found = docs.select(*[F.col(quoted(c)).alias(n) for n, c in zip(names, kept, strict=True)]).mapInArrow(run, schema)
    back = dict(zip(names, kept, strict=True))
    return found.select(*[F.col(n).alias(back.get(n, n)) for n in found.columns])


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span replaced by its kind; where spans overlap, the earliest (longest) names the whole stretch."""
    out, at = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if s >= at:
            out += [text[at:s], f"<{KINDS[k]}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])
