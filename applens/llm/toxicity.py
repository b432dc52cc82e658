"""Operator 7: toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

The kernel of two words counts common subsequences of three letters, each
weighted by DECAY for every place it skips in either word (spans of up to five
places). So an insult with an inserted character, a mark between its letters or
an unknown ending still shares most of its subsequences. Marks
and digits are left out, letters set apart by single blanks are read as one word, and
case is folded.

A text is a bag of words; its kernel with a landmark is that of its best word,
so one insult in a long text counts as much as in a short one; the number of words
that hold the landmark as a whole adds to it. Landmarks are
strings of 5 to 8 letters that tell the labelled classes apart, chosen greedily
so that each adds toxic texts the others miss. The Nystroem map turns the
kernel values into coordinates, a linear SVM (squared hinge) is fitted on them and
its margin is turned into a probability. Examples are the texts and, of toxic texts,
the sentences that hold a whole landmark.

Learning uses a bounded sample of labelled rows: `sample` rows of each class
(those with the smallest hash of doc_id) with texts of up to SAMPLE_CHARS
characters. Scoring reads every whole text. A NULL, empty or letter-free text gets
the score of a text without any common subsequence.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.llm.common import doc_crc_mod, quoted, release_memory

DECAY = 0.6
GAPS = ((1, 1), (1, 2), (2, 1), (2, 2), (1, 3), (3, 1))  # steps to the second and third letter
LETTERS = 64                                             # letter classes, 0: not a letter
START = 63                                               # the class of a word's start
CLEAN_COST = 2                                           # of a share of clean texts that hold a landmark
LEAST_TEXTS, LEAST_RATIO = 5, 4                          # of toxic texts that do, and against the share of clean ones
WHOLE = 0.99                                             # of a landmark's kernel: the word holds it
DEGREE = 3                                               # the kernel's power: sharper, a kernel still
SIZES = (5, 6, 7, 8)                                     # letters of a landmark
LANDMARKS = 48
SAMPLE, SAMPLE_CHARS = 1200, 20_000
INSTANCE = 32                                            # letters of a longer word taken together
SLICE = 128


def _letter_classes() -> np.ndarray:
    """The class of each code point up to 0x24F: a to z one each, other letters by remainder."""
    table = np.zeros(0x250, np.uint8)
    for cp in range(0x250):
        low = chr(cp).lower()
        if len(low) == 1 and low.isalpha():
            table[cp] = ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % (START - 27)
    return table


_CLASSES = _letter_classes()
_BLANK = np.zeros(0x250, bool)
_BLANK[[9, 10, 11, 12, 13, 32, 133, 160]] = True


def _encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter class, word number and text number of every character (blanks and marks dropped)."""
    parts = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    gap = np.full(4, 32, np.uint32)
    cps = np.concatenate([x for p in parts for x in (gap, p)] + [gap])
    text = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) + len(gap) for p in parts])
    text = np.r_[text, np.full(len(gap), max(0, len(parts) - 1), np.int32)]
    near = np.minimum(cps, 0x24F)
    letter, blank = _CLASSES[near], _BLANK[near]
    far = cps >= 0x250
    if far.any():
        blank[far] = (cps[far] >= 0x2000) & (cps[far] <= 0x200B) | (cps[far] == 0x3000)
        letter[far] = np.where(blank[far], 0, 27 + cps[far] % (START - 27))
    # A blank between single letters ("i d i o t") joins them.
    is_letter = letter > 0
    joins = np.zeros(len(cps), bool)
    joins[2:-2] = (blank[2:-2] & is_letter[1:-3] & is_letter[3:-1] & ~is_letter[:-4] & ~is_letter[4:])
    word = np.cumsum(blank & ~joins, dtype=np.int32)
    keep = is_letter  # marks and digits inside a word are left out
    starts = np.r_[~blank[1:], False] & blank & ~joins  # the blank before a word stands for its start
    letter = np.where(starts, START, letter)
    keep |= starts
    return letter[keep], word[keep], text[keep]


def _grams(letter: np.ndarray, word: np.ndarray):
    """For each gap pattern: places, codes of the subsequences of one word that start there, and their weight."""
    n = len(letter)
    wide = letter.astype(np.int32)
    for g, h in GAPS:
        m = n - g - h
        if m <= 0:
            continue
        code = (wide[:m] << 12) | (wide[g:g + m] << 6) | wide[g + h:]
        ok = (wide[:m] > 0) & (wide[g:g + m] > 0) & (wide[g + h:] > 0) & (word[:m] == word[g + h:])
        yield code, ok, np.float32(DECAY ** (g + h - 2))


@dataclass
class Model:
    rows: np.ndarray      # of a subsequence code in `table`, -1: none of a landmark
    table: np.ndarray     # weights of the subsequences in the landmarks
    project: np.ndarray   # kernel values to one margin, Nystroem map and SVM together
    bias: float
    slope: float
    offset: float

    def features(self, texts: list[str | None]) -> np.ndarray:
        """The kernel of each text's best word with each landmark, then log2(1 + words that hold it)."""
        letter, word, text = _encode(texts)
        n = self.table.shape[1]
        out = np.zeros((len(texts), 2 * n), np.float32)
        at, row, weight = [], [], []
        for code, ok, w in _grams(letter, word):
            r = self.rows[code]
            hit = np.flatnonzero((r >= 0) & ok)
            at.append(hit)
            row.append(r[hit])
            weight.append(np.full(len(hit), w, np.float32))
        if not at:
            return out
        at, row, weight = np.concatenate(at), np.concatenate(row), np.concatenate(weight)
        order = np.argsort(at, kind="stable")
        at, row, weight = at[order], row[order], weight[order]
        if not len(at):
            return out
        new = np.r_[True, word[1:] != word[:-1]]
        place = np.arange(len(word)) - np.maximum.accumulate(np.where(new, np.arange(len(word)), 0))
        value = self.table[row] * weight[:, None]
        for shift in (0, INSTANCE // 2):
            part = (place[at] + shift) // INSTANCE
            first = np.flatnonzero(np.r_[True, (word[at][1:] != word[at][:-1]) | (part[1:] != part[:-1])])
            best = np.add.reduceat(value, first, axis=0)
            owner = text[at][first]
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rows = owner[start]
            out[rows, :n] = np.maximum(out[rows, :n], np.maximum.reduceat(best, start, axis=0))
            if shift == 0:
                out[rows, n:] = np.log2(1 + np.add.reduceat(best >= WHOLE, start, axis=0, dtype=np.int64))
            if place[at].max() < INSTANCE // 2:
                break
        out[:, :n] = np.minimum(out[:, :n], 1.0) ** DEGREE
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        margin = self.features(texts) @ self.project + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def _strings_of(texts: list[str], numbers: np.ndarray, size: int):
    """For SLICE texts at a time, their distinct (string, text) in one number each: a sample has fewer than 2**15 texts."""
    for at in range(0, len(numbers), SLICE):
        some = numbers[at:at + SLICE]
        letter, word, text = _encode([texts[i] for i in some])
        wide = letter.astype(np.int64)
        m = len(wide) - size + 1
        if m <= 0:
            continue
        code = np.zeros(m, np.int64)
        ok = word[:m] == word[size - 1:]
        for k in range(size):
            code = code << 6 | wide[k:k + m]
            ok &= wide[k:k + m] > 0
        yield np.unique(code[ok] << 15 | some[text[:m][ok]])


def _landmark_strings(texts: list[str], toxic: np.ndarray) -> list[np.ndarray]:
    """Letter strings that tell the classes apart, each adding toxic texts to those the others find."""
    if len(texts) >= 1 << 15:
        raise ValueError("the training sample has too many texts")
    n_toxic, n_clean = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    candidates: list[tuple[float, int, int, np.ndarray]] = []
    for size in SIZES:
        # Only strings of LEAST_TEXTS toxic texts can gain: the clean texts are searched for these alone.
        pairs = np.concatenate([np.zeros(0, np.int64), *_strings_of(texts, np.flatnonzero(toxic), size)])
        pairs.sort()
        codes, start = np.unique(pairs >> 15, return_index=True)
        often = codes[np.diff(np.r_[start, len(pairs)]) >= LEAST_TEXTS]
        pairs = pairs[np.isin(pairs >> 15, often)]
        clean = [p[np.isin(p >> 15, often)] for p in _strings_of(texts, np.flatnonzero(~toxic), size)]
        pairs = np.concatenate([pairs, *clean])
        pairs.sort()
        owner = pairs & (1 << 15) - 1
        codes, start = np.unique(pairs >> 15, return_index=True)
        ends = np.r_[start, len(pairs)][1:]
        hot = np.r_[0, np.cumsum(toxic[owner])]
        in_toxic = hot[ends] - hot[start]
        in_clean = ends - start - in_toxic
        gain = in_toxic / n_toxic - CLEAN_COST * in_clean / n_clean
        gain[(in_toxic < LEAST_TEXTS) | (in_toxic * n_clean < LEAST_RATIO * in_clean * n_toxic)] = 0
        for k in np.argsort(-gain, kind="stable")[:400]:
            if gain[k] > 0:
                candidates.append((float(gain[k]), size, int(codes[k]), owner[start[k]:ends[k]].copy()))
    chosen: list[np.ndarray] = []
    found = np.zeros(len(texts))
    while candidates and len(chosen) < LANDMARKS:
        # A text counts less with every landmark that finds it already.
        value = [((toxic[c[3]] * 0.25 ** found[c[3]]).sum() / n_toxic - CLEAN_COST * (~toxic[c[3]]).sum() / n_clean, c[1], -c[2])
                 for c in candidates]
        best = candidates[max(range(len(value)), key=value.__getitem__)]
        if max(value)[0] <= 1e-3:
            break
        candidates.remove(best)
        found[best[3]] += 1
        chosen.append(np.array([best[2] >> 6 * (best[1] - 1 - k) & 63 for k in range(best[1])], np.uint8))
    return chosen or [np.array([1, 2, 3, 4], np.uint8)]


def _subsequences(letters: np.ndarray) -> dict[int, float]:
    out: dict[int, float] = {}
    for code, ok, w in _grams(letters, np.zeros(len(letters), np.int64)):
        for c in code[ok]:
            out[int(c)] = out.get(int(c), 0) + float(w)
    return out


def train(texts: list[str], toxic: list[int], share: float | None = None) -> Model:
    """share: of toxic rows among all labelled ones, for the probabilities (the sample is balanced)."""
    y = np.array([t == 1 for t in toxic], bool)
    landmarks = [_subsequences(s) for s in _landmark_strings(texts, y)]
    codes = sorted({c for s in landmarks for c in s})
    rows = np.full(LETTERS ** 3, -1, np.int32)
    rows[codes] = np.arange(len(codes))
    table = np.zeros((len(codes), len(landmarks)), np.float32)
    for j, s in enumerate(landmarks):
        for c, v in s.items():
            table[rows[c], j] = v
    norm = (table ** 2).sum(0)
    k = (table.T @ table / np.sqrt(np.outer(norm, norm))) ** DEGREE
    table /= norm  # the share of a landmark's own kernel that a word reaches
    model = Model(rows, table, np.zeros(2 * len(landmarks)), 0.0, 1.0, 0.0)
    values, vectors = np.linalg.eigh(k.astype(float))
    root = np.eye(2 * len(landmarks))
    root[:len(landmarks), :len(landmarks)] = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
    # A sentence of a toxic text that holds a whole landmark is an example of its own.
    sentences = [s for t, hot in zip(texts, y, strict=True) if hot for s in re.split(r"[.!?|\n]+", t or "")]
    held = [s for i in range(0, len(sentences), SLICE)
            for s, f in zip(sentences[i:], model.features(sentences[i:i + SLICE]), strict=False) if f[len(landmarks):].max() > 0]
    texts, y = [*texts, *held], np.r_[y, np.ones(len(held), bool)]
    raw = np.concatenate([model.features(texts[i:i + SLICE]) for i in range(0, len(texts), SLICE)] or [np.zeros((0, 2 * len(landmarks)))])
    x = raw @ root
    x = np.c_[x, np.ones(len(x))]
    sign = np.where(y, 1.0, -1.0)
    weight = np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum())) * len(y)
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(30):  # Newton steps of the squared-hinge SVM
        inside = sign * (x @ w) < 1
        a = x[inside] * weight[inside, None]
        new = np.linalg.solve(a.T @ x[inside] + ridge, a.T @ sign[inside]) if inside.any() else w
        if np.allclose(new, w):
            break
        w = new
    margin = x @ w
    slope, offset = _calibrate(margin, y, share)
    return Model(rows, table, (root @ w[:-1]).astype(np.float32), float(w[-1]), slope, offset)


def _calibrate(margin: np.ndarray, y: np.ndarray, share: float | None) -> tuple[float, float]:
    """Slope and offset of the logistic curve over the margin (with Platt's targets)."""
    if y.all() or not y.any():
        return 1.0, 0.0
    share = min(max(share if share is not None else y.mean(), 1e-3), 1 - 1e-3)
    weight = np.where(y, share / y.mean(), (1 - share) / (1 - y.mean()))
    hi, lo = (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2)
    t, x = np.where(y, hi, lo), np.c_[margin, np.ones(len(margin))]
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (weight * (p - t)))
        b = b - step
        if np.abs(step).max() < 1e-8:
            break
    return (float(b[0]), float(b[1])) if b[0] > 0 else (1.0, 0.0)


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[list[tuple[str, int]], float | None]:
    """Up to `sample` labelled (text, toxic) rows of each class, and the share of toxic ones in all.

    Learns from rows whose crc32(doc_id) mod 5 is not 0. Picks ids from `labels` alone, so the documents are filtered by a bounded list and not shuffled.
    """
    seen = (labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(doc_crc_mod(5) != 0)
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64("doc_id", F.lit(7))
    ids = [r for t in (0, 1) for r in
           seen.filter(F.col("toxic") == t).orderBy(order, "doc_id").limit(sample).collect()]
    if not ids:
        return [], None
    share = seen.agg(F.avg("toxic")).first()[0]
    spark = docs.sparkSession
    picked = F.broadcast(spark.createDataFrame([tuple(r) for r in ids], "doc_id bigint, toxic int"))
    rows = (docs.select("doc_id", "text").filter(F.length("text") <= SAMPLE_CHARS).join(picked, "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect())
    return [(r.text, r.toxic) for r in sorted(rows, key=lambda r: (r.doc_id, r.toxic))], share


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows, share = labelled_sample(docs, labels, sample)
    model = train([t for t, _ in rows], [y for _, y in rows], share)
    release_memory()  # the driver lives on too
    return model


def add_scores(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """Every column of `docs` (text among them) and the score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != column]

    def run(batches):
        for batch in batches:
            texts = batch.column(names.index("text"))
            found = [shared.value.score(texts.slice(i, SLICE).to_pylist()) for i in range(0, batch.num_rows, SLICE)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(found or [np.zeros(0)]), pa.float64())], names=[*names, "score"])
            release_memory()

    names = [c if c == "text" else f"other_{i}" for i, c in enumerate(kept)]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"{n} {kinds[c]}" for n, c in zip(names, kept, strict=True)) + ", score double"
    scored = docs.select(*[F.col(quoted(c)).alias(n) for n, c in zip(names, kept, strict=True)]).mapInArrow(run, schema)
    return scored.select(*[F.col(n).alias(c) for n, c in zip([*names, "score"], [*kept, column], strict=True)])
