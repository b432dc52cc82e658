"""Operator 1: language identification by rank-order n-gram profiles.

A text is folded to lower case, everything that is not a letter becomes a blank,
and its 1- to 3-grams (within and at the edges of words) are ranked by how
often they occur, ties by code. Its out-of-place distance to a language is the sum
over its PROFILE most frequent n-grams of how many places each is away from its place
in the language's profile; one missing there counts PROFILE. The nearest
language wins, ties by name. The score is the share by which the next language is
farther, times the share of n-grams that the winner knows: 0 to 1.

Profiles are learnt from a bounded sample: for each language the SAMPLE rows with
the smallest hash of doc_id. A NULL text, or one without a letter, is `und` with score 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from applens.llm.common import doc_crc_mod, quoted

PROFILE = 400
SAMPLE = 400
CHUNK = 1 << 20     # characters counted at once
SLICE = 512
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of a text (three code points of 21 bits) and how often each occurs."""
    cps = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[cps]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Runs of other characters become one blank; the text starts and ends with one.
    first = letter | np.r_[False, letter[:-1]]
    cps = np.where(letter, cps, 32)[first].astype(np.int64)
    cps = np.r_[32, cps, 32] if cps[-1] != 32 else np.r_[32, cps]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(cps), CHUNK):
        part = cps[at:at + CHUNK + 2]
        own = min(CHUNK, len(cps) - at)
        a, b, c = part[:own], part[1:own + 1], part[2:own + 2]
        two = a[:len(b)] << 21 | b
        codes = np.concatenate([a[a != 32], two, two[:len(c)] << 21 | c])
        found.append(np.unique(codes, return_counts=True))
    if len(found) == 1:
        return found[0]
    codes, place = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return codes, np.bincount(place, np.concatenate([f[1] for f in found])).astype(np.int64)


def ranked(text: str, size: int = PROFILE) -> np.ndarray:
    """Codes of the most frequent n-grams, by count, then by code."""
    codes, counts = _counts(text)
    return codes[np.argsort(-counts, kind="stable")[:size]]


@dataclass
class Profiles:
    languages: list[str]
    codes: np.ndarray     # ordered codes of all profiles
    places: np.ndarray    # (codes, languages): the place in the profile, PROFILE where missing

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(text) if text else np.zeros(0, np.int64)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        places = np.where((self.codes[at] == own)[:, None], self.places[at], PROFILE)
        away = np.where(places == PROFILE, PROFILE, np.abs(places - np.arange(len(own))[:, None]))
        distance = away.sum(0)
        best = int(distance.argmin())
        others = np.delete(distance, best)
        known = float((places[:, best] < PROFILE).mean())
        lead = 1 - distance[best] / others.min() if len(others) and others.min() else 1.0 if not len(others) else 0.0
        return self.languages[best], float(min(1.0, max(0.0, lead)) * known)


def learn(docs: DataFrame, sample: int = SAMPLE) -> Profiles:
    """Profiles from the rows of `docs` (doc_id, text, lang) with a language: up to `sample` each.

    The sample is picked from ids and languages alone; counting and ranking run on Spark.
    """
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id")
    picked = (docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang")
              .withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample).select("doc_id", "lang"))
    named = docs.select("doc_id", "text", "lang").join(F.broadcast(picked), ["doc_id", "lang"], "left_semi")

    def count(batches):
        for batch in batches:
            total: dict[str, list] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    total.setdefault(lang, []).append(_counts(text))
            for lang, parts in total.items():
                codes, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(place, np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(codes)), "code": pa.array(codes), "n": pa.array(n)})

    top = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    rows = (named.select("text", "lang").mapInArrow(count, "lang string, code bigint, n bigint")
            .groupBy("lang", "code").agg(F.sum("n").alias("n"))
            .withColumn("place", F.row_number().over(top) - 1).filter(F.col("place") < PROFILE)
            .select("lang", "code", "place").collect())
    languages = sorted({r.lang for r in rows})
    codes = np.array(sorted({r.code for r in rows}), np.int64)
    places = np.full((len(codes), len(languages)), PROFILE, np.int64)
    for r in rows:
        places[np.searchsorted(codes, r.code), languages.index(r.lang)] = r.place
    return Profiles(languages, codes, places)


def add_language(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """Every column of `docs` (text among them), then lang_pred and score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    names = [c if c == "text" else f"other_{i}" for i, c in enumerate(kept)]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def run(batches):
        for batch in batches:
            texts = batch.column(names.index("text"))
            found = [shared.value.predict(t) for at in range(0, batch.num_rows, SLICE) for t in texts.slice(at, SLICE).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*names, "lang_pred", "score"])

    schema = ", ".join(f"{n} {kinds[c]}" for n, c in zip(names, kept, strict=True)) + ", lang_pred string, score double"
    out = docs.select(*[F.col(quoted(c)).alias(n) for n, c in zip(names, kept, strict=True)]).mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip([*names, "lang_pred", "score"], [*kept, "lang_pred", "score"], strict=True)])


def trained_on_folds(docs: DataFrame, sample: int = SAMPLE) -> Profiles:
    """Profiles from the documents whose crc32(doc_id) mod 3 is not 1."""
    return learn(docs.filter(doc_crc_mod(3) != 1), sample)
