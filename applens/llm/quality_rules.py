"""Operator 8: line-first quality rules, in DataFrame functions alone.

Every line of a text is judged by itself and removed if it fails:

* punctuation: more than MARKS_PERCENT of its characters other than white space are
  neither letters nor digits;
* navigation: at least MENU_MARKS separators as menus and link lists have them;
* boilerplate: it holds one of the fixed phrases, in any case.

A document is kept if it passes the base rules (enough words, few of them in
repeated three-word windows) and the failed lines hold at most
LOST_PERCENT of the characters of its lines. The cleaned text is the lines that are left.

Repeated windows are found within the row: windows are hashed, and only texts with
an equal pair are sorted by (hash, place) to find neighbours. A NULL text has no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applens.llm.common import quoted

# Fixed values of the rules.
MARKS_PERCENT, MENU_MARKS, LOST_PERCENT = 30, 3, 30
LEAST_WORDS, REPEAT_PERCENT = 50, 50
MENU = "[|»›•·]"
BOILERPLATE = ("copyright", "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie",
               "javascript", "click here", "subscribe", "sign in", "log in", "lorem ipsum")
WHITE = r"[\x20\x09-\x0D]+"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = (*COUNTS, "base_failed", "kept", "clean_text")


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once a row."""
    return F.transform(F.array(value), body)[0]


def occurrences(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern, -1)) - F.lit(1)


def repeated_words(words: Column) -> Column:
    """Words within three-word windows that occur at least twice."""
    def windows(w):
        places = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def places(hashes):
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s: F.filter(s, lambda x, j: (
            (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])))
        return F.sort_array(F.transform(_let(ordered, same), lambda x: x["i"]))

    def covered(starts):
        # Each window adds the words that the one before it does not hold.
        zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(starts, zero, lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"])

    def count(hashes):
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(covered(places(hashes)))

    return _let(_let(words, windows), count)


def line_fails(line: Column) -> Column:
    low = F.lower(line)
    phrase = low.contains(BOILERPLATE[0])
    for p in BOILERPLATE[1:]:
        phrase = phrase | low.contains(p)
    marks, white = occurrences(line, r"[^\p{L}\p{N}\s]"), occurrences(line, r"\s")
    return (100 * marks > MARKS_PERCENT * (F.char_length(line) - white)) | (occurrences(line, MENU) >= MENU_MARKS) | phrase


def quality(docs: DataFrame) -> DataFrame:
    """Every column of `docs` (text among them; columns named as the result's are replaced), then
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and clean_text."""
    kept = [c for c in docs.columns if c not in RESULT]
    names = [c if c == "text" else f"other_{i}" for i, c in enumerate(kept)]
    words = F.filter(F.split(F.col("full"), WHITE, -1), lambda w: w != "")
    lines = F.split(F.col("full"), "\n", -1)
    with_word = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    chars = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda n, x: n + F.char_length(x))
    counted = (
        docs.select(*[F.col(quoted(c)).alias(n) for n, c in zip(names, kept, strict=True)])
        .withColumn("full", F.coalesce("text", F.lit("")))
        .select("*",
                _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), chars(w).alias("chars"), repeated_words(w).alias("repeat"))).alias("w"),
                occurrences(F.col("full"), "[#*$%&|<>]").cast("long").alias("n_symbols"),
                _let(with_word, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
                _let(lines, lambda a: F.struct(
                    chars(a).alias("all"), F.filter(a, lambda x: ~line_fails(x)).alias("left"))).alias("l"))
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    lost = F.col("l.all") - _let(F.col("l.left"), chars)
    return (counted.select(*names, "l", F.col("w.n").alias("n_words"), F.col("w.chars").alias("word_chars"), "n_symbols",
                           "n_dup_lines", F.col("w.repeat").alias("n_repeat_words"))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (100 * lost <= LOST_PERCENT * F.col("l.all")))
            .withColumn("clean_text", F.when(F.col("text").isNotNull(), F.array_join("l.left", "\n")))
            .select(*[F.col(n).alias(c) for n, c in zip(names, kept, strict=True)], *RESULT))


def oracle() -> str:
    """DuckDB SQL of the query's rows."""
    phrases = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
g AS (SELECT k, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
tri AS (SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM g),
rep AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, x) AS c FROM tri) WHERE c >= 2),
cov AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY k),
ln AS (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d),
lj AS (SELECT k, line, length(line) AS n,
         100 * len(regexp_extract_all(line, '[^\\p{{L}}\\p{{N}}\\x20\\x09-\\x0D]')) >
           {MARKS_PERCENT} * (length(line) - len(regexp_extract_all(line, '[\\x20\\x09-\\x0D]')))
         OR len(regexp_extract_all(line, '{MENU}')) >= {MENU_MARKS} OR {phrases} AS bad,
         regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS has_word
       FROM ln),
la AS (SELECT k, sum(n) AS all_n, coalesce(sum(n) FILTER (WHERE bad), 0) AS lost,
         count(*) FILTER (WHERE has_word) - count(DISTINCT line) FILTER (WHERE has_word) AS dup FROM lj GROUP BY k),
r AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(dup AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, all_n, lost
      FROM d JOIN w USING (k) JOIN la USING (k) LEFT JOIN cov USING (k)),
f AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= {LOST_PERCENT} * all_n AS kept
FROM f"""
