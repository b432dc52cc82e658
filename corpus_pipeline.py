"""A cleaning pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last
return the columns of documents; rows without a doc_id stay where a stage has no reason to drop them.

1. toxicity: documents scored 0.5 or more go. Labels are learnt from the fold that op7 learns from.
2. jaccard: of each group of linked documents the one with the smallest doc_id stays.
3. suffix_array: bytes of 50-byte strings that a smaller doc_id holds are cut from the text;
   n_chars follows the text (NULL text: n_chars as it was).
4. pii: personal data is replaced by its kind in angle brackets; n_chars follows.
5. packing: the pieces of the remaining documents and their places in sequences.
"""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from applens.llm import jaccard_join, packing, pii, suffix_dedup, toxicity
from applens.llm.common import quoted, shared_dir, small_batches


def _with_new_text(docs: DataFrame, operator, new: str) -> DataFrame:
    """The columns of `docs` with the text that `operator` names `new`, and n_chars from it.

    Other columns pass under neutral names, so that none clashes with the operator's own.
    """
    names = {c: c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)}
    out = operator(docs.select(*[F.col(quoted(c)).alias(n) for c, n in names.items()]))
    text = F.when(F.col("text").isNotNull(), F.col(new))
    own = {"text": text}
    if "n_chars" in names:
        kept = F.col(names["n_chars"])
        own["n_chars"] = F.when(F.col("text").isNull(), kept).otherwise(F.char_length(new).cast(docs.schema["n_chars"].dataType))
    return out.select(*[own.get(c, F.col(n)).alias(c) for c, n in names.items()])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = "toxicity_score"
    while score in docs.columns:
        score += "_"
    return toxicity.add_scores(docs, model, score).filter(F.col(score) < 0.5).drop(score)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    groups = jaccard_join.jaccard_groups(docs)
    others = groups.filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*[F.col(quoted(c)) for c in docs.columns])


def suffix_array_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return _with_new_text(docs, suffix_dedup.remove_repeats, "kept_text")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return _with_new_text(docs, lambda d: pii.find(d, pii.fit(docs)), "masked_text")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity_stage), ("jaccard", jaccard_stage), ("suffix_array", suffix_array_stage),
          ("pii", pii_stage), ("packing", packing_stage)]

#: The learnt and iterative stages have no SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = os.path.join(shared_dir(spark), f"corpus-{uuid.uuid4().hex}")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            path = f"{base}/{n}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
