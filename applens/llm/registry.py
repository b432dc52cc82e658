"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import functions as F

import applens
from applens.llm import (hard_negatives, jaccard_join, language_id, lm_scoring, packing, pii, quality_rules,
                         sentencepiece_dropout, source_mixing, suffix_dedup, topk_search, toxicity, vector_codes)
from applens.llm.common import doc_crc_mod, documents, small_batches


def op1_language_id(spark, sf):
    docs = documents(spark, sf)
    profiles = language_id.trained_on_folds(docs)
    return language_id.add_language(docs.select("doc_id", "text"), profiles).select(
        "doc_id", (doc_crc_mod(3) == 1).alias("held_out"), "lang_pred", "score")


def op2_packing(spark, sf):
    return packing.pack(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.json"))


def op3_lm_scoring(spark, sf):
    return lm_scoring.fold_scores(documents(spark, sf))


def op4_pii(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return pii.find(docs, pii.fit(docs), with_text=False)


def op5_topk_search(spark, sf):
    vectors = topk_search.integer_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))
    return topk_search.search(vectors, vectors.filter("vec_id % 50 = 0"))


def op6_sentencepiece(spark, sf):
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_dropout.encode(documents(spark, sf), path, seed=1, rate=0.1, with_ids=False)


def op7_toxicity(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    return toxicity.add_scores(docs, model, "score").select(
        "doc_id", (doc_crc_mod(5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_quality_rules(spark, sf):
    found = quality_rules.quality(documents(spark, sf).select("doc_id", "text"))
    return found.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op9_jaccard_join(spark, sf):
    return jaccard_join.jaccard_groups(documents(spark, sf))


def op10_suffix_dedup(spark, sf):
    return suffix_dedup.remove_repeats(documents(spark, sf), with_text=False)


def op11_hard_negatives(spark, sf):
    return hard_negatives.negatives(spark.read.parquet(f"{sf}/embeddings.parquet"))


def op12_vector_codes(spark, sf):
    return vector_codes.codes(spark.read.parquet(f"{sf}/embeddings.parquet"))


def op13_source_mixing(spark, sf):
    return source_mixing.mix(documents(spark, sf))


def pipeline(spark, sf):
    import corpus_pipeline  # beside the package, at the repository's top

    return corpus_pipeline.run(spark, sf)


def _with_code(query):
    """Let Python workers import this package wherever the driver was started."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(applens.__file__)))

    def run(spark, sf):
        env = spark.sparkContext.environment
        paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            env["PYTHONPATH"] = os.pathsep.join([root, *paths])
        small_batches(spark)
        return query(spark, sf)

    return run


QUERIES = (op1_language_id, op2_packing, op3_lm_scoring, op4_pii, op5_topk_search, op6_sentencepiece,
           op7_toxicity, op8_quality_rules, op9_jaccard_join, op10_suffix_dedup, op11_hard_negatives, op12_vector_codes,
           op13_source_mixing, pipeline)


def queries():
    return {f.__name__: _with_code(f) for f in QUERIES}


def oracle_sql():
    return {"op5_topk_search": topk_search.oracle(), "op8_quality_rules": quality_rules.oracle(),
            "op11_hard_negatives": hard_negatives.oracle(), "op12_vector_codes": vector_codes.oracle()}
