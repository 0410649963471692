"""Registered queries of the training-data operators, one per operator."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlight.llm import (centroids, decontamination, language_model, mixing, ngram_join, packing, pseudonyms, quality_classifier,
                             quality_rules, resampling, token_counts, toxicity, url_reputation)
from ledgerlight.llm.common import in_fold


#: Vocabulary of the token counts, a ranks file on the driver.
VOCABULARY = os.environ.get("TOKENIZER_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Tokenizer of the packing, a JSON file on the driver.
TOKENIZER = os.environ.get("TOKENIZER_JSON", "/opt/tokenizers/byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mix(spark, d):
    return mixing.plan(_table(spark, d, "documents"))


def op2_token_counts(spark, d):
    return token_counts.counted(_table(spark, d, "documents"), token_counts.byte_vocabulary(VOCABULARY))


def op3_pseudonyms(spark, d):
    return pseudonyms.pseudonymised(_table(spark, d, "documents").select("doc_id", "text"), count="n_values")


def op4_ngram_join(spark, d):
    return ngram_join.near_duplicates(_table(spark, d, "documents"))


def op5_quality_rules(spark, d):
    return quality_rules.judged(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op6_decontaminate(spark, d):
    return decontamination.find_leaks(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def op7_url_filter(spark, d):
    return url_reputation.judged(_table(spark, d, "pages"), _table(spark, d, "labels"))


def op8_language_model(spark, d):
    return language_model.scored(_table(spark, d, "documents"), in_fold(5, 1))


def op9_toxicity(spark, d):
    documents, held_out = _table(spark, d, "documents"), in_fold(4, 2)
    model = toxicity.train(documents, _table(spark, d, "labels"), ~held_out)
    rows = toxicity.scored(documents.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out.alias("held_out"), "score",
                       (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op10_quality(spark, d):
    documents, held_out = _table(spark, d, "documents"), in_fold(5, 0)
    model = quality_classifier.train(documents, _table(spark, d, "labels"), ~held_out)
    rows = quality_classifier.scored(documents.select("doc_id", "text"), model, "score")
    return rows.select("doc_id", held_out.alias("held_out"), "score",
                       (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"))


def op11_centroids(spark, d):
    return centroids.clusters(_table(spark, d, "embeddings")).drop("checked")


def op12_best_fit(spark, d):
    with open(TOKENIZER, encoding="utf-8") as vocabulary:
        return packing.packed(_table(spark, d, "documents"), vocabulary.read())


def op13_resample(spark, d):
    return resampling.resampled(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def pipeline(spark, d):
    return corpus_pipeline.run(spark, d)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mix, op2_token_counts, op3_pseudonyms, op4_ngram_join, op5_quality_rules, op6_decontaminate,
                                   op7_url_filter, op8_language_model, op9_toxicity, op10_quality,
                                   op11_centroids, op12_best_fit, op13_resample, pipeline)}
