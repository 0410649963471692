"""A training corpus from raw documents, in five stages.

1. ``quality``: the quality classifier, learned from ``labels``, rejects documents
   that score below its threshold;
2. ``near_duplicates``: one document of each near-duplicate class stays;
3. ``decontaminate``: documents that a ``benchmark`` item leaks into go;
4. ``pii``: personal values become format-preserving pseudonyms;
5. ``mix``: sources are mixed to target weights; the result holds the documents
   taken, with the columns ``size``, ``copies`` and ``taken`` (words, repeats counted).

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents`` as they came.  ``run`` writes each
stage's result as Parquet in the shared folder and reads it as the next one's
input.  Empty inputs pass through every stage as empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import decontamination, mixing, ngram_join, pseudonyms, quality_classifier
from ledgerlight.llm.common import fresh, in_fold
from ledgerlight.plans.lineage import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_classifier.train(docs, _table(spark, sf_dir, "labels"), ~in_fold(5, 0))
    score = fresh(docs, "score")
    rows = quality_classifier.scored(docs, model, score)
    return rows.where(F.col(score) >= quality_classifier.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("pii", pii), ("mix", mix)]

#: Trained weights, keyed digests and draws have no SQL counterpart: the tests
#: hold each stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
