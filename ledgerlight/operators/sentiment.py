"""Sentiment classifier on object vectors.

A gradient-boosted tree classifier over the dense text vectors of labelled objects,
trained on a 70/30 hash split (seed 1883), evaluated by area under ROC on
the held-out part; scoring adds the probability of the positive class.
Training is Spark ML's distributed tree learner; nothing is stacked into a
local array.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.hashing import in_train
from ledgerlight.operators.dense_text import DenseText, transform
from ledgerlight.operators.evaluation import auc

# 70/30 split with seed 1883, model seed 42.
SPLIT_SEED = 1883
TRAIN_PERCENT = 70
MODEL_SEED = 42


def labelled_vectors(df: DataFrame, key: str, vector_col: str, positive: Column) -> DataFrame:
    return df.select(key, array_to_vector(F.col(vector_col)).alias("features"),
                     positive.cast("double").alias("label"))


def train(data: DataFrame, key: str, max_iter: int = 20, max_depth: int = 5):
    """Fit on the training split; returns the model and its metrics."""
    flag = in_train(F.col(key), SPLIT_SEED, TRAIN_PERCENT)
    train_df, test_df = data.where(flag), data.where(~flag)
    model = GBTClassifier(featuresCol="features", labelCol="label", seed=MODEL_SEED,
                          maxIter=max_iter, maxDepth=max_depth).fit(train_df)
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                        metricName="areaUnderROC").evaluate(model.transform(test_df))
    return model, {"test_auc": auc}


def score_objects(model: GBTClassificationModel, dense: DenseText, objects: DataFrame, text_col: str) -> DataFrame:
    """``objects`` with a ``sentiment``: the probability of the positive class of their text."""
    vectors = transform(dense, objects, text_col, "_vector").withColumn("features", array_to_vector("_vector"))
    return model.transform(vectors).select(
        *objects.columns, vector_to_array("probability")[1].alias("sentiment"))


def auc_by_split(scored: DataFrame, key: str) -> DataFrame:
    """(is_train, positives, negatives, auc) of scored rows (key, label, sentiment) on both sides of the split (M8, M9)."""
    flag = in_train(F.col(key), SPLIT_SEED, TRAIN_PERCENT)
    return auc(scored.withColumn("is_train", flag), ["is_train"], "label", "sentiment")


def score(model: GBTClassificationModel, data: DataFrame, key: str) -> DataFrame:
    """Probability of the positive class per object."""
    return model.transform(data).select(
        key, vector_to_array("probability")[1].alias("sentiment"))
