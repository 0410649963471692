"""Taxi trip-duration regression (Q16, M1-M7).

Features: one-hot of pickup zone, drop-off zone and hour of day, plus the
trip distance scaled by its maximum absolute value; label: trip seconds.
The encoder and scaler are fitted once, on the training split, and saved
inside the model (D16), so predicting never refits on the rows it scores.
The split is a hash of the trip key (D17): the same rows land in train on
any cluster size or partitioning.

Spark ML keeps the one-hot columns sparse, so a wide category set costs
nothing extra; the regression solves the normal equations from one
distributed aggregation of the Gram matrix.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import MaxAbsScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.dates import seconds_between
from ledgerlight.functions.hashing import in_train, split_bucket
from ledgerlight.operators import normal_equations

# Encoded columns, label and prediction names, the 70/30 split
# with seed 42, and the model name and tags the registry records.
CATEGORIES = ["pickup_location_id", "dropoff_location_id", "hour_of_day"]
LABEL = "trip_duration_sec"
PREDICTION = "trip_duration_sec_pred"
SPLIT_SEED = 42
TRAIN_PERCENT = 70
MODEL_NAME = "trip_duration_estimator"
MODEL_TAGS = {"stage": "dev", "model_type": "LinearRegression"}


def transform(trips: DataFrame) -> DataFrame:
    """Trip duration in seconds (second boundaries crossed) and pickup hour (Q16)."""
    ptype = trips.schema["pickup_datetime"].dataType
    return trips.select(
        "trip_id",
        F.col("pickup_location_id").cast("string").alias("pickup_location_id"),
        F.col("dropoff_location_id").cast("string").alias("dropoff_location_id"),
        F.hour("pickup_datetime").alias("hour"),
        "trip_distance",
        seconds_between("pickup_datetime", "dropoff_datetime", ptype).alias(LABEL),
    )


def scaled_distance(features: DataFrame) -> DataFrame:
    """Distance divided by the largest absolute distance (M2), via a scalar subquery."""
    peak = features.select(F.max(F.abs("trip_distance"))).scalar()
    return features.select("trip_id", "trip_distance",
                           (F.col("trip_distance") / peak).alias("trip_distance_scaled"))


def with_split(df: DataFrame, key: str, seed: int, train_percent: int = 70) -> DataFrame:
    """Hash split column: stable under repartitioning and checkable in SQL (M4, M8)."""
    return df.select(key, split_bucket(F.col(key), seed).alias("split_bucket"),
                     in_train(F.col(key), seed, train_percent).alias("is_train"))


def feature_stages() -> list:
    """One-hot of the categories (alphabetical order, unseen values kept) + scaled distance (M1, M2)."""
    idx = [f"{c}_idx" for c in CATEGORIES]
    return [
        StringIndexer(inputCols=CATEGORIES, outputCols=idx, stringOrderType="alphabetAsc",
                      handleInvalid="keep"),
        OneHotEncoder(inputCols=idx, outputCols=[f"{c}_vec" for c in CATEGORIES], dropLast=False,
                      handleInvalid="keep"),
        VectorAssembler(inputCols=["trip_distance"], outputCol="trip_distance_vec"),
        MaxAbsScaler(inputCol="trip_distance_vec", outputCol="trip_distance_scaled"),
        VectorAssembler(inputCols=[f"{c}_vec" for c in CATEGORIES] + ["trip_distance_scaled"],
                        outputCol="features"),
    ]


def featurise_input(features: DataFrame) -> DataFrame:
    return features.withColumn("hour_of_day", F.col("hour").cast("string"))


def split(features: DataFrame, seed: int = SPLIT_SEED):
    flag = in_train(F.col("trip_id"), seed, TRAIN_PERCENT)
    return features.where(flag), features.where(~flag)


def fit_features(features: DataFrame, seed: int = SPLIT_SEED) -> DataFrame:
    """Feature vectors of all trips from encoders fitted on the training split (M1, M3)."""
    data = featurise_input(features)
    train, _ = split(data, seed)
    model = Pipeline(stages=feature_stages()).fit(train)
    return model.transform(data).select("trip_id", *CATEGORIES, "features", LABEL)


def train(features: DataFrame, seed: int = SPLIT_SEED):
    """Fit encoders + linear regression on the training split; R^2 on both splits (M5, M7)."""
    # fitting scans its input once per stage (indexers, scaler, solver) and
    # the evaluations scan it again: keep it cached for those passes
    data = featurise_input(features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train_df, test_df = split(data, seed)
        lr = LinearRegression(featuresCol="features", labelCol=LABEL, predictionCol=PREDICTION)
        model = Pipeline(stages=feature_stages() + [lr]).fit(train_df)
        evaluator = RegressionEvaluator(labelCol=LABEL, predictionCol=PREDICTION, metricName="r2")
        metrics = {"train_score": evaluator.evaluate(model.transform(train_df)),
                   "test_score": evaluator.evaluate(model.transform(test_df))}
    finally:
        data.unpersist()
    return model, metrics


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Predicted seconds per trip with the saved encoders (M6)."""
    return model.transform(featurise_input(features)).select(*CATEGORIES, PREDICTION)


def fit_sums(features: DataFrame, seed: int = SPLIT_SEED) -> normal_equations.Fit:
    """The same regression from one aggregation, with R^2 of both splits (M5, M7)."""
    return normal_equations.fit(featurise_input(features), CATEGORIES, "trip_distance", LABEL,
                                in_train(F.col("trip_id"), seed, TRAIN_PERCENT))


def predict_trips(model: normal_equations.Fit, features: DataFrame) -> DataFrame:
    """The trips with their predicted seconds (M6)."""
    return normal_equations.predict(model, featurise_input(features), "trip_distance", PREDICTION)


def cross_counts(features: DataFrame, seed: int = SPLIT_SEED) -> DataFrame:
    """Trips and their seconds by split over each category, each pair of them and all trips: the normal equations."""
    flag = in_train(F.col("trip_id"), seed, TRAIN_PERCENT)
    return normal_equations.cross_sums(featurise_input(features), CATEGORIES, "trip_distance", LABEL, flag).select(
        "is_train", *CATEGORIES, F.col("n").alias("trips"), F.col("y").cast("long").alias("seconds"))


def long_features(featurised: DataFrame) -> DataFrame:
    """One row per trip and non-zero feature: (trip_id, position, value)."""
    return (featurised.select("trip_id", F.posexplode(vector_to_array("features")).alias("position", "value"))
            .where("value != 0"))


def residuals(model: normal_equations.Fit, features: DataFrame, seed: int = SPLIT_SEED) -> DataFrame:
    """Rows and mean residual of the training rows of every category value.

    Least squares with a column per category value leaves no mean residual on
    the rows it was fitted on, whatever the data: a check of any fit.  In units
    of the label's mean, to two digits.
    """
    data, _ = split(features, seed)
    gap = F.col(LABEL) - F.col(PREDICTION)
    cells = predict_trips(model, data).groupBy(*CATEGORIES).agg(
        F.count("*").alias("n"), F.sum(gap).alias("gap"), F.sum(F.abs(LABEL)).alias("size"))
    value = F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("value")) for c in CATEGORIES]))
    mean = F.round(F.sum("gap") / F.sum("size"), 2) + F.lit(0.0)     # no negative zero
    return (cells.select(value.alias("v"), "n", "gap", "size").groupBy("v.category", "v.value")
            .agg(F.sum("n").alias("train_rows"), mean.alias("mean_residual")))


def new_version() -> str:
    return uuid.uuid4().urn
