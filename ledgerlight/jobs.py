"""End-to-end flows: the two batch jobs of the reference, as one Spark session each.

``customer_analytics`` stages the inputs as tables, runs the three transforms
(order rollups, MRR, attribution), builds the presentation tables from them
and the scored texts, writes every result table (replacing earlier runs) and
drops the intermediate tables it created.  ``taxi_regression`` stages trips,
fits and logs the regression, and writes the predictions.

Every step reads tables written by the step before it, so lineage is cut at
each table (a lost executor recomputes at most one step) and each step can
be re-run on its own.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.operators import attribution, commerce, dense_text, presentation, registry, revenue, taxi, text, vectors
from ledgerlight.operators import sentiment as classifier
from ledgerlight.operators.dense_text import DenseText
from ledgerlight.plans.lineage import materialize
from ledgerlight.sources import catalog
from ledgerlight.sources import fixtures as fx

SENTIMENT_MODEL, SENTIMENT_VECTORS = "sentiment_classifier", "sentiment_text_vectors"

RESULT_TABLES = ["pres_sentiment", "pres_ad_spend", "pres_clv", "pres_churn", "pred_customer_calls",
                 "pred_twitter_comments", "attribution_touches"]


def customer_analytics(spark: SparkSession, sf_dir: str, start_month=None, as_of=None, database: str | None = None,
                       staging_prefix: str = "stg_", temp_prefix: str = "tmp__") -> dict[str, str]:
    """``start_month`` and ``as_of`` bound the calendar; by default it covers every period."""
    db = database or catalog.work_database(spark)

    def table(name: str) -> str:
        return f"{db}.{name}"

    # load (S1, S3): inputs as staged tables
    sources = {
        "customers": fx.stg_customers, "orders": fx.stg_orders, "payments": fx.stg_payments,
        "subscription_periods": fx.stg_subscription_periods, "sessions": fx.stg_sessions,
        "customer_conversions": fx.stg_conversions,
    }
    staged = {name: catalog.save_table(fn(spark, sf_dir), table(staging_prefix + name))
              for name, fn in sources.items()}

    # text objects scored by the classifier that is trained on labelled texts,
    # logged and loaded by version
    dense, model = sentiment_model(spark, sf_dir)
    objects = {"scored_calls": (text.clean_calls(fx.stg_calls(spark, sf_dir)), "transcript"),
               "scored_comments": (text.clean_comments(fx.stg_comments(spark, sf_dir)), "review_text")}
    for name, (rows, column) in objects.items():
        staged[name] = catalog.save_table(classifier.score_objects(model, dense, rows, column), table(staging_prefix + name))

    # transforms, materialised as intermediate tables
    customers = catalog.materialize_step(
        commerce.customers(staged["customers"], staged["orders"], staged["payments"]),
        temp_prefix, "customers", db)
    first, last = revenue.calendar_bounds(staged["subscription_periods"])
    mrr = catalog.materialize_step(
        revenue.mrr(staged["subscription_periods"], start_month or first, as_of or last), temp_prefix, "mrr", db)
    touches = catalog.materialize_step(
        attribution.attribution_touches(staged["sessions"], staged["customer_conversions"]),
        temp_prefix, "attribution_touches", db)
    sentiment = catalog.materialize_step(
        presentation.sentiment(staged["scored_calls"], staged["scored_comments"]),
        temp_prefix, "sentiment", db)

    # presentation tables (S8): replaced on every run
    results = {
        "pres_sentiment": sentiment,
        "pres_ad_spend": attribution.ad_spend(touches),
        "pres_clv": presentation.clv(customers, sentiment),
        "pres_churn": presentation.churn(customers, mrr, sentiment),
        "pred_customer_calls": staged["scored_calls"],
        "pred_twitter_comments": staged["scored_comments"],
        "attribution_touches": touches,
    }
    written = {name: table(name) for name in results}
    for name, df in results.items():
        catalog.save_table(df, written[name], "overwrite")

    # teardown (S13): intermediates and staged inputs
    catalog.drop_tables_with_prefix(spark, db, temp_prefix)
    catalog.drop_tables_with_prefix(spark, db, staging_prefix)
    return written


def sentiment_model(spark: SparkSession, sf_dir: str):
    """Fit the text vectors and the classifier on labelled texts, log both with the metrics, load them by version:
    (dense text model, classifier)."""
    dense, data = training_vectors(spark, sf_dir)
    model, metrics = classifier.train(data, "uuid")
    reg, version = registry.Registry(spark), taxi.new_version()
    reg.log_model(dense, SENTIMENT_VECTORS, version)
    reg.log_model(model, SENTIMENT_MODEL, version)
    for metric, value in metrics.items():
        reg.set_metric(SENTIMENT_MODEL, version, metric, value)
    return reg.load_model(DenseText, SENTIMENT_VECTORS, version), reg.load_model(GBTClassificationModel, SENTIMENT_MODEL, version)


def training_vectors(spark: SparkSession, sf_dir: str) -> tuple[DenseText, DataFrame]:
    """The dense text model of the labelled texts, and their (uuid, features, label) through a collection of
    objects with vectors, written: the tree learner and the scores read them several times."""
    texts = text.clean_training(fx.stg_training(spark, sf_dir))
    dense, objects = dense_text.fit_transform(texts, "review_text")
    coll = vectors.flatten(vectors.collection(
        objects, ["doc_id", "review_text", "label"], "vector", text.TRAINING_CLASS))
    return dense, materialize(classifier.labelled_vectors(coll, "uuid", "vector", F.col("label") == "1"), "labelled-vectors")


def taxi_regression(spark: SparkSession, sf_dir: str, database: str | None = None,
                    write_mode: str = "errorifexists") -> dict:
    """Stage trips, fit and log the model, write predictions (default: fail if present, S9)."""
    db = database or catalog.work_database(spark)
    trips = catalog.save_table(fx.stg_taxi(spark, sf_dir), f"{db}.stg_taxi_trips")
    features = taxi.transform(trips)
    model, metrics = taxi.train(features)
    reg = registry.Registry(spark)
    name, version = taxi.MODEL_NAME, taxi.new_version()
    reg.log_model(model, name, version, taxi.MODEL_TAGS)
    for metric, value in metrics.items():
        reg.set_metric(name, version, metric, value)
    catalog.save_table(taxi.predict(model, features), f"{db}.taxi_pred", write_mode)
    spark.sql(f"DROP TABLE IF EXISTS {db}.stg_taxi_trips")
    return {"name": name, "version": version, "metrics": metrics, "table": f"{db}.taxi_pred"}
