"""Registered queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built from the
driver's tables through the adapters.  Drill-down ranks, the pivot, searches,
models and the file and catalog keys write intermediates when called; the
others are lazy.  Keys with a DuckDB statement in
``ledgerlight.oracle`` are checked value for value; model keys return what
holds of any right fit.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ledgerlight import jobs
from ledgerlight.functions import hashing
from ledgerlight.functions.hashing import row_uuid
from ledgerlight.operators import (attribution, commerce, dense_text, presentation, registry, revenue, sentiment,
                                   taxi, text, vectors)
from ledgerlight.plans.lineage import scratch_path
from ledgerlight.sources import catalog, files
from ledgerlight.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Dates as midnight TIMESTAMP_NTZ, the driver tables' own convention.

    The operators compute with DATE; only the registered results present
    day-valued columns the way the source tables store days (``o_orderdate``
    is a timestamp), so they reach Arrow and pandas alike from any engine.
    """
    dates = {f.name for f in df.schema.fields if isinstance(f.dataType, DateType)}
    if not dates:
        return df
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in dates else F.col(c)
                       for c in df.columns])


def query(name: str):
    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def presented(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(spark, sf_dir))
        REGISTRY[name] = presented
        return fn
    return register


# -- Q1, Q2: order rollups ---------------------------------------------------

@query("customer_orders")
def q_customer_orders(spark, d):
    return commerce.customer_orders(fx.stg_orders(spark, d))


@query("customer_payments")
def q_customer_payments(spark, d):
    return commerce.customer_payments(fx.stg_payments(spark, d), fx.stg_orders(spark, d))


@query("customers")
def q_customers(spark, d):
    return commerce.customers(fx.stg_customers(spark, d), fx.stg_orders(spark, d),
                              fx.stg_payments(spark, d))


@query("order_payments")
def q_order_payments(spark, d):
    return commerce.order_payments(fx.stg_orders(spark, d), fx.stg_payments(spark, d))


@query("order_payments_pivot")
def q_order_payments_pivot(spark, d):
    return commerce.order_payments_pivot(fx.stg_orders(spark, d), fx.stg_payments(spark, d))


# -- Q3-Q7: monthly recurring revenue -----------------------------------------

def _periods(spark, d):
    """The subscription periods and the calendar bounds that cover them."""
    periods = fx.stg_subscription_periods(spark, d)
    return periods, *revenue.calendar_bounds(periods)


@query("calendar_months")
def q_calendar_months(spark, d):
    return revenue.calendar_spanning(fx.stg_subscription_periods(spark, d))


@query("calendar_from_to")
def q_calendar_from_to(spark, d):
    """The calendar from given parameters: the months from the first to the last order."""
    days = fx.stg_orders(spark, d)
    return revenue.calendar(spark, days.select(F.min("order_date")).scalar(),
                            days.select(F.max("order_date")).scalar())


@query("customer_span")
def q_customer_span(spark, d):
    return revenue.customer_span(fx.stg_subscription_periods(spark, d))


@query("customer_months")
def q_customer_months(spark, d):
    return revenue.customer_months(*_periods(spark, d))


@query("mrr_monthly")
def q_mrr_monthly(spark, d):
    return revenue.mrr_monthly(*_periods(spark, d))


@query("mrr")
def q_mrr(spark, d):
    return revenue.mrr(*_periods(spark, d))


# -- Q8, Q10, Q13: attribution -------------------------------------------------

def _touches(spark, d, lookback_days=attribution.LOOKBACK_DAYS):
    return attribution.attribution_touches(fx.stg_sessions(spark, d), fx.stg_conversions(spark, d),
                                           lookback_days)


def _window_sessions(spark, d):
    return attribution.window_sessions(fx.stg_sessions(spark, d), fx.stg_conversions(spark, d))


@query("attribution_touches")
def q_attribution_touches(spark, d):
    return _touches(spark, d)


@query("attribution_touches_1d")
def q_attribution_touches_1d(spark, d):
    return _touches(spark, d, lookback_days=1)


@query("distinct_mediums")
def q_distinct_mediums(spark, d):
    return attribution.distinct_mediums(_window_sessions(spark, d))


@query("pres_ad_spend")
def q_pres_ad_spend(spark, d):
    return attribution.ad_spend(_window_sessions(spark, d))


@query("revenue_by_medium")
def q_revenue_by_medium(spark, d):
    return attribution.revenue_by_medium(_window_sessions(spark, d))


# -- V1-V3, F22, S14: text cleaning, ids, import -----------------------------

@query("text_clean_training")
def q_text_clean_training(spark, d):
    return text.clean_training(fx.stg_training(spark, d))


@query("text_clean_comments")
def q_text_clean_comments(spark, d):
    return text.clean_comments(fx.stg_comments(spark, d))


@query("text_clean_calls")
def q_text_clean_calls(spark, d):
    return text.clean_calls(fx.stg_calls(spark, d))


@query("uuid5_ids")
def q_uuid5_ids(spark, d):
    docs = fx.read_table(spark, d, "documents")
    return docs.select("doc_id", row_uuid("Document", ["doc_id", "lang", "text"]).alias("uuid"))


def _document_objects(docs):
    return text.clean_objects(docs.select(F.col("text").alias("review_text"), "lang"),
                              "review_text", "Document")


@query("import_new_only")
def q_import_new_only(spark, d):
    docs = fx.read_table(spark, d, "documents")
    labelled = docs.join(fx.read_table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")
    return text.import_new_only(_document_objects(labelled), _document_objects(docs))


# -- Q9-Q15: presentation tables and drill-downs -------------------------------

def _sentiment(spark, d):
    return presentation.sentiment(fx.scored_calls(spark, d), fx.scored_comments(spark, d))


def _churn(spark, d):
    return presentation.churn(q_customers(spark, d), q_mrr(spark, d), _sentiment(spark, d))


@query("pres_sentiment")
def q_pres_sentiment(spark, d):
    return _sentiment(spark, d)


@query("pres_clv")
def q_pres_clv(spark, d):
    return presentation.clv(q_customers(spark, d), _sentiment(spark, d))


@query("pres_churn")
def q_pres_churn(spark, d):
    return _churn(spark, d)


@query("calls_drilldown")
def q_calls_drilldown(spark, d):
    return presentation.calls_drilldown(fx.scored_calls(spark, d), _churn(spark, d))


@query("comments_top5")
def q_comments_top5(spark, d):
    return presentation.comments_top(fx.scored_comments(spark, d))


@query("rename_all")
def q_rename_all(spark, d):
    return presentation.rename_for_display(fx.scored_calls(spark, d))


@query("pred_like")
def q_pred_like(spark, d):
    return fx.stg_payments(spark, d).where(presentation.like_literal_prefix("payment_method", "bank_"))


# -- V4-V8, S15: collections and search -----------------------------------------

def _embedding_collection(spark, d):
    return vectors.collection(fx.stg_embeddings(spark, d), ["vec_id", "label"], "embedding", "Embedding")


def _label_topk(spark, d, k=vectors.NEAR_TEXT_K):
    coll = _embedding_collection(spark, d)
    queries_ = vectors.centroids(fx.stg_embeddings(spark, d), "label", "embedding")
    return vectors.top_k_similar(queries_, coll, k, "uuid")


@query("collection_flatten")
def q_collection_flatten(spark, d):
    return vectors.flatten(_embedding_collection(spark, d))


@query("vector_topk")
def q_vector_topk(spark, d):
    """Three nearest objects to each label's centroid (queries derived from the table)."""
    return _label_topk(spark, d)


@query("vector_by_id")
def q_vector_by_id(spark, d):
    """Objects fetched by the ids the search returned first (V5)."""
    best = _label_topk(spark, d).where(F.col("rank") == 1)
    return vectors.flatten(vectors.lookup(_embedding_collection(spark, d), best))


@query("text_embed")
def q_text_embed(spark, d):
    weights, _, _ = vectors.text_vectors(fx.stg_documents(spark, d), "doc_id", "text")
    return weights.withColumn("weight", F.round("weight", 9))


def _dense_documents(spark, d):
    """(dense model, documents with their dense vector)."""
    return dense_text.fit_transform(fx.stg_documents(spark, d))


@query("text_dense")
def q_text_dense(spark, d):
    """The dense vector of each document (V7)."""
    return _dense_documents(spark, d)[1].select(
        "doc_id", F.transform("vector", lambda x: F.round(x, 4) + F.lit(0.0)).alias("vector"))


@query("text_dense_topk")
def q_text_dense_topk(spark, d):
    """Three nearest objects to each benchmark passage over a collection of dense text vectors (V4, V7)."""
    model, docs = _dense_documents(spark, d)
    coll = vectors.collection(docs, ["doc_id", "lang"], "vector", "DenseDocument")
    passages = dense_text.transform(model, fx.stg_benchmark(spark, d)).select(F.col("item_id").alias("query_id"), "vector")
    return vectors.top_k_similar(passages, coll, vectors.NEAR_TEXT_K, "uuid")


@query("text_search_top1")
def q_text_search_top1(spark, d):
    """Best document for each benchmark passage (V6 retrieval)."""
    return vectors.search_text(fx.stg_benchmark(spark, d), fx.stg_documents(spark, d), k=vectors.QUESTION_K)


# -- Q16, M1-M7, M11: taxi regression and registry --------------------------------

def _taxi(spark, d):
    return taxi.transform(fx.stg_taxi(spark, d))


def _metrics_frame(spark, name, version, metrics):
    return spark.createDataFrame(
        [(name, version, k, float(v)) for k, v in sorted(metrics.items())],
        "name string, version string, metric string, value double")


@query("taxi_transform")
def q_taxi_transform(spark, d):
    return _taxi(spark, d)


@query("taxi_scaled")
def q_taxi_scaled(spark, d):
    return taxi.scaled_distance(_taxi(spark, d))


@query("split_hash")
def q_split_hash(spark, d):
    return taxi.with_split(_taxi(spark, d), "trip_id", taxi.SPLIT_SEED)


@query("taxi_features")
def q_taxi_features(spark, d):
    return taxi.long_features(taxi.fit_features(_taxi(spark, d)))


@query("taxi_model")
def q_taxi_model(spark, d):
    """The fit checked on its training rows, by category value (M5, M7)."""
    features = _taxi(spark, d)
    return taxi.residuals(taxi.fit_sums(features), features)


@query("taxi_cross_counts")
def q_taxi_cross_counts(spark, d):
    """The counts and sums that the regression is solved from, by split and by one or two categories (M5)."""
    return taxi.cross_counts(_taxi(spark, d))


@query("taxi_r2")
def q_taxi_r2(spark, d):
    """Rows and R squared of the training and the test split (M7)."""
    model = taxi.fit_sums(_taxi(spark, d))
    return spark.createDataFrame([(s, model.rows[s], model.r2[s]) for s in (True, False)],
                                 "is_train boolean, trips long, r2 double").withColumn("r2", F.round("r2", 9))


@query("taxi_trip_predictions")
def q_taxi_trip_predictions(spark, d):
    """The predicted seconds of each trip (M6)."""
    features = _taxi(spark, d)
    return taxi.predict_trips(taxi.fit_sums(features), features).select(
        "trip_id", F.round(taxi.PREDICTION, 4).alias(taxi.PREDICTION))


@query("taxi_predict")
def q_taxi_predict(spark, d):
    """Trips and finite predictions by pickup zone and hour (M6)."""
    features = _taxi(spark, d)
    model = taxi.fit_sums(features)
    finite = F.col(taxi.PREDICTION).isNotNull() & ~F.isnan(taxi.PREDICTION)
    return taxi.predict_trips(model, features).groupBy("pickup_location_id", "hour_of_day").agg(
        F.count("*").alias("trips"), F.count_if(finite).alias("predicted"))


@query("registry_roundtrip")
def q_registry_roundtrip(spark, d):
    """Train, log with tags, set metrics, reload by version: predictions that differ, by zone."""
    from pyspark.ml import PipelineModel
    features = _taxi(spark, d)
    model, metrics = taxi.train(features)
    reg = registry.Registry(spark)
    name, version = taxi.MODEL_NAME, taxi.new_version()
    reg.log_model(model, name, version, taxi.MODEL_TAGS)
    for k, v in metrics.items():
        reg.set_metric(name, version, k, v)
    reloaded = reg.load_model(PipelineModel, name, version)
    data = taxi.featurise_input(features)
    now = model.transform(data).select("trip_id", "pickup_location_id", F.col(taxi.PREDICTION).alias("now"))
    again = reloaded.transform(data).select("trip_id", F.col(taxi.PREDICTION).alias("again"))
    logged = reg.metrics(name, version).select(F.count("*")).scalar()
    return now.join(again, "trip_id").groupBy("pickup_location_id").agg(
        F.count("*").alias("trips"), F.count_if(~F.col("now").eqNullSafe(F.col("again"))).alias("differ"),
        F.max(logged).alias("metrics"))


# -- M8-M10: sentiment classifier ------------------------------------------------

@query("sentiment_model")
def q_sentiment_model(spark, d):
    """Labelled texts by split and label, and whether the classifier ranks each label's mean rightly (M8, M9)."""
    _, data = jobs.training_vectors(spark, d)
    model, _ = sentiment.train(data, "uuid")
    scored = sentiment.score(model, data, "uuid").join(data.select("uuid", "label"), "uuid")
    train = hashing.in_train(F.col("uuid"), sentiment.SPLIT_SEED, sentiment.TRAIN_PERCENT)
    return (scored.where(train).groupBy(F.col("label").cast("int").alias("label"))
            .agg(F.count("*").alias("objects"), (F.avg("sentiment") > 0.5).alias("likely_positive")))


@query("sentiment_score")
def q_sentiment_score(spark, d):
    """Comments and calls scored by the logged classifier, each with a probability."""
    return _scored_objects(spark, d).select("uuid", F.col("sentiment").between(0, 1).alias("is_probability"))


def _scored_objects(spark, d):
    dense, model = jobs.sentiment_model(spark, d)
    comments = text.clean_comments(fx.stg_comments(spark, d)).select("uuid", F.col("review_text").alias("text"))
    calls = text.clean_calls(fx.stg_calls(spark, d)).select("uuid", F.col("transcript").alias("text"))
    return sentiment.score_objects(model, dense, comments.unionByName(calls), "text")


@query("sentiment_probability")
def q_sentiment_probability(spark, d):
    """The probability of each comment and call."""
    return _scored_objects(spark, d).select("uuid", F.round("sentiment", 6).alias("sentiment"))


@query("sentiment_auc")
def q_sentiment_auc(spark, d):
    """Area under ROC of the classifier on its training and its held-out texts (M9)."""
    _, data = jobs.training_vectors(spark, d)
    model, _ = sentiment.train(data, "uuid")
    scored = sentiment.score(model, data, "uuid").join(data.select("uuid", "label"), "uuid")
    return sentiment.auc_by_split(scored, "uuid")


@query("length_auc")
def q_length_auc(spark, d):
    """Area under ROC, ties and all, of the labelled texts' length score on both sides of the split (M8, M9)."""
    rows = text.clean_training(fx.stg_training(spark, d)).select(
        "uuid", (F.col("label") == "1").cast("int").alias("label"), ((F.length("review_text") % 129) / 128.0).alias("sentiment"))
    return sentiment.auc_by_split(rows, "uuid")


# -- S1-S16: sources, sinks, catalog -------------------------------------------

@query("src_csv_roundtrip")
def q_src_csv_roundtrip(spark, d):
    """Customers written as CSV and loaded back with an explicit schema."""
    df = fx.stg_customers(spark, d)
    path = files.write_csv(df, scratch_path(spark, "csv-customers"))
    return files.read_csv(spark, path, df.schema)


@query("src_csv_multi")
def q_src_csv_multi(spark, d):
    """Trips written as one CSV file per pickup day, all files loaded into one table."""
    trips = fx.stg_taxi(spark, d)
    root = files.write_csv(trips.withColumn("pickup_day", F.to_date("pickup_datetime")),
                           scratch_path(spark, "csv-trips"), partition_by=["pickup_day"])
    return files.read_csv(spark, root, trips.schema)


#: Folders that the call files are dealt to, by customer; size of a file (some eight calls: the listing of many files is the query).
CALL_FOLDERS, CALL_FILE_BYTES = 16, 1 << 13


def _call_files(spark, d):
    folder = (F.col("customer_id").cast("long") % CALL_FOLDERS).alias("customer_group")
    calls = fx.stg_calls(spark, d).select(folder, F.col("relative_path").alias("call"), "transcript")
    root = files.write_text_files(calls, scratch_path(spark, "call-files"), "customer_group", ["call"], "transcript", CALL_FILE_BYTES)
    return files.list_files(spark, root)


@query("src_file_listing")
def q_src_file_listing(spark, d):
    """Call files listed by metadata only: each file's name, its folder read from the path, its size."""
    return _call_files(spark, d).select("name", "folder", "size")


@query("src_file_lookup")
def q_src_file_lookup(spark, d):
    """The files of one group of customers, found by their relative path."""
    return files.files_like(_call_files(spark, d), "customer_group=1/").select("name", "folder", "size")


@query("sink_overwrite")
def q_sink_overwrite(spark, d):
    """The customer rollup saved twice with overwrite; the table holds one copy."""
    name = catalog.fresh_table(spark, "customers")
    result = q_customers(spark, d)
    catalog.save_table(result, name, "overwrite")
    return catalog.save_table(result, name, "overwrite")


@query("sink_new_table")
def q_sink_new_table(spark, d):
    """Ad spend by medium saved with the default mode, which fails where the table exists."""
    name = catalog.fresh_table(spark, "ad_spend")
    return catalog.save_table(attribution.ad_spend(_window_sessions(spark, d)), name, "errorifexists")


@query("catalog_ddl")
def q_catalog_ddl(spark, d):
    """Database and NOT NULL table created if missing, then filled."""
    name = catalog.fresh_table(spark, "dim_customers")
    catalog.create_table_if_not_exists(
        spark, name, "customer_id BIGINT NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL")
    return catalog.insert_overwrite(fx.stg_customers(spark, d), name)


@query("catalog_cleanup")
def q_catalog_cleanup(spark, d):
    """Steps materialised under a prefix, final table written, intermediates dropped."""
    db, prefix = catalog.work_database(spark), f"tmp_{uuid.uuid4().hex[:12]}__"
    orders, payments = fx.stg_orders(spark, d), fx.stg_payments(spark, d)
    per_customer = catalog.materialize_step(commerce.customer_orders(orders), prefix, "customer_orders", db)
    paid = catalog.materialize_step(commerce.customer_payments(payments, orders), prefix,
                                    "customer_payments", db)
    final = (fx.stg_customers(spark, d).join(per_customer, "customer_id", "left")
             .join(paid, "customer_id", "left")
             .withColumnRenamed("total_amount", "customer_lifetime_value"))
    table = catalog.save_table(final, catalog.fresh_table(spark, "customers_final"), "overwrite")
    catalog.drop_tables_with_prefix(spark, db, prefix)
    return table


@query("snapshot_restore")
def q_snapshot_restore(spark, d):
    """Collection written as a snapshot, restored over the live table, read back."""
    name = catalog.fresh_table(spark, "embedding_collection").split(".")[1]
    snap = catalog.write_snapshot({name: _embedding_collection(spark, d)}, scratch_path(spark, "snapshot"))
    table = catalog.restore_snapshot(spark, snap, [name])[name]
    return vectors.flatten(spark.table(table))


@query("comments_near_text")
def q_comments_near_text(spark, d):
    """Three nearest comments to each benchmark passage (V4 near-text, limit 3)."""
    corpus = text.clean_comments(fx.stg_comments(spark, d)).select(
        "uuid", F.col("review_text").alias("text"))
    return vectors.search_text(fx.stg_benchmark(spark, d), corpus, k=vectors.NEAR_TEXT_K, doc_id="uuid")


@query("calls_near_text")
def q_calls_near_text(spark, d):
    """Three nearest call transcripts to each benchmark passage (V4 near-text, limit 3)."""
    corpus = text.clean_calls(fx.stg_calls(spark, d)).select("uuid", F.col("transcript").alias("text"))
    return vectors.search_text(fx.stg_benchmark(spark, d), corpus, k=vectors.NEAR_TEXT_K, doc_id="uuid")


@query("comments_question_top1")
def q_comments_question_top1(spark, d):
    """Best comment for each benchmark passage (V6 question search, retrieval half, limit 1)."""
    corpus = text.clean_comments(fx.stg_comments(spark, d)).select(
        "uuid", F.col("review_text").alias("text"))
    return vectors.search_text(fx.stg_benchmark(spark, d), corpus, k=vectors.QUESTION_K, doc_id="uuid")


@query("calls_question_top1")
def q_calls_question_top1(spark, d):
    """Best call transcript for each benchmark passage (V6 question search, limit 1)."""
    corpus = text.clean_calls(fx.stg_calls(spark, d)).select("uuid", F.col("transcript").alias("text"))
    return vectors.search_text(fx.stg_benchmark(spark, d), corpus, k=vectors.QUESTION_K, doc_id="uuid")


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
