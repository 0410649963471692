"""Adapters: the driver's tables reshaped into the reference's inputs.

The reference loads seven CSV sources, two Parquet text sets, call
transcripts and taxi trips.  None ship with it, so each input is derived from
a driver table with a fixed, documented rule (see FIXTURES.md).  Every
adapter reads its whole source table; derived categories come from the data,
no rows are dropped to save work.

The same rules are written as DuckDB SQL in ``ledgerlight.oracle`` for the
correctness check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlight.sources.tables import read_table

__all__ = ["read_table"]

# Payment methods in the order a part key selects them
# (``l_partkey % 5``); the fifth lies outside the reference's pivot list.
PAYMENT_METHODS = ["credit_card", "coupon", "bank_transfer", "gift_card", "other"]

# Fixed value: the day comment dates count from.
COMMENT_EPOCH = "2024-01-01 00:00:00"


def stg_customers(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
    )


def stg_orders(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
    )


def stg_payments(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    methods = F.array(*[F.lit(m) for m in PAYMENT_METHODS])
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("payment_id"),
        F.col("l_orderkey").alias("order_id"),
        F.element_at(methods, (F.col("l_partkey") % 5 + 1).cast("int")).alias("payment_method"),
        F.round("l_extendedprice").cast("long").alias("amount"),
    )


def stg_subscription_periods(spark: SparkSession, d: str) -> DataFrame:
    """One subscription per order; periods of a customer never overlap.

    start: the order date, moved to the month start for even order keys;
    end:   the next start of the same customer or ``1 + key % 6`` months,
           whichever is first; the last period of customers with
           ``custkey % 10 = 0`` stays open (NULL end).
    """
    o = read_table(spark, d, "orders")
    day = F.to_date("o_orderdate")
    start = F.when(F.col("o_orderkey") % 2 == 0, F.trunc(day, "MM")).otherwise(day)
    base = o.select(
        F.col("o_orderkey").alias("subscription_id"),
        F.col("o_custkey").alias("customer_id"),
        start.alias("start_date"),
        (F.lit(10.0) * (F.col("o_orderkey") % 5 + 1)).alias("monthly_amount"),
    )
    # the next start of the same customer: its next start day, or the same day
    # for all but the day's last order; a customer has one row per day here,
    # however many orders it holds
    by_day = Window.partitionBy("customer_id").orderBy("start_date")
    days = (base.groupBy("customer_id", "start_date").agg(F.max("subscription_id").alias("_last"))
            .withColumn("_later", F.lead("start_date").over(by_day)))
    with_next = base.join(days, ["customer_id", "start_date"]).withColumn(
        "_next", F.when(F.col("subscription_id") < F.col("_last"), F.col("start_date")).otherwise(F.col("_later")))
    nxt = F.col("_next")
    term_end = F.add_months("start_date", (F.col("subscription_id") % 6 + 1).cast("int"))
    end = (F.when(nxt.isNull() & (F.col("customer_id") % 10 == 0), F.lit(None).cast("date"))
             .when(nxt.isNull(), term_end)
             .otherwise(F.least(nxt, term_end)))
    return with_next.select("subscription_id", "customer_id", "start_date",
                            end.alias("end_date"), "monthly_amount")


def stg_sessions(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events")
    return e.select(
        F.col("event_id").alias("session_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("started_at"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("utm_medium"),
        F.concat(F.lit("src"), (F.col("event_id") % 4).cast("string")).alias("utm_source"),
    )


def stg_conversions(spark: SparkSession, d: str) -> DataFrame:
    """Latest purchase of each user; revenue rounded to whole cents."""
    e = read_table(spark, d, "events").where(F.col("event_type") == "purchase")
    latest = e.groupBy("user_id").agg(
        F.max("ts").alias("converted_at"),
        F.max_by("value", F.struct("ts", "event_id")).alias("value"))
    return latest.select(
        F.col("user_id").alias("customer_id"),
        "converted_at",
        (F.round(F.col("value") * 100) / 100).alias("revenue"),
    )


def stg_comments(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "conversations").where(F.col("role") == "user")
    return c.select(
        F.col("conv_id").cast("string").alias("customer_id"),
        F.col("text").alias("review_text"),
        F.expr(f"timestampadd(DAY, turn, TIMESTAMP_NTZ'{COMMENT_EPOCH}')").alias("date"),
    )


def stg_calls(spark: SparkSession, d: str) -> DataFrame:
    """Transcribed calls; the customer id is read back from the file name."""
    c = read_table(spark, d, "conversations").where(F.col("role") == "assistant")
    path = F.concat(F.col("conv_id").cast("string"), F.lit("-"),
                    F.col("turn").cast("string"), F.lit(".wav"))
    return c.select(
        F.split_part(path, F.lit("-"), F.lit(1)).alias("customer_id"),
        F.col("text").alias("transcript"),
        path.alias("relative_path"),
    )


def stg_training(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    labels = read_table(spark, d, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        "doc_id", F.col("text").alias("review_text"),
        F.col("quality").cast("string").alias("label"))


def scored_comments(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned comments with a stand-in sentiment in [0, 1].

    The score is a multiple of 1/128, so sums and means are exact in any
    order and the presentation tables are reproducible bit for bit.
    """
    from ledgerlight.operators.text import clean_comments
    c = clean_comments(stg_comments(spark, d))
    return c.withColumn("sentiment", (F.length("review_text") % 129) / F.lit(128.0))


def scored_calls(spark: SparkSession, d: str) -> DataFrame:
    from ledgerlight.operators.text import clean_calls
    c = clean_calls(stg_calls(spark, d))
    return c.withColumn("sentiment", (F.length("transcript") % 65) / F.lit(64.0))


def stg_taxi(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events")
    return e.select(
        F.col("event_id").alias("trip_id"),
        (F.col("user_id") % 20).alias("pickup_location_id"),
        (F.col("event_id") % 15).alias("dropoff_location_id"),
        F.col("ts").alias("pickup_datetime"),
        F.expr("timestampadd(SECOND, CAST(floor(value * 60) AS INT), ts)").alias("dropoff_datetime"),
        (F.col("value") / 10).alias("trip_distance"),
    )


def stg_embeddings(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "embeddings").select("vec_id", "embedding", "label")


def stg_documents(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", "text", "lang")


def stg_benchmark(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "benchmark").select("item_id", "text")

