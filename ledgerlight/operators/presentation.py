"""Presentation tables and dashboard drill-downs.

Inputs are scored calls and comments (``customer_id`` as text, a
``sentiment`` in [0, 1]), the customer rollup and the MRR movements.  The
text tables carry the customer id as text; it is converted once, with
``try_cast`` so that a malformed id matches nothing instead of failing the
job, before joining to the numeric customer key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.plans.ordering import group_index

# Score rounding digits, bucket range and count, value rounding
# digits, and the number of comments shown per customer.
SCORE_DIGITS = 4
BUCKET_LOW, BUCKET_HIGH, BUCKETS = 0.0, 1.0, 10
CLV_DIGITS = 2
TOP_COMMENTS = 5


def _numeric_customer(df: DataFrame) -> DataFrame:
    return df.withColumn("customer_id", F.col("customer_id").try_cast("long"))


def sentiment(scored_calls: DataFrame, scored_comments: DataFrame) -> DataFrame:
    """Mean call and comment sentiment per customer, score and decile (Q9).

    Customers with comments are kept (right join); a missing call mean counts
    as 0 (D20).  Bucket 1..10 over [0, 1), 11 for a score of exactly 1.
    """
    calls = scored_calls.groupBy("customer_id").agg(F.avg("sentiment").alias("calls_sentiment"))
    comments = scored_comments.groupBy("customer_id").agg(F.avg("sentiment").alias("comments_sentiment"))
    score = F.round((F.col("calls_sentiment") + F.col("comments_sentiment")) / 2, SCORE_DIGITS)
    return (calls.join(comments, "customer_id", "right")
            .na.fill(0.0, subset=["calls_sentiment"])
            .withColumn("sentiment_score", score)
            # the built-in called by name, as the reference does
            .withColumn("sentiment_bucket",
                        F.call_function("width_bucket", F.col("sentiment_score"),
                                        F.lit(BUCKET_LOW), F.lit(BUCKET_HIGH), F.lit(BUCKETS))))


def _name() -> Column:
    return F.concat(F.col("first_name"), F.lit(" "), F.col("last_name"))


def with_clv(customers: DataFrame) -> DataFrame:
    return customers.withColumn("clv", F.round("customer_lifetime_value", CLV_DIGITS))


def clv(customers: DataFrame, sentiment_: DataFrame) -> DataFrame:
    """Customers with a lifetime value, named, with their sentiment (Q11).

    No sort on write: order is applied when the table is read (D10).
    """
    scores = _numeric_customer(sentiment_).select("customer_id", "sentiment_score")
    return (with_clv(customers).na.drop(subset=["clv"])
            .join(scores, "customer_id", "left")
            .select("customer_id", _name().alias("name"), "first_order", "most_recent_order",
                    "number_of_orders", "clv", "sentiment_score"))


def churn(customers: DataFrame, mrr: DataFrame, sentiment_: DataFrame) -> DataFrame:
    """One row per churn movement of a customer with a lifetime value (Q12).

    Written as the reference's right join plus NULL drop; the drop makes the
    join inner and Catalyst pushes ``change_category = 'churn'`` into the
    MRR side before the join.
    """
    scores = _numeric_customer(sentiment_).select("customer_id", "sentiment_score")
    movements = mrr.select("customer_id", "first_active_month", "last_active_month", "change_category")
    return (with_clv(customers).select("customer_id", "first_name", "last_name", "clv")
            .join(movements, "customer_id", "right")
            .join(scores, "customer_id", "left")
            .na.drop(subset=["clv"])
            .where(F.col("change_category") == "churn")
            .select("customer_id", _name().alias("name"), "clv", "last_active_month", "sentiment_score"))


def calls_drilldown(scored_calls: DataFrame, customers_of_interest: DataFrame) -> DataFrame:
    """Calls of the chosen customers, ranked by sentiment, highest first (Q14).

    ``customers_of_interest`` holds ``customer_id`` (numeric); a semi join
    keeps the calls of those customers.  The rank column carries the order.
    """
    wanted = customers_of_interest.select("customer_id").distinct()
    calls = _numeric_customer(scored_calls).join(wanted, "customer_id", "left_semi").drop("uuid")
    # every call is ranked (no limit), over range slices: a customer with a
    # large share of the calls is ranked by many tasks
    order = [F.col("sentiment").desc_nulls_last(), F.col("relative_path")]
    return group_index(calls, ["customer_id"], order, "call_rank")


def comments_top(scored_comments: DataFrame, k: int = TOP_COMMENTS) -> DataFrame:
    """The ``k`` highest-sentiment comments of every customer (Q15).

    ``row_number() <= k`` is planned as a window group limit: each task keeps
    at most ``k`` rows per customer before the shuffle, so a customer with a
    huge number of comments costs ``k`` rows per task, not all of them.
    """
    rank = F.row_number().over(Window.partitionBy("customer_id")
                               .orderBy(F.col("sentiment").desc_nulls_last(), F.col("uuid")))
    return (scored_comments.withColumn("comment_rank", rank.cast("long"))
            .where(F.col("comment_rank") <= k).drop("uuid"))


def rename_for_display(df: DataFrame) -> DataFrame:
    """Column names upper-cased, underscores as spaces."""
    return df.toDF(*[c.upper().replace("_", " ") for c in df.columns])


def like_literal_prefix(col: str, prefix: str) -> Column:
    """``col LIKE 'prefix%'`` with ``_`` and ``%`` in the prefix taken literally."""
    escaped = prefix.replace("\\", "\\\\").replace("_", "\\_").replace("%", "\\%")
    return F.col(col).like(escaped + "%")
