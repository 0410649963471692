"""Marketing attribution.

``attribution_touches`` keeps the sessions of a customer that fall in the
lookback window before the conversion and gives each first-touch, last-touch,
40-20-40 and linear points and revenue shares.

Plan notes: each conversion is exploded into the days of its window and
sessions join it on (customer, day), so a customer with a large share of all
sessions spreads over as many tasks as it has days.  Sessions are numbered
within their day, on the join's own partitioning; the sessions of earlier days
come from per-day counts, of which a customer has one per calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.functions.dates import add_days
from ledgerlight.plans.lineage import cut_lineage

# The lookback window in days and the name shown for a missing medium.
LOOKBACK_DAYS = 30
NULL_MEDIUM = "NONE"


def _money_sum(c: str) -> Column:
    """Exact sum of amounts with up to 6 decimals (as DECIMAL), returned as DOUBLE.

    Summing doubles depends on the order the rows arrive in; the decimal sum
    does not, so the result is the same on any cluster layout.
    """
    return F.sum(F.col(c).cast("decimal(38,6)")).cast("double")


def _share(idx: Column, total: Column) -> Column:
    return (F.when(total == 1, F.lit(1.0))
             .when(total == 2, F.lit(0.5))
             .when(idx == 1, F.lit(0.4))
             .when(idx == total, F.lit(0.4))
             .otherwise(F.lit(0.2) / (total - 2)))


def window_sessions(sessions: DataFrame, conversions: DataFrame,
                    lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Sessions within ``lookback_days`` before (and up to) the conversion, with its columns.

    Both window ends are inclusive; the lower end keeps the time of day.
    """
    return _by_day(sessions, conversions, lookback_days).drop("_day")


def _by_day(sessions: DataFrame, conversions: DataFrame, lookback_days: int) -> DataFrame:
    opens = add_days(F.col("converted_at"), -lookback_days)
    s = sessions.withColumn("_day", F.to_date("started_at"))
    c = conversions.withColumn("_opens", opens).withColumn(
        "_day", F.explode(F.sequence(F.to_date("_opens"), F.to_date("converted_at"), F.expr("INTERVAL 1 DAY"))))
    inside = F.col("started_at").between(F.col("_opens"), F.col("converted_at"))
    return s.join(c, ["customer_id", "_day"]).where(inside).select(
        *sessions.columns, *[x for x in conversions.columns if x != "customer_id"], "_day")


def attribution_touches(sessions: DataFrame, conversions: DataFrame,
                        lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """``window_sessions`` numbered per customer, with points and revenue shares.

    Sessions of a customer are ordered by start time, then session id.
    """
    joined = _by_day(sessions, conversions, lookback_days)
    day = Window.partitionBy("customer_id", "_day")
    whole = Window.partitionBy("customer_id")
    earlier = whole.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = (joined.groupBy("customer_id", "_day").agg(F.count(F.lit(1)).alias("_n"))
            .select("customer_id", "_day", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"),
                    F.sum("_n").over(whole).alias("total_sessions")))
    in_day = F.row_number().over(day.orderBy("started_at", "session_id", "converted_at"))
    touches = (joined.withColumn("_in_day", in_day).join(days, ["customer_id", "_day"])
               .withColumn("session_index", F.col("_earlier") + F.col("_in_day")))

    idx, total, revenue = F.col("session_index"), F.col("total_sessions"), F.col("revenue")
    first = F.when(idx == 1, F.lit(1.0)).otherwise(F.lit(0.0))
    last = F.when(idx == total, F.lit(1.0)).otherwise(F.lit(0.0))
    linear = F.lit(1.0) / total
    return touches.select(
        *[x for x in joined.columns if x != "_day"], "total_sessions", "session_index",
        first.alias("first_touch_points"),
        last.alias("last_touch_points"),
        _share(idx, total).alias("forty_twenty_forty_points"),
        linear.alias("linear_points"),
        (revenue * first).alias("first_touch_revenue"),
        (revenue * last).alias("last_touch_revenue"),
        (revenue * _share(idx, total)).alias("forty_twenty_forty_revenue"),
        (revenue * linear).alias("linear_revenue"),
    )


def distinct_mediums(touches: DataFrame) -> DataFrame:
    """Mediums present, a missing medium named ``NONE``."""
    return touches.select(F.coalesce("utm_medium", F.lit(NULL_MEDIUM)).alias("utm_medium")).distinct()


def ad_spend(touches: DataFrame) -> DataFrame:
    """Full revenue per touch summed by medium; rows with a NULL dropped."""
    return (touches.select("utm_medium", "revenue").na.drop("any")
            .groupBy("utm_medium").agg(_money_sum("revenue").alias("revenue"))
            .withColumnRenamed("utm_medium", "medium"))


def revenue_by_medium(touches: DataFrame) -> DataFrame:
    """Revenue by source (rows) and medium (columns); NULL medium as ``NONE``.

    The touches are summed per (source, medium) before the mediums become
    columns, so the pivot reads that small table, checkpointed once for the
    list of mediums (each a column of the result) and the pivot itself.
    """
    sums = cut_lineage(touches.groupBy(
        "utm_source", F.coalesce("utm_medium", F.lit(NULL_MEDIUM)).alias("utm_medium"))
        .agg(_money_sum("revenue").alias("revenue")))
    mediums = [r[0] for r in sums.select("utm_medium").distinct().orderBy("utm_medium").collect()]
    return (sums.groupBy(F.col("utm_source").alias("source"))
            .pivot("utm_medium", mediums).agg(F.first("revenue")))
