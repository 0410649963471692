"""Monthly recurring revenue (Q3-Q7).

Semantics follow the SQL statement of the operation (decisions D7, D8, D9,
worth 0.0 in the month after the last active month, ``lag`` ordered by
``(date_month, churn row last)``, ``id = md5(customer_id)``.

Plan notes
----------
* No theta join.  A customer's months are ``explode(sequence(...))`` over its
  span clipped to the calendar, and each subscription period is exploded
  into the month starts it covers; the "month inside the period" join
  becomes an equi-join on ``(customer_id, date_month)``.  Both sides hash on
  the pair, so a customer with many rows spreads over many tasks, and no
  pair is produced that the result does not contain.
* First and last active month are worked out on one row per customer before
  its months are exploded, from its covered month ranges (at most one per
  calendar month), so no window gathers a customer's rows.
* The previous month's value is carried forward: every row also travels to the
  next month, where it precedes that month's rows in a window over
  ``(customer_id, date_month)``.  A customer's months are contiguous, so this
  equals ``lag`` over the customer, and a customer with very many rows spreads
  over as many tasks as it has months.
* ``mrr`` deals its months to a number of tasks that grows with the months: a
  customer's one row (written) holds its span and its covered months, and their
  sum sets the number.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlight.plans.lineage import materialize

#: Months of spans and periods that a task of ``mrr`` takes (about 100 MB while sorted).
TASK_MONTHS = 500_000


def _month_step() -> Column:
    return F.expr("INTERVAL 1 MONTH")


def _date(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, (_dt.date, _dt.datetime)):
        v = v.isoformat()[:10]
    return F.to_date(F.lit(str(v)))


def calendar(spark: SparkSession, start_month, as_of) -> DataFrame:
    """Month starts from ``start_month`` through the month of ``as_of`` (Q3)."""
    # one row per month: ordering it is free and gives the calendar in order (O1)
    return spark.range(1).select(F.explode(F.sequence(
        F.trunc(_date(start_month), "MM"), F.trunc(_date(as_of), "MM"), _month_step())).alias("date_month")) \
        .orderBy("date_month")


def calendar_spanning(periods: DataFrame) -> DataFrame:
    """Calendar covering every start and end date of the periods (Q3, from data)."""
    last = F.greatest(F.col("start_date"), F.coalesce(F.col("end_date"), F.col("start_date")))
    bounds = periods.agg(F.min("start_date").alias("lo"), F.max(last).alias("hi"))
    return bounds.select(F.explode(F.sequence(
        F.trunc("lo", "MM"), F.trunc("hi", "MM"), _month_step())).alias("date_month")).orderBy("date_month")


def calendar_bounds(periods: DataFrame) -> tuple[Column, Column]:
    """First and last day of the calendar that covers the periods, read by one scalar subquery."""
    last = F.greatest(F.col("start_date"), F.coalesce(F.col("end_date"), F.col("start_date")))
    bounds = periods.select(F.struct(F.min("start_date").alias("lo"), F.max(last).alias("hi"))).scalar()
    return bounds["lo"], bounds["hi"]


def customer_span(periods: DataFrame) -> DataFrame:
    """First start month and last end month per customer (A3).

    ``max`` ignores open ends; a customer whose every period is open gets a
    NULL end and no months (D21).
    """
    return periods.groupBy("customer_id").agg(
        F.trunc(F.min("start_date"), "MM").alias("date_month_start"),
        F.trunc(F.max("end_date"), "MM").alias("date_month_end"))


def _clipped_span(periods: DataFrame, start_month, as_of) -> DataFrame:
    """(customer_id, lo, hi): first and last month of each customer within the calendar."""
    # greatest/least skip NULLs; a NULL span end must leave the customer out
    lo = F.when(F.col("date_month_start").isNotNull(),
                F.greatest(F.col("date_month_start"), F.trunc(_date(start_month), "MM")))
    hi = F.when(F.col("date_month_end").isNotNull(),
                F.least(F.add_months("date_month_end", -1), F.trunc(_date(as_of), "MM")))
    return (customer_span(periods).select("customer_id", lo.alias("lo"), hi.alias("hi"))
            .where(F.col("lo") <= F.col("hi")))


def customer_months(periods: DataFrame, start_month, as_of) -> DataFrame:
    """(customer, month) for months in [span start, span end) within the calendar (Q4)."""
    return _clipped_span(periods, start_month, as_of).select(
        "customer_id", F.explode(F.sequence("lo", "hi", _month_step())).alias("date_month"))


def period_months(periods: DataFrame, start_month, as_of, bounds_only: bool = False) -> DataFrame:
    """Month starts m with start_date <= m < end_date (or open), within the calendar.

    ``bounds_only``: the first and last covered month per period, unexploded.
    """
    first = F.when(F.col("start_date") == F.trunc("start_date", "MM"), F.col("start_date")) \
             .otherwise(F.add_months(F.trunc("start_date", "MM"), 1))
    cal_lo, cal_hi = F.trunc(_date(start_month), "MM"), F.trunc(_date(as_of), "MM")
    last = F.coalesce(F.trunc(F.date_sub("end_date", 1), "MM"), cal_hi)
    lo = F.when(first.isNotNull(), F.greatest(first, cal_lo))   # no start: covers nothing
    hi = F.least(last, cal_hi)
    spans = (periods.select("customer_id", "monthly_amount", lo.alias("lo"), hi.alias("hi"))
                    .where(F.col("lo") <= F.col("hi")))
    if bounds_only:
        return spans
    return (spans.select("customer_id", "monthly_amount",
                           F.explode(F.sequence("lo", "hi", _month_step())).alias("date_month")))


def _active_spans(periods: DataFrame, start_month, as_of) -> DataFrame:
    """(customer_id, lo, hi, first_active_month, last_active_month, covered): one row per customer with months.

    ``covered`` counts the months of all its periods within the calendar.
    """
    # month ranges per customer: at most one per first month; the last paid one with it
    months = F.months_between("hi", "lo").cast("long") + 1
    ranges = (period_months(periods, start_month, as_of, bounds_only=True)
              .groupBy("customer_id", F.col("lo").alias("first_lo"))
              .agg(F.max(F.when(F.col("monthly_amount") > 0, F.col("hi"))).alias("paid_hi"), F.sum(months).alias("months")))
    reached = (F.col("first_lo") <= F.col("hi")) & F.col("paid_hi").isNotNull()
    return (_clipped_span(periods, start_month, as_of).join(ranges, "customer_id", "left")
            .groupBy("customer_id", "lo", "hi")
            .agg(F.min(F.when(reached, F.col("first_lo"))).alias("first_active_month"),
                 F.max(F.when(reached, F.least("paid_hi", "hi"))).alias("last_active_month"),
                 F.coalesce(F.sum("months"), F.lit(0)).alias("covered")))


def _monthly(spans: DataFrame, covered: DataFrame) -> DataFrame:
    """The months of ``spans`` with the covering amounts (0.0 for none) and the flags."""
    return spans.join(covered, ["customer_id", "date_month"], "left").withColumn(
        "mrr", F.coalesce(F.col("monthly_amount"), F.lit(0.0))).select(
        "date_month", "customer_id", "mrr", (F.col("mrr") > 0).alias("is_active"),
        "first_active_month", "last_active_month",
        F.col("first_active_month").eqNullSafe(F.col("date_month")).alias("is_first_month"),
        F.col("last_active_month").eqNullSafe(F.col("date_month")).alias("is_last_month"))


def _months_of(spans: DataFrame) -> DataFrame:
    return spans.select("customer_id", "first_active_month", "last_active_month",
                        F.explode(F.sequence("lo", "hi", _month_step())).alias("date_month"))


def mrr_monthly(periods: DataFrame, start_month, as_of) -> DataFrame:
    """Revenue per customer month with activity flags (Q5)."""
    return _monthly(_months_of(_active_spans(periods, start_month, as_of)), period_months(periods, start_month, as_of))


def _category() -> Column:
    return (F.when(F.col("is_first_month"), "new")
             .when(~F.col("is_active") & F.col("previous_month_is_active"), "churn")
             .when(F.col("is_active") & ~F.col("previous_month_is_active"), "reactivation")
             .when(F.col("mrr_change") > 0, "upgrade")
             .when(F.col("mrr_change") < 0, "downgrade"))


def mrr(periods: DataFrame, start_month, as_of) -> DataFrame:
    """MRR movements: new, churn, reactivation, upgrade, downgrade (Q6, Q7).

    The churn row (month after the last active month, worth 0.0) is emitted
    next to its source row, and each row's copy for the next month next to it,
    by one ``explode``: the union and ``lag`` of the SQL form in one shuffle on
    ``(customer_id, date_month)``.  Within a month rows go by carried first,
    churn row last, then amount (ties only arise when periods overlap).
    """
    def row(months: int, amount: Column, first: Column, last: Column, churn: int, own: int) -> Column:
        return F.struct(F.add_months("date_month", months).alias("date_month"), amount.alias("mrr"),
                        first.alias("is_first_month"), last.alias("is_last_month"),
                        F.lit(churn).alias("_churn"), F.lit(own).alias("_own"))

    no, none = F.lit(False), F.lit(0.0)
    value, first, last = F.col("mrr"), F.col("is_first_month"), F.col("is_last_month")
    plain = F.array(row(0, value, first, last, 0, 1), row(1, value, no, no, 0, 0))
    closing = F.array(row(0, value, first, last, 0, 1), row(1, value, no, no, 0, 0),
                      row(1, none, no, no, 1, 1), row(2, none, no, no, 1, 0))
    # customers' rows and months are counted before the months are made: tasks of
    # TASK_MONTHS months sort in memory at any size, where a fixed number would spill
    spans = materialize(_active_spans(periods, start_month, as_of), "active-spans")
    months = spans.agg(F.sum(F.months_between("hi", "lo") + 1 + F.col("covered"))).first()[0] or 0
    tasks = int(months // TASK_MONTHS) + 1
    cell = ["customer_id", "date_month"]
    monthly = _monthly(_months_of(spans).repartition(tasks, *cell),
                       period_months(periods, start_month, as_of).repartition(tasks, *cell))
    rows = monthly.select("customer_id", "first_active_month", "last_active_month",
                          F.inline(F.when(last, closing).otherwise(plain))).repartition(tasks, *cell)
    before = Window.partitionBy("customer_id", "date_month").orderBy("_own", "_churn", "mrr")
    return (rows
            .withColumn("previous_month_mrr", F.coalesce(F.lag("mrr").over(before), none))
            .where("_own = 1")
            .withColumn("is_active", F.col("mrr") > 0)
            .withColumn("previous_month_is_active", F.col("previous_month_mrr") > 0)
            .withColumn("mrr_change", F.col("mrr") - F.col("previous_month_mrr"))
            .withColumn("change_category", _category())
            .withColumn("renewal_amount", F.least("mrr", "previous_month_mrr"))
            .withColumn("id", F.md5(F.col("customer_id").cast("string")))
            .drop("_churn", "_own"))
