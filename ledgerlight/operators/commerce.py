"""Customer and order rollups (Q1, Q2).

Money arrives as integer cents.  Sums stay integral and are divided by 100
once, so totals are exact and independent of summation order.

Plan notes: each rollup is one hash aggregation with a map-side partial
aggregate, so a customer or order holding a large share of rows is reduced
before the shuffle.  Joins are on the aggregated (one row per key) sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The payment methods given their own column.
PAYMENT_TYPES = ["credit_card", "coupon", "bank_transfer", "gift_card"]


def _cents():
    return F.lit(100.0)


def customer_orders(orders: DataFrame) -> DataFrame:
    """First and latest order date and order count per customer (A1)."""
    return orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("most_recent_order"),
        F.count("order_id").alias("number_of_orders"),
    )


def order_cents(payments: DataFrame) -> DataFrame:
    """Paid cents per order: the largest table shrinks to one row per order
    (map-side partial sums) before it meets any join."""
    return payments.groupBy("order_id").agg(F.sum("amount").alias("cents"))


def customer_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Paid total per customer of the paid order.

    Payments whose order is unknown form one group with a NULL customer.
    Integer sums are exact, so summing per order first changes nothing.
    """
    paid = order_cents(payments).join(orders.select("order_id", "customer_id"), "order_id", "left")
    return paid.groupBy("customer_id").agg(
        (F.sum("cents") / _cents()).alias("total_amount"))


def customers(customers_: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Customer rollup with lifetime value (Q1).

    Equal to joining ``customer_orders`` and ``customer_payments`` to the
    customers (payments of unknown orders belong to no customer), computed
    with one pass over the orders: payments are summed per order, attached
    to their order, and order statistics and paid totals are aggregated per
    customer together.
    """
    per_order = orders.select("order_id", "customer_id", "order_date").join(
        order_cents(payments), "order_id", "left")
    per_customer = per_order.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("most_recent_order"),
        F.count("order_id").alias("number_of_orders"),
        (F.sum("cents") / _cents()).alias("customer_lifetime_value"))
    return customers_.join(per_customer, "customer_id", "left")


def _payment_sums(payments: DataFrame, in_cents: bool) -> DataFrame:
    """One pass: per-method sums and the total for each order."""
    aggs = []
    for m in PAYMENT_TYPES:
        hit = F.col("payment_method") == m
        if in_cents:
            # pivot semantics: NULL when the order has no payment of the method;
            # as DOUBLE (exact for whole cents) so the NULLs survive any client
            aggs.append(F.sum(F.when(hit, F.col("amount"))).cast("double").alias(f"{m}_amount"))
        else:
            aggs.append((F.sum(F.when(hit, F.col("amount")).otherwise(F.lit(0))) / _cents())
                        .alias(f"{m}_amount"))
    total = F.sum("amount")
    aggs.append((total if in_cents else total / _cents()).alias("total_amount"))
    return payments.groupBy("order_id").agg(*aggs)


def order_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with amount per payment method and total, in currency units (Q2).

    Every order is kept; an order without payments gets NULL amounts.  A
    method outside ``PAYMENT_TYPES`` counts only in ``amount``.
    """
    sums = _payment_sums(payments, in_cents=False).withColumnRenamed("total_amount", "amount")
    return orders.select("order_id", "customer_id", "order_date", "status").join(
        sums, "order_id", "left")


def order_payments_pivot(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """The pivot form: cents, NULL for an absent method, paid orders only.

    Written as conditional sums, which is what a pivot over a fixed value
    list is; it needs one aggregation where ``pivot`` + a separate total
    would need two plus a join.
    """
    sums = _payment_sums(payments.drop("payment_id"), in_cents=True)
    return sums.join(orders.select("order_id", "customer_id", "order_date", "status"), "order_id")
