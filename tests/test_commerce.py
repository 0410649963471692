import datetime as dt

from ledgerlight.operators import commerce

D = dt.date


def _frames(spark):
    customers = spark.createDataFrame(
        [(1, "Ann", "A"), (2, "Bob", "B"), (3, "Cy", "C")], "customer_id long, first_name string, last_name string")
    orders = spark.createDataFrame(
        [(10, 1, D(2020, 1, 5), "F"), (11, 1, D(2020, 3, 1), "O"), (12, 2, D(2021, 6, 1), "F")],
        "order_id long, customer_id long, order_date date, status string")
    payments = spark.createDataFrame(
        [(1, 10, "credit_card", 1000), (2, 10, "coupon", 250), (3, 11, "other", 199),
         (4, 99, "gift_card", 500)],          # order 99 does not exist; order 12 has no payment
        "payment_id long, order_id long, payment_method string, amount long")
    return customers, orders, payments


def test_customer_rollup_keeps_everyone(spark):
    c, o, p = _frames(spark)
    rows = {r.customer_id: r for r in commerce.customers(c, o, p).collect()}
    assert rows[1].number_of_orders == 2 and rows[1].first_order == D(2020, 1, 5)
    assert rows[1].customer_lifetime_value == 14.49
    assert rows[2].number_of_orders == 1 and rows[2].customer_lifetime_value is None
    assert rows[3].number_of_orders is None and rows[3].first_order is None


def test_orphan_payment_forms_null_group(spark):
    _, o, p = _frames(spark)
    rows = {r.customer_id: r.total_amount for r in commerce.customer_payments(p, o).collect()}
    assert rows[None] == 5.0 and rows[1] == 14.49


def test_order_payments_sql_form(spark):
    _, o, p = _frames(spark)
    rows = {r.order_id: r for r in commerce.order_payments(o, p).collect()}
    assert set(rows) == {10, 11, 12}
    assert rows[10].credit_card_amount == 10.0 and rows[10].coupon_amount == 2.5
    assert rows[10].gift_card_amount == 0.0 and rows[10].amount == 12.5
    # a method outside the list only counts in the total
    assert rows[11].credit_card_amount == 0.0 and rows[11].amount == 1.99
    assert rows[12].amount is None


def test_order_payments_pivot_form(spark):
    _, o, p = _frames(spark)
    rows = {r.order_id: r for r in commerce.order_payments_pivot(o, p).collect()}
    assert set(rows) == {10, 11}              # paid orders that exist
    assert rows[10].credit_card_amount == 1000 and rows[10].gift_card_amount is None
    assert rows[10].total_amount == 1250
    for r in rows.values():
        parts = [r.credit_card_amount, r.coupon_amount, r.bank_transfer_amount, r.gift_card_amount]
        assert sum(x or 0 for x in parts) <= r.total_amount
