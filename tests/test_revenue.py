import datetime as dt

from ledgerlight.operators import revenue

D = dt.date
SCHEMA = "subscription_id long, customer_id long, start_date date, end_date date, monthly_amount double"


def _mrr(spark, rows, start="2020-01-01", as_of="2020-12-31"):
    periods = spark.createDataFrame(rows, SCHEMA)
    out = revenue.mrr(periods, start, as_of).collect()
    return sorted(out, key=lambda r: (r.customer_id, r.date_month, r.is_active is False and r.mrr == 0.0))


def test_new_upgrade_downgrade_churn_reactivation(spark):
    rows = [
        (1, 1, D(2020, 1, 1), D(2020, 3, 1), 10.0),
        (2, 1, D(2020, 3, 1), D(2020, 4, 1), 20.0),     # upgrade
        (3, 1, D(2020, 4, 1), D(2020, 5, 1), 15.0),     # downgrade
        (4, 1, D(2020, 7, 1), D(2020, 9, 1), 15.0),     # gap in May/June, back in July
    ]
    out = _mrr(spark, rows)
    cat = {(r.date_month, r.mrr): r.change_category for r in out}
    assert cat[(D(2020, 1, 1), 10.0)] == "new"
    assert cat[(D(2020, 3, 1), 20.0)] == "upgrade"
    assert cat[(D(2020, 4, 1), 15.0)] == "downgrade"
    assert cat[(D(2020, 5, 1), 0.0)] == "churn"
    assert cat[(D(2020, 7, 1), 15.0)] == "reactivation"
    # months run to the last end month (exclusive); churn row after the last active month
    assert max(r.date_month for r in out) == D(2020, 9, 1)
    churn_rows = [r for r in out if r.date_month == D(2020, 9, 1)]
    assert len(churn_rows) == 1 and churn_rows[0].change_category == "churn"


def test_mid_month_start_counts_from_next_month(spark):
    out = _mrr(spark, [(1, 5, D(2020, 2, 15), D(2020, 5, 1), 30.0)])
    active = [r.date_month for r in out if r.is_active]
    assert active == [D(2020, 3, 1), D(2020, 4, 1)]
    assert out[0].date_month == D(2020, 2, 1) and out[0].mrr == 0.0


def test_open_end_extends_to_latest_closed_end_only(spark):
    rows = [(1, 7, D(2020, 1, 1), D(2020, 3, 1), 10.0), (2, 7, D(2020, 3, 1), None, 12.0)]
    out = _mrr(spark, rows)
    assert [r.date_month for r in out if r.mrr > 0] == [D(2020, 1, 1), D(2020, 2, 1)]
    # all-open customers have no span end and vanish
    assert _mrr(spark, [(3, 8, D(2020, 1, 1), None, 5.0)]) == []


def test_churn_row_sorts_after_real_row_of_same_month(spark):
    # last active month Feb; the span runs to April so March has a real 0 row and the churn row
    rows = [(1, 9, D(2020, 1, 1), D(2020, 3, 1), 10.0), (2, 9, D(2020, 4, 1), D(2020, 5, 1), 0.0)]
    out = _mrr(spark, rows)
    march = [r for r in out if r.date_month == D(2020, 3, 1)]
    assert len(march) == 2
    assert {r.previous_month_mrr for r in march} == {10.0, 0.0}


def test_change_sums_to_mrr(spark):
    rows = [(1, 1, D(2020, 1, 1), D(2020, 3, 1), 10.0), (2, 1, D(2020, 3, 1), D(2020, 6, 1), 25.0)]
    running = 0.0
    for r in _mrr(spark, rows):
        running += r.mrr_change
        assert abs(running - r.mrr) < 1e-9


def test_calendar_and_customer_months(spark):
    cal = revenue.calendar(spark, "2019-11-15", "2020-02-03").collect()
    assert [r.date_month for r in cal] == [D(2019, 11, 1), D(2019, 12, 1), D(2020, 1, 1), D(2020, 2, 1)]
    periods = spark.createDataFrame([(1, 1, D(2019, 6, 1), D(2021, 1, 1), 1.0)], SCHEMA)
    months = revenue.customer_months(periods, "2020-01-01", "2020-03-31").collect()
    assert [r.date_month for r in months] == [D(2020, 1, 1), D(2020, 2, 1), D(2020, 3, 1)]


def test_tasks_grow_with_the_months_and_the_rows_stay(spark, monkeypatch):
    rows = [(1, 1, D(2020, 1, 1), D(2020, 3, 1), 10.0), (1, 1, D(2020, 2, 1), D(2020, 5, 1), 20.0),      # overlap
            (2, None, D(2020, 1, 1), D(2020, 6, 1), 10.0), (3, 2, D(2020, 3, 1), D(2020, 9, 1), 0.0),
            (4, 3, D(2020, 1, 1), None, 5.0), (5, 3, D(2020, 2, 1), D(2020, 12, 1), None)]
    rows += [(9 + c, 9 + c, D(2020, 1, 1), D(2020, 12, 1), 10.0 + c) for c in range(20)]
    periods = spark.createDataFrame(rows, SCHEMA)

    def run():
        df = revenue.mrr(periods, "2020-01-01", "2020-12-31")
        return df.rdd.getNumPartitions(), sorted(map(str, df.collect()))

    few, one = run()
    monkeypatch.setattr(revenue, "TASK_MONTHS", 10)
    many, two = run()
    assert few == 1 and many > 40                  # some 500 months of spans and periods
    assert one == two
    by_month = sorted((r.date_month, r.mrr, r.previous_month_mrr) for r in revenue.mrr(periods, "2020-01-01", "2020-12-31").collect() if r.customer_id == 1)
    assert by_month == [(D(2020, 1, 1), 10.0, 0.0), (D(2020, 2, 1), 10.0, 10.0), (D(2020, 2, 1), 20.0, 10.0),
                        (D(2020, 3, 1), 20.0, 20.0), (D(2020, 4, 1), 20.0, 20.0), (D(2020, 5, 1), 0.0, 20.0)]
