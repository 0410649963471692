"""Randomised checks against brute force on small fixtures."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlight.operators import revenue
from ledgerlight.plans.ordering import group_index

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20)), min_size=1, max_size=300),
       st.integers(1, 9))
def test_group_index_equals_row_number(spark, rows, slices):
    data = [(i, k, t) for i, (k, t) in enumerate(rows)]        # ties on t are common
    df = spark.createDataFrame(data, "id long, k long, t long")
    got = group_index(df, ["k"], [F.col("t").desc(), F.col("id")], "idx", "n", slices=slices)
    w = Window.partitionBy("k").orderBy(F.col("t").desc(), F.col("id"))
    want = df.select("id", F.row_number().over(w).alias("idx"),
                     F.count("*").over(Window.partitionBy("k")).alias("n"))
    assert sorted((r.id, r.idx, r.n) for r in got.collect()) == \
        sorted((r.id, r.idx, r.n) for r in want.collect())


def _months(a: dt.date, b: dt.date):
    m = dt.date(a.year, a.month, 1)
    while m <= b:
        yield m
        m = dt.date(m.year + (m.month == 12), m.month % 12 + 1, 1)


def _add_month(m: dt.date) -> dt.date:
    return dt.date(m.year + (m.month == 12), m.month % 12 + 1, 1)


def brute_mrr(periods, start, end_month):
    out = []
    for cust in sorted({p[1] for p in periods}):
        ps = [p for p in periods if p[1] == cust]
        ends = [p[3] for p in ps if p[3] is not None]
        if not ends:
            continue
        lo = dt.date(min(p[2] for p in ps).year, min(p[2] for p in ps).month, 1)
        hi = dt.date(max(ends).year, max(ends).month, 1)
        rows = []
        for m in _months(max(lo, start), end_month):
            if m >= hi:
                break
            hits = [p for p in ps if m >= p[2] and (p[3] is None or m < p[3])]
            for amt in ([p[4] for p in hits] or [0.0]):
                rows.append([m, amt])
        active = [m for m, a in rows if a > 0]
        first, last = (min(active), max(active)) if active else (None, None)
        seq = [(m, 0, a, a > 0, m == first, m == last) for m, a in rows]
        seq += [(_add_month(m), 1, 0.0, False, False, False) for m, a in rows if m == last]
        seq.sort(key=lambda r: (r[0], r[1]))
        prev_a, prev_m = False, 0.0
        for m, _, amt, act, is_first, _is_last in seq:
            change = amt - prev_m
            if is_first:
                cat = "new"
            elif not act and prev_a:
                cat = "churn"
            elif act and not prev_a:
                cat = "reactivation"
            elif change > 0:
                cat = "upgrade"
            elif change < 0:
                cat = "downgrade"
            else:
                cat = None
            out.append((cust, m, amt, cat, min(amt, prev_m)))
            prev_a, prev_m = act, amt
    return sorted(out, key=lambda r: (r[0], r[1], r[2], str(r[3])))


@st.composite
def periods_strategy(draw):
    rows, sid = [], 0
    for cust in range(draw(st.integers(1, 4))):
        day = dt.date(2020, 1, 1) + dt.timedelta(days=draw(st.integers(0, 60)))
        for i in range(draw(st.integers(1, 4))):
            length = draw(st.integers(1, 120))
            end = day + dt.timedelta(days=length)
            is_last = i == 3
            open_end = draw(st.booleans()) and is_last
            rows.append((sid, cust, day, None if open_end else end, float(draw(st.sampled_from([0, 10, 20, 35])))))
            sid += 1
            day = end + dt.timedelta(days=draw(st.integers(0, 70)))
    return rows


@SETTINGS
@given(periods_strategy())
def test_mrr_equals_brute_force(spark, periods):
    start, end_month = dt.date(2020, 1, 1), dt.date(2021, 12, 1)
    df = spark.createDataFrame(periods, revenue_schema())
    want = brute_mrr(periods, start, end_month)
    got = sorted(((r.customer_id, r.date_month, r.mrr, r.change_category, r.renewal_amount)
                  for r in revenue.mrr(df, "2020-01-01", "2021-12-31").collect()),
                 key=lambda r: (r[0], r[1], r[2], str(r[3])))
    assert got == want


def revenue_schema():
    return "subscription_id long, customer_id long, start_date date, end_date date, monthly_amount double"
