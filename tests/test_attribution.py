import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlight.operators import attribution
from ledgerlight.plans.ordering import group_index

T = dt.datetime
SESSIONS = "session_id long, customer_id long, started_at timestamp_ntz, utm_medium string, utm_source string"
CONV = "customer_id long, converted_at timestamp_ntz, revenue double"


def _run(spark, sessions, conversions, days=30):
    s = spark.createDataFrame(sessions, SESSIONS)
    c = spark.createDataFrame(conversions, CONV)
    return attribution.attribution_touches(s, c, days).collect()


def test_one_two_three_sessions_and_edges(spark):
    conv_at = T(2024, 1, 31, 12, 0, 0)
    sessions = [
        (1, 1, T(2024, 1, 20), "a", "s"),                                  # one session
        (2, 2, T(2024, 1, 10), "a", "s"), (3, 2, T(2024, 1, 11), None, "s"),  # two
        (4, 3, conv_at - dt.timedelta(days=30), "a", "s"),                  # exactly on the lower end
        (5, 3, T(2024, 1, 15), "b", "s"),
        (6, 3, conv_at, "c", "s"),                                          # exactly at conversion
        (7, 3, conv_at - dt.timedelta(days=30, seconds=1), "x", "s"),       # just outside
        (8, 3, conv_at + dt.timedelta(seconds=1), "x", "s"),                # after conversion
    ]
    convs = [(c, conv_at, 100.0) for c in (1, 2, 3)]
    out = {r.session_id: r for r in _run(spark, sessions, convs)}
    assert set(out) == {1, 2, 3, 4, 5, 6}
    assert out[1].forty_twenty_forty_points == 1.0 and out[1].linear_points == 1.0
    assert out[2].forty_twenty_forty_points == 0.5 and out[3].last_touch_points == 1.0
    assert [out[i].session_index for i in (4, 5, 6)] == [1, 2, 3]
    assert [out[i].forty_twenty_forty_points for i in (4, 5, 6)] == [0.4, 0.2, 0.4]
    for cust in (1, 2, 3):
        rows = [r for r in out.values() if r.customer_id == cust]
        for col in ("first_touch_points", "last_touch_points", "forty_twenty_forty_points", "linear_points"):
            assert abs(sum(getattr(r, col) for r in rows) - 1.0) < 1e-12


def test_group_index_matches_window_on_a_hot_key(spark):
    rnd = random.Random(7)
    rows = [(i, 0 if i % 3 else rnd.randint(1, 50), rnd.randint(0, 10_000)) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, k long, t long")      # key 0 holds two thirds
    got = group_index(df, ["k"], [F.col("t"), F.col("id")], "idx", "n", slices=16)
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.withColumn("idx", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("k")))
    a = sorted((r.id, r.idx, r.n) for r in got.collect())
    b = sorted((r.id, r.idx, r.n) for r in want.collect())
    assert a == b


def test_revenue_by_medium_names_null_medium(spark):
    conv_at = T(2024, 1, 31)
    sessions = [(1, 1, T(2024, 1, 20), None, "s1"), (2, 1, T(2024, 1, 21), "web", "s2")]
    touches = attribution.attribution_touches(
        spark.createDataFrame(sessions, SESSIONS), spark.createDataFrame([(1, conv_at, 10.0)], CONV))
    piv = {r.source: r for r in attribution.revenue_by_medium(touches).collect()}
    assert float(piv["s1"]["NONE"]) == 10.0 and piv["s1"]["web"] is None
    spend = {r.medium: float(r.revenue) for r in attribution.ad_spend(touches).collect()}
    assert spend == {"web": 10.0}


def test_hot_customer_is_numbered_as_by_one_window(spark):
    rnd = random.Random(11)
    conv_at = T(2024, 1, 31, 12)
    sessions = [(i, 0 if i % 3 == 0 else rnd.randint(1, 40),
                 conv_at - dt.timedelta(seconds=rnd.randint(-86_400, 33 * 86_400) // 600 * 600), "a", "s")
                for i in range(3000)]                                 # a third on customer 0, many ties
    got = sorted((r.customer_id, r.session_index, r.session_id, r.total_sessions)
                 for r in _run(spark, sessions, [(c, conv_at, 1.0) for c in range(41)]))
    want = []
    for c in range(41):
        inside = sorted((at, i) for i, k, at, *_ in sessions
                        if k == c and conv_at - dt.timedelta(days=30) <= at <= conv_at)
        want += [(c, n + 1, i, len(inside)) for n, (_, i) in enumerate(inside)]
    assert got == sorted(want)
