"""Area under ROC against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlight.operators.evaluation import auc


def brute(rows):
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    if not pos or not neg:
        return len(pos), len(neg), None
    return len(pos), len(neg), sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)


@pytest.mark.parametrize("values", [3, 50, 10**6])
def test_area_equals_all_pairs(spark, values):
    rng = random.Random(values)
    rows = [(g, rng.choice([0, 1, 1]), rng.randrange(values) / values) for g in ("a", "b") for _ in range(300)]
    rows += [("one side", 1, 0.5)] * 3 + [("a", None, 0.1), ("a", 1, None), ("a", 0, float("nan"))]
    got = auc(spark.createDataFrame(rows, "g string, label int, score double").repartition(5), ["g"]).collect()
    assert {r.g for r in got} == {"a", "b", "one side"}
    for r in got:
        p, n, area = brute([(y, s) for g, y, s in rows if g == r.g and y is not None and s is not None and s == s])
        assert (r.positives, r.negatives) == (p, n)
        assert r.auc is None if area is None else abs(r.auc - area) < 1e-12


def test_area_of_very_many_ties(spark):
    rows = spark.range(0, 200_000, 1, 4).select(F.lit(1).alias("g"), (F.col("id") % 2).alias("label"), F.when(F.col("id") % 10 < 9, 0.5).otherwise(F.col("id") / 2e5).alias("score"))
    r = auc(rows, ["g"]).first()
    assert (r.positives, r.negatives) == (100_000, 100_000) and 0.0 < r.auc < 1.0
    pandas = rows.toPandas()
    ranks = pandas["score"].rank()
    assert abs(r.auc - (ranks[pandas["label"] == 1].sum() - 100_000 * 100_001 / 2) / 1e10) < 1e-12


def test_area_of_no_rows(spark):
    assert auc(spark.createDataFrame([], "g string, label int, score double"), ["g"]).count() == 0
