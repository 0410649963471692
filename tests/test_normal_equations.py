"""The one-pass regression against a least-squares fit of the full design matrix."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import normal_equations, taxi

SCHEMA = "id long, a string, b string, c string, x double, y double, tr boolean"
CATS = ["a", "b", "c"]


def _rows(n=400, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c, x = rnd.choice("pqrs"), rnd.choice("uvw"), str(rnd.randint(0, 5)), rnd.uniform(-3, 9)
        rows.append((i, a, b, c, x, 40 * x + 7 * ord(a) - 11 * int(c) + rnd.gauss(0, 5), rnd.random() < 0.7))
    rows += [(1000, "new", "u", "1", 2.0, 50.0, False), (1001, None, "u", "1", 2.0, 30.0, True),
             (1002, "p", "v", "2", None, 9.0, True), (1003, "p", "v", "2", 1.0, None, True)]
    return rows + rows[:40]                                     # repeated rows count again


def _brute(rows):
    """Predictions by numpy's least squares on centred columns (least norm) and R squared by split."""
    used = [r for r in rows if r[4] is not None and r[5] is not None]
    train = [r for r in used if r[6]]
    columns = sorted({(k, r[1 + k]) for r in train for k in range(3) if r[1 + k] is not None})
    peak = max(abs(r[4]) for r in train)
    design = lambda rs: np.array([[float(r[1 + k] == v) for k, v in columns] + [r[4] / peak] for r in rs])
    x, y = design(train), np.array([r[5] for r in train])
    w = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=1e-10)[0]
    b = y.mean() - x.mean(0) @ w
    r2 = {}
    for flag in (True, False):
        part = [r for r in used if r[6] == flag]
        t, p = np.array([r[5] for r in part]), design(part) @ w + b
        r2[flag] = 1 - ((t - p) ** 2).sum() / ((t - t.mean()) ** 2).sum()
    return {r[0]: float((design([r]) @ w + b)[0]) for r in rows if r[4] is not None}, r2


def test_equals_least_squares_of_the_design_matrix(spark):
    rows = _rows()
    data = spark.createDataFrame(rows, SCHEMA)
    model = normal_equations.fit(data, CATS, "x", "y", F.col("tr"))
    want, r2 = _brute(rows)
    got = {r.id: r.p for r in normal_equations.predict(model, data, "x", "p").collect()}
    assert got.pop(1002) is None
    assert got == pytest.approx(want, abs=1e-6)
    assert model.r2 == pytest.approx(r2, abs=1e-9)


def test_residuals_are_orthogonal_to_every_column(spark):
    data = spark.createDataFrame(_rows(), SCHEMA).where("a IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL")
    model = normal_equations.fit(data, CATS, "x", "y", F.col("tr"))
    gap = normal_equations.predict(model, data.where("tr"), "x", "p").withColumn("gap", F.col("y") - F.col("p"))
    assert abs(gap.agg(F.sum(F.col("gap") * F.col("x"))).first()[0]) < 1e-6
    for c in CATS:
        assert all(abs(r.s) < 1e-6 for r in gap.groupBy(c).agg(F.sum("gap").alias("s")).collect())


def test_no_training_rows_and_a_constant_label(spark):
    data = spark.createDataFrame([(1, "p", "u", "1", 2.0, 5.0, False)], SCHEMA)
    for rows in (data, data.limit(0)):
        model = normal_equations.fit(rows, CATS, "x", "y", F.col("tr"))
        assert model.intercept is None and model.r2 == {True: None, False: None}
        assert all(r.p is None for r in normal_equations.predict(model, rows, "x", "p").collect())
    flat = data.withColumn("tr", F.lit(True))
    model = normal_equations.fit(flat, CATS, "x", "y", F.col("tr"))
    assert model.r2[True] is None
    assert normal_equations.predict(model, flat, "x", "p").first().p == pytest.approx(5.0)


def test_too_many_values_raise(spark, monkeypatch):
    monkeypatch.setattr(normal_equations, "MAX_VALUES", 5)
    with pytest.raises(ValueError, match="category values"):
        normal_equations.fit(spark.createDataFrame(_rows(), SCHEMA), CATS, "x", "y", F.col("tr"))


def test_agrees_with_the_spark_ml_pipeline(spark):
    from ledgerlight.sources import fixtures as fx
    features = taxi.transform(fx.stg_taxi(spark, "/root/testdata/sf0.001"))
    pipeline, metrics = taxi.train(features)
    model = taxi.fit_sums(features)
    assert model.r2[True] == pytest.approx(metrics["train_score"], abs=1e-6)
    assert model.r2[False] == pytest.approx(metrics["test_score"], abs=1e-3)
