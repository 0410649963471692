"""Least squares over one-hot categories and a scaled number from one aggregation (M5-M7).

The Gram matrix of one-hot columns is block-sparse: within a category it is the
count of each value, between two categories their cross-count.  All of it, with
the number's and the label's sums, is one grouped aggregation over grouping sets
of the categories, for the training and the test split at once; its partial sums
are taken by category cell before the shuffle.  The small system is solved once.

One-hot columns of a category add up to the constant column, so the system lacks
rank: columns and label are centred and the weights of least norm are taken.  R
squared of both splits comes from the same sums.

Rows with a null number or label are left out of the fit; a null or unseen value
of a category has no column and adds nothing.  Without training rows there is no
fit: predictions and R squared are null.  A split whose label doesn't vary has a
null R squared.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct category values at most: the system has so many rows and columns, and the driver holds it.
MAX_VALUES = 4096


@dataclass(frozen=True)
class Fit:
    weights: dict[str, dict[str, float]]      # category -> value -> weight
    number_weight: float | None               # per unit of the number divided by ``peak``
    peak: float
    intercept: float | None
    rows: dict[bool, int]                     # training split or not -> rows
    r2: dict[bool, float | None]


def cross_sums(data: DataFrame, categories: list[str], number: str, label: str, train: Column) -> DataFrame:
    """(is_train, categories..., in_<category>..., n and sums) over each category, each pair of them and all rows.

    ``in_<category>`` tells whether a row of the result is by that category; the others' columns are null.
    """
    x, y = F.col(number).cast("double"), F.col(label).cast("double")
    rows = data.where(x.isNotNull() & y.isNotNull()).select(train.alias("is_train"), *categories, x.alias("x"), y.alias("y"))
    cells = rows.groupBy("is_train", *categories).agg(
        F.count("*").alias("n"), F.sum("x").alias("x"), F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum("y").alias("y"),
        F.sum(F.col("x") * F.col("y")).alias("xy"), F.sum(F.col("y") * F.col("y")).alias("yy"), F.max(F.abs("x")).alias("peak"))
    sets = [["is_train", *some] for size in range(3) for some in combinations(categories, size)]
    sums = [F.sum(c).alias(c) for c in ("n", "x", "xx", "y", "xy", "yy")]
    return cells.groupingSets(sets, "is_train", *categories).agg(
        *[(F.grouping(c) == 0).alias(f"in_{c}") for c in categories], *sums, F.max("peak").alias("peak"))


def _system(rows: list, place: dict, categories: list[str], peak: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(Gram matrix, products with the label, label squared) of a split: values, number and constant as columns."""
    number, constant = len(place), len(place) + 1
    gram, product, squared = np.zeros((constant + 1, constant + 1)), np.zeros(constant + 1), 0.0
    for r in rows:
        at = [place.get((c, r[c])) for c in categories if r[f"in_{c}"]]
        if None in at:
            continue                                  # a value without a column
        if len(at) == 2:
            gram[at[0], at[1]] = gram[at[1], at[0]] = r["n"]
            continue
        i = at[0] if at else constant
        gram[i, i] = r["n"]
        gram[i, constant] = gram[constant, i] = r["n"]
        gram[i, number] = gram[number, i] = r["x"] / peak
        product[i] = r["y"]
        if not at:
            gram[number, number], product[number], squared = r["xx"] / peak ** 2, r["xy"] / peak, r["yy"]
    return gram, product, squared


def _r2(gram: np.ndarray, product: np.ndarray, squared: float, weights: np.ndarray) -> float | None:
    n, total = gram[-1, -1], product[-1]
    spread = squared - total * total / n if n else 0.0
    if spread <= 1e-12 * squared or not n:
        return None
    return float(1 - (squared - 2 * product @ weights + weights @ gram @ weights) / spread)


def fit(data: DataFrame, categories: list[str], number: str, label: str, train: Column) -> Fit:
    """One scan of ``data``; its distinct category values must be at most ``MAX_VALUES``."""
    return _solved(cross_sums(data, categories, number, label, train).toLocalIterator(), categories)


def _solved(table, categories: list[str]) -> Fit:
    splits: dict[bool, list] = {True: [], False: []}
    for r in table:
        splits[r["is_train"]].append(r)
        if len(splits[True]) + len(splits[False]) > 2 * MAX_VALUES ** 2:
            raise ValueError(f"more than {MAX_VALUES} category values: use the iterative solver (taxi.train)")
    single = [(c, r[c]) for r in splits[True] for c in categories
              if r[f"in_{c}"] and sum(r[f"in_{o}"] for o in categories) == 1 and r[c] is not None]
    if len(single) > MAX_VALUES:
        raise ValueError(f"{len(single)} category values, at most {MAX_VALUES}: use the iterative solver (taxi.train)")
    place = {key: i for i, key in enumerate(sorted(single))}
    whole = [r for r in splits[True] if not any(r[f"in_{c}"] for c in categories)]
    if not whole:
        return Fit({c: {} for c in categories}, None, 1.0, None, {True: 0, False: 0}, {True: None, False: None})
    peak = whole[0]["peak"] or 1.0
    gram, product, squared = _system(splits[True], place, categories, peak)
    n = gram[-1, -1]
    mean = gram[:-1, -1] / n
    centred = gram[:-1, :-1] - n * np.outer(mean, mean)
    w = np.linalg.pinv(centred, rcond=1e-10, hermitian=True) @ (product[:-1] - mean * product[-1])
    full = np.append(w, product[-1] / n - mean @ w)
    test = _system(splits[False], place, categories, peak)
    weights: dict[str, dict[str, float]] = {c: {} for c in categories}
    for (c, v), i in place.items():
        weights[c][v] = float(w[i])
    return Fit(weights, float(w[-1]), float(peak), float(full[-1]), {True: int(n), False: int(test[0][-1, -1])},
               {True: _r2(gram, product, squared, full), False: _r2(*test, full)})


def predict(model: Fit, data: DataFrame, number: str, output: str) -> DataFrame:
    """``data`` with the predicted label in ``output`` (null where the number is null)."""
    spark = data.sparkSession
    total = F.lit(model.intercept).cast("double") + F.lit(model.number_weight).cast("double") * (F.col(number).cast("double") / model.peak)
    for c, weights in model.weights.items():
        value, weight = f"_value_{c}", f"_weight_{c}"
        table = spark.createDataFrame(sorted(weights.items()), f"{value} string, {weight} double")
        # at most MAX_VALUES rows
        data = data.join(F.broadcast(table), F.col(c) == F.col(value), "left").drop(value)
        total = total + F.coalesce(F.col(weight), F.lit(0.0))
    return data.withColumn(output, total).drop(*[f"_weight_{c}" for c in model.weights])
