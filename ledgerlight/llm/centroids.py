"""Exact centroid clustering with Ptolemaic pivots.

Vectors become integers, ``floor(1024 * x)`` by component, so that distances,
sums and centroids are exact and don't depend on partitions.  Centroids start
as the kept vectors of the least hashes; each round assigns every vector to its
nearest centroid (ties: the smaller number) and moves every non-empty centroid
to the floor of its vectors' mean.

Ptolemy's inequality bounds a distance from below by pivot distances: for a
pair of pivots p, s, ``d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s)``.
The pivots are the centroids after the first round (which has no bounds and
checks all), the farthest from each other where there are more than ``PIVOTS``:
a bound is tight where a centroid stays near a pivot.  The distances of the
vectors to the pivots never change: they are worked out once and written beside
the vectors.  A round works out only the centroids' distances to the pivots; a
task takes a vector's centroids in the order of their bounds, checks a candidate
exactly, and stops where the next bound is above the best distance so far.
Bounds are floating point and are rounded down by more than their error, so the
result is that of brute force.

A task folds its vectors to one sum and count a centroid; only those meet in
the shuffle and only ``k`` centroids reach the driver.

Rows without a vector, of another length, or with a null, NaN or infinite
component are left out, as are those with a component outside +-2^27 after
scaling (their squared distances need not fit a long).  Repeated rows count
each; a null id hashes last.  Fewer kept vectors than ``k`` are as many
centroids; none at all, an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.plans.lineage import materialize

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, "3"
#: Largest component in absolute value.
LIMIT = 1 << 27
PIVOTS = 16
#: Relative error allowed to products of distances, and to squares of bounds; both far above double rounding.
PRODUCT_SLACK, SQUARE_SLACK = 1e-14, 1e-12
#: Bounds (vectors times centroids) held at once.
TILE = 1 << 19


def kept(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, column: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows with a whole, finite vector, as integers."""
    wide = F.transform(F.col(column), lambda v: v.cast("double"))
    whole = F.forall(wide, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * scale) < LIMIT))
    return (vectors.where((F.size(column) == dimensions) & whole)
            .select("vec_id", F.transform(wide, lambda v: F.floor(v * scale).cast("int")).alias("x")))


def first_centroids(rows: DataFrame, k: int, seed: str) -> list[list[int]]:
    """Vectors of the ``k`` least hashes of ``seed:<vec_id>``, in their order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(key.alias("h"), "x").orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()
    return [list(r["x"]) for r in first]


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of two integer tables, row by row."""
    gap = x - y
    return np.einsum("ij,ij->i", gap, gap)


def spread(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of the sample at most, each the farthest from those before; none twice."""
    chosen = [0]
    near = squares(sample, sample[[0]])
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squares(sample, sample[[chosen[-1]]]))
    return sample[chosen]


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(squares(x, p[None, :])) for p in pivots], axis=1) if len(pivots) else np.zeros((len(x), 0))


def pivot_pairs(pivots: np.ndarray) -> list[tuple[int, int, float]]:
    """Neighbours in the order of choice, round about: (place, place, distance)."""
    n = len(pivots)
    pairs = {tuple(sorted((i, (i + step) % n))) for i in range(n) for step in (1, 2) if n > 1}
    gap = to_pivots(pivots, pivots)
    return [(i, j, float(gap[i, j])) for i, j in sorted(pairs) if i != j and gap[i, j] > 0]


def lower_bounds(near: np.ndarray, centroid_near: np.ndarray, pairs: list[tuple[int, int, float]]) -> np.ndarray:
    """Lower bounds of squared distances (vectors by centroids) from both sides' pivot distances."""
    bound = np.zeros((len(near), len(centroid_near)))
    for i, j, gap in pairs:
        a, b = near[:, i, None] * centroid_near[:, j], near[:, j, None] * centroid_near[:, i]
        np.maximum(bound, (np.abs(a - b) - PRODUCT_SLACK * (a + b)) / gap, out=bound)
    return bound * bound * (1 - SQUARE_SLACK)


def nearest(x: np.ndarray, near: np.ndarray, centroids: np.ndarray, pivots: np.ndarray,
            pairs: list[tuple[int, int, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centroid, squared distance, candidates checked exactly) of each vector."""
    k = len(centroids)
    which, best, checked = np.full(len(x), k), np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int32)
    centroid_near = to_pivots(centroids, pivots)
    step = max(1, TILE // k)
    for low in range(0, len(x), step):
        part = slice(low, low + step)
        bound = lower_bounds(near[part], centroid_near, pairs)
        order = np.argsort(bound, axis=1, kind="stable")
        at = np.arange(len(bound))
        for turn in range(k):
            candidate = order[at, turn]
            open_ = bound[at, candidate] <= best[low + at]
            at, candidate = at[open_], candidate[open_]
            if not len(at):
                break
            d = squares(x[low + at], centroids[candidate])
            checked[low + at] += 1
            wins = (d < best[low + at]) | ((d == best[low + at]) & (candidate < which[low + at]))
            best[low + at[wins]], which[low + at[wins]] = d[wins], candidate[wins]
    return which, best, checked


def _table(lists, width: int, kind) -> np.ndarray:
    """A list column as a table of ``width`` columns."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(lists), width)


def _sums(centroids: np.ndarray, pivots: np.ndarray, pairs: list):
    """A task's (cluster, n, sums) over all its vectors."""

    def fold(batches):
        k, width = centroids.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            x = _table(batch["x"], width, np.int64)
            which, _, _ = nearest(x, _table(batch["near"], len(pivots), float), centroids, pivots, pairs)
            count += np.bincount(which, minlength=k)
            for c in range(k):
                total[c] += x[which == c].sum(axis=0)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(at, pa.int32()), "n": pa.array(count[at], pa.int64()),
                                          "s": pa.array(total[at].tolist(), pa.list_(pa.int64()))})

    return fold


def _assign(centroids: np.ndarray, pivots: np.ndarray, pairs: list):
    def assign(x: pa.Array, near: pa.Array) -> pa.Array:
        which, best, checked = nearest(_table(x, centroids.shape[1], np.int64), _table(near, len(pivots), float), centroids, pivots, pairs)
        return pa.StructArray.from_arrays([pa.array(which, pa.int32()), pa.array(best, pa.int64()), pa.array(checked)],
                                          ["cluster", "distance", "checked"])

    return F.arrow_udf(assign, "struct<cluster:int,distance:bigint,checked:int>")("x", "near")


def with_pivots(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, x, near): the pivot distances of each vector, written once for all rounds."""

    def near(x: pa.Array) -> pa.Array:
        d = to_pivots(_table(x, pivots.shape[1], np.int64), pivots)
        offsets = np.arange(len(d) + 1, dtype=np.int32) * len(pivots)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(d.ravel()))

    return materialize(rows.withColumn("near", F.arrow_udf(near, "array<double>")("x")), "pivot-distances")


def _moved(cached: DataFrame, centroids: np.ndarray, pivots: np.ndarray, pairs: list) -> np.ndarray:
    """Centroids after one round."""
    parts = cached.select("x", "near").mapInArrow(_sums(centroids, pivots, pairs), "cluster int, n long, s array<long>")
    sums = (parts.select("cluster", "n", F.posexplode("s").alias("place", "s")).groupBy("cluster", "place")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    out = centroids.copy()
    for r in sums:
        out[r["cluster"], r["place"]] = r["s"] // r["n"]
    return out


def clusters(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
             scale: int = SCALE, seed: str = SEED, column: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, checked, cluster_inertia, inertia, centroid_sha256) of each kept vector.

    ``distance`` is squared; ``checked`` is the number of centroids compared exactly in the last assignment."""
    spark = vectors.sparkSession
    rows = kept(vectors, dimensions, scale, column)
    rows = materialize(rows, "vectors")
    centroids = np.array(first_centroids(rows, k, seed), np.int64).reshape(-1, dimensions)
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        none = spark.createDataFrame([], schema)
        return (rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"), F.lit(0).alias("checked"))
                .join(none, "cluster").select("vec_id", "cluster", "distance", "checked", "cluster_inertia", "inertia", "centroid_sha256"))
    pivots, pairs = np.zeros((0, dimensions), np.int64), []
    cached = rows.withColumn("near", F.array().cast("array<double>"))
    for turn in range(rounds):
        centroids = _moved(cached, centroids, pivots, pairs)
        if turn == 0:
            pivots = spread(centroids, PIVOTS)
            pairs = pivot_pairs(pivots)
            cached = with_pivots(rows, pivots)
    assigned = materialize(cached.select("vec_id", _assign(centroids, pivots, pairs).alias("a")).select("vec_id", "a.*"), "assigned")
    inertia = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(inertia.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per = spark.createDataFrame([(c, s, total, digest[c]) for c, s in sorted(inertia.items())], schema)
    return (assigned.join(F.broadcast(per), "cluster")      # at most k rows
            .select("vec_id", "cluster", "distance", "checked", "cluster_inertia", "inertia", "centroid_sha256"))
