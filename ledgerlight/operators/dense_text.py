"""Dense text vectors by a distributed randomized SVD (V7, input of V4 and M9).

A text becomes a unit TF-IDF row over ``FEATURES`` hashed terms, and its dense
vector is that row projected onto the leading right singular vectors of all
rows.  They are found by a randomized range finder:

1. start from a seeded random matrix of ``dimensions + OVERSAMPLE`` columns;
2. a pass over the rows A forms ``A^T (A Z)``: a task multiplies its rows by the
   current matrix and folds the products into one partial sum, and Spark adds
   the partial sums by term; ``POWER`` further passes sharpen the subspace, with
   an orthonormal basis (QR of the summed matrix) taken between passes;
3. a last pass sums the small Gram matrix of the projected rows, whose
   eigenvectors turn the basis into singular vectors, largest first.

What a task holds and what reaches the driver is ``FEATURES`` times the columns,
at any number of texts and of different terms; rows are read as written sparse
vectors, once a pass, and shuffled in none.  The vector of a text depends on the
text and the fitted model only, so queries and later texts use the same model.

Null and empty texts have the zero vector, which is similar to nothing.  With
fewer independent rows than ``dimensions`` the last components are zero.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import IDF, HashingTF, IDFModel, Normalizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.functions.text import tokens
from ledgerlight.plans.lineage import discard, materialize

DIMENSIONS, OVERSAMPLE, POWER = 64, 16, 2
FEATURES, SEED = 1 << 15, 7


@dataclass
class DenseText:
    """A fitted model: inverse document frequencies, singular vectors (terms by dimensions) and singular values."""

    idf: IDFModel
    basis: np.ndarray
    singular_values: np.ndarray

    def write(self) -> Writer:
        return Writer(self)

    @staticmethod
    def load(path: str) -> DenseText:
        """A model written by ``write().save(path)``."""
        spark = SparkSession.getActiveSession()
        rows = spark.read.parquet(f"{path}/basis").orderBy("term").collect()
        values = spark.read.parquet(f"{path}/singular_values").orderBy("place").collect()
        return DenseText(IDFModel.load(f"{path}/idf"), np.array([r["v"] for r in rows]), np.array([r["value"] for r in values]))


class Writer:
    """Saves a model as the registry saves Spark's own: the frequencies, a row for each term, the singular values."""

    def __init__(self, model: DenseText):
        self.model = model

    def overwrite(self) -> Writer:
        return self

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.model.idf.write().overwrite().save(f"{path}/idf")
        basis = np.ascontiguousarray(self.model.basis, dtype=np.float64)
        vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(basis) + 1, dtype=np.int32) * basis.shape[1]), pa.array(basis.ravel()))
        # Arrow tables: rows of a pandas frame are refused where the session has no Arrow transfer
        spark.createDataFrame(pa.table({"term": np.arange(len(basis)), "v": vectors}), "term long, v array<double>") \
            .write.mode("overwrite").parquet(f"{path}/basis")
        values = np.asarray(self.model.singular_values, dtype=np.float64)
        spark.createDataFrame(pa.table({"place": np.arange(len(values)), "value": values}), "place long, value double") \
            .write.mode("overwrite").parquet(f"{path}/singular_values")


def _counted(df: DataFrame, text_col: str, features: int) -> DataFrame:
    words = df.withColumn("_tokens", tokens(F.coalesce(F.col(text_col), F.lit(""))))
    return HashingTF(numFeatures=features, inputCol="_tokens", outputCol="_counts").transform(words).drop("_tokens")


def _unit_rows(counted: DataFrame, idf: IDFModel) -> DataFrame:
    weighted = idf.transform(counted).drop("_counts")
    return Normalizer(inputCol="_weights", outputCol="_row").transform(weighted).drop("_weights")


def _functions():
    """The numpy steps of the tasks, as closures that pickle by value."""

    def sparse(rows):
        """(offsets, terms, weights) of a column of sparse vectors."""
        import numpy as np
        terms, weights = rows.field("indices"), rows.field("values")
        offsets = terms.offsets.to_numpy().astype(np.int64)
        return offsets - offsets[0], terms.flatten().to_numpy().astype(np.int64), weights.flatten().to_numpy()

    def projected(offsets, terms, weights, basis):
        """Rows times ``basis``: a product of a row's weights and its terms' rows of ``basis`` at a time, which stay in cache."""
        import numpy as np
        out = np.zeros((len(offsets) - 1, basis.shape[1]))
        bounds = offsets.tolist()
        for i in np.flatnonzero(np.diff(offsets)).tolist():
            a, b = bounds[i], bounds[i + 1]
            np.dot(weights[a:b], basis.take(terms[a:b], axis=0), out=out[i])
        return out

    def pulled_back(offsets, terms, weights, y, total):
        """Add the transposed rows times ``y`` to ``total``; a row has a term once."""
        import numpy as np
        bounds = offsets.tolist()
        for i in np.flatnonzero(np.diff(offsets)).tolist():
            a, b = bounds[i], bounds[i + 1]
            own = terms[a:b]
            sums = total.take(own, axis=0)
            sums += weights[a:b, None] * y[i]
            total[own] = sums

    def emit(total):
        """The rows of a task's sum that hold anything."""
        import numpy as np
        import pyarrow as pa
        at = np.flatnonzero(total.any(axis=1))
        offsets = np.arange(len(at) + 1, dtype=np.int32) * total.shape[1]
        vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(total[at].ravel()))
        return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), vectors], ["key", "v"])

    return sparse, projected, pulled_back, emit


def _table(rows: DataFrame, fold, keys: int, width: int) -> np.ndarray:
    """The (key, vector) rows of all tasks added up by key."""
    parts = rows.select("_row").mapInArrow(fold, "key int, v array<double>")
    sums = parts.groupBy("key").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(width)]).alias("v")).toArrow()
    out = np.zeros((keys, width))
    if sums.num_rows:
        out[sums["key"].to_numpy()] = sums["v"].combine_chunks().flatten().to_numpy().reshape(-1, width)
    return out


def _power_step(rows: DataFrame, z: np.ndarray) -> np.ndarray:
    """A^T (A z) over all rows."""
    shipped = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(z))
    sparse, projected, pulled_back, emit = _functions()
    shape = z.shape

    def fold(batches):
        import numpy as np
        total = np.zeros(shape)
        for batch in batches:
            row = sparse(batch.column(0))
            pulled_back(*row, projected(*row, shipped.value), total)
        yield emit(total)

    out = _table(rows, fold, *shape)
    shipped.destroy()
    return out


def _gram(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """(A q)^T (A q) over all rows."""
    shipped = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(q))
    sparse, projected, _, emit = _functions()
    width = q.shape[1]

    def fold(batches):
        import numpy as np
        total = np.zeros((width, width))
        for batch in batches:
            y = projected(*sparse(batch.column(0)), shipped.value)
            total += y.T @ y
        yield emit(total)

    out = _table(rows, fold, width, width)
    shipped.destroy()
    return out


def fit(docs: DataFrame, text_col: str = "text", dimensions: int = DIMENSIONS, oversample: int = OVERSAMPLE,
        power: int = POWER, features: int = FEATURES, seed: int = SEED) -> DenseText:
    """The model of the rows of ``docs``."""
    return _fit(docs.select(text_col), text_col, dimensions, oversample, power, features, seed)[0]


def fit_transform(docs: DataFrame, text_col: str = "text", out_col: str = "vector", dimensions: int = DIMENSIONS,
                  oversample: int = OVERSAMPLE, power: int = POWER, features: int = FEATURES, seed: int = SEED) -> tuple[DenseText, DataFrame]:
    """``fit`` and ``transform`` of the same ``docs``: their texts are split and counted once, beside their columns."""
    model, rows = _fit(docs, text_col, dimensions, oversample, power, features, seed)
    return model, _projected(model, rows, out_col).select(*docs.columns, out_col)


def _fit(docs: DataFrame, text_col: str, dimensions: int, oversample: int, power: int, features: int,
         seed: int) -> tuple[DenseText, DataFrame]:
    """(the model, ``docs`` with their unit TF-IDF rows, written)."""
    written = materialize(_counted(docs, text_col, features), "term-counts")
    counted = written.select("_counts")
    if counted.isEmpty():                # one empty text: no term has a weight
        counted = _counted(docs.sparkSession.createDataFrame([("",)], f"`{text_col}` string"), text_col, features).select("_counts")
    idf = IDF(inputCol="_counts", outputCol="_weights").fit(counted)
    rows = materialize(_unit_rows(written, idf), "tfidf-rows")
    discard(written)
    z = np.random.default_rng(seed).standard_normal((features, min(dimensions + oversample, features)))
    for _ in range(1 + power):
        z = np.linalg.qr(_power_step(rows, z))[0]
    values, vectors = np.linalg.eigh(_gram(rows, z))
    order = np.argsort(values)[::-1][:dimensions]
    singular = np.sqrt(np.maximum(values[order], 0.0))
    basis = z @ vectors[:, order]
    basis *= np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])])     # a vector's largest component is positive
    basis[:, singular <= 1e-9 * max(singular.max(initial=0.0), 1e-300)] = 0.0
    return DenseText(idf, basis, singular), rows


def transform(model: DenseText, df: DataFrame, text_col: str = "text", out_col: str = "vector") -> DataFrame:
    """``df`` with the dense unit vector of each text (zeros where a text has no known direction)."""
    return _projected(model, _unit_rows(_counted(df, text_col, model.basis.shape[0]), model.idf), out_col)


def _projected(model: DenseText, rows: DataFrame, out_col: str) -> DataFrame:
    """``rows`` with the dense unit vector of their unit TF-IDF row, in place of that."""
    shipped = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.basis))
    sparse, projected, _, _ = _functions()
    ready = {}

    def vector(column: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa
        if "basis" not in ready:
            ready["basis"] = shipped.value
        y = projected(*sparse(column), ready["basis"])
        norm = np.linalg.norm(y, axis=1, keepdims=True)
        y = y / np.where(norm > 1e-12, norm, 1.0) * (norm > 1e-12)
        offsets = np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(y.ravel()))

    return rows.withColumn(out_col, F.arrow_udf(vector, "array<double>")("_row")).drop("_row")
