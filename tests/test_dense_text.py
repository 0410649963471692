"""Dense text vectors against a full SVD of the same TF-IDF rows."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from ledgerlight import jobs
from ledgerlight.operators import dense_text, vectors
from ledgerlight.operators.registry import Registry

FEATURES, R = 512, 8


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    topics = [["".join(rng.choices("abcdefgh", k=5)) for _ in range(12)] for _ in range(8)]
    noise = ["".join(rng.choices("qrstuv", k=5)) for _ in range(200)]
    texts = [" ".join(rng.choices(topics[k % 8], k=20) + rng.choices(noise, k=2)) for k in range(240)]
    rows = list(enumerate([*texts, None, "", "   "]))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def full(docs, model):
    """TF-IDF rows as a dense matrix, in the order of ids."""
    rows = dense_text._unit_rows(dense_text._counted(docs, "text", FEATURES), model.idf)
    return np.array([r.v for r in rows.select("doc_id", vector_to_array("_row").alias("v")).orderBy("doc_id").collect()])


def test_subspace_and_error_are_those_of_a_full_svd(docs):
    model = dense_text.fit(docs, dimensions=R, features=FEATURES)
    a = full(docs, model)
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(model.basis.T @ model.basis, np.eye(R), atol=1e-9)
    assert np.allclose(model.singular_values, s[:R], rtol=1e-4)
    cosines = np.linalg.svd(vt[:R] @ model.basis, compute_uv=False)      # of the principal angles
    assert cosines.min() > 0.9999
    best = np.linalg.norm(a - a @ vt[:R].T @ vt[:R])
    assert np.linalg.norm(a - a @ model.basis @ model.basis.T) < best * 1.0001


def test_vectors_are_the_projected_rows(docs):
    model = dense_text.fit(docs, dimensions=R, features=FEATURES)
    a = full(docs, model) @ model.basis
    got = {r.doc_id: np.array(r.vector) for r in dense_text.transform(model, docs).collect()}
    for k, row in enumerate(a):
        norm = np.linalg.norm(row)
        assert np.allclose(got[k], row / norm if norm > 1e-12 else 0.0, atol=1e-9)
    assert not any(got[k].any() for k in (240, 241, 242))


def test_partitions_do_not_change_the_vectors_and_texts_of_a_topic_are_near(docs):
    model = dense_text.fit(docs, dimensions=R, features=FEATURES)
    again = dense_text.fit(docs.repartition(7), dimensions=R, features=FEATURES)
    one = {r.doc_id: np.array(r.vector) for r in dense_text.transform(model, docs).collect()}
    two = {r.doc_id: np.array(r.vector) for r in dense_text.transform(again, docs).collect()}
    assert all(np.allclose(one[k], two[k], atol=1e-6) for k in one)
    objects = dense_text.transform(model, docs).select("doc_id", "vector")
    queries = objects.where("doc_id < 16").withColumnRenamed("doc_id", "query_id")
    hits = vectors.top_k_similar(queries, objects, 3, "doc_id").collect()
    assert len(hits) == 48 and all(r.doc_id % 8 == r.query_id % 8 for r in hits)


def test_fewer_rows_than_dimensions_and_no_rows(spark, docs):
    few = docs.where("doc_id < 3")
    model = dense_text.fit(few, dimensions=R, features=FEATURES)
    assert (model.singular_values[3:] < 1e-6).all() and not model.basis[:, 3:].any()
    none = dense_text.fit(docs.where("doc_id < 0"), dimensions=R, features=FEATURES)
    assert not any(any(r.vector) for r in dense_text.transform(none, few).collect())


def test_a_logged_model_gives_the_same_vectors(spark, docs, tmp_path):
    model = dense_text.fit(docs, dimensions=R, features=FEATURES)
    reg = Registry(spark, str(tmp_path))
    reg.log_model(model, "vectors", "1")
    loaded = reg.load_model(dense_text.DenseText, "vectors", "1")
    assert (loaded.basis == model.basis).all() and (loaded.singular_values == model.singular_values).all()
    one, two = ({r.doc_id: r.vector for r in dense_text.transform(m, docs).collect()} for m in (model, loaded))
    assert one == two


def test_a_model_is_logged_where_the_session_has_no_arrow_transfer(spark, tmp_path):
    values = np.arange(12.0).reshape(4, 3)
    counts = dense_text._counted(spark.createDataFrame([("a b",), ("b c",)], "text string"), "text", 4).select("_counts")
    idf = dense_text.IDF(inputCol="_counts", outputCol="_weights").fit(counts)
    before = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        dense_text.DenseText(idf, values, np.array([3.0, 2.0, 1.0])).write().save(str(tmp_path / "model"))
        loaded = dense_text.DenseText.load(str(tmp_path / "model"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", before)
    assert (loaded.basis == values).all() and loaded.singular_values.tolist() == [3.0, 2.0, 1.0]


def test_texts_are_counted_once_for_the_model_and_their_vectors(docs, monkeypatch):
    model = dense_text.fit(docs, dimensions=R, features=FEATURES)
    want = {r.doc_id: np.array(r.vector) for r in dense_text.transform(model, docs).collect()}
    counted, calls = dense_text._counted, []
    monkeypatch.setattr(dense_text, "_counted", lambda *given: calls.append(given) or counted(*given))
    again, rows = dense_text.fit_transform(docs, dimensions=R, features=FEATURES)
    got = {r.doc_id: np.array(r.vector) for r in rows.collect()}
    assert rows.columns == ["doc_id", "text", "vector"] and len(calls) == 1
    assert np.allclose(again.singular_values, model.singular_values, rtol=1e-9)
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-6) for k in want)
    none, empty = dense_text.fit_transform(docs.where("doc_id < 0"), dimensions=R, features=FEATURES)
    assert empty.collect() == [] and not none.basis.any()


def test_labelled_vectors_are_written_before_they_are_read_again(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "good fine text", "1"), (2, "bad poor\ntext", "0"), (3, " ", "1"), (4, "good", None)],
                                 "doc_id long, review_text string, label string")
    monkeypatch.setattr(jobs.fx, "stg_training", lambda spark, d: rows)
    dense, data = jobs.training_vectors(spark, "unused")
    assert sorted(r.label for r in data.collect()) == [0.0, 1.0] and data.columns == ["uuid", "features", "label"]
    assert "ArrowEvalPython" not in data._jdf.queryExecution().executedPlan().toString()
