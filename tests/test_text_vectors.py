import uuid

import numpy as np
from pyspark.sql import functions as F

from ledgerlight.functions.hashing import row_name, uuid5
from ledgerlight.operators import pruning, text, vectors


def test_uuid5_equals_python(spark):
    names = ["ab", "", "héllo wörld", "CommentTraining|label=1:1", "x" * 5000]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r.u for r in df.select(uuid5(F.col("name")).alias("u")).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


def test_row_name_is_unambiguous(spark):
    df = spark.createDataFrame([("a|b=1:c", "d"), ("a", "b=1:c|d")], "x string, y string")
    names = [r.n for r in df.select(row_name("C", ["x", "y"]).alias("n")).collect()]
    assert names[0] != names[1]


def test_cleaning_drops_blank_and_missing_and_newlines(spark):
    rows = [(1, "good\ntext\n", "1"), (2, " \t\n", "0"), (3, "fine", None), (4, "ok", " "), (5, "x", "1")]
    df = spark.createDataFrame(rows, "doc_id long, review_text string, label string")
    out = {r.doc_id: r for r in text.clean_training(df).collect()}
    assert set(out) == {1, 5}
    assert out[1].review_text == "goodtext"
    assert out[1].uuid != out[5].uuid and len(out[1].uuid) == 36


def test_import_twice_adds_nothing(spark):
    df = spark.createDataFrame([("a", "en"), ("a", "en"), ("b", "de")], "review_text string, lang string")
    objs = text.clean_objects(df, "review_text", "Document")
    empty = objs.limit(0)
    first = text.import_new_only(empty, objs)
    assert first.count() == 2                      # copies collapse to one object
    assert text.import_new_only(first, objs).count() == 0


def test_topk_own_vector_is_nearest(spark):
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(200, 16)).astype(np.float32)
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "id long, vector array<float>")
    queries = corpus.where(F.col("id") < 20).withColumnRenamed("id", "query_id")
    top = vectors.top_k_similar(queries, corpus, 3, "id").where("rank = 1").collect()
    assert sorted((r.query_id, r.id) for r in top) == [(i, i) for i in range(20)]
    assert all(abs(r.similarity - 1.0) < 1e-6 for r in top)


def test_text_search_finds_the_source_document(spark):
    docs = spark.createDataFrame(
        [(1, "the quick brown fox jumps"), (2, "lorem ipsum dolor sit amet"), (3, "spark joins and shuffles")],
        "doc_id long, text string")
    q = spark.createDataFrame([(10, "Dolor sit!"), (11, "shuffles, joins")], "item_id long, text string")
    best = {r.item_id: r.doc_id for r in vectors.search_text(q, docs, k=1).collect()}
    assert best == {10: 2, 11: 3}


def test_centroids(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [0.0, 1.0])], "label int, v array<float>")
    got = {r.query_id: list(r.vector) for r in vectors.centroids(df, "label", "v").collect()}
    assert got == {1: [2.0, 3.0], 2: [0.0, 1.0]}


def test_topk_in_tiles_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERY_TILE", 7)
    monkeypatch.setattr(vectors, "ROW_TILE", 5)
    rng = np.random.default_rng(5)
    rows = np.repeat(rng.integers(-2, 3, size=(30, 3)), 3, axis=0).astype(float)     # copies: many ties
    rows[[4, 17]] = 0
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)] + [(500, None)],
                                   "id long, vector array<double>")
    queries = corpus.withColumnRenamed("id", "query_id")
    got = sorted((r.query_id, r.rank, r.id, r.similarity) for r in vectors.top_k_similar(queries, corpus, 4, "id").collect())
    live = [i for i, v in enumerate(rows) if v.any()]
    unit = {i: rows[i] / np.linalg.norm(rows[i]) for i in live}
    want = []
    for q in live:
        best = sorted((-round(float(unit[q] @ unit[i]), 6), i) for i in live)[:4]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert all(abs(g[3] - w[3]) < 1e-6 for g, w in zip(got, sorted(want), strict=True))


def test_scores_of_a_document_are_summed_where_it_lies(spark):
    docs = spark.createDataFrame([(i, f"the word{i % 5} and word{i % 3}") for i in range(60)], "doc_id long, text string")
    found = vectors.search_text(docs.withColumnRenamed("doc_id", "item_id"), docs, k=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "item_id" in line and "doc_id" in line]
    assert found.count() == 120


def test_rows_of_a_hot_word_are_split(spark):
    docs = spark.createDataFrame([(i, f"the word{i}") for i in range(4000)], "doc_id long, text string")
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
           "spark.sql.adaptive.coalescePartitions.enabled": "false",
           "spark.sql.files.openCostInBytes": str(128 << 20)}     # a task per file: several writers to split between
    before = {key: spark.conf.get(key, None) for key in low}
    try:
        for key, value in low.items():
            spark.conf.set(key, value)
        weights, _, _ = vectors.text_vectors(docs)
        assert weights.count() == 8000
        weights.collect()
        assert "SortMergeJoin(skew=true)" in weights._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_tasks_grow_with_the_texts_and_the_rows_stay(spark, monkeypatch):
    rows = [(i, f"the and word{i % 40} word{i % 7} own{i}") for i in range(300)]
    docs = spark.createDataFrame([*rows, (3, "the other word3"), (None, "the null id"), (301, None), (302, "")], "doc_id long, text string")
    queries = docs.where("doc_id < 20").withColumnRenamed("doc_id", "item_id").dropDuplicates(["item_id"])

    def run():
        counts = vectors.term_counts(docs, "doc_id", "text").rdd.getNumPartitions()
        weights, _, _ = vectors.text_vectors(docs)
        best = sorted(map(str, vectors.search_text(queries, docs, k=2).collect()))
        return counts, weights.rdd.getNumPartitions(), sorted((str(r.doc_id), r.term, round(r.weight, 9)) for r in weights.collect()), best

    few = run()
    monkeypatch.setattr(vectors, "TASK_CHARS", 300)
    monkeypatch.setattr(vectors, "TASK_ROWS", 40)             # "the" and "and" have more rows than a task takes
    monkeypatch.setattr(pruning, "TASK_ROWS", 40)
    broadcast = run()
    monkeypatch.setattr(vectors, "FEW_TERMS", 0)
    sorted_ = run()
    assert few[0] <= 8 and few[1] <= 8
    assert all(x[0] > 16 and x[1] > 16 for x in (broadcast, sorted_))
    assert few[2:] == broadcast[2:] == sorted_[2:]
    assert len(few[2]) > 1200
