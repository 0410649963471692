"""Zero and null vectors in the search; sessions keep what is set already."""

from pyspark.sql import functions as F

from ledgerlight.operators.vectors import top_k_similar
from ledgerlight.session import build_session


def test_zero_and_null_vectors_are_similar_to_nothing(spark):
    rows = [(k, [float(k + 1), 1.0]) for k in range(7)]
    for zeros in (1, 3):
        corpus = spark.createDataFrame(rows + [(100 + z, [0.0, 0.0]) for z in range(zeros)] + [(200, None)], "id long, vector array<double>").coalesce(1)
        queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None)], "query_id long, vector array<double>")
        got = [(r.query_id, r.id) for r in top_k_similar(queries, corpus, 3, "id").orderBy("query_id", "rank").collect()]
        assert got == [(1, 6), (1, 5), (1, 4)]


def test_build_session_keeps_set_values(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        assert build_session().conf.get("spark.sql.session.timeZone") == "Europe/Paris"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert spark.range(1).select(F.lit(1)).count() == 1
