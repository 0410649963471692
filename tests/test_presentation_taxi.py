import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.functions.dates import seconds_between
from ledgerlight.operators import presentation
from ledgerlight.sources import catalog


def test_sentiment_fill_and_buckets(spark):
    calls = spark.createDataFrame([("1", 1.0), ("3", 0.5)], "customer_id string, sentiment double")
    comments = spark.createDataFrame([("1", 1.0), ("2", 0.0), ("2", 0.25)], "customer_id string, sentiment double")
    out = {r.customer_id: r for r in presentation.sentiment(calls, comments).collect()}
    assert set(out) == {"1", "2"}                    # calls-only customer 3 drops out
    assert out["1"].sentiment_score == 1.0 and out["1"].sentiment_bucket == 11
    assert out["2"].calls_sentiment == 0.0 and out["2"].sentiment_score == 0.0625
    assert out["2"].sentiment_bucket == 1


def test_like_prefix_is_literal(spark):
    df = spark.createDataFrame([("tmp__a",), ("tmpxya",), ("tmp__",)], "name string")
    got = sorted(r.name for r in df.where(presentation.like_literal_prefix("name", "tmp__")).collect())
    assert got == ["tmp__", "tmp__a"]


def test_rename_for_display(spark):
    df = spark.createDataFrame([(1, 2)], "customer_id long, relative_path long")
    assert presentation.rename_for_display(df).columns == ["CUSTOMER ID", "RELATIVE PATH"]


def test_seconds_count_boundaries_in_any_zone(spark):
    rows = [(dt.datetime(2024, 3, 10, 6, 59, 59, 900000), dt.datetime(2024, 3, 10, 7, 0, 1, 100000)),
            (dt.datetime(2024, 3, 10, 1, 30, 0), dt.datetime(2024, 3, 10, 3, 30, 0))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    ntz = df.schema["a"].dataType
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r.s for r in df.select(seconds_between("a", "b", ntz).alias("s")).collect()]
            assert got == [2, 7200]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_cleanup_drops_only_literal_prefix(spark):
    db = catalog.work_database(spark)
    base = spark.range(3)
    for name in ("tmp__one", "tmpxxtwo", "keep_me"):
        catalog.save_table(base, f"{db}.{name}")
    dropped = catalog.drop_tables_with_prefix(spark, db, "tmp__")
    left = {t.name for t in spark.catalog.listTables(db)}
    assert dropped == ["tmp__one"] and {"tmpxxtwo", "keep_me"} <= left and "tmp__one" not in left
