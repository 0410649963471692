from ledgerlight.operators import text
from ledgerlight.plans.lineage import scratch_path
from ledgerlight.streaming.imports import start_import


def test_stream_import_is_idempotent(spark):
    src = scratch_path(spark, "stream-src")
    df = spark.createDataFrame([("a", "en"), ("a", "en"), ("b", "de"), ("c", "fr")],
                               "review_text string, lang string")
    text.clean_objects(df, "review_text", "Document").write.parquet(src)
    target = scratch_path(spark, "stream-target")
    schema = spark.read.parquet(src).schema
    for _ in range(2):       # the second run replays everything from a fresh checkpoint
        q = start_import(spark.readStream.schema(schema).parquet(src), target,
                         scratch_path(spark, "stream-ckpt"))
        q.awaitTermination(120)
    assert spark.read.parquet(target).count() == 3
