from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml import Pipeline

from ledgerlight.operators.registry import Registry
from ledgerlight.plans.lineage import scratch_path


def test_log_set_metrics_and_load(spark):
    reg = Registry(spark, scratch_path(spark, "registry"))
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="v")]).fit(df)
    reg.log_model(model, "m", "urn:uuid:1", {"stage": "dev"})
    reg.set_metric("m", "urn:uuid:1", "score", 0.5)
    reg.set_metric("m", "urn:uuid:1", "score", 0.75)         # latest value wins
    reg.set_metric("m", "urn:uuid:1", "other", 1.0)
    got = {r.metric: r.value for r in reg.metrics("m", "urn:uuid:1").collect()}
    assert got == {"score": 0.75, "other": 1.0}
    entry = reg.entries().collect()[0]
    assert entry.tags == {"stage": "dev"}
    loaded = reg.load_model(PipelineModel, "m", "urn:uuid:1")
    assert loaded.transform(df).first().v.toArray().tolist() == [1.0, 2.0]
