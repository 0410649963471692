"""Model registry (M11): log a model with tags, set metrics, read them, load by version.

Two append-only Parquet tables under a shared root -- ``entries`` (name,
version, tags, path, created) and ``metrics`` (name, version, metric,
value, logged) -- and the fitted model saved with Spark ML persistence next
to them.  Appends never rewrite earlier files, so concurrent writers and
retried tasks cannot lose an entry; the latest value of a metric wins.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.plans.lineage import shared_dir

ENTRY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("version", T.StringType(), False),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("path", T.StringType(), False),
    T.StructField("created", T.TimestampType(), False),
])
METRIC_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("version", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("logged", T.TimestampType(), False),
])


class Registry:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or spark.conf.get("ledgerlight.registry.root", None)
                     or f"{shared_dir(spark)}/model_registry").rstrip("/")

    def _now(self):
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def log_model(self, model: MLWritable, name: str, version: str, tags: dict | None = None) -> str:
        path = f"{self.root}/models/{name}/{version.replace(':', '_')}"
        model.write().overwrite().save(path)
        row = [(name, version, dict(tags or {}), path, self._now())]
        self.spark.createDataFrame(row, ENTRY_SCHEMA).write.mode("append").parquet(f"{self.root}/entries")
        return path

    def set_metric(self, name: str, version: str, metric: str, value: float) -> None:
        row = [(name, version, metric, float(value), self._now())]
        self.spark.createDataFrame(row, METRIC_SCHEMA).write.mode("append").parquet(f"{self.root}/metrics")

    def entries(self) -> DataFrame:
        return self.spark.read.schema(ENTRY_SCHEMA).parquet(f"{self.root}/entries")

    def metrics(self, name: str, version: str) -> DataFrame:
        """Latest value of each metric of a model version."""
        m = (self.spark.read.schema(METRIC_SCHEMA).parquet(f"{self.root}/metrics")
             .where((F.col("name") == name) & (F.col("version") == version)))
        latest = Window.partitionBy("metric").orderBy(F.col("logged").desc(), F.col("value").desc())
        return (m.withColumn("_r", F.row_number().over(latest)).where("_r = 1")
                 .select("name", "version", "metric", "value"))

    def path_of(self, name: str, version: str) -> str:
        rows = (self.entries().where((F.col("name") == name) & (F.col("version") == version))
                .orderBy(F.col("created").desc(), F.col("path").desc()).select("path").limit(1).collect())
        if not rows:
            raise KeyError(f"{name} {version}")
        return rows[0][0]

    def load_model(self, loader, name: str, version: str):
        """``loader`` is the model class, e.g. ``PipelineModel``."""
        return loader.load(self.path_of(name, version))
