"""Shared-folder locations for lineage cuts and written intermediates.

On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
system every executor can reach).  Only a local session without one gets a
scratch folder; on a cluster a missing setting is an error, as executors do
not share machine-local folders.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediates."""
    sc = spark.sparkContext
    current = spark.conf.get(_CONF, None) or sc.getConf().get(_CONF, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    existing = sc.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError(f"{_CONF} must name a folder that all executors share")
    current = tempfile.mkdtemp(prefix="ledgerlight-ckpt-")
    sc.setCheckpointDir(current)
    try:
        spark.conf.set(_CONF, current)
    except Exception:  # core settings may be read-only at runtime
        pass
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    # without rows no partition is written that the schema could be read from
    written = (spark.read.schema(df.schema) if partition_by else spark.read).parquet(path)
    written.written_path = path
    return written


def tasks_for(amount: int, most: int) -> int:
    """Tasks that ``amount`` of work goes to, about ``most`` each."""
    return int(amount // most) + 1


def dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in ``tasks`` tasks, where these are more than the partitions that Spark would deal it to."""
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, *keys)


def discard(*written: DataFrame | None) -> None:
    """Remove the files of ``materialize`` results that no later step reads (None is passed over)."""
    for df in written:
        path = getattr(df, "written_path", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
