"""Idempotent object import as a micro-batch stream (S14 over Structured Streaming).

The reference imports objects in batches and skips ids the store already
holds.  ``start_import`` runs the same keyed import for a stream: each
micro-batch is reduced to objects whose id the target does not hold yet and
appended.

The target is partitioned by a hash bucket of the id, so a batch reads only the
ids of the folders its own ids fall in, not the whole target.  After the append
the batch is noted beside the target under its stream's id (which the stream's
checkpoint keeps); a batch that is noted is skipped unread when it is replayed.
A batch that was appended but not noted (the driver failed in between) runs
again, finds its ids present and appends nothing, so the sink stays exact.  One
import writes to a target at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlight.operators.text import import_new_only

#: Folders of a target, and the column that names them.
BUCKETS, BUCKET = 256, "import_bucket"
#: Spark's local property that holds the id of a stream, the same after each restart from its checkpoint.
STREAM_ID = "sql.streaming.queryId"


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS)).cast("int")


def existing(spark: SparkSession, target: str, schema, buckets: list[int]) -> DataFrame:
    """The target's rows in ``buckets``; rows of files without a bucket (written before there were any) as well."""
    try:
        held = spark.read.schema(schema).parquet(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        # first batch: nothing imported yet
        return spark.createDataFrame([], schema)
    return held.where(F.col(BUCKET).isin(buckets) | F.col(BUCKET).isNull())


def import_batch(batch: DataFrame, target: str, key: str = "uuid", stream: str | None = None,
                 batch_id: int | None = None) -> bool:
    """Append the batch's new objects; False if the batch of this stream was noted before, and so is skipped."""
    if BUCKET in {c.lower() for c in batch.columns}:
        raise ValueError(f"the batch has a column {BUCKET}, which names the target's folders")
    log = _Log(batch.sparkSession, target, stream, batch_id)
    if log.noted():
        return False
    rows = batch.withColumn(BUCKET, bucket_of(key))
    touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]     # at most BUCKETS
    held = existing(batch.sparkSession, target, rows.schema, touched)
    import_new_only(held, rows, key).write.mode("append").partitionBy(BUCKET).parquet(target)
    log.note()
    return True


class _Log:
    """The last appended batch of a stream, as an empty file that a reader of the target passes over."""

    def __init__(self, spark: SparkSession, target: str, stream: str | None, batch_id: int | None):
        self.known = stream is not None and batch_id is not None
        if self.known:
            self.batch_id, path = batch_id, spark._jvm.org.apache.hadoop.fs.Path
            self.at = lambda n: path(f"{target}/_batches/{stream}/{n}")
            self.files = self.at(batch_id).getFileSystem(spark._jsc.hadoopConfiguration())

    def noted(self) -> bool:
        return self.known and self.files.exists(self.at(self.batch_id))

    def note(self) -> None:
        if self.known:
            self.files.create(self.at(self.batch_id), True).close()
            # a stream replays its last batch only
            self.files.delete(self.at(self.batch_id - 1), False)


def start_import(stream: DataFrame, target: str, checkpoint: str, key: str = "uuid",
                 available_now: bool = True) -> StreamingQuery:
    def append(batch: DataFrame, batch_id: int) -> None:
        name = batch.sparkSession.sparkContext.getLocalProperty(STREAM_ID)
        import_batch(batch, target, key, name, batch_id)

    writer = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
