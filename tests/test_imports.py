"""Keyed imports into a target partitioned by id bucket, with a note of the last batch."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlight.plans.lineage import scratch_path
from ledgerlight.streaming import imports


def _objects(spark, ids):
    return spark.createDataFrame([(f"id{i}", f"text {i}") for i in ids], "uuid string, body string")


def _ids(spark, target):
    return sorted(int(r.uuid[2:]) for r in spark.read.parquet(target).collect())


def test_only_touched_folders_are_read(spark):
    target = scratch_path(spark, "import-target")
    imports.import_batch(_objects(spark, range(500)), target)
    one = _objects(spark, [7]).withColumn(imports.BUCKET, imports.bucket_of("uuid"))
    buckets = [r[0] for r in one.select(imports.BUCKET).collect()]
    held = imports.existing(spark, target, one.schema, buckets)
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and imports.BUCKET in plan.split("PartitionFilters: [")[1].split("]")[0]
    folders = {r[0] for r in held.select(F.input_file_name()).distinct().collect()}
    assert {f.split(f"{imports.BUCKET}=")[1].split("/")[0] for f in folders} == {str(buckets[0])}
    assert held.where("uuid = 'id7'").count() == 1


def test_batches_that_overlap_append_each_id_once(spark):
    target = scratch_path(spark, "import-target")
    imports.import_batch(_objects(spark, [*range(60), *range(60)]), target)
    imports.import_batch(_objects(spark, range(40, 100)), target)
    imports.import_batch(_objects(spark, []), target)
    assert _ids(spark, target) == list(range(100))


def test_a_noted_batch_is_skipped_and_another_streams_is_not(spark):
    target = scratch_path(spark, "import-target")
    assert imports.import_batch(_objects(spark, range(5)), target, stream="s", batch_id=0)
    assert not imports.import_batch(_objects(spark, range(5)), target, stream="s", batch_id=0)
    assert imports.import_batch(_objects(spark, range(3, 9)), target, stream="other", batch_id=0)
    assert imports.import_batch(_objects(spark, range(8, 12)), target, stream="s", batch_id=1)
    assert _ids(spark, target) == list(range(12))
    assert [f for f in os.listdir(f"{target}/_batches/s") if not f.startswith(".")] == ["1"]


def test_a_batch_appended_but_not_noted_appends_nothing_again(spark, monkeypatch):
    target = scratch_path(spark, "import-target")

    def fail(self):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(imports._Log, "note", fail)
        with pytest.raises(OSError):
            imports.import_batch(_objects(spark, range(20)), target, stream="s", batch_id=0)
    assert imports.import_batch(_objects(spark, range(20)), target, stream="s", batch_id=0)
    assert _ids(spark, target) == list(range(20))


def test_files_written_without_buckets_are_read(spark):
    target = scratch_path(spark, "import-target")
    _objects(spark, range(10)).write.parquet(target)
    rows = _objects(spark, range(5, 15)).withColumn(imports.BUCKET, imports.bucket_of("uuid"))
    held = imports.existing(spark, target, rows.schema, [0])
    assert held.count() == 10


def test_a_column_named_like_the_folders_is_refused(spark):
    with pytest.raises(ValueError):
        imports.import_batch(_objects(spark, [1]).withColumn(imports.BUCKET, F.lit(1)), "/nowhere")


def test_a_restarted_stream_keeps_its_id_and_notes_its_batches(spark):
    src, target, ckpt = (scratch_path(spark, f"stream-{n}") for n in ("src", "target", "ckpt"))
    schema = _objects(spark, []).schema
    for ids in (range(10), range(5, 20)):
        _objects(spark, ids).write.mode("append").parquet(src)
        imports.start_import(spark.readStream.schema(schema).parquet(src), target, ckpt).awaitTermination(120)
    assert _ids(spark, target) == list(range(20))
    streams = [f for f in os.listdir(f"{target}/_batches") if not f.startswith(".")]
    assert len(streams) == 1
    assert [f for f in os.listdir(f"{target}/_batches/{streams[0]}") if not f.startswith(".")] == ["1"]
