"""Row numbers inside groups that may be hot.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one task.
When one key may hold a large share of all rows (one customer with a third
of all sessions), that task becomes the job.  ``group_index`` gives the same
``row_number`` and group ``count`` without that bottleneck:

1. range-partition the rows by ``(keys, order)`` and sort each slice; the
   sampled bounds split a hot key over many slices, each a contiguous run
   of the global order;
2. ``monotonically_increasing_id`` numbers the rows of a slice in that order;
3. per (key, slice): first position and row count (a small aggregate), and
   rows of the key in earlier slices (a running sum over at most one row per
   slice);
4. join back: ``index = position - first + 1 + earlier``.

Full-data shuffles: the range exchange and the join back.  The order must be
total (end it with a unique column), as with any deterministic ``row_number``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.plans.lineage import cut_lineage


def _slices(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return max(int(conf), 1)


def group_index(df: DataFrame, keys: list[str], order: list[Column],
                index_col: str, count_col: str | None = None,
                slices: int | None = None) -> DataFrame:
    n = slices or _slices(df)
    order_exprs = list(order)
    ranged = (df.repartitionByRange(n, *[F.col(k) for k in keys], *order_exprs)
                .sortWithinPartitions(*[F.col(k) for k in keys], *order_exprs)
                .withColumn("_slice", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()))
    # The numbered slices feed two branches (sizes and the join back).  Range
    # bounds come from sampling, so two evaluations could slice differently;
    # a reliable checkpoint in the shared folder fixes one slicing for both
    # and also bounds recomputation after an executor loss.
    ranged = cut_lineage(ranged)

    sizes = ranged.groupBy(*keys, "_slice").agg(F.min("_pos").alias("_first"),
                                                F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if count_col:
        offsets = offsets.withColumn(count_col, F.sum("_n").over(Window.partitionBy(*keys)))
    offsets = offsets.drop("_n")

    index = F.col("_pos") - F.col("_first") + F.lit(1) + F.col("_offset")
    return (ranged.join(offsets, [*keys, "_slice"], "inner")
                  .withColumn(index_col, index.cast("long"))
                  .drop("_slice", "_pos", "_first", "_offset"))


def running_before(df: DataFrame, keys: list[str], order: list[Column], value: Column, out: str,
                   slices: int | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same keys that come earlier (0 for the first).

    As ``group_index``, with sums in place of counts: a hot key spreads over
    the slices.  Rows equal in keys and order share a slice.
    """
    n = slices or _slices(df)
    by = [F.col(k) for k in keys]
    ranged = (df.withColumn("_value", value).repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order)
                .withColumn("_slice", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)              # sampled bounds: one slicing for both branches
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*keys, "_slice").agg(F.sum("_value").alias("_sum"))
               .select(*keys, "_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")))
    inside = Window.partitionBy(*keys, "_slice").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
                  .join(offsets, [*keys, "_slice"]).withColumn(out, F.col("_offset") + F.col("_inside"))
                  .drop("_slice", "_pos", "_value", "_inside", "_offset"))
