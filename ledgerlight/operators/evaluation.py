"""Area under the ROC curve, exact and distributed, with half credit for ties (M7, M9).

The area is the chance that a positive row scores above a negative one, equal
scores counting half.  Rows are first added up by score (ties collapse before
the shuffle); the distinct scores are dealt to range slices, and the negatives
below a score are those below it in its slice and those of earlier slices.  No
task sorts more than a slice, and all counts are whole numbers until the last
division.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.plans.lineage import cut_lineage


def auc(scored: DataFrame, by: list[str], label_col: str = "label", score_col: str = "score") -> DataFrame:
    """(by..., positives, negatives, auc) of each group of ``by`` columns (few groups; a group may hold all rows).

    ``label_col`` is 1 or 0; rows with a null label or score are left out.  The
    area of a group without positives or negatives is null.
    """
    n = max(int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    rows = scored.where(F.col(label_col).isNotNull() & F.col(score_col).isNotNull() & ~F.isnan(score_col))
    label = F.col(label_col).cast("int")
    per = rows.groupBy(*by, F.col(score_col).alias("_score")).agg(
        F.count_if(label == 1).alias("_pos"), F.count_if(label == 0).alias("_neg"))
    per = cut_lineage(per.repartitionByRange(n, *by, "_score").withColumn("_slice", F.spark_partition_id()))
    sums = per.groupBy(*by, "_slice").agg(F.sum("_neg").alias("_all"))
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*by, "_slice", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_before"))
    below = Window.partitionBy(*by, "_slice").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = per.withColumn("_below", F.coalesce(F.sum("_neg").over(below), F.lit(0))).join(sums, [*by, "_slice"])
    credit = F.col("_pos").cast("decimal(19,0)") * (2 * (F.col("_below") + F.col("_before")) + F.col("_neg")).cast("decimal(19,0)")
    out = ranked.groupBy(*by).agg(F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"), F.sum(credit).alias("_credit"))
    pairs = 2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return out.select(*by, "positives", "negatives", F.when(pairs > 0, F.col("_credit").cast("double") / pairs).alias("auc"))
