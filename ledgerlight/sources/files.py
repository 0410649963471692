"""File sources and sinks.

* CSV is read with an explicit schema (no inference pass); several files,
  or a whole directory of part files, become one DataFrame in one read.
* A directory of binary files is listed with the ``binaryFile`` source
  without its ``content`` column, so only file metadata is read.
* Texts are packed into files of a bounded size, whose names follow from the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlight.plans.ordering import running_before

#: Size of a packed text file, to within one text.
FILE_BYTES = 128 << 20

# Text forms of timestamps in CSV files (microseconds kept).
CSV_OPTIONS = {
    "header": "true",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "dateFormat": "yyyy-MM-dd",
}


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite").options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
    return path


def read_csv(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """One DataFrame from one or many CSV files / directories."""
    return (spark.read.schema(schema).options(**CSV_OPTIONS)
            .option("mode", "FAILFAST").option("recursiveFileLookup", "true").csv(paths))


def pack(df: DataFrame, folder_col: str, order: list[str], text_col: str, file_bytes: int) -> DataFrame:
    """Adds ``file``: the number of the file, within its folder, that a text goes to.

    A folder's texts lie one after another in ``order`` (a key of the texts, ties
    by text), a line each; a text goes to the file in whose ``file_bytes`` it
    starts.  So a file outgrows the bound by less than one text, the number of
    files follows the data, and the numbers are a function of the rows alone.
    """
    line = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint") + 1
    placed = running_before(df, [folder_col], [F.col(c) for c in (*order, text_col)], line, "_before")
    return placed.withColumn("file", F.floor(F.col("_before") / F.lit(file_bytes)).cast("bigint")).drop("_before")


def write_text_files(df: DataFrame, root: str, folder_col: str, order: list[str], text_col: str,
                     file_bytes: int = FILE_BYTES) -> str:
    """Texts as files of about ``file_bytes`` (``pack``), each alone under its stable name ``<folder>/file=<number>``.

    A file is one task's work, whatever share of the texts its folder holds.
    """
    packed = pack(df.select(folder_col, *order, text_col), folder_col, order, text_col, file_bytes)
    (packed.repartition(folder_col, "file").sortWithinPartitions(folder_col, "file", *order, text_col)
           .select(folder_col, "file", text_col).write.mode("overwrite").partitionBy(folder_col, "file").text(root))
    return root


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """File listing from metadata: path below the root, its stable name (the path without the part
    file that Spark names), its outer folder's value, size, modification time (S5, V8)."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt")
               .option("recursiveFileLookup", "true").load(root).drop("content"))
    base = root.rstrip("/").rsplit("/", 1)[-1]
    relative = F.substring_index("path", f"/{base}/", -1)
    return listing.select(
        relative.alias("relative_path"),
        F.regexp_replace(relative, "/[^/]*$", "").alias("name"),
        F.substring_index(F.substring_index(relative, "/", 1), "=", -1).alias("folder"),
        F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def files_like(listing: DataFrame, prefix: str) -> DataFrame:
    """Files whose relative path starts with ``prefix``, taken literally."""
    return listing.where(F.col("relative_path").startswith(prefix))
