"""Text cleaning and object ids (V1-V3, F22) and keyed import.

Cleaning, as done before objects are vectorised and imported: a value that
is empty or whitespace only counts as missing, rows with a missing value are
dropped, newlines are removed from the text, and each row gets a stable
name-based id within its object class.  All of it is native column
expressions; whole texts are processed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.hashing import row_uuid
from ledgerlight.functions.text import COMMENT_DATE_FORMAT, blank_to_null, drop_newlines

# The object class names ids are derived within.
TRAINING_CLASS = "CommentTraining"
COMMENT_CLASS = "CustomerComment"
CALL_CLASS = "CustomerCall"


def clean_objects(df: DataFrame, text_col: str, class_name: str, id_col: str = "uuid") -> DataFrame:
    cols = df.columns
    present = df.select(*[blank_to_null(F.col(c)).alias(c) for c in cols]).na.drop("any")
    cleaned = present.withColumn(text_col, drop_newlines(F.col(text_col)))
    return cleaned.withColumn(id_col, row_uuid(class_name, cols))


def clean_training(training: DataFrame) -> DataFrame:
    """Labelled training text (V1): label as text."""
    df = training.withColumn("label", F.col("label").cast("string"))
    return clean_objects(df, "review_text", TRAINING_CLASS)


def clean_comments(comments: DataFrame) -> DataFrame:
    """Customer comments (V2): customer id as text, date as ISO text with offset."""
    df = comments.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        "review_text",
        F.date_format("date", COMMENT_DATE_FORMAT).alias("date"))
    return clean_objects(df, "review_text", COMMENT_CLASS)


def clean_calls(calls: DataFrame) -> DataFrame:
    """Call transcripts (V3)."""
    df = calls.select(F.col("customer_id").cast("string").alias("customer_id"),
                      "transcript", "relative_path")
    return clean_objects(df, "transcript", CALL_CLASS)


def import_new_only(existing: DataFrame, incoming: DataFrame, key: str = "uuid") -> DataFrame:
    """Objects of ``incoming`` whose id is not in ``existing``, one per id.

    Ids are derived from all of an object's values, so rows sharing an id
    are copies and any one of them stands for all.  ``dropDuplicates`` is a
    partial+final aggregation: copies collapse map-side before the shuffle,
    so a value copied millions of times costs one row per task.
    """
    return incoming.dropDuplicates([key]).join(existing.select(key), key, "left_anti")
