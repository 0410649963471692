"""Shared pieces of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Separators of words: space and the characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"


def fold(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of an id's decimal text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string")) % modulus


def in_fold(modulus: int, remainder: int, column: str = "doc_id") -> Column:
    """Whether an id falls in a fold; a null id falls in none."""
    return F.coalesce(fold(modulus, column) == remainder, F.lit(False))


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once per row, however often ``then`` refers to it
    and wherever the optimizer moves the expression; a lambda would else repeat it at each step."""
    return F.element_at(F.transform(F.array(value), then), 1)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name.lower() in taken:
        name += "_"
    return name


def row_key(*columns) -> list[Column]:
    """A 128-bit key of columns as two longs, nulls told apart: rows dealt by it stay together for
    what follows (no second shuffle), where null-safe conditions would each become a key."""
    nulls = F.concat_ws("", *[F.col(c).isNull().cast("string") for c in columns])
    return [F.xxhash64(F.lit(seed), nulls, *columns) for seed in (1, 2)]


def labelled_sample(labels: DataFrame, column: str, train: Column, max_rows: int) -> DataFrame:
    """(doc_id, label) of at most about ``max_rows`` labelled training rows.

    Null ids and labels are left out; the largest label counts when an id has
    several.  Beyond ``max_rows`` an id stays if its hash falls below the
    matching share, so the sample doesn't depend on partitions.  This bound is
    what makes the frame safe to broadcast.
    """
    rows = (labels.select("doc_id", F.col(column).cast("int").alias("label"))
            .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & train)
            .groupBy("doc_id").agg(F.max("label").alias("label")))
    n = rows.count()
    if n > max_rows:
        share = int(max_rows / n * (1 << 30))
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("labelled")), F.lit(1 << 30)) < share)
    return rows


def salted_join(rows: DataFrame, per_key: DataFrame, key: str, spread: Column, salts: int = 64,
                how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``per_key`` (one row per key) where one key may hold most rows.

    Each key's rows are dealt over ``salts`` sub-keys by ``spread`` and its
    row of ``per_key`` is repeated for each, so no task gets a whole hot key.
    Null keys match nulls; ``key`` comes back once.
    """
    salt, other = fresh(rows, "salt"), fresh(rows, "key")
    left = rows.withColumn(salt, F.pmod(F.xxhash64(spread, F.lit(salts)), F.lit(salts)))
    right = (per_key.withColumnRenamed(key, other)
             .withColumn("__s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))))
    hit = left[key].eqNullSafe(right[other]) & (left[salt] == right["__s"])
    return left.join(right, hit, how).drop(salt, "__s", other)
