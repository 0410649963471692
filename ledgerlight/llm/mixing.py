"""Mixing sources to target weights by pivotal dependent rounding.

A document's size is its number of words.  A source's target is its share of
the wanted total by weight, at most ``MAX_COPIES`` times its own size, the
excess reshared by weight until no source is above.  Every document of a
source is owed the same number of copies, target / size: its whole part is
certain; the fraction is rounded by the pivotal method.  Two fractional
documents are paired and a random amount of words moves from one to the other
until one of them is at a whole copy, so the words taken from a source never
drift from the target, while each document keeps its expected copies.  Pairs
are made from the longest document down, so that what is left over at the end
is a short one.

Rounding runs as a reduction tree: documents are dealt by the hash of their id
into buckets of about ``BUCKET`` rows, each bucket rounds all but one document
per source, and those residuals meet in buckets of ``FAN`` until one per source
is left, whose fraction is settled by a draw.  All draws come from hashes of
the ids, so a rerun agrees on any partitioning.  A hot source is spread over
all buckets; a task never holds more than a bucket.

Null and empty texts have size 0 and are taken 0 times; a null source is a
source, ordered last; rows with the same id, source and size share one draw
and differ by a copy at most.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import WORD, fresh, row_key, salted_join
from ledgerlight.plans.lineage import materialize
from ledgerlight.plans.ordering import group_index

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_COPIES = 2.0
BUCKET, FAN = 2048, 64

#: Ids travel as text, so that a null beside them changes none; ``h`` is a hash of id, source and size.
_UNIT = ("doc_id string, h long, size long, source string, source_size long, target double, m long, certain long, "
         "fraction double, bucket long, settled boolean")
#: Copies of a row numbered by one array.
STRETCH = 4096


def sizes(documents: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    return documents.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"))


def targets(units: DataFrame, total_share: float = TOTAL_SHARE, weights: tuple = WEIGHTS,
            max_copies: float = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) of each source."""
    per = units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    ranked = group_index(per.withColumn("__k", F.lit(0)), ["__k"], [F.col("source").isNull(), F.col("source")], "__i")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("__i") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = materialize(ranked.select("source", "source_size", weight.alias("w"),
                                    (F.col("source_size") * F.lit(float(max_copies))).alias("cap")), "sources")
    whole = per.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0        # words per unit of weight; a source at or below its cap's level is capped
    while True:
        capped = F.col("cap") < F.lit(level) * F.col("w")
        fixed, free = per.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0.0)), F.sum(F.when(~capped, F.col("w")).otherwise(0.0))).first()
        if not free:
            break
        new = (total_share * whole - fixed) / free
        if new <= level:
            break
        level = new
    return per.select("source", "source_size", F.least(F.col("cap"), F.lit(level) * F.col("w")).alias("target"))


def settle(size: np.ndarray, p: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int | None]:
    """Pivotal rounding in the given order: fractions to 0 or 1, but for one residual (its place or None)."""
    p = p.copy()
    held = None
    for k in range(len(p)):
        if not 0.0 < p[k] < 1.0:
            continue
        if held is None:
            held = k
            continue
        a, b, sa, sb = p[held], p[k], float(size[held]), float(size[k])
        up, down = min((1 - a) * sa, b * sb), min(a * sa, (1 - b) * sb)    # words that a can gain or lose
        if draws[k] * (up + down) < down:
            moved, a_full, b_full = up, (1 - a) * sa <= b * sb, b * sb <= (1 - a) * sa
            p[held], p[k] = (1.0 if a_full else a + moved / sa), (0.0 if b_full else b - moved / sb)
        else:
            moved, a_full, b_full = down, a * sa <= (1 - b) * sb, (1 - b) * sb <= a * sa
            p[held], p[k] = (0.0 if a_full else a - moved / sa), (1.0 if b_full else b + moved / sb)
        if not 0.0 < p[held] < 1.0:
            held = k if 0.0 < p[k] < 1.0 else None
    return p, held


def _hash(values: pd.Series, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (values.to_numpy(np.int64).view(np.uint64) ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def _settle_bucket(level: int, last: bool):
    """Round the units of a bucket, source by source; residuals are marked unsettled unless ``last``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        order = _hash(pdf["h"], 2 * level + 1)
        pdf = (pdf.assign(__o=order, __s=pdf["source"].fillna(""), __n=pdf["source"].isna(), __z=-pdf["size"])
               .sort_values(["__n", "__s", "__z", "__o", "doc_id", "fraction"], kind="stable").reset_index(drop=True))
        p, settled = pdf["fraction"].to_numpy().copy(), np.ones(len(pdf), bool)
        size, draws = pdf["size"].to_numpy(), _hash(pdf["h"], 2 * level + 2) / 2.0**64
        change = np.flatnonzero(np.concatenate([[True], (pdf["__s"].to_numpy()[1:] != pdf["__s"].to_numpy()[:-1])
                                                | (pdf["__n"].to_numpy()[1:] != pdf["__n"].to_numpy()[:-1]), [True]]))
        for a, b in zip(change[:-1], change[1:], strict=True):
            p[a:b], held = settle(size[a:b], p[a:b], draws[a:b])
            if held is not None:
                if last:
                    draw = float(_hash(pdf["h"].iloc[[a + held]], 977)[0] / 2.0**64)
                    p[a + held] = float(draw < p[a + held])
                else:
                    settled[a + held] = False
        return pdf.assign(fraction=p, settled=settled).drop(columns=["__o", "__s", "__n", "__z"])

    return run


def settled_units(documents: DataFrame) -> DataFrame:
    """(doc_id, size, source, source_size, target, m, taken_copies): a row for each id, source
    and size, ``m`` rows strong, with the copies that all of them get together."""
    units = materialize(sizes(documents).groupBy("doc_id", "source", "size").agg(F.count("*").alias("m")), "units")
    per = targets(units)
    n = units.count()
    buckets = max(1, math.ceil(n / BUCKET))
    owed = F.when(F.col("source_size") > 0, F.col("m") * F.col("target") / F.col("source_size")).otherwise(0.0)
    owed = F.when(F.col("size") > 0, owed).otherwise(0.0)
    owed = F.when(F.abs(owed - F.round(owed)) < 1e-9, F.round(owed)).otherwise(owed)
    rows = (salted_join(units.withColumn("h", F.xxhash64("doc_id", "source", "size", F.lit("mix"))), per, "source", F.col("h"))
            .withColumn("certain", F.floor(owed)).withColumn("fraction", owed - F.col("certain"))
            .withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets)))
            .withColumn("settled", F.lit(True))
            .select(F.col("doc_id").cast("string").alias("doc_id"), "h", "size", "source", "source_size", "target", "m", "certain",
                    "fraction", "bucket", "settled"))
    keys, level, done = ["bucket"], 0, None
    while True:
        last = buckets == 1
        out = rows.groupBy(*keys).applyInPandas(_settle_bucket(level, last), _UNIT)
        if not last:
            out = materialize(out, "settled")
        part = out.where("settled")
        done = part if done is None else done.unionByName(part)
        if last:
            break
        buckets = math.ceil(buckets / FAN)
        rows = out.where("NOT settled").withColumn("bucket", F.floor(F.col("bucket") / FAN))
        keys, level = ["source", "bucket"], level + 1
    copies = (F.col("certain") + F.round("fraction")).cast("bigint")
    return done.select(F.col("doc_id").cast(units.schema["doc_id"].dataType).alias("doc_id"), "size", "source", "source_size", "target", "m",
                       copies.alias("taken_copies"))


def _share(nth, m, taken_copies) -> F.Column:
    """Copies of the ``nth`` of the ``m`` rows of a unit."""
    return (F.floor(taken_copies / m) + F.when(nth <= taken_copies % m, 1).otherwise(0)).cast("bigint")


def plan(documents: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken): a row for each document."""
    one, m = F.lit(1).cast("bigint"), F.col("m")
    rows = settled_units(documents).withColumn("__first", F.explode(F.sequence(one, m, F.lit(STRETCH).cast("bigint"))))
    rows = rows.withColumn("__r", F.explode(F.sequence(F.col("__first"), F.least(F.col("__first") + (STRETCH - 1), m))))
    copies = _share(F.col("__r"), m, F.col("taken_copies"))
    return rows.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(documents: DataFrame) -> DataFrame:
    """The documents that the mix takes, with the columns ``size``, ``copies`` and ``taken``
    (replacing columns of those names).

    Only rows that share id, source and size with others are numbered, over slices of their own order."""
    own = [c for c in documents.columns if c.lower() not in ("size", "copies", "taken")]
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = documents.select(*own, size.alias("size"))
    names, source, m, taken, nth, at = [fresh(rows, "k1"), fresh(rows, "k2")], *(fresh(rows, c) for c in ("source", "m", "taken", "nth", "at"))
    units = settled_units(documents).where("taken_copies > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), "m", "taken_copies")
    units = materialize(units.select(F.col("m").alias(m), F.col("taken_copies").alias(taken), *[
        k.alias(n) for k, n in zip(row_key("__id", "__source", "__size"), names, strict=True)]), "taken")
    rows = rows.withColumn(source, F.col("source").cast("string"))
    rows = rows.withColumns(dict(zip(names, row_key("doc_id", source, "size"), strict=True))).drop(source)
    joined = rows.join(units, names)
    result = joined.where(F.col(m) == 1).withColumn(nth, F.lit(1).cast("bigint"))
    if not units.where(F.col(m) > 1).isEmpty():
        several = joined.where(F.col(m) > 1).withColumn(at, F.monotonically_increasing_id())
        result = result.unionByName(group_index(several, names, [F.col(at)], nth).drop(at))
    copies = _share(F.col(nth), F.col(m), F.col(taken))
    return (result.select(*[F.col(c) for c in own], "size", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
            .where("copies > 0"))
