"""Importance resampling towards a target distribution, by bit-sliced sums.

A word is a run of ASCII digits, letters (A-Z lower-cased) and all characters
beyond ASCII; a feature is a word, hashed to one of ``BUCKETS`` buckets.  A
bucket's gain is the rounded-down logarithm, in thousandths, of its share in
the target texts over its share in the documents, both smoothed by one count a
bucket.  A document's weight is the floored mean gain of its features.

The sums behind the means are bit-sliced.  A document's counts by bucket become
planes of ``BUCKETS`` bits: bit ``b`` of plane ``j`` is bit ``j`` of the count
of bucket ``b``.  Gains become planes by bit and sign in the same way, and

    sum = sum over i, j of 2^(i+j) * (popcount(P_j & G_i+) - popcount(P_j & G_i-))

which is exact in integers: no gain is looked up and nothing is rounded before
the mean.

Documents are tokenised once, to a written table of bucket counts; a task
folds the counts of its rows into one row a bucket, and 10,000 sums at most
reach the driver, at any size.  The draw adds Gumbel noise from a hash of the
id to each weight and takes the highest tenth of the documents with at least
``MIN_WORDS`` words; ranks are numbered over range slices, so ties and one
repeated row spread over tasks.

Null and empty texts have no features, weight 0, and take no part in the draw.
A null id draws as the empty string and comes last in ties; repeated rows each
take part (equal rows in any order).  An empty table gives an empty result, an
empty target the gains of all-equal shares.  Other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.words import CHUNK_BYTES, buffers
from ledgerlight.plans.lineage import materialize
from ledgerlight.plans.ordering import group_index

BUCKETS = 10_000
SEED = "2024"
MIN_WORDS, PERCENT = 20, 10
#: Words of more bytes are hashed one by one.
LONG_WORD = 48
#: Planes held at once in a task, each of BUCKETS bits (bytes while they are filled).
PLANES = 512

_FEATURES = "struct<n:bigint,buckets:array<smallint>,counts:array<int>>"


def _crc_steps() -> np.ndarray:
    """CRC-32 of each byte value by the reflected polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = (c >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (c & np.uint32(1)))
    return c


def crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte runs ``data[start:end]``, all words a byte at a time."""
    steps, ones = _crc_steps(), np.uint32(0xFFFFFFFF)
    length = end - start
    order = np.argsort(-np.minimum(length, LONG_WORD + 1), kind="stable")
    start, length = start[order], length[order]
    crc = np.full(len(start), ones, np.uint32)
    n_long = int((length > LONG_WORD).sum())
    alive = np.searchsorted(-length[n_long:], -np.arange(1, LONG_WORD + 1), "right") + n_long
    for at, n in enumerate(alive.tolist()):
        if n <= n_long:
            break
        part = slice(n_long, n)
        crc[part] = steps[(crc[part] ^ data[start[part] + at]) & np.uint32(255)] ^ (crc[part] >> np.uint32(8))
    crc ^= ones
    for at in range(n_long):
        crc[at] = zlib.crc32(data[start[at]:start[at] + length[at]].tobytes())
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _words(column):
    """(first row, last row, row of each word, its CRC-32) by chunks of whole rows."""
    data_all, offsets = buffers(column)
    lower, inside = np.arange(256, dtype=np.uint8), np.zeros(256, bool)
    lower[65:91] += 32
    for a, b in ((48, 58), (65, 91), (97, 123), (128, 256)):
        inside[a:b] = True
    n_rows, first = len(offsets) - 1, 0
    while first < n_rows:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), n_rows)
        data = data_all[offsets[first]:offsets[last]]
        bound = offsets[first:last + 1] - offsets[first]
        word = np.zeros(len(data) + 1, bool)
        word[:-1] = inside[data]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        edges = bound[:-1][np.diff(bound) > 0]
        begins[edges] = word[edges]                         # a row's first word isn't the last row's
        start = np.flatnonzero(begins)
        stops = ~word
        stops[edges] = True
        stop = np.flatnonzero(stops)
        end = stop[np.searchsorted(stop, start, "right")]
        row = np.searchsorted(bound, start, "right") - 1 + first
        yield first, last, row, crc32(lower[data], start, end)
        first = last


def _features(column: pa.Array) -> pa.Array:
    n, rows, buckets, counts = np.zeros(len(column), np.int64), [], [], []
    for first, last, row, crc in _words(column):
        n[first:last] = np.bincount(row - first, minlength=last - first)
        packed, count = np.unique(row * BUCKETS + crc % np.uint32(BUCKETS), return_counts=True)
        rows.append(packed // BUCKETS)
        buckets.append((packed % BUCKETS).astype(np.int16))
        counts.append(count.astype(np.int32))
    row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    offsets = pa.array(np.searchsorted(row, np.arange(len(column) + 1)).astype(np.int32))
    flat = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else np.zeros(0, kind), kind()))
            for x, kind in ((buckets, pa.int16), (counts, pa.int32))]
    return pa.StructArray.from_arrays([pa.array(n), *flat], ["n", "buckets", "counts"])


def features(text: Column) -> Column:
    """struct(n, buckets, counts): the number of features of a text, its buckets in order and their counts."""
    return F.arrow_udf(_features, _FEATURES).asNondeterministic()(text)


def _totals(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        at, by = batch["buckets"].flatten().to_numpy(), batch["counts"].flatten().to_numpy()
        total += np.bincount(at, by, BUCKETS).astype(np.int64)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """Features in each bucket over all ``rows`` (buckets, counts)."""
    parts = rows.select("buckets", "counts").mapInArrow(_totals, "bucket int, n long")
    out = np.zeros(BUCKETS, object)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = int(r["n"])
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Rounded-down thousandths of the log ratio of smoothed shares, by bucket."""
    whole_own, whole_target = sum(own.tolist()) + BUCKETS, sum(target.tolist()) + BUCKETS
    return np.array([math.floor(1000 * math.log(float((t + 1) * whole_own) / float((s + 1) * whole_target)))
                     for s, t in zip(own.tolist(), target.tolist(), strict=True)], np.int64)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), np.uint8)
    wide[:, :bits.shape[1]] = bits
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


def gain_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(signed power of two, words of the plane) of each plane that holds a bit."""
    planes = []
    for sign in (1, -1):
        size = np.maximum(sign * gain, 0)
        for i in range(int(size.max()).bit_length()):
            planes.append((sign * (1 << i), _packed(((size >> i) & 1)[None, :])[0]))
    return planes


def sliced_sums(offsets: np.ndarray, buckets: np.ndarray, counts: np.ndarray, planes: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Sum of gain times count of each row, from the rows' count planes and the gain planes."""
    total = np.zeros(len(offsets) - 1, np.int64)
    row = np.repeat(np.arange(len(total)), np.diff(offsets))
    for j in range(int(counts.max(initial=0)).bit_length()):
        on = (counts >> j) & 1 == 1
        rows, at = row[on], buckets[on]
        present, place = np.unique(rows, return_inverse=True)
        for low in range(0, len(present), PLANES):
            a, b = np.searchsorted(rows, present[low]), np.searchsorted(rows, present[min(low + PLANES, len(present)) - 1], "right")
            bits = np.zeros((min(PLANES, len(present) - low), BUCKETS), np.uint8)
            bits[place[a:b] - low, at[a:b]] = 1
            own = _packed(bits)
            part = np.zeros(len(own), np.int64)
            for power, plane in planes:
                part += power * np.bitwise_count(own & plane).sum(axis=1, dtype=np.int64)
            total[present[low:low + PLANES]] += part << j
    return total


def _weights(shipped):
    def weigh(n: pa.Array, buckets: pa.Array, counts: pa.Array) -> pa.Array:
        offsets = buckets.offsets.to_numpy().astype(np.int64)
        sums = sliced_sums(offsets - offsets[0], buckets.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy(), shipped.value)
        n = n.to_numpy()
        return pa.array(np.where(n > 0, sums // np.maximum(n, 1), 0))

    return F.arrow_udf(weigh, "bigint")


def weighed(documents: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_features, weight, uid): a row for each document, written, ``uid`` a number of the row."""
    own = documents.select("doc_id", features(F.col("text")).alias("f")).select("doc_id", "f.*")
    own = materialize(own.withColumn("uid", F.monotonically_increasing_id()), "bucket-counts")
    wanted = bucket_counts(target.select(features(F.col("text")).alias("f")).select("f.*"))
    planes = documents.sparkSession.sparkContext.broadcast(gain_planes(gains(bucket_counts(own), wanted)))
    weight = _weights(planes)("n", "buckets", "counts")
    return materialize(own.select("doc_id", F.col("n").alias("n_features"), weight.alias("weight"), "uid"), "weights")


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resampled(documents: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; ``rank`` is null where it isn't drawn."""
    rows = weighed(documents, target).withColumn("score", (F.col("weight") + noise(F.col("doc_id"), seed)).cast("bigint"))
    able = F.col("n_features") >= min_words
    drawn = rows.where(able).count() * percent // 100
    ranked = group_index(rows.where(able), [], [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("uid")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(rows.where(~able).withColumn("rank", F.lit(None).cast("bigint"))).select(
        "doc_id", "n_features", "weight", "score", "rank")
