"""Benchmark decontamination by spaced-seed hashing.

A leak is a window of ``WINDOW`` aligned words in which a document and a
benchmark item agree in all but ``SUBSTITUTIONS`` places at most (an item
shorter than the window must occur whole and unchanged).  ``MASKS`` are
fixed patterns of used (1) and ignored (0) word positions, chosen so that any
such window contains at least one mask free of substitutions (the tests prove
it over all placements); documents and items that share a masked hash are
aligned there and the window is verified word by word.

The benchmark is a stated query set: its items are dealt into blocks of at
most about ``BLOCK_WORDS`` words, each block's seed table is broadcast and all
documents are scanned against it.  Document words are never shuffled; only
verified leaks leave the scan.

Nulls and empty texts match nothing; repeated items and rows each count;
words are compared with A-Z lower-cased.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import WORD, fresh
from ledgerlight.llm.words import U64, Words, mix, multipliers, words

WINDOW, SUBSTITUTIONS = 13, 3
MASKS = ("111011", "1100001011", "110111")
BLOCK_WORDS = 1_000_000
_BITMAP_BITS = 22


@dataclass
class Seeds:
    """The seed tables of one block of items."""

    items: list                    # item ids, as they come
    tokens: np.ndarray             # word hashes of all items, one after another
    bound: np.ndarray              # where each item starts, with a closing bound
    tables: list                   # (mask, bitmap, sorted hashes, item, position)


def masked(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the used positions of ``mask`` at every start that has room."""
    m = len(hashes) - len(mask) + 1
    if m <= 0:
        return np.zeros(0, U64)
    total = np.zeros(m, U64)
    used = [k for k, c in enumerate(mask) if c == "1"]
    for k, c in zip(used, multipliers(len(used), len(mask)), strict=True):
        total += hashes[k:k + m] * c
    return mix(total)


def seeds(ids: list, texts: list) -> Seeds:
    parts, bound = [], [0]
    for w in words(pa.array(texts, pa.large_string())):
        starts = w.row_bounds()
        parts.append(w.hash)
        bound.extend((bound[-1] + np.cumsum(np.diff(starts))).tolist())
    tokens, bound = np.concatenate(parts) if parts else np.zeros(0, U64), np.array(bound)
    length = np.diff(bound)
    short = sorted({int(n) for n in length if 0 < n < WINDOW})
    tables = []
    for mask, fits in [(m, length >= WINDOW) for m in MASKS] + [("1" * n, length == n) for n in short]:
        hashed, item, place = [], [], []
        for i in np.flatnonzero(fits):
            h = masked(tokens[bound[i]:bound[i + 1]], mask)
            hashed.append(h)
            item.append(np.full(len(h), i))
            place.append(np.arange(len(h)))
        if hashed:
            h = np.concatenate(hashed)
            order = np.argsort(h, kind="stable")
            bitmap = np.zeros(1 << _BITMAP_BITS, bool)
            bitmap[h >> U64(64 - _BITMAP_BITS)] = True
            tables.append((mask, bitmap, h[order], np.concatenate(item)[order], np.concatenate(place)[order]))
    return Seeds(ids, tokens, bound, tables)


def leaks(w: Words, s: Seeds) -> list[tuple[int, int, int, int]]:
    """(row, item, best agreement, word position) of the verified leaks in a chunk."""
    starts = w.row_bounds()
    found = []
    for mask, bitmap, table, item, place in s.tables:
        h = masked(w.hash, mask)
        at = np.flatnonzero(bitmap[h >> U64(64 - _BITMAP_BITS)])
        lo, hi = np.searchsorted(table, h[at], "left"), np.searchsorted(table, h[at], "right")
        n = hi - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        if len(at):
            k = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            at = np.repeat(at, n)
            found.append(np.stack([w.row[at], item[k], at - place[k]], axis=1))
    out: dict[tuple[int, int], tuple[int, int]] = {}
    if not found:
        return []
    diagonals = np.unique(np.concatenate(found), axis=0)
    by_item = np.argsort(diagonals[:, 1], kind="stable")
    diagonals = diagonals[by_item]
    edges = np.flatnonzero(np.diff(diagonals[:, 1], prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        i = int(diagonals[a, 1])
        own = s.tokens[s.bound[i]:s.bound[i + 1]]
        span = min(WINDOW, len(own))
        need = span - (SUBSTITUTIONS if len(own) >= WINDOW else 0)
        for c in range(a, b, max(1, 4_000_000 // len(own))):       # bounded slabs of diagonals
            d = diagonals[c:min(b, c + max(1, 4_000_000 // len(own)))]
            r = d[:, 0]
            place = d[:, 2][:, None] + np.arange(len(own))
            inside = (place >= starts[r - w.first][:, None]) & (place < starts[r - w.first + 1][:, None])
            equal = inside & (w.hash[np.clip(place, 0, len(w.hash) - 1)] == own)
            run = np.cumsum(equal, axis=1, dtype=np.int32)
            run = np.concatenate([np.zeros((len(d), 1), np.int32), run], axis=1)
            agree = run[:, span:] - run[:, :-span]
            # a window must lie within the document
            whole = inside[:, :len(own) - span + 1] & inside[:, span - 1:]
            agree = np.where(whole, agree, -1)
            best = agree.argmax(axis=1)
            score = agree[np.arange(len(d)), best]
            for j in np.flatnonzero(score >= need):
                key, value = (int(r[j]), i), (int(score[j]), int(place[j, best[j]] - starts[r[j] - w.first]))
                if key not in out or (value[0], -value[1]) > (out[key][0], -out[key][1]):
                    out[key] = value
    return [(r, i, *v) for (r, i), v in sorted(out.items())]


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> list[Seeds]:
    """The benchmark's seed tables, in blocks of bounded size."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    total = items.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
    n = max(1, math.ceil(total / block_words))
    out = []
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        out.append(seeds([r.item_id for r in rows], [r.text for r in rows]))
    return out


def leak_column(spark, block: Seeds, text: Column, id_type: str) -> Column:
    """The verified leaks of a text: array of (item_id, agreeing words, word position)."""
    shipped = spark.sparkContext.broadcast((block.items, block.tokens, block.bound, block.tables))
    ids = pa.int64() if id_type == "bigint" else pa.string()
    kind = pa.struct([("item_id", ids), ("agreeing", pa.int32()), ("at_word", pa.int32())])

    def find(column: pa.Array) -> pa.Array:
        s = Seeds(*shipped.value)
        per_row = [[] for _ in range(len(column))]
        for w in words(column):
            for row, item, agreeing, at in leaks(w, s):
                per_row[row].append({"item_id": s.items[item], "agreeing": agreeing, "at_word": at})
        return pa.array(per_row, pa.list_(kind))

    return F.arrow_udf(find, f"array<struct<item_id:{id_type},agreeing:int,at_word:int>>").asNondeterministic()(text)


def _typed(benchmark: DataFrame) -> tuple[DataFrame, str]:
    kind = dict(benchmark.dtypes)["item_id"]
    if kind in ("bigint", "int", "smallint", "tinyint"):
        return benchmark.withColumn("item_id", F.col("item_id").cast("bigint")), "bigint"
    return benchmark.withColumn("item_id", F.col("item_id").cast("string")), "string"


def find_leaks(documents: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, agreeing, at_word), a row for each document row and item that leaks into it."""
    benchmark, kind = _typed(benchmark)
    out = None
    for block in blocks(benchmark, block_words):
        hits = (documents.select("doc_id", leak_column(documents.sparkSession, block, F.col("text"), kind).alias("leak"))
                .select("doc_id", F.explode("leak").alias("leak")).select("doc_id", "leak.*"))
        out = hits if out is None else out.unionByName(hits)
    return out


def without_leaks(documents: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``documents`` without the rows that any benchmark item leaks into; columns as they came."""
    benchmark, kind = _typed(benchmark)
    columns = documents.columns
    for block in blocks(benchmark, block_words):
        name = fresh(documents, "leaks")
        documents = (documents.withColumn(name, F.size(leak_column(documents.sparkSession, block, F.col("text"), kind)))
                     .where(F.col(name) == 0).select(*columns))
    return documents
