"""Best-fit packing of documents into sequences, certified by lower bounds.

A document's tokens are its ids and a closing id; a document longer than a
sequence is cut into whole sequences, the first piece taking the rest.  Pieces
are dealt to partitions of about ``PART`` pieces, each packed best-fit
decreasing on its own.  Dual-feasible functions of the lengths give a lower
bound of the partition's sequences: a partition that meets it is certified and
gives up its emptiest sequences only, with half of its free room; one above it
has a gap and gives up all that aren't full.  Sequences given up are dealt anew, whole, to fewer
partitions, which repack the documents that they exchanged and keep the new
packing where it needs fewer sequences.  Rounds go on until one partition holds
all that is left, or a round saves less than ``LEAST_GAIN`` of its sequences.

The bound takes, for every threshold e up to half a sequence, the function that
counts a length above the rest as a whole sequence and one below e as nothing,
followed by the rounding function of each order up to ``ORDERS``; all in
integers, from the histogram of lengths.

Text is split as the vocabulary's byte-level rule splits it and each distinct
word goes through the vocabulary's merges once a worker (``MEMORY`` words are
remembered, from task to task); a text with characters beyond ``PLAIN`` is encoded whole by the
tokenizer, so no other library's character classes decide.  The ids are those
of the tokenizer for every text, special tokens' strings taken as plain text.

Null texts count as empty: a document without ids is the closing id alone.
Rows repeating an id are documents each; nulls in other columns don't matter,
and other columns are not read.  An empty table packs to nothing.
"""

from __future__ import annotations

import functools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.plans.lineage import materialize

LENGTH, END = 2048, 0
PART = 8192
LEAST_GAIN = 0.001
ORDERS = 24
MEMORY, LONG_WORD = 500_000, 64
#: Bytes of text split at a time.
CHUNK = 1 << 18
#: Characters whose class no version of Unicode's tables changes: Latin, Greek and Cyrillic letters, general marks.
PLAIN = "\x00-ɏΑ-ΡΣ-ϿЀ-ҁҊ-ԯ‐-‧‰-⁞₠-₰"
#: The byte-level rule's split of a text into words (a fixed value of the vocabulary).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same split of texts of ``PLAIN`` characters, whose classes are spelled out; words of letters are tried first.
PLAIN_SPLIT = " ?[{L}]+| ?[{N}]+|'(?:[stmd]|re|ve|ll)| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"

_PIECES = "array<struct<start:bigint,length:int,ids_crc32:bigint>>"
_PACKED = "uid long, doc_id {id}, piece int, start long, length int, ids_crc32 long, bin long, offset int, settled boolean"


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it prints, else the next from 256 on."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(prints)]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(other)}


def plain_split():
    """texts of ``PLAIN`` characters -> their words, as ``SPLIT`` gives them."""
    import regex

    plain = "".join(map(chr, range(0x10000)))
    plain = "".join(re.findall(f"[{PLAIN}]", plain))
    members = {name: "".join(map(re.escape, regex.findall(rule, plain))) for name, rule in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))}
    return re.compile(PLAIN_SPLIT.format(**members)).findall


class Merges(dict):
    """Words' ids as bytes; a word that is asked for the first time goes through the vocabulary's merges."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, byte_letters()

    def __missing__(self, w: str) -> bytes:
        got = np.array([t.id for t in self.model.tokenize(w.encode().decode("latin-1").translate(self.letters))], "<u4").tobytes()
        if len(w) <= LONG_WORD:
            if len(self) >= MEMORY:
                self.clear()
            self[w] = got
        return got


@functools.lru_cache(maxsize=1)
def encoder(vocabulary: str):
    """texts -> little-endian 32-bit ids of each, as bytes, for a byte-level vocabulary given as JSON text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.encode_special_tokens = True
    odd, split, ids_of = re.compile(f"[^{PLAIN}]"), plain_split(), Merges(tokenizer.model).__getitem__

    def ids(text: str) -> bytes:
        if odd.search(text):
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(ids_of, split(text)))

    return ids


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: the first takes what whole sequences leave."""
    first = n % length or length
    return [(0, min(first, n))] + [(s, length) for s in range(first, n, length)]


def pieces(spark, vocabulary: str, text: Column, length: int = LENGTH, end: int = END) -> Column:
    """The pieces of a text: (start, length, CRC-32 of the ids as little-endian 32-bit numbers)."""
    shipped = spark.sparkContext.broadcast(vocabulary)
    ready: dict = {}
    close = np.array([end], "<u4").tobytes()

    def cut(column: pa.Array) -> pa.Array:
        if "ids" not in ready:
            ready["ids"] = encoder(shipped.value)
        offsets, starts, lengths, sums = [0], [], [], []
        for at in range(len(column)):
            raw = ready["ids"](column[at].as_py() or "") + close
            for s, n in cuts(len(raw) // 4, length):
                starts.append(s)
                lengths.append(n)
                sums.append(zlib.crc32(raw[4 * s:4 * (s + n)]))
            offsets.append(len(starts))
        values = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(lengths, pa.int32()), pa.array(sums, pa.int64())],
                                            ["start", "length", "ids_crc32"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    return F.arrow_udf(cut, _PIECES).asNondeterministic()(text)


def lower_bound(histogram: np.ndarray, length: int) -> int:
    """Sequences that pieces need at least, from how many pieces have each length, by dual-feasible functions."""
    size = np.arange(length + 1)
    n = histogram.astype(object)
    if not histogram[1:].any():
        return 0
    half = np.arange(1, length // 2 + 1)                    # thresholds
    best = 0
    for k in range(ORDERS + 1):
        if k == 0:
            value, unit = size, length
        else:
            whole = (k + 1) * size % length == 0
            value, unit = np.where(whole, k * size, (k + 1) * size // length * length), k * length
        below = np.concatenate([[0], np.cumsum(n * value)])          # below[i]: lengths under i
        count = np.concatenate([[0], np.cumsum(n)])
        middle = below[length - half + 1] - below[half]
        large = count[length + 1] - count[length - half + 1]
        best = max(best, -(-int(below[-1]) // unit), max(-(-int(v) // unit) for v in middle + large * unit))
    return best


def best_fit(lengths: np.ndarray, length: int) -> tuple[np.ndarray, int]:
    """(sequence of each piece, sequences used): longest first, each to the fullest sequence that has room."""
    room_of: list[list[int]] = [[] for _ in range(length + 1)]
    mask, used = 0, 0                                        # bit r: some sequence has room r
    where = np.empty(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    for at, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fit = mask >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = room_of[room].pop()
            if not room_of[room]:
                mask ^= 1 << room
        else:
            room, b, used = length, used, used + 1
        left = room - size
        if left:
            if not room_of[left]:
                mask |= 1 << left
            room_of[left].append(b)
        where[at] = b
    return where, used


def repacked(lengths: np.ndarray, old: np.ndarray | None, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset, whether it is settled) of each piece of a partition; ``old``: its sequences before, if any."""
    where, used = best_fit(lengths, length)
    if old is not None:
        names, before = np.unique(old, return_inverse=True)
        if len(names) <= used:
            where, used = before, len(names)
    fill = np.bincount(where, lengths, used).astype(np.int64)
    free = fill < length
    if used <= lower_bound(np.bincount(lengths, minlength=length + 1), length):
        emptiest = np.argsort(fill, kind="stable")
        room = np.cumsum(length - fill[emptiest])
        free[emptiest[int(np.searchsorted(room, room[-1] / 2)) + 1:]] = False
    order = np.lexsort((-lengths, where))
    before = np.cumsum(lengths[order]) - lengths[order]
    first = np.searchsorted(where[order], where[order])
    offset = np.empty(len(lengths), np.int64)
    offset[order] = before - before[first]
    return where, offset, ~free[where]


def _pack_part(level: int, last: bool, length: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        old = None if level == 0 else table["bin"].to_numpy()
        where, offset, settled = repacked(table["length"].to_numpy().astype(np.int64), old, length)
        name = (level << 52) | (key[0].as_py() << 20)        # round, partition, sequence
        out = table.drop_columns(["part", "bin", "offset", "settled"])
        return (out.append_column("bin", pa.array(where + name)).append_column("offset", pa.array(offset.astype(np.int32)))
                .append_column("settled", pa.array(settled | last)))

    return run


def packed(documents: DataFrame, vocabulary: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): a row for each piece."""
    spark = documents.sparkSession
    cut = pieces(spark, vocabulary, F.col("text"), length, end)
    rows = (documents.select("doc_id", cut.alias("p")).select("doc_id", F.posexplode("p").alias("piece", "p"))
            .select(F.monotonically_increasing_id().alias("uid"), "doc_id", "piece", "p.*"))
    rows = materialize(rows, "pieces").withColumns({"bin": F.col("uid"), "offset": F.lit(0), "settled": F.lit(False)})
    schema = _PACKED.format(id=documents.schema["doc_id"].dataType.simpleString())
    parts, level, bins, done = max(1, math.ceil(rows.count() / PART)), 0, None, []
    while True:
        last = parts == 1
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(parts)))
        out = dealt.groupBy("part").applyInArrow(_pack_part(level, last, length), schema)
        if last:
            done.append(out)
            break
        out = materialize(out, "packed")
        left = out.where("NOT settled")
        n, now, whole = left.agg(F.count("*"), F.count_if(F.col("offset") == 0), F.lit(out.where("offset = 0").count())).first()
        done.append(out.where("settled"))
        if not n:
            break
        stuck = bins is not None and bins - whole < LEAST_GAIN * bins
        fewer = min(max(1, math.ceil(n / PART)), parts)
        if stuck and fewer == parts:
            done.append(left)
            break
        rows, parts, level, bins = left, fewer, level + 1, now
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select("doc_id", "piece", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32",
                         F.col("bin").alias("sequence_id"), F.col("offset").cast("bigint").alias("offset"))
