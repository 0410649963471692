"""Token counts by a linear longest-match automaton.

A word's greedy word pieces (at each place the longest piece that fits) are
counted without being built: a vocabulary trie has for every node a failure
link and the number of pieces that are complete when the link is taken, so
that a word costs one pass over its bytes, however its pieces overlap.

Pieces are byte strings; one that begins a word starts with ``START``, any
other continues one.  ``byte_vocabulary`` reads a ranks file (one base-64 piece
and its rank a line) of a byte-level vocabulary, whose pieces with a leading
space begin words; ``marked_vocabulary`` takes plain pieces with a mark for
continuations.  A word that no pieces cover is one unknown token.

Words are runs outside spaces and control separators, in their own case.  Null
and empty texts have no tokens.  The vocabulary (``MAX_PIECES`` at most) is
broadcast; each task remembers up to ``MEMORY`` words' counts and walks the
others, so the memory stays bounded for any corpus.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.words import words

START = b" "
MAX_PIECES = 1_000_000
MEMORY = 200_000


def byte_vocabulary(path: str) -> list[bytes]:
    """Pieces of a byte-level vocabulary that can occur within one word."""
    with open(path, "rb") as lines:
        pieces = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    inner = bytes([9, 10, 11, 12, 13, 32])
    return [p for p in pieces if p and not any(c in inner for c in p[1:]) and (p[0] not in inner or p[:1] == START)]


def marked_vocabulary(pieces: Iterable[str], mark: str = "##") -> list[bytes]:
    return [p[len(mark):].encode() if p.startswith(mark) else START + p.encode() for p in pieces if p and p != mark]


def automaton(pieces: list[bytes]) -> tuple[dict, list, list]:
    """(child by node * 256 + byte, failure link or -1, pieces completed by taking it) of the trie; the root is 0."""
    if len(pieces) > MAX_PIECES:
        raise ValueError(f"{len(pieces)} pieces; at most {MAX_PIECES} are broadcast")
    child: dict[int, int] = {}
    ends, parent, by = [False], [-1], [0]
    for piece in sorted(set(pieces)):
        node = 0
        for c in piece:
            key = node * 256 + c
            if key not in child:
                child[key] = len(ends)
                ends.append(False)
                parent.append(node)
                by.append(c)
            node = child[key]
        ends[node] = True
    depth = [0] * len(ends)
    for v in range(1, len(ends)):
        depth[v] = depth[parent[v]] + 1
    link, popped = [-1] * len(ends), [0] * len(ends)
    for v in sorted(range(1, len(ends)), key=depth.__getitem__):
        if ends[v]:
            link[v], popped[v] = 0, 1
            continue
        z, pops = link[parent[v]], popped[parent[v]]
        while z >= 0 and z * 256 + by[v] not in child:
            pops += popped[z]
            z = link[z]
        if z >= 0:
            link[v], popped[v] = child[z * 256 + by[v]], pops
    return child, link, popped


def pieces_of(word: bytes, child: dict, link: list, popped: list) -> int:
    """Number of greedy pieces of a word; 1 if no pieces cover it."""
    node, n = 0, 0
    for c in START + word:
        while (after := child.get(node * 256 + c)) is None:
            n += popped[node]
            node = link[node]
            if node < 0:
                return 1
        node = after
    while node:
        n += popped[node]
        node = link[node]
        if node < 0:
            return 1
    return n


def count_columns(spark, pieces: list[bytes], text: Column) -> Column:
    """struct(n_words, n_tokens) of a text."""
    child, link, popped = automaton(pieces)
    keys = np.fromiter(child.keys(), np.int64, len(child))
    shipped = spark.sparkContext.broadcast((keys, np.fromiter(child.values(), np.int32, len(child)),
                                            np.array(link, np.int32), np.array(popped, np.int32)))
    ready: dict = {}

    def count(column: pa.Array) -> pa.Array:
        if "child" not in ready:
            k, v, f, p = shipped.value
            ready.update(child=dict(zip(k.tolist(), v.tolist(), strict=True)), link=f.tolist(), popped=p.tolist(), seen={})
        child, link, popped, seen = (ready[x] for x in ("child", "link", "popped", "seen"))
        n_words, n_tokens = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
        for w in words(column, lower=False):
            token, first, at = np.unique(w.hash, return_index=True, return_inverse=True)
            sizes = []
            for h, a, b in zip(token.tolist(), w.start[first].tolist(), w.end[first].tolist(), strict=True):
                n = seen.get(h)
                if n is None:
                    if len(seen) >= MEMORY:
                        seen.clear()
                    n = seen[h] = pieces_of(w.data[a:b].tobytes(), child, link, popped)
                sizes.append(n)
            n_words += np.bincount(w.row, minlength=len(column))
            n_tokens += np.bincount(w.row, np.array(sizes, np.int64)[at], minlength=len(column)).astype(np.int64)
        return pa.StructArray.from_arrays([pa.array(n_words), pa.array(n_tokens)], ["n_words", "n_tokens"])

    return F.arrow_udf(count, "struct<n_words:bigint,n_tokens:bigint>").asNondeterministic()(text)


def counted(documents: DataFrame, pieces: list[bytes]) -> DataFrame:
    """(doc_id, n_words, n_tokens) of each row."""
    return (documents.select("doc_id", count_columns(documents.sparkSession, pieces, F.col("text")).alias("c"))
            .select("doc_id", "c.*"))
