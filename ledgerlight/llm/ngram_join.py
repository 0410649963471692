"""N-gram Jaccard self-join by chosen paths.

A text is the set of its runs of five words (a text of one to four words is
one run), A-Z lower-cased; two different texts are linked if their sets have a
Jaccard similarity of 0.8 or more.  Texts of the same words are one class.

Each class follows paths of sampled shared tokens: at a node it goes on by
every token whose hash, salted with the node, falls below ``c / (0.8 * size)``,
so that two linked texts are expected to share ``c`` children (5/2 at the root,
3/2 below).  Classes that share a node are a bucket.  Buckets of at most
``BUCKET`` classes are brute-forced; larger ones are split again.  A passage that
most of a large bucket shares would only lead to the same bucket again, so its
tokens are set aside there: a class of ``n`` tokens, ``s`` of them set aside, has
at least ``0.8 n - s`` of the others in common with a linked one, and goes on by
those below ``c / (0.8 n - s)``, which leaves the expected shared children as they
were.  Classes made up mostly of such tokens (groups of near copies) are a bucket
of their own that isn't split and is brute-forced block by block.  ``RUNS`` independent runs bring the recall of a pair at exactly 0.8
above 0.999 for one split and above 0.99 for three; it is higher for more
similar pairs, and whatever is reported has been verified on the whole sets.

A bucket's task emits one row per class (its links and the least class it
reaches), never its pairs.  A pair that meets in several buckets counts in the
least of them, which both sides know from their lists of buckets.  Sets go by
32-bit hashes.  Texts without words are linked to nothing; null ids are taken
as they are; rows repeating an id and its text are copies of each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.llm.common import fresh, row_key
from ledgerlight.llm.words import U64, mix, multipliers, words
from ledgerlight.plans.lineage import discard, materialize

N_GRAM = 5
#: Similarity of 0.8 as a fraction: 5 * common >= 4 * joint.
ABOVE, BELOW = 4, 5
RUNS = 4
ROOT_CHILDREN, NODE_CHILDREN = 2.5, 1.5
#: Classes of a bucket that isn't split, and of a block of a bucket that can't be.
BUCKET, BLOCK = 512, 1024
#: Tokens of at least this share of a large bucket's classes, seen on ``SAMPLE`` of them, are set aside.  Which ones are
#: bears on the work only: whatever is set aside, linked classes share as many children, or both are in the core.
COMMON, SAMPLE = 0.5, 32
#: Classes with a smaller share of other tokens than ``SPLIT_FROM`` are core only, below ``CORE_BELOW`` core as well: a
#: class linked to one with a share of 0.22 has at most (0.22 + 0.25) / 1.25 = 0.376.
SPLIT_FROM, CORE_BELOW = 0.22, 0.38
#: A child that keeps this share of its parent has stopped shrinking.
STUCK = 0.5
MAX_DEPTH = 8
#: Tokens worked on at a time when classes are split.
CHUNK_TOKENS = 1 << 18
#: Classes of a bucket (or block of it) whose groups are tied all pairs, and classes that stand for a larger bucket.
STAR, STAR_REPRESENTATIVES = 256, 8

_RECORD = "struct<ka:bigint,kb:bigint,n:int,paths:array<bigint>>"


def _chosen(tokens: np.ndarray, sizes: np.ndarray, node, children: float) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens continue a path at ``node``, and the children they lead to."""
    u = mix(tokens.astype(U64) * U64(0x9E3779B97F4A7C15) + node)
    share = np.minimum(children * BELOW / (ABOVE * np.maximum(sizes, 1e-9)), 0.9999999)
    take = u < (share * 2.0**64).astype(U64)
    return take, mix(u + U64(0x632BE59BD9B4E019)).view(np.int64)


def shingle_sets(column):
    """(rows, 32-bit shingles, distinct and sorted within a row; the chunk's words) by chunk."""
    for w in words(column):
        at, h = w.grams(N_GRAM, seed=1)
        parts = [(w.row[at], h)]
        bound = w.row_bounds()
        length = np.diff(bound)
        for n in range(1, N_GRAM):                     # short texts: all their words are one shingle
            rows = np.flatnonzero(length == n)
            if len(rows):
                first = bound[rows]
                total = sum(w.hash[first + k] * c for k, c in enumerate(multipliers(n, seed=n + 1)))
                parts.append((rows + w.first, mix(total)))
        row = np.concatenate([p[0] for p in parts]).astype(np.int64) - w.first
        h = np.concatenate([p[1] for p in parts]) >> U64(32)
        packed = np.unique((row.astype(U64) << U64(32)) | h)
        yield (packed >> U64(32)).astype(np.int64) + w.first, packed & U64(0xFFFFFFFF), w


def _text_keys(w) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(128-bit key of each row's word sequence as two longs, words of the row)."""
    bound = w.row_bounds()
    length = np.diff(bound)
    place = (np.arange(len(w.hash)) - np.repeat(bound[:-1], length)).astype(U64)
    keys = []
    for seed in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
        each = mix((w.hash ^ U64(seed)) + place * U64(0x9E3779B97F4A7C15))
        total = np.concatenate([np.zeros(1, U64), np.cumsum(each, dtype=U64)])
        keys.append(mix(total[bound[1:]] - total[bound[:-1]] + length.astype(U64)).view(np.int64))
    return keys[0], keys[1], length


def _records(column: pa.Array) -> pa.Array:
    n_rows = len(column)
    ka, kb, size = np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64)
    rows, paths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row, token, w in shingle_sets(column):
        part = slice(w.first, w.last)
        ka[part], kb[part], _ = _text_keys(w)
        size[part] = np.bincount(row - w.first, minlength=w.last - w.first)
        for run in range(RUNS):
            take, child = _chosen(token, size[row], mix(np.array([run + 1], U64)), ROOT_CHILDREN)
            rows.append(row[take])
            paths.append(child[take])
    row, path = np.concatenate(rows), np.concatenate(paths)
    order = np.argsort(row, kind="stable")
    offsets = np.searchsorted(row[order], np.arange(n_rows + 1)).astype(np.int32)
    none = size == 0
    return pa.StructArray.from_arrays(
        [pa.array(ka, mask=none), pa.array(kb, mask=none), pa.array(size.astype(np.int32)),
         pa.ListArray.from_arrays(pa.array(offsets), pa.array(path[order]))], ["ka", "kb", "n", "paths"])


def _sets(column: pa.Array) -> pa.Array:
    count, tokens = np.zeros(len(column), np.int64), [np.zeros(0, np.uint32)]
    for row, token, _ in shingle_sets(column):
        count += np.bincount(row, minlength=len(column))
        tokens.append(token.astype(np.uint32))
    offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(tokens).view(np.int32)))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, values) of a list column."""
    offsets = lists.offsets.to_numpy()
    return offsets - offsets[0], lists.values.to_numpy()[offsets[0]:offsets[-1]]


def _usual(lists: pa.Array) -> pa.Array:
    """The tokens that at least the share ``COMMON`` of a row's sets have."""
    offsets, out = [0], [np.zeros(0, np.int32)]
    for at in range(len(lists)):
        sets = lists[at].values
        token, count = np.unique(sets.flatten().to_numpy(), return_counts=True)
        out.append(token[count >= COMMON * len(sets)].astype(np.int32))
        offsets.append(offsets[-1] + len(out[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(out)))


def _children(node: pa.Array, tokens: pa.Array, common: pa.Array) -> pa.Array:
    """(children of each class by the tokens that aren't set aside, whether it is of the core), by runs of rows."""
    offsets, (aside_offsets, _) = _flat(tokens)[0], _flat(common)
    load, parts, at = offsets + aside_offsets, [], 0
    while at < len(node):
        stop = max(at + 1, int(np.searchsorted(load, load[at] + CHUNK_TOKENS, "right")) - 1)
        parts.append(_children_of(node[at:stop], tokens[at:stop], common[at:stop]))
        at = stop
    return pa.concat_arrays(parts or [_children_of(node, tokens, common)])


def _children_of(node: pa.Array, tokens: pa.Array, common: pa.Array) -> pa.Array:
    offsets, values = _flat(tokens)
    length = np.diff(offsets)
    row = np.repeat(np.arange(len(length), dtype=np.uint64), length) << U64(32)
    aside_offsets, aside = _flat(common)
    aside_row = np.repeat(np.arange(len(length), dtype=np.uint64), np.diff(aside_offsets)) << U64(32)
    own = ~np.isin(row | values.view(np.uint32).astype(U64), aside_row | aside.view(np.uint32).astype(U64))
    n_own = np.diff(np.concatenate([[0], np.cumsum(own)])[offsets])
    splits = n_own >= SPLIT_FROM * length
    # 0.8 of these "sizes" are the tokens that a linked class has at least in common, beside those set aside
    sizes = np.maximum(length - (length - n_own) * BELOW / ABOVE, 0.02 * length)
    at = np.repeat(mix(node.to_numpy().view(U64)), length)
    take, child = _chosen(values.view(np.uint32), np.repeat(sizes, length), at, NODE_CHILDREN)
    take &= own & np.repeat(splits, length)
    kept = np.concatenate([[0], np.cumsum(take)])[offsets].astype(np.int32)
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(kept), pa.array(child[take])),
                                       pa.array(n_own < CORE_BELOW * length)], ["paths", "core"])


def _common(offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """How many values each two lists share (lists of distinct values), as a square."""
    g = len(offsets) - 1
    owner = np.repeat(np.arange(g), np.diff(offsets))
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    total = np.zeros((g, g), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = max(256, min(1 << 14, (1 << 22) // max(g, 1)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        m = np.zeros((g, width), np.float32)
        m[owner[a:b], column[a:b] - low] = 1
        total += m @ m.T
    return total.astype(np.int32)


def brute_force(bucket: int, block: np.ndarray, own: tuple, met: tuple, cross: bool) -> tuple | None:
    """(links of each class counted here, number of the least class each reaches), or None without a hit.

    ``own``: offsets and values of the shingle sets; ``met``: of the lists of buckets.
    In a cross cell only classes of different blocks are compared."""
    size = np.diff(own[0]).astype(np.int32)
    low, high = np.minimum(size[:, None], size), np.maximum(size[:, None], size)
    possible = BELOW * low >= ABOVE * high
    np.fill_diagonal(possible, False)
    if cross:
        possible &= block[:, None] != block
    if not possible.any():
        return None
    common = _common(*own)
    hit = possible & (BELOW * common >= ABOVE * (size[:, None] + size - common))
    if not hit.any():
        return None
    del low, high, possible, common
    earlier = met[1] < bucket
    offsets = np.concatenate([[0], np.cumsum(earlier)])[met[0]]
    counted = hit & (_common(offsets, met[1][earlier]) == 0)
    least = np.arange(len(size), dtype=np.int32)
    none = np.int32(len(size))
    while True:
        new = np.minimum(least, np.where(hit, least, none).min(axis=1))
        new = new[new]
        if (new == least).all():
            return counted.sum(axis=1), least
        least = new


def _cells(batches):
    """Brute force over rows sorted by cell: (class, its links here, least class that it reaches)."""
    kind = pa.schema([("ka", pa.int64()), ("kb", pa.int64()), ("links", pa.int64()), ("ca", pa.int64()), ("cb", pa.int64())])

    def solve(table):
        bucket, i, j = (table[c].to_numpy() for c in ("bucket", "i", "j"))
        edges = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]), [True]]))
        ka, kb, block = (table[c].to_numpy() for c in ("ka", "kb", "block"))
        own, met = _flat(table["tokens"].combine_chunks()), _flat(table["buckets"].combine_chunks())
        rows = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b - a < 2:
                continue
            order = np.lexsort((kb[a:b], ka[a:b])) + a   # numbers in the order of the keys

            def cut(lists, order=order):
                length = lists[0][order + 1] - lists[0][order]
                offsets = np.concatenate([[0], np.cumsum(length)])
                return offsets, lists[1][np.repeat(lists[0][order] - offsets[:-1], length) + np.arange(offsets[-1])]

            got = brute_force(int(bucket[a]), block[order], cut(own), cut(met), bool(i[a] != j[a]))
            if got:
                links, least = got
                part = np.flatnonzero((links > 0) | (least != np.arange(b - a)))
                part = np.union1d(part, least[part])
                rows.append((ka[order][part], kb[order][part], links[part], ka[order][least[part]], kb[order][least[part]]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], schema=kind)

    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        last = [table[c][-1].as_py() for c in ("bucket", "i", "j")]
        same = np.ones(table.num_rows, bool)
        for c, v in zip(("bucket", "i", "j"), last, strict=True):
            same &= table[c].to_numpy() == v
        whole = int(np.flatnonzero(same)[0])
        yield from solve(table.slice(0, whole).combine_chunks())
        rest = table.slice(whole)
    if rest is not None and rest.num_rows:
        yield from solve(rest.combine_chunks())


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex of the edges (u, v): the least vertex that it reaches.

    Alternating stars: each round ties the larger neighbours of every vertex
    to the least one, then the smaller ones, until nothing changes; a few
    rounds, on edge rows only.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        large = materialize(large, "large")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        edges = materialize(small, "edges")
        now = tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())
        if now == before:
            break
        before = now
    return edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("v"), "root")


def _nodes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes) of one level: the rows (bucket, band, ka, kb) that may have a partner, and the
    buckets to go on with (node, bucket, low, high, size, parent and a signature of the classes).

    ``band`` is the logarithm of a set's size to the base 1.25: sets of Jaccard
    similarity 0.8 lie in the same or in neighbouring bands.  A bucket is cut
    where a band is empty, and parts of one class go."""
    sums = (rows.groupBy("bucket").agg(F.count("*").alias("size"), F.bit_or(F.expr("shiftleft(1L, band)")).alias("bands"))
            .where("size > 1 AND (bit_count(bands) < size OR (bands & shiftleft(bands, 1)) != 0)").select("bucket"))
    sums = materialize(sums, "buckets")
    rows = materialize(rows.join(sums, "bucket"), "rows")
    discard(sums)
    bands = (rows.groupBy("bucket", "band")
             .agg(F.count("*").alias("c"), F.first("parent").alias("parent"),
                  F.bit_xor(F.xxhash64("ka", "kb")).alias("s1"), F.bit_xor(F.xxhash64("kb", "ka", F.lit(1))).alias("s2")))
    order = Window.partitionBy("bucket").orderBy("band")
    gap = F.coalesce(F.col("band") - F.lag("band").over(order) > 1, F.lit(True))
    part = F.sum(F.col("gap").cast("int")).over(order)
    nodes = (bands.withColumn("gap", gap).withColumn("part", part).groupBy("bucket", "part")
             .agg(F.sum("c").alias("size"), F.first("parent").alias("parent"), F.min("band").alias("low"), F.max("band").alias("high"),
                  F.bit_xor("s1").alias("s1"), F.bit_xor("s2").alias("s2"))
             .where("size > 1").withColumn("node", F.xxhash64("bucket", "low")))
    return rows, materialize(nodes, "nodes")


def _of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(bucket, size, ka, kb) of the members of ``nodes``."""
    places = nodes.select("node", "size", F.col("bucket").alias("b"), F.explode(F.sequence("low", "high")).alias("d"))
    return (rows.join(places, (F.col("bucket") == F.col("b")) & (F.col("band") == F.col("d")))
            .select(F.col("node").alias("bucket"), "size", "ka", "kb", "band"))


def _leaves(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(bucket, size, ka, kb) of the members of ``nodes``, buckets of the same classes once."""
    first = nodes.groupBy("size", "s1", "s2").agg(F.min_by(F.struct("node", "bucket", "low", "high"), "node").alias("x"))
    return materialize(_of(rows, first.select("size", "x.*")).drop("band"), "leaves")


def _merged(leaves: DataFrame) -> DataFrame:
    """Large buckets whose member of the least hash is the same as one bucket: independent runs find a group of
    near copies again and again, each time but for a few, and two buckets have the same least member
    with the chance of their overlap.  All pairs that met still meet."""
    least = F.xxhash64(F.lit("least"), "ka", "kb")
    names = materialize(leaves.groupBy("bucket").agg(F.min(least).alias("name")), "names")
    rows = materialize(leaves.join(names, "bucket").select(F.col("name").alias("bucket"), "ka", "kb").distinct(), "merged")
    sizes = materialize(rows.groupBy("bucket").agg(F.count("*").alias("size")), "sizes")
    return materialize(rows.join(sizes, "bucket").select("bucket", "size", "ka", "kb"), "leaves")


def _set_aside(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(bucket, common): the tokens that most classes of each bucket have, by a sample of fixed size."""
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(F.xxhash64("ka", "kb"), "ka", "kb"))
    sample = members.withColumn("place", place).where(F.col("place") <= SAMPLE).select("bucket", "size", "ka", "kb")
    lists = sample.join(sets, ["ka", "kb"]).groupBy("bucket").agg(F.collect_list("tokens").alias("lists"))
    return materialize(lists.select("bucket", F.arrow_udf(_usual, "array<int>")("lists").alias("common")), "set-aside")


def _split(texts: DataFrame, build_sets) -> tuple[DataFrame, DataFrame]:
    """((bucket, size, ka, kb) of the final buckets of all paths, the sets of their classes)."""
    band = F.least(F.lit(62), F.floor(F.log(F.col("n")) / F.log(F.lit(BELOW / ABOVE)) + 1e-9)).cast("int")
    rows = texts.select(F.explode("paths").alias("bucket"), "ka", "kb", band.alias("band"), F.lit(None).cast("bigint").alias("parent"))
    leaves, sets, paths = [], None, None
    for depth in range(1, MAX_DEPTH + 1):
        rows, nodes = _nodes(rows)
        if sets is None:
            # classes of deeper buckets are among those of the first ones that are split
            split = F.max((F.col("size") > BUCKET).cast("int")).alias("split")
            wanted = materialize(_of(rows, nodes).groupBy("ka", "kb").agg(split), "wanted")
            sets = build_sets(wanted)
            splitting = sets.where("split = 1").select("ka", "kb", "tokens")
            discard(wanted)
        final = (F.col("size") <= BUCKET) | (F.col("size") >= STUCK * F.coalesce("parent", F.lit(float("inf")))) | F.lit(depth == MAX_DEPTH)
        leaves.append(_leaves(rows, nodes.where(final)))
        hot = nodes.where(~final)
        last = hot.isEmpty()
        members = None if last else materialize(_of(rows, hot), "hot")
        discard(rows, nodes, paths)
        if last:
            break
        common = _set_aside(members, splitting)
        children = F.arrow_udf(_children, "struct<paths:array<bigint>,core:boolean>").asNondeterministic()
        none = F.array().cast("array<int>")
        paths = (members.join(splitting, ["ka", "kb"]).join(common, "bucket", "left")
                 .select("bucket", "ka", "kb", "band", F.col("size").alias("parent"),
                         children("bucket", "tokens", F.coalesce("common", none)).alias("x"))
                 .select("bucket", "ka", "kb", "band", "parent", "x.*"))
        paths = materialize(paths, "paths")
        discard(members, common)
        core, nodes = _nodes(paths.where("core").select(F.xxhash64("bucket", F.lit("core")).alias("bucket"), "ka", "kb", "band", "parent"))
        leaves.append(_leaves(core, nodes))
        discard(core, nodes)
        rows = paths.select("ka", "kb", "band", "parent", F.explode("paths").alias("bucket"))
    union = leaves[0]
    for part in leaves[1:]:
        union = union.unionByName(part)
    return union.where(F.col("size") <= BUCKET).unionByName(_merged(union.where(F.col("size") > BUCKET))), sets


def _candidates(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(records, texts, leaves, sets): (doc_id, t, ka, kb, n) per row; per class of equal texts its
    first row and number of rows; its final buckets; the sets of classes in any bucket, those of large ones (split = 1) apart."""
    docs = documents.select("doc_id", F.xxhash64("text").alias("t"), "text")
    record = F.arrow_udf(_records, _RECORD).asNondeterministic()
    whole = materialize(docs.select("doc_id", "t", record("text").alias("r")).select("doc_id", "t", "r.*"), "records")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "t")
    texts = (whole.where("n > 0").groupBy("ka", "kb")
             .agg(F.min(first).alias("first"), F.first("paths").alias("paths"), F.first("n").alias("n"), F.count("*").alias("copies")))
    texts = materialize(texts, "texts")
    records = materialize(whole.drop("paths"), "rows-of-texts")
    discard(whole)

    def sets(wanted: DataFrame) -> DataFrame:
        named = texts.join(wanted, ["ka", "kb"]).select("ka", "kb", "split", F.col("first.doc_id").alias("w"), F.col("first.t").alias("wt"))
        k1, k2 = row_key("w", "wt")
        named = materialize(named.select("ka", "kb", "split", k1.alias("k1"), k2.alias("k2")), "named")
        k1, k2 = row_key("doc_id", "t")
        found = docs.select(k1.alias("k1"), k2.alias("k2"), "text").join(named, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
        out = materialize(found.select("ka", "kb", "split", F.arrow_udf(_sets, "array<int>")("text").alias("tokens")), "sets", ("split",))
        discard(named)
        return out

    leaves, tokens = _split(texts, sets)
    return records, texts, leaves, tokens


def _solved(cells: DataFrame, members: DataFrame, name: str) -> DataFrame:
    """(ka, kb, links, ca, cb) of the classes with a hit in ``cells`` (bucket, i, j, block, ka, kb)."""
    rows = (cells.join(members, ["ka", "kb"])
            .repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), "bucket", "i", "j")
            .sortWithinPartitions("bucket", "i", "j"))
    return materialize(rows.mapInArrow(_cells, "ka long, kb long, links long, ca long, cb long"), name)


def _roots(found: DataFrame) -> DataFrame:
    """(ka, kb, root) of the classes that any hit ties to another."""
    roots = components(found.select(F.struct(F.col("ka").alias("a"), F.col("kb").alias("b")).alias("u"),
                                    F.struct(F.col("ca").alias("a"), F.col("cb").alias("b")).alias("v")))
    return roots.select(F.col("v.a").alias("ka"), F.col("v.b").alias("kb"), "root")


def _own_root() -> F.Column:
    return F.struct(F.col("ka").alias("a"), F.col("kb").alias("b"))


def join(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, texts, links): as ``_candidates``, and per linked class its links and root."""
    records, texts, leaves, tokens = _candidates(documents)
    met = leaves.groupBy("ka", "kb").agg(F.collect_set("bucket").alias("buckets"))
    n = F.ceil(F.col("size") / BLOCK).cast("int")
    cells = (leaves.withColumn("block", F.when(F.col("size") <= BLOCK, F.lit(0)).otherwise(F.pmod(F.xxhash64("ka", "kb"), n).cast("int")))
             .withColumn("k", F.explode(F.when(F.col("size") <= BLOCK, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n - 1))))
             .select("bucket", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "block", "ka", "kb"))
    found = _solved(cells, tokens.select("ka", "kb", "tokens").join(met, ["ka", "kb"]), "found")
    discard(tokens)
    links = found.groupBy("ka", "kb").agg(F.sum("links").alias("links")).join(_roots(found), ["ka", "kb"], "left")
    return records, texts, links.select("ka", "kb", "links", F.coalesce("root", _own_root()).alias("root"))


def ties(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, texts, links) with the same roots as ``join``, without counting links.

    A bucket above ``STAR`` classes is cut into blocks, and each block is compared with the bucket's
    ``STAR_REPRESENTATIVES`` only: a group of near copies is tied together by rows in proportion to
    it.  What then still isn't in a bucket's largest group is compared with all of the bucket."""
    records, texts, leaves, tokens = _candidates(documents)
    members = tokens.select("ka", "kb", "tokens", F.array().cast("array<bigint>").alias("buckets"))
    small = leaves.where(F.col("size") <= STAR).select("bucket", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("block"), "ka", "kb")
    large = materialize(leaves.where(F.col("size") > STAR).select("bucket", "size", "ka", "kb"), "large-buckets")
    n = F.ceil(F.col("size") / STAR).cast("int")
    own = large.select("bucket", F.pmod(F.xxhash64("ka", "kb"), n).cast("int").alias("i"), F.lit(-1).alias("j"), F.lit(0).alias("block"), "ka", "kb")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(F.xxhash64("kb", "ka"), "ka", "kb"))
    stars = (large.withColumn("place", place).where(F.col("place") <= STAR_REPRESENTATIVES)
             .select("bucket", F.explode(F.sequence(F.lit(0), n - 1)).alias("i"), F.lit(-1).alias("j"), F.lit(1).alias("block"), "ka", "kb"))
    found = _solved(small.unionByName(own).unionByName(stars), members, "found")
    roots = materialize(_roots(found), "roots")

    labelled = large.join(roots, ["ka", "kb"], "left").withColumn("root", F.coalesce("root", _own_root()))
    labelled = materialize(labelled, "labelled")
    groups = labelled.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    main = groups.groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("size"), F.max("n").alias("most"))
    main = materialize(main.where("most < size").withColumn("rest", F.col("size") - F.col("most")).drop("most", "size"), "main-groups")
    if not main.isEmpty():
        m = F.ceil(F.col("rest") / STAR).cast("int")
        open_ = labelled.join(main, "bucket")
        queries = (open_.where("root != main")
                   .select("bucket", F.pmod(F.xxhash64("ka", "kb"), m).cast("int").alias("i"), F.explode(F.sequence(F.lit(1), n)).alias("k"), "ka", "kb")
                   .select("bucket", "i", (-F.col("k")).alias("j"), F.lit(0).alias("block"), "ka", "kb"))
        all_ = (open_.select("bucket", F.explode(F.sequence(F.lit(0), m - 1)).alias("i"), (-1 - F.pmod(F.xxhash64("ka", "kb"), n).cast("int")).alias("j"),
                             F.lit(1).alias("block"), "ka", "kb"))
        rest = _solved(queries.unionByName(all_), members, "found-rest")
        roots = _roots(found.unionByName(rest))
    links = roots.select("ka", "kb", F.lit(None).cast("bigint").alias("links"), "root")
    return records, texts, links


def _classes(texts: DataFrame, links: DataFrame) -> DataFrame:
    """(ka, kb, first row of the text, its copies, links, first row of its near-duplicate class)."""
    joined = (texts.drop("paths", "n").join(links, ["ka", "kb"], "left")
              .withColumn("links", F.coalesce("links", F.lit(0).cast("bigint")))
              .withColumn("root", F.coalesce("root", F.struct(F.col("ka").alias("a"), F.col("kb").alias("b")))))
    joined = materialize(joined, "joined")
    heads = materialize(joined.groupBy("root").agg(F.min("first").alias("head")), "heads")
    return joined.join(heads, "root").drop("root")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, class_id, copy_of, n_copies, n_links) for each row.

    ``class_id`` is the least id of the rows that links connect, ``copy_of`` the
    least id of the rows of the same words, ``n_copies`` their number, and
    ``n_links`` the number of different texts linked to this one.  A row
    without words is a class of its own.
    """
    records, texts, links = join(documents)
    classes = materialize(_classes(texts, links), "classes")
    rows = records.select("doc_id", "ka", "kb").where("n > 0").join(classes, ["ka", "kb"])
    out = rows.select("doc_id", F.col("head.doc_id").alias("class_id"), F.col("first.doc_id").alias("copy_of"),
                      F.col("copies").alias("n_copies"), F.col("links").alias("n_links"))
    alone = records.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"),
                                          F.lit(1).cast("bigint").alias("n_copies"), F.lit(0).cast("bigint").alias("n_links"))
    return out.unionByName(alone)


def one_of_each(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each near-duplicate class: that of the least id.

    Rows without words stay, once for each id and text."""
    records, texts, links = ties(documents)
    heads = _classes(texts, links).select("head.doc_id", "head.t").distinct()
    alone = records.where("n = 0").select("doc_id", "t").distinct()
    keep = materialize(heads.unionByName(alone), "keep").select(F.col("doc_id").alias("__keep"), F.col("t").alias("__keep_t"))
    columns, t = documents.columns, fresh(documents, "t")
    names = [fresh(documents, "k1"), fresh(documents, "k2")]
    keep = keep.select(*[k.alias(n) for k, n in zip(row_key("__keep", "__keep_t"), names, strict=True)])
    rows = documents.withColumn(t, F.xxhash64("text"))
    rows = rows.withColumns(dict(zip(names, row_key("doc_id", t), strict=True)))
    return rows.join(keep, names).dropDuplicates(names).select(*columns)
