"""Object collections, vector search and text retrieval.

The reference keeps objects (properties + vector + id) in a vector store and
asks it for the nearest objects to a text.  Here a collection is a table
``(uuid, properties struct, vector array<float>)`` and search is a Spark job:

* dense top-k (``top_k_similar``): queries go in tiles of a fixed size; every
  task scores its slice of the collection against a tile with matrix products
  and keeps its own top-k per query, so the shuffle carries ``k x queries``
  rows per task, never the pairs;
* text retrieval (``text_vectors`` / ``search_text``): TF-IDF weights in long
  form ``(doc, term, weight)``.  Texts are dealt by document before they are
  split into terms, so term counts and scores of a document stay in its task.
  What a term is joined to is a written table, so Spark broadcasts it where it
  is small, and else AQE can split the rows of a word that most documents hold
  (it can't where an aggregation lies between a join and its shuffle).  The
  number of tasks grows with the characters of the texts and with the rows, so
  that what a task counts or sorts stays the same at any size; from where this
  is more than the session's partitions, a word with more rows than a task
  takes is dealt to several by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.functions.hashing import row_uuid
from ledgerlight.functions.text import tokens
from ledgerlight.operators.pruning import best_scores
from ledgerlight.plans.lineage import dealt, materialize, tasks_for

# Search depth of near-text (3) and question (1) search.
NEAR_TEXT_K = 3
QUESTION_K = 1

SCORE_DIGITS = 6

#: Queries shipped to the tasks at a time, and corpus rows scored at a time.
QUERY_TILE, ROW_TILE = 4096, 1024
#: Characters that a task splits into terms and counts (some 160 MB), and rows (document, term) that it sorts.
TASK_CHARS, TASK_ROWS = 4_000_000, 500_000
#: Up to this many terms, Spark decides alone how their frequencies reach the rows: it broadcasts them.
FEW_TERMS = 1 << 19


# -- collections --------------------------------------------------------------

def collection(df: DataFrame, properties: list[str], vector_col: str, class_name: str) -> DataFrame:
    """Objects of a class: id from the properties, nested properties, the vector."""
    return df.select(
        row_uuid(class_name, properties).alias("uuid"),
        F.struct(*properties).alias("properties"),
        F.col(vector_col).alias("vector"))


def flatten(coll: DataFrame) -> DataFrame:
    """Properties as top-level columns next to the id and vector."""
    return coll.select("uuid", "properties.*", "vector")


def lookup(coll: DataFrame, ids: DataFrame, key: str = "uuid") -> DataFrame:
    """Objects whose id is in ``ids`` (V5), as a semi join."""
    return coll.join(ids.select(key).distinct(), key, "left_semi")


# -- dense vectors ---------------------------------------------------------------

def centroids(df: DataFrame, group_col: str, vector_col: str) -> DataFrame:
    """Element-wise mean vector per group, in double precision.

    Exploded to (group, position) so the mean is a partial+final aggregate;
    one group holding most rows is reduced map-side.
    """
    parts = df.select(group_col, F.posexplode(vector_col).alias("pos", "x"))
    means = parts.groupBy(group_col, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    ordered = means.groupBy(group_col).agg(
        F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("pm"))
    return ordered.select(F.col(group_col).alias("query_id"),
                          F.transform("pm", lambda s: s["m"]).alias("vector"))


def _query_tiles(queries: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, unit vectors) of up to ``QUERY_TILE`` queries at a time; null and zero vectors left out."""
    def unit(tile):
        mat = np.array([v for _, v in tile], dtype=np.float64)
        return np.array([q for q, _ in tile], dtype=np.int64), mat / np.linalg.norm(mat, axis=1, keepdims=True)

    tile = []
    for q, v in queries.select("query_id", "vector").where("vector IS NOT NULL").toLocalIterator():
        if any(v):
            tile.append((q, list(v)))
        if len(tile) == QUERY_TILE:
            yield unit(tile)
            tile = []
    if tile:
        yield unit(tile)


def top_k_similar(queries: DataFrame, corpus: DataFrame, k: int, id_col: str,
                  vector_col: str = "vector") -> DataFrame:
    """The ``k`` corpus rows most cosine-similar to each query.

    ``queries``: (query_id integral, vector array), any number: each tile of
    them is one pass over the corpus.  Ties on the rounded score go to the
    smaller id.  A null or zero vector has no direction: it is similar to
    nothing, as a query and as a corpus row.  Output: query_id, rank,
    <id_col>, similarity.
    """
    spark = corpus.sparkSession
    schema = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType),
                           T.StructField(id_col, corpus.schema[id_col].dataType),
                           T.StructField("similarity", T.DoubleType())])
    rows = corpus.select(id_col, vector_col).where(F.col(vector_col).isNotNull())
    partial = None
    for tile in _query_tiles(queries):
        best = rows.mapInPandas(_scorer(spark.sparkContext.broadcast(tile), k, id_col, vector_col), schema)
        partial = best if partial is None else partial.unionByName(best)
    if partial is None:
        partial = spark.createDataFrame([], schema)
    rank = F.row_number().over(Window.partitionBy("query_id")
                               .orderBy(F.col("similarity").desc(), F.col(id_col)))
    return (partial.withColumn("rank", rank).where(F.col("rank") <= k)
                   .select("query_id", F.col("rank").cast("long").alias("rank"), id_col, "similarity"))


def _scorer(tile, k: int, id_col: str, vector_col: str):
    """A task's top ``k`` rows per query of the tile, folded over its batches."""
    digits, step = SCORE_DIGITS, ROW_TILE

    # Runs on the Python workers: self-contained (numpy, pandas and captured
    # values only), so it pickles by value and needs no package on executors.
    def score(batches):
        import numpy as np
        import pandas as pd

        query_ids, queries = tile.value
        floor = np.full(len(query_ids), -np.inf)          # a query's k-th best so far
        kept_j, kept_id, kept_s = np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0)
        for pdf in batches:
            for at in range(0, len(pdf), step):
                part = pdf.iloc[at:at + step]
                ids, x = part[id_col].to_numpy(), np.stack(part[vector_col].to_numpy()).astype(np.float64)
                norms = np.linalg.norm(x, axis=1)
                ids, x = ids[norms > 0], x[norms > 0] / norms[norms > 0, None]
                if not len(ids):
                    continue
                sims = np.round(queries @ x.T, digits)    # (queries, rows)
                if len(ids) > k:
                    floor = np.maximum(floor, np.partition(sims, len(ids) - k, axis=1)[:, len(ids) - k])
                j, i = np.nonzero(sims >= floor[:, None])
                j, found, s = (np.concatenate(c) for c in ((kept_j, j), (kept_id, ids[i]), (kept_s, sims[j, i])))
                order = np.lexsort((found, -s, j))
                j, found, s = j[order], found[order], s[order]
                place = np.arange(len(j)) - np.searchsorted(j, j)
                kept_j, kept_id, kept_s = j[place < k], found[place < k], s[place < k]
                last = np.flatnonzero(place == k - 1)
                floor[j[last]] = s[last]
        if len(kept_j):
            yield pd.DataFrame({"query_id": query_ids[kept_j], id_col: kept_id, "similarity": kept_s})

    return score


# -- text retrieval ----------------------------------------------------------------

def term_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf) over the whole text, a document's rows in one partition."""
    chars = docs.select(F.sum(F.length(text_col))).first()[0] or 0
    tasks = tasks_for(chars, TASK_CHARS)
    texts = docs.select(id_col, text_col)
    return (dealt(texts.repartition(id_col), tasks, id_col)
            .select(id_col, F.explode(tokens(F.col(text_col))).alias("term"))
            .groupBy(id_col, "term").agg(F.count("*").alias("tf")))


def document_frequency(tf: DataFrame) -> DataFrame:
    """(term, df): documents containing each term; partial aggregation absorbs stop words."""
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def _idf(df_col: Column, n_docs: Column) -> Column:
    return F.ln((n_docs + F.lit(1.0)) / (df_col + F.lit(1.0)))


def _normalise(weights: DataFrame, id_col: str, tasks: int = 1) -> DataFrame:
    # a document's rows are its distinct terms: the window group is bounded
    # by the vocabulary of one text, not by the data size
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return dealt(weights, tasks, id_col).withColumn("weight", F.col("w") / norm).drop("w")


def _fitted(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, Column]:
    """Term counts (written), document frequencies (written) and the number of documents."""
    tf = materialize(term_counts(docs, id_col, text_col), "tf")   # tokenised once, read by every use
    return tf, materialize(document_frequency(tf), "df"), docs.select(F.count("*").cast("double")).scalar()


def _with_frequency(tf: DataFrame, dfs: DataFrame, id_col: str, tasks: int) -> DataFrame:
    """``tf`` with the ``df`` of each term, sorted by term in ``tasks`` tasks where there are many terms and rows.

    Terms with more than ``TASK_ROWS`` rows (at most as many as tasks) go to several tasks by document.
    """
    if tasks <= int(tf.sparkSession.conf.get("spark.sql.shuffle.partitions")) or dfs.count() <= FEW_TERMS:
        return tf.join(dfs, "term")
    shares = F.floor(F.col("df") / TASK_ROWS).cast("int") + 1
    hot = dfs.select("term", shares.alias("_shares")).where("_shares > 1")
    share = F.coalesce(F.pmod(F.xxhash64(id_col), F.col("_shares")).cast("int"), F.lit(0))
    rows = tf.join(F.broadcast(hot), "term", "left").withColumn("_share", share).drop("_shares")
    spread = dfs.withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1)))
    keys = ["term", "_share"]
    return rows.repartition(tasks, *keys).join(spread.repartition(tasks, *keys), keys).drop("_share")


def text_vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """Unit-length TF-IDF vectors in long form plus the fitted (term, df) table and N."""
    tf, dfs, n_docs = _fitted(docs, id_col, text_col)
    tasks = tasks_for(tf.count(), TASK_ROWS)
    w = _with_frequency(tf, dfs, id_col, tasks).select(id_col, "term", (F.col("tf") * _idf(F.col("df"), n_docs)).alias("w"))
    return _normalise(w, id_col, tasks), dfs, n_docs


def query_terms(queries: DataFrame, dfs: DataFrame, n_docs: Column, query_id: str, text_col: str = "text") -> DataFrame:
    """(query, term, qw): unit TF-IDF vectors of query texts, the terms that occur in the documents (written)."""
    absent = _idf(F.coalesce(F.col("df"), F.lit(0)), n_docs)
    weights = _normalise(term_counts(queries, query_id, text_col).join(dfs, "term", "left")
                         .select(query_id, "term", "df", (F.col("tf") * absent).alias("w")), query_id)
    return materialize(weights.where(F.col("df").isNotNull())
                       .select(query_id, "term", F.col("weight").alias("qw")), "query-terms")


def search_text(queries: DataFrame, docs: DataFrame, k: int = 1,
                query_id: str = "item_id", doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Top-``k`` documents per query text by TF-IDF cosine (V6 retrieval, V7).

    cosine(q, d) = sum_t qw_t * dw_t over the unit vectors of ``text_vectors``,
    the query's written as a table of (query, term, weight).  Only documents that
    can be among a query's best are scored (``pruning``).  Where the query tables
    are small enough for Spark to broadcast them, a document's scores are summed
    where its vector lies; a window group limit then leaves ``k`` rows per
    query and task to shuffle.  Ties go to the smaller document id.
    """
    vectors, dfs, n_docs = text_vectors(docs, doc_id, text_col)
    q_terms = query_terms(queries, dfs, n_docs, query_id, text_col)
    scores = best_scores(vectors, q_terms, k, query_id, doc_id).withColumn("score", F.round("score", SCORE_DIGITS))
    rank = F.row_number().over(Window.partitionBy(query_id)
                               .orderBy(F.col("score").desc(), F.col(doc_id)))
    return (scores.withColumn("rank", rank).where(F.col("rank") <= k)
                  .select(query_id, F.col("rank").cast("long").alias("rank"), doc_id, "score"))
