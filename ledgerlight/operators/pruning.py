"""Exact top-k of sparse dot products without scoring the pairs that can't win (V4, V6).

A query's score of a document is the sum of ``qw * weight`` over the terms they
share.  Scoring every pair that shares a term means nearly all pairs, as common
words are in nearly every text.  Here a term's rows are told apart by weight, in
layers of powers of two, and a query works in three steps:

1. *seeds*: the heaviest document of each of the query's ``SEEDS`` most promising
   (term, layer) entries is scored exactly; the k-th best of these is a score that
   every result must reach;
2. *candidates*: entries are set aside while what they can add at most, summed over
   the query, stays below that score, those with most rows per unit of score first.
   A document that lies in set-aside entries only can't win, so the others alone
   make candidates; of these go the ones whose sum so far, with all that was set
   aside, is still below it;
3. *scores*: the candidates are scored over all shared terms.

Common words weigh little and have most rows, so they are set aside and cost
nothing.  A query with fewer than ``k`` seeds sets nothing aside: its result is
exact as well.  Rows that are read are dealt by document right after the join on
the term (which AQE can split, as no aggregation follows before the shuffle); the
candidates of a document are summed and scored in its task, and the number of these
tasks grows with the rows.  What a query holds is bounded by its terms times ``LAYERS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.plans.lineage import dealt, materialize, tasks_for

#: Layers of a term's weights (the last is open) and entries of a query whose heaviest document is scored first.
LAYERS, SEEDS = 12, 48
#: Scores are compared after rounding to six digits, and sums differ in their last bits.
SLACK = 2e-6
#: Rows (document, term) that a task sorts to score its documents.
TASK_ROWS = 500_000


def layered(vectors: DataFrame, q_terms: DataFrame) -> DataFrame:
    """The rows of ``vectors`` (doc, term, weight) that any query reads, with their layer of weight."""
    layer = F.when(F.col("weight") > 2.0 ** -LAYERS, F.floor(-F.log2("weight"))).otherwise(LAYERS)
    asked = q_terms.select("term").distinct()
    return vectors.join(asked, "term", "left_semi").withColumn("layer", F.greatest(layer, F.lit(0)).cast("int"))


def query_entries(q_terms: DataFrame, postings: DataFrame, doc_id: str) -> DataFrame:
    """(query, term, qw, layer, n, top, heaviest): the entries of each query, with their rows and largest weight."""
    entries = postings.groupBy("term", "layer").agg(
        F.count("*").alias("n"), F.max("weight").alias("top"), F.max_by(doc_id, "weight").alias("heaviest"))
    return q_terms.join(entries, "term")


def scores(pairs: DataFrame, postings: DataFrame, q_terms: DataFrame, query_id: str, doc_id: str, tasks: int = 1) -> DataFrame:
    """(doc, query, score) of distinct (doc, query) pairs over all their shared terms."""
    return (pairs.join(dealt(postings.select(doc_id, "term", "weight"), tasks, doc_id), doc_id).join(q_terms, [query_id, "term"])
            .groupBy(doc_id, query_id).agg(F.sum(F.col("qw") * F.col("weight")).alias("score")))


def floors(entries: DataFrame, postings: DataFrame, q_terms: DataFrame, k: int, query_id: str, doc_id: str) -> DataFrame:
    """(query, floor): the k-th best score of the query's seeds, for queries with ``k`` seeds."""
    promising = Window.partitionBy(query_id).orderBy((F.col("qw") * F.col("top")).desc(), "term", "layer")
    pairs = (entries.withColumn("place", F.row_number().over(promising)).where(F.col("place") <= SEEDS)
             .select(query_id, F.col("heaviest").alias(doc_id)).distinct())
    best = Window.partitionBy(query_id).orderBy(F.col("score").desc(), doc_id)
    return (scores(pairs, postings, q_terms, query_id, doc_id).withColumn("place", F.row_number().over(best))
            .where(F.col("place") == k).select(query_id, F.col("score").alias("floor")))


def read_entries(entries: DataFrame, least: DataFrame, query_id: str) -> DataFrame:
    """(query, term, layer, qw, n, floor, aside): the entries that must be read; ``aside`` is what the others can add.

    A term's layers are set aside from its smallest weights up: each costs its
    largest weight over that of the layer below.  The order is by rows per cost,
    lowered to the smallest of the term's lower layers, so it keeps to that.
    """
    up = Window.partitionBy(query_id, "term").orderBy(F.col("layer").desc())
    cost = F.col("qw") * (F.col("top") - F.coalesce(F.lag("top").over(up), F.lit(0.0)))
    rows = entries.join(least, query_id, "left").withColumn("cost", cost)
    rows = rows.withColumn("rate", F.when(F.col("cost") > 0, F.col("n") / F.col("cost")).otherwise(F.lit(1e300)))
    rows = rows.withColumn("rate", F.min("rate").over(up))
    order = (Window.partitionBy(query_id).orderBy(F.col("rate").desc(), "term", F.col("layer").desc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = F.coalesce(F.sum("cost").over(order) < F.col("floor") - SLACK, F.lit(False))
    rows = rows.withColumn("cut", cut)
    whole = Window.partitionBy(query_id)
    aside = F.sum(F.when(F.col("cut"), F.col("cost")).otherwise(0.0)).over(whole)
    return (rows.withColumn("aside", aside).where(~F.col("cut"))
            .select(query_id, "term", "layer", "qw", "n", F.coalesce("floor", F.lit(0.0)).alias("floor"), "aside"))


def _tasks(to_read: DataFrame, postings: DataFrame) -> int:
    """Tasks by the rows that the queries read (each entry knows its own) or those of all entries."""
    return tasks_for(max(to_read.agg(F.sum("n")).first()[0] or 0, postings.count()), TASK_ROWS)


def candidates(to_read: DataFrame, postings: DataFrame, query_id: str, doc_id: str, tasks: int = 1) -> DataFrame:
    """(doc, query) pairs that can still be among the best."""
    read = postings.join(to_read.drop("n"), ["term", "layer"]).repartition(doc_id)
    return (dealt(read, tasks, doc_id).groupBy(doc_id, query_id)
            .agg(F.sum(F.col("qw") * F.col("weight")).alias("part"), F.first("floor").alias("floor"), F.first("aside").alias("aside"))
            .where(F.col("part") + F.col("aside") >= F.col("floor") - SLACK).select(doc_id, query_id))


def prepare(vectors: DataFrame, q_terms: DataFrame, k: int, query_id: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """(postings of the queries' terms, the entries that queries must read), both written tables."""
    postings = materialize(layered(vectors, q_terms), "postings")
    entries = materialize(query_entries(q_terms, postings, doc_id), "query-entries")
    least = materialize(floors(entries, postings, q_terms, k, query_id, doc_id), "query-floors")
    return postings, materialize(read_entries(entries, least, query_id), "read-entries")


def best_scores(vectors: DataFrame, q_terms: DataFrame, k: int, query_id: str, doc_id: str) -> DataFrame:
    """(doc, query, score) with at least the ``k`` best documents of each query, ties at the last place included.

    ``vectors``: (doc, term, weight), one row per document and term, weights not
    negative; ``q_terms``: (query, term, qw), a written table.  Queries without a
    term that occurs have no row.
    """
    postings, to_read = prepare(vectors, q_terms, k, query_id, doc_id)
    tasks = _tasks(to_read, postings)
    return scores(candidates(to_read, postings, query_id, doc_id, tasks), postings, q_terms, query_id, doc_id, tasks)
