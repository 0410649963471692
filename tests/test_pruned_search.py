"""Pruned text search against a brute-force version of the same score."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from ledgerlight.operators import pruning, vectors


def _brute(queries, docs, k):
    """Top-k by TF-IDF cosine, every pair that shares a term scored; a term's share of a unit vector as in ``vectors``."""
    counts = {i: Counter(t.split()) for i, t in docs}
    df = Counter(t for c in counts.values() for t in c)
    idf = lambda t: math.log((len(docs) + 1) / (df[t] + 1))

    def unit(c):
        norm = math.sqrt(sum((n * idf(t)) ** 2 for t, n in c.items()))
        return {t: n * idf(t) / norm for t, n in c.items()}

    units = {i: unit(c) for i, c in counts.items() if c}
    out = []
    for q, text in queries:
        if not text.split():
            continue
        uq = unit(Counter(text.split()))
        found = sorted((-round(sum(uq[t] * u[t] for t in u if t in uq), 6), i) for i, u in units.items() if set(u) & set(uq))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return out


def _texts(seed, n):
    """Texts of common and rare words, some very alike, some repeated, some empty, one long."""
    rnd = random.Random(seed)
    words = [f"w{j}" for j in range(400)]
    weight = [1 / (j + 1) for j in range(400)]
    texts = [" ".join(rnd.choices(words, weight, k=rnd.randint(1, 40))) for _ in range(n)]
    texts[5], texts[11], texts[12] = texts[4], "", texts[4] + " w399"
    texts[20] = " ".join(rnd.choices(words, weight, k=3000))
    return texts


def _same(got, want):
    got = sorted((r.item_id, r.rank, r.doc_id, r.score) for r in got)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) <= 1.1e-6 for g, w in zip(got, want, strict=True))


def test_equals_brute_force_for_any_k(spark):
    docs = list(enumerate(_texts(1, 300)))
    queries = [(1000 + i, t) for i, (_, t) in enumerate(docs[:25])] + [(2000, "w0"), (2001, "w0 w1 w2"), (2002, "unknown"), (2003, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(queries, "item_id long, text string")
    for k in (1, 3, 20):
        _same(vectors.search_text(q, d, k=k).collect(), _brute(queries, docs, k))


def test_fewer_documents_than_k(spark):
    docs = [(1, "a b"), (2, "b c"), (3, "d e")]
    queries = [(7, "b"), (8, "e d"), (9, "x")]
    found = vectors.search_text(spark.createDataFrame(queries, "item_id long, text string"),
                                spark.createDataFrame(docs, "doc_id long, text string"), k=5)
    _same(found.collect(), _brute(queries, docs, 5))


def test_a_word_in_every_text_only(spark):
    """Without weight on any shared word all scores are 0: the smallest ids are returned."""
    docs = [(i, f"the own{i}") for i in range(8)]
    queries = [(7, "the other")]
    found = vectors.search_text(spark.createDataFrame(queries, "item_id long, text string"),
                                spark.createDataFrame(docs, "doc_id long, text string"), k=3)
    assert sorted((r.rank, r.doc_id, r.score) for r in found.collect()) == [(1, 0, 0.0), (2, 1, 0.0), (3, 2, 0.0)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert vectors.search_text(none, docs).collect() == []
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert vectors.search_text(q, docs.limit(0)).collect() == []


def test_common_words_make_no_candidates(spark):
    docs = [(i, f"the and of name{i} part{i % 40}") for i in range(2000)]
    queries = [(i, f"the and of name{i} part{i % 40}") for i in range(0, 2000, 100)]
    weights, dfs, n_docs = vectors.text_vectors(spark.createDataFrame(docs, "doc_id long, text string"))
    terms = vectors.query_terms(spark.createDataFrame(queries, "item_id long, text string"), dfs, n_docs, "item_id")
    postings, to_read = pruning.prepare(weights, terms, 1, "item_id", "doc_id")
    assert to_read.where(F.col("term").isin("the", "and", "of")).count() == 0
    left = pruning.candidates(to_read, postings, "item_id", "doc_id").collect()
    assert {(r.item_id, r.doc_id) for r in left} >= {(i, i) for i, _ in queries}
    assert len(left) <= 20 * 50                       # all pairs: 20 x 2000
