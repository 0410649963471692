"""Toxicity by maximum-scoring segments over token log-odds.

Tokens (lower-cased runs of letters and digits or of symbols) get the log-odds
of toxic against other labelled documents, each document counting a token once,
under a Dirichlet prior shaped like the corpus; tokens whose likelihood ratio is
significant make the lexicon, any other token costs ``DRIFT``.  A linear-time scan finds all maximal-scoring segments
of a text.  Under the null (the tokens of non-toxic documents) the best score
of a text of n tokens follows an extreme-value law with the decay ``lam`` at
which the mean of exp(lam * score) is 1, so a segment of score S has about
K * n * exp(-lam * S) equals by chance; segments for which that is below
``CHANCE`` are significant, and their evidence adds up to the document's.  A
logistic curve turns the evidence into the share of label 1.

Counting runs in Spark over the labelled training rows (a bounded hash sample)
with partial sums per batch; only the lexicon, bounded by ``LEXICON``, reaches
the driver.  Scoring happens beside the scan.  Null and empty texts have no
evidence and score the curve's lowest value.  Without labels of both kinds the
score is the smoothed share of label 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import labelled_sample
from ledgerlight.llm.words import words
from ledgerlight.plans.lineage import materialize

#: Labelled rows that the lexicon and the curve are fitted on, at most (about).
MAX_LABELLED = 40_000
LEXICON = 20_000
PRIOR, SIGNIFICANT, LIMIT, DRIFT = 1000.0, 4.5, 6.0, 0.2
K, CHANCE, THRESHOLD = 0.1, 0.05, 0.3
MAX_EVIDENCE = 50.0


@dataclass
class Model:
    tokens: np.ndarray        # sorted uint64 hashes
    scores: np.ndarray
    lam: float
    intercept: float
    slope: float


def _counts(batches):
    """(token, toxic texts that have it, others), summed per batch."""
    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False)
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for w in words(batch.column(0), lower=True, split_symbols=True):
            order = np.lexsort((w.row, w.hash))
            h, row = w.hash[order], w.row[order]
            once = np.ones(len(h), bool)
            once[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            token, at = np.unique(h[once], return_inverse=True)
            c1 = np.bincount(at, label[row[once]] == 1, minlength=len(token)).astype(np.int64)
            parts.append((token, c1, np.bincount(at, minlength=len(token)) - c1))
        token, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = [np.bincount(at, np.concatenate([p[k] for p in parts]), minlength=len(token)).astype(np.int64) for k in (1, 2)]
        yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), *map(pa.array, sums)], ["token", "c1", "c0"])


def segments(place: np.ndarray, score: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first place, last place, score), best order of places.

    ``place``: positions of the scored tokens, ascending; every other position costs ``drift``.  Each held
    segment knows the last one before it whose total before is lower, so that no search steps over the
    same segments twice: the scan is linear in the scored tokens."""
    held: list[tuple] = []                    # (first, last, total before, total through, last lower one)
    total, behind = 0.0, -1
    for at, s in zip(place.tolist(), score.tolist(), strict=True):
        total -= drift * (at - behind - 1)
        behind = at
        if s <= 0:
            total += s
            continue
        first, low, high = at, total, total + s
        total = high
        k = len(held) - 1
        while True:
            while k >= 0 and held[k][2] >= low:
                k = held[k][4]
            if k < 0 or held[k][3] >= high:
                held.append((first, at, low, high, k))
                break
            first, low, lower = held[k][0], held[k][2], held[k][4]
            del held[k:]
            k = lower
    return [(a, b, high - low) for a, b, low, high, _ in held]


def evidence(column, tokens: np.ndarray, scores: np.ndarray, lam: float) -> tuple[np.ndarray, list]:
    """(evidence per row, significant segments per row: (first word, last word, score))."""
    total, found = np.zeros(len(column)), [[] for _ in range(len(column))]
    for w in words(column, lower=True, split_symbols=True):
        if not len(tokens) or not len(w.hash):
            continue
        at = np.minimum(np.searchsorted(tokens, w.hash), len(tokens) - 1)
        known = np.flatnonzero(tokens[at] == w.hash)
        score = scores[at[known]]
        bound = w.row_bounds()
        length, row = np.diff(bound), w.row[known]
        for r in np.unique(row[score > 0]):
            a, b = np.searchsorted(row, [r, r + 1])
            base = bound[r - w.first]
            chance = np.log(K * length[r - w.first])
            for first, last, s in segments(known[a:b] - base, score[a:b], DRIFT):
                e = lam * s - chance
                if e > -np.log(CHANCE):
                    total[r] += e
                    found[r].append((first, last, s))
    return np.minimum(total, MAX_EVIDENCE), found


def _decay(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum(share * exp(lam * scores)) = 1, the rest of the share at -DRIFT."""
    rest = max(0.0, 1 - share.sum())
    mean = lambda lam: share @ np.exp(np.minimum(lam * scores, 50)) + rest * np.exp(-lam * DRIFT)
    if not (scores > 0).any() or share @ scores - rest * DRIFT >= 0:
        return 0.5
    low, high = 0.0, 1.0
    while mean(high) < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if mean(mid) < 1 else (low, mid)
    return max(0.05, low)


def _logistic(x: np.ndarray, y1: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Intercept and slope (not below 0) by Newton steps, lightly regularised."""
    w = np.zeros(2)
    design = np.stack([np.ones(len(x)), x], axis=1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (y1 - n * p) - 0.01 * w
        hess = (design * (n * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def train(documents: DataFrame, labels: DataFrame, in_training: Column, column: str = "toxic",
          max_labelled: int = MAX_LABELLED) -> Model:
    chosen = labelled_sample(labels, column, in_training, max_labelled)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")
    none = np.zeros(0, np.uint64), np.zeros(0)
    n1, n0 = (x or 0 for x in chosen.agg(F.sum("label"), F.sum(1 - F.col("label"))).first())
    if not n1 or not n0:
        share = (n1 + 1) / (n1 + n0 + 2)
        return Model(*none, 1.0, float(np.log(share / (1 - share))), 0.0)
    counts = (rows.mapInArrow(_counts, "token long, c1 long, c0 long").groupBy("token")
              .agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0")))
    counts = materialize(counts, "tokens")
    t1, t0 = (float(x or 0) for x in counts.agg(F.sum("c1"), F.sum("c0")).first())
    prior = F.lit(PRIOR / max(t1 + t0, 1)) * (F.col("c1") + F.col("c0"))
    odds = lambda c, t: F.log((F.col(c) + prior) / (F.lit(t + PRIOR) - F.col(c) - prior))
    delta = odds("c1", t1) - odds("c0", t0)
    # signed root of the likelihood ratio of the two shares of documents
    share = float(n1) / (n1 + n0)
    both = F.col("c1") + F.col("c0")
    part = lambda c, e: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (both * e))).otherwise(0.0)
    z = F.signum(delta) * F.sqrt(F.greatest(F.lit(0.0), 2 * (part("c1", share) + part("c0", 1 - share))))
    lexicon = (counts.select("token", "c0", delta.alias("delta"), z.alias("z")).where(F.abs("z") > SIGNIFICANT)
               .orderBy(F.abs("z").desc(), "token").limit(LEXICON).toPandas())
    token = lexicon["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    token, score = token[order], np.clip(lexicon["delta"].to_numpy(float)[order], -LIMIT, LIMIT)
    lam = _decay(score, lexicon["c0"].to_numpy(float)[order] / max(t0, 1.0))
    model = Model(token, score, lam, 0.0, 1.0)
    curve = (rows.select("label", F.round(evidence_column(documents.sparkSession, model, F.col("text")), 1).alias("x"))
             .groupBy("x").agg(F.sum("label").alias("y"), F.count("*").alias("n")).orderBy("x").toPandas())
    model.intercept, model.slope = _logistic(*(curve[c].to_numpy(float) for c in ("x", "y", "n")))
    return model


def evidence_column(spark, model: Model, text: Column) -> Column:
    shipped = spark.sparkContext.broadcast((model.tokens, model.scores, model.lam))

    def score(column: pa.Array) -> pa.Array:
        return pa.array(evidence(column, *shipped.value)[0])

    return F.arrow_udf(score, "double").asNondeterministic()(text)


def passages(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, first_word, last_word, score) of every significant toxic passage."""
    shipped = documents.sparkSession.sparkContext.broadcast((model.tokens, model.scores, model.lam))
    kind = pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("score", pa.float64())])

    def find(column: pa.Array) -> pa.Array:
        found = evidence(column, *shipped.value)[1]
        return pa.array([[dict(zip(("first_word", "last_word", "score"), s, strict=True)) for s in row] for row in found], pa.list_(kind))

    spans = F.arrow_udf(find, "array<struct<first_word:int,last_word:int,score:double>>").asNondeterministic()
    return documents.select("doc_id", F.explode(spans("text")).alias("s")).select("doc_id", "s.*")


def scored(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``documents`` with the probability of label 1 in column ``name``."""
    margin = F.lit(model.intercept) + F.lit(model.slope) * evidence_column(documents.sparkSession, model, F.col("text"))
    return documents.withColumn(name, 1 / (1 + F.exp(-margin)))
