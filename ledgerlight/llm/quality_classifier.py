"""Quality classifier: hashed word n-grams, logistic regression, FTRL updates.

Words are runs of letters and digits or runs of symbols, in their own case;
a document's features are its distinct hashed words and word pairs (2, 3 or 4
equal words in a row make one shared feature each), each weighted 1/sqrt(count).
The weights are trained with follow-the-regularised-leader (proximal, L1 and
L2) on a bounded hash sample of labelled documents whose features are built
by Spark; scoring is a sparse dot product per document beside the scan: no
shuffle, and the texts stay in the JVM rows.

Nulls and empty texts have no features and score the intercept.  Repeated
rows score alike.  With no labelled row, or labels of one kind only, the
score is the smoothed share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import labelled_sample
from ledgerlight.llm.words import U64, mix, words

#: Bits of the feature hash: 2**18 weights, 1 MB, broadcast.
BITS = 18
#: Labelled documents that the weights are fitted on, at most (about).
MAX_LABELLED = 12_000
#: Updates of the fit: few examples are passed over more often.
UPDATES = 36_000
THRESHOLD = 0.3
#: Features of 2, 3 and 4 equal words in a row, whichever word it is.
REPEATS = {n: U64(0x5851F42D4C957F2D * n % (1 << 64)) for n in (2, 3, 4)}


@dataclass
class Model:
    weights: np.ndarray
    intercept: float


def features(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, feature) pairs of an Arrow string column, distinct within a row, by chunk."""
    for w in words(column, lower=False, split_symbols=True):
        grams = [(w.row, w.hash)]
        if len(w.hash) > 1:
            h, same_row = w.hash, w.row[1:] == w.row[:-1]
            twice = same_row & (h[1:] == h[:-1])
            with np.errstate(over="ignore"):
                pair = mix(h[:-1] * U64(0x9E3779B97F4A7C15) + h[1:])
            pair[twice] = REPEATS[2]
            grams.append((w.row[1:][same_row], pair[same_row]))
            run = twice                                # n-grams of one word said again and again
            for n in (3, 4):
                run = run[1:] & twice[:len(run) - 1]
                grams.append((w.row[:len(run)][run], np.full(int(run.sum()), REPEATS[n])))
        row = np.concatenate([g[0] for g in grams])
        hashed = np.concatenate([g[1] for g in grams]) >> U64(64 - BITS)
        yield np.divmod(np.unique((row.astype(np.int64) << BITS) | hashed.astype(np.int64)), 1 << BITS)


def _feature_lists(text: pa.Array) -> pa.Array:
    count, parts = np.zeros(len(text), np.int64), [np.zeros(0, np.int32)]
    for row, feature in features(text):
        count += np.bincount(row, minlength=len(text))
        parts.append(feature.astype(np.int32))
    offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts)))


def ftrl(examples: list[np.ndarray], labels: np.ndarray, updates: int = UPDATES, alpha: float = 2.0,
         beta: float = 1.0, l1: float = 0.01, l2: float = 0.01, seed: int = 7) -> Model:
    """FTRL-proximal over sparse examples (arrays of distinct feature numbers), in whole
    passes of shuffled examples until ``updates`` are made."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = 1 << BITS
    rng = np.random.default_rng(seed)
    share = labels.mean()                             # the rarer label's rows weigh more, up to twofold
    cost = np.minimum(2.0, np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)))

    def weights(i, free):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        w[np.abs(zi) <= l1] = 0
        if free:                                      # the intercept isn't regularised
            w[-1] = -zi[-1] / ((beta + np.sqrt(n[i[-1]])) / alpha)
        return w

    for _ in range(max(2, -(-updates // len(examples)))):
        for k in rng.permutation(len(examples)):
            i = np.append(examples[k], bias)
            x = np.full(len(i), 1 / np.sqrt(max(1, len(i) - 1)))
            x[-1] = 1.0
            w = weights(i, True)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = cost[k] * (p - labels[k]) * x
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - s * w
            n[i] += g * g
    every = np.arange((1 << BITS) + 1)
    w = weights(every, True)
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def train(documents: DataFrame, labels: DataFrame, in_training: Column, column: str = "quality",
          max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on labelled rows of ``in_training``; Spark builds the features, the bounded
    sample of feature lists comes to the driver for the sequential updates."""
    chosen = labelled_sample(labels, column, in_training, max_labelled)
    sample = (documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
              .select("doc_id", "label", F.arrow_udf(_feature_lists, "array<int>")("text").alias("f"))
              .toArrow().combine_chunks())
    label = sample["label"].to_numpy().astype(float)
    lists = sample["f"].combine_chunks() if len(sample) else None
    if not len(label) or label.min() == label.max():
        share = (label.sum() + 1) / (len(label) + 2)
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    ids = sample["doc_id"].to_numpy()
    order = np.lexsort((np.diff(offsets), ids))
    return ftrl([values[offsets[k]:offsets[k + 1]] for k in order], label[order])


def score_column(spark, model: Model, text: Column) -> Column:
    """P(label 1) of a text, by a sparse dot product."""
    shipped = spark.sparkContext.broadcast((model.weights, model.intercept))

    def score(column: pa.Array) -> pa.Array:
        weights, intercept = shipped.value
        total, count = np.zeros(len(column)), np.zeros(len(column))
        for row, feature in features(column):
            total += np.bincount(row, weights[feature], minlength=len(column))
            count += np.bincount(row, minlength=len(column))
        margin = intercept + total / np.sqrt(np.maximum(count, 1))
        return pa.array(1 / (1 + np.exp(-np.clip(margin, -35, 35))))

    return F.arrow_udf(score, "double").asNondeterministic()(text)


def scored(documents: DataFrame, model: Model, name: str) -> DataFrame:
    """``documents`` with the score in column ``name``."""
    return documents.withColumn(name, score_column(documents.sparkSession, model, F.col("text")))
