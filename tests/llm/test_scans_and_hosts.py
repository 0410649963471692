"""The toxicity scan on long texts, and op7's join for a host with most pages."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from ledgerlight.llm import toxicity, url_reputation


def _all_maximal(totals):
    """Maximal-scoring segments by their definition: take the best (shortest of equals), go on left and right of it."""
    if not totals:
        return []
    best = max(((sum(totals[i:j + 1]), i - j, -i, j) for i in range(len(totals)) for j in range(i, len(totals))))
    value, first, last = best[0], -best[2], best[3]
    if value <= 0:
        return []
    left = _all_maximal(totals[:first])
    right = [(a + last + 1, b + last + 1, s) for a, b, s in _all_maximal(totals[last + 1:])]
    return left + [(first, last, value)] + right


def test_all_maximal_segments_equal_their_definition():
    rnd = random.Random(4)
    for _ in range(400):
        score = [rnd.choice([-3, -2, -1, 1, 2, 3]) + rnd.random() / 64 for _ in range(rnd.randint(0, 14))]
        got = toxicity.segments(np.arange(len(score)), np.array(score), 0.2)
        want = _all_maximal(score)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_the_scan_is_linear_on_alternating_scores():
    def seconds(n, pattern):
        score = np.tile(np.array(pattern), n // len(pattern))
        start = time.process_time()
        toxicity.segments(np.arange(len(score)), score, 0.2)
        return time.process_time() - start

    for pattern in ([1.0, -2.0], [2.0, -1.0], [1.0, -2.0, 3.0, -1.5]):
        seconds(4000, pattern)
        short, long = seconds(40_000, pattern), seconds(320_000, pattern)
        assert long < 8 * 4 * max(short, 0.02)             # a quadratic scan takes 64 times as long


def test_pages_of_a_hot_host_are_all_judged_and_hosts_are_not_repeated(spark):
    urls = [(i, "http://hot.example/a" if i % 3 else f"http://h{i}.test/b") for i in range(600)] + [(None, None), (7, "nothing")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(300)], "doc_id long, quality int")
    out = url_reputation.judged(pages, labels)
    assert out.count() == len(urls)
    assert out.where("host = ''").count() == 2
    assert out.where(F.col("verdict").isNull()).count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan
