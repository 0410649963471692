"""``corpus_pipeline.run`` as a whole: what each stage keeps against plain Python over its own input, and empty tables."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlight.llm import pseudonyms, quality_classifier
from ledgerlight.llm.common import in_fold
from tests.llm.test_llm import WORD, brute_classes, lower

SMALL = "/root/testdata/sf0.001"
EXTRA = ["m", "score", "label", "h", "__score", "item_id"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables, with extra columns of clashing names, nulls, empty texts, near copies and repeated rows."""
    root = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{root}/{name}.parquet")
    copies = docs.where("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 10_000).withColumn("text", F.concat("text", F.lit(" The END 12")))
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").where("text IS NOT NULL").orderBy("item_id").first().text
    leaked = docs.where("doc_id >= 20 AND doc_id < 26").withColumn("doc_id", F.col("doc_id") + 20_000).withColumn("text", F.concat("text", F.lit(" " + item.upper() + " end")))
    hard = spark.createDataFrame([(None, None, None, None, None), (30_000, "", None, None, 0), (30_001, " \n", "en", "s", 2), (None, "a few words of nobody", "en", None, 4)],
                                 docs.schema)
    rows = docs.unionByName(copies).unionByName(leaked).unionByName(hard).unionByName(docs.where("doc_id < 3"))
    rows.select("*", *[F.lit(c).alias(c) for c in EXTRA]).repartition(5).write.parquet(f"{root}/documents.parquet")
    return root


@pytest.fixture(scope="module")
def stages(spark, folder):
    """The rows that each stage got and gave, and the columns of each."""
    kept, materialize = {}, corpus_pipeline.materialize
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(corpus_pipeline, "materialize", lambda df, name: kept.setdefault(name.removeprefix("pipeline-"), materialize(df, name)))
        last = corpus_pipeline.run(spark, folder)
    frames = {"documents": spark.read.parquet(f"{folder}/documents.parquet"), **kept, "mix": last}
    return {name: (df.columns, df.collect()) for name, df in frames.items()}


def test_columns(stages):
    first = stages["documents"][0]
    assert list(stages) == ["documents", *[name for name, _ in corpus_pipeline.STAGES]]
    assert all(stages[name][0] == first for name in list(stages)[:-1])
    assert stages["mix"][0] == [*first, "size", "copies", "taken"]


def test_quality(spark, folder, stages):
    model = quality_classifier.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"), ~in_fold(5, 0))

    def good(text):
        numbers = [int(k) for _, f in quality_classifier.features(pa.array([text], pa.string())) for k in f]
        margin = model.intercept + sum(float(model.weights[k]) for k in numbers) / max(1, len(numbers)) ** 0.5
        return 1 / (1 + np.exp(-margin)) >= quality_classifier.THRESHOLD

    assert Counter(stages["quality"][1]) == Counter(r for r in stages["documents"][1] if good(r.text))


def test_near_duplicates(stages):
    rows, kept = stages["quality"][1], stages["near_duplicates"][1]
    assert not Counter(kept) - Counter(rows)
    _, find = brute_classes(rows)
    classes = [find(w) for w in (tuple(WORD.findall(lower(r.text))) for r in kept) if w]
    assert Counter(classes) == Counter({find(w) for w in (tuple(WORD.findall(lower(r.text))) for r in rows) if w})
    assert len(classes) < sum(bool(WORD.findall(lower(r.text))) for r in rows)


def test_decontaminate(spark, folder, stages):
    number = {}

    def numbers(text):
        return np.array([number.setdefault(w, len(number)) for w in WORD.findall(lower(text))], np.int64)

    items = [numbers(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]

    def leaks(document):
        for item in items:
            span = min(13, len(item))
            if not span or len(document) < span:
                continue
            same = (document[:, None] == item[None, :]).astype(np.int64)
            rows, columns = len(document) - span + 1, len(item) - span + 1
            equal = sum(same[k:k + rows, k:k + columns] for k in range(span))
            if equal.max() >= (10 if span == 13 else span):
                return True
        return False

    rows = stages["near_duplicates"][1]
    want = [r for r in rows if not leaks(numbers(r.text))]
    assert Counter(stages["decontaminate"][1]) == Counter(want) and len(want) < len(rows)


def test_pii(spark, folder, stages):
    columns, rows = stages["decontaminate"]
    given, out = Counter(rows), stages["pii"][1]
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    revealed = pseudonyms.reveal(spark.createDataFrame(out, schema), pseudonyms.KEY).select(*columns).collect()
    assert Counter(revealed) == given and sum((Counter(out) - given).values()) > 0


def test_mix(stages):
    columns, given = stages["pii"]
    units = Counter(given)
    mixed = stages["mix"][1]
    assert not Counter(tuple(r[c] for c in columns) for r in mixed) - Counter({tuple(r): n for r, n in units.items()})
    assert all(r.size == len(WORD.findall(r.text or "")) and r.taken == r.size * r.copies and 1 <= r.copies <= 2 for r in mixed)
    share = {s: 0 for s in {r.source for r in given}}
    for r in given:
        share[r.source] += len(WORD.findall(r.text or ""))
    total = sum(share.values())
    ordered = sorted((s for s in share if s is not None)) + [s for s in share if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(ordered)}
    target, free, rest = {}, set(ordered), 1.5 * total
    while free:
        per = rest / sum(weight[s] for s in free)
        above = {s for s in free if per * weight[s] > 2 * share[s]}
        if not above:
            target |= {s: per * weight[s] for s in free}
            break
        target |= {s: 2.0 * share[s] for s in above}
        rest -= sum(2 * share[s] for s in above)
        free -= above
    largest = max(r.size for r in mixed)
    for s in ordered:
        assert abs(sum(r.taken for r in mixed if r.source == s) - target[s]) <= 2 * largest


def test_empty_tables_pass_through(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns[-3:] == ["size", "copies", "taken"]
