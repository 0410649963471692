"""Hard rows of the training-data operators: long texts, ids beside nulls, clashing columns, many copies, and the pipeline as a whole."""

import re
import time
from collections import Counter

from pyspark.sql import functions as F

from ledgerlight.llm import mixing, pseudonyms


def test_every_day_is_permuted_in_every_form(spark):
    """All days of 1900 to 2099: each form's images are different, and the key goes back."""
    days = spark.range(0, 72899).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    forms = [F.date_format("day", f) for f in ("yyyy-MM-dd", "dd.MM.yyyy", "MM/dd/yyyy")]
    forms.append(F.when(F.dayofmonth("day") > 12, F.date_format("day", "dd/MM/yyyy")))
    docs = days.select(F.explode(F.array(*forms)).alias("text")).where("text IS NOT NULL").withColumn("doc_id", F.col("text")).repartition(4)
    out = pseudonyms.pseudonymised(docs, "k").cache()
    n = docs.count()
    assert out.select("text").distinct().count() == n == out.where("text != doc_id OR text = doc_id").count()
    assert out.where("text != doc_id").count() > 0.99 * n
    assert pseudonyms.reveal(out, "k").where("text != doc_id").count() == 0
    linked = out.where("doc_id LIKE '____-__-__'").select(F.date_format(F.to_date("doc_id"), "dd.MM.yyyy").alias("doc_id"), F.date_format(F.to_date("text"), "dd.MM.yyyy").alias("iso"))
    assert linked.join(out, "doc_id").where("iso != text").count() == 0
    out.unpersist()


def test_pseudonyms_of_long_texts_take_time_in_proportion(spark):
    kinds = {"dots": ("x@", "a."), "at": ("", "@"), "digits": ("", "1"), "groups": ("+1 ", "12 "), "addresses": ("", "a.b-c%d+e_f."), "ibans": ("", "GB82 ")}

    def run(n):
        rows = [(k, start + unit * (n // len(unit)) + " end 12") for k, (start, unit) in kinds.items()]
        begin = time.perf_counter()
        got = pseudonyms.pseudonymised(spark.createDataFrame(rows, "doc_id string, text string"), "k").collect()
        assert all(len(r.text) == len(t) for r, (_, t) in zip(sorted(got), sorted(rows), strict=True))
        return time.perf_counter() - begin

    run(4000)
    short, long = run(250_000), run(1_000_000)
    assert long < 6 * short + 5


def test_addresses_within_the_standards_lengths(spark):
    local, domain = "q" * 64, "d" * 60 + "." + "e" * 60 + ".example.org"
    rows = [(1, f"{local}@{domain}"), (2, "first.last@sub.example.co.uk, 12"), (3, "a@b.c 12"), (4, "x@" + "y" * 300 + ".com 12")]
    out = {r.doc_id: r.text for r in pseudonyms.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    assert out[1] != rows[0][1] and out[1].endswith("@" + domain)
    assert re.fullmatch(r"[a-z]{5}\.[a-z]{4}@sub\.example\.co\.uk, 12", out[2]) and out[2] != rows[1][1]
    assert out[3] == rows[2][1] and out[4] == rows[3][1]


DOCS = "doc_id long, text string, lang string, source string, n_chars long, m string, taken_copies string, __r string, h string"


def test_mix_keeps_ids_beside_nulls(spark):
    big = 2**53 + 1
    rows = [(big + 2 * k, "w " * (20 + k), "en", "s", 0, "a", "b", "c", "d") for k in range(6)] + [(None, "w w w", "en", "s", 0, *"abcd"), (None, None, None, None, None, *"abcd")]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.plan(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    mixed = mixing.mixed(docs)
    assert mixed.columns == [*docs.columns, "size", "copies", "taken"]
    taken = {r.doc_id: r.copies for r in got if r.copies}
    assert {r.doc_id: r.copies for r in mixed.collect()} == taken
    assert all((r.m, r.taken_copies, r["__r"], r.h) == ("a", "b", "c", "d") for r in mixed.collect())


def test_mix_of_very_many_copies_of_one_row(spark):
    n = 1_000_000
    docs = spark.range(0, n, 1, 6).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("two words").alias("text"), F.lit("a").alias("source"))
    docs = docs.unionByName(spark.createDataFrame([(k, "x " * 300, "b") for k in range(500)], "doc_id long, text string, source string"))
    got = mixing.plan(docs).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("copies").alias("c"), F.max("copies").alias("most")).where("doc_id = 7").first()
    part = mixing.mixed(docs).where("doc_id = 7 AND source = 'a'").agg(F.count("*").alias("n"), F.sum("copies").alias("c"), F.max("copies").alias("most")).first()
    assert part.c <= got.c and got.n == n + 1 and part.most <= 2 and part.n <= n
    sizes = mixing.plan(docs).where("size = 2")
    assert sizes.agg(F.sum("copies")).first()[0] == part.c
