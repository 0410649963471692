"""Texts packed into files of a bounded size with stable names."""

import random

from pyspark.sql import functions as F

from ledgerlight.sources import files

BOUND = 300


def _rows(seed=1, n=900):
    rng = random.Random(seed)
    rows = [(0 if rng.random() < 0.7 else rng.randrange(1, 5), f"c{k:04d}", "x" * rng.choice((0, 3, 40, 90))) for k in range(n)]
    rows += [(0, "c9999", "\u00e9" * 500), (2, "c9998", None), (3, "c0007", "tie"), (3, "c0007", "tie"), (3, "c0007", "a tie")]
    rng.shuffle(rows)
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "folder int, call string, text string")


def _brute(rows):
    """(folder, file) -> texts, by walking each folder's rows in order."""
    out, before = {}, {}
    for folder, call, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "")):
        at = before.get(folder, 0)
        out.setdefault((folder, at // BOUND), []).append(text)
        before[folder] = at + len((text or "").encode()) + 1
    return out


def test_files_equal_a_walk_in_order_under_any_partitioning(spark):
    rows = _rows()
    want = _brute(rows)
    for parts in (1, 7):
        got = files.pack(_frame(spark, rows).repartition(parts), "folder", ["call"], "text", BOUND).collect()
        found = {}
        for r in sorted(got, key=lambda r: (r.folder, r.call, r.text or "")):
            found.setdefault((r.folder, r.file), []).append(r.text)
        assert found == want


def test_written_files_are_bounded_and_named_by_the_rows(spark, tmp_path):
    rows, listings = _rows(), []
    for k, parts in enumerate((1, 5)):
        root = files.write_text_files(_frame(spark, rows).repartition(parts), str(tmp_path / f"calls{k}"), "folder", ["call"], "text", BOUND)
        listings.append({r.name: (r.folder, r.size) for r in files.list_files(spark, root).collect()})
        assert files.list_files(spark, root).count() == len(listings[k])        # a file alone under each name
    want = {f"folder={f}/file={n}": (str(f), sum(len((t or "").encode()) + 1 for t in texts)) for (f, n), texts in _brute(rows).items()}
    assert listings == [want, want]
    longest = max(len((t or "").encode()) + 1 for *_, t in rows)
    assert all(size < BOUND + longest for _, size in want.values())
    assert files.files_like(files.list_files(spark, root), "folder=2/").where("folder != '2'").count() == 0


def test_the_number_of_files_follows_the_data_and_no_texts_make_none(spark):
    count = [files.pack(_frame(spark, _rows(n=n)), "folder", ["call"], "text", BOUND).select("folder", "file").distinct().count() for n in (400, 1600)]
    assert count[1] > 3 * count[0]
    assert files.pack(_frame(spark, []), "folder", ["call"], "text", BOUND).count() == 0


def test_a_hot_folder_is_spread_over_slices(spark):
    hot = spark.range(40_000).select(F.lit(1).alias("folder"), F.col("id").cast("string").alias("call"), F.lit("word " * 10).alias("text"))
    packed = files.pack(hot, "folder", ["call"], "text", 1 << 12)
    sizes = packed.groupBy("file").count().collect()
    assert len(sizes) > 400 and max(r["count"] for r in sizes) <= (1 << 12) // 51 + 1
