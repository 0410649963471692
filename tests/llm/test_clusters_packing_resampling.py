"""Clustering, packing and resampling against brute force, on small fixtures with hard cases: nulls,
empty and very long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import centroids, packing, queries, resampling

TEXTS = "doc_id long, text string, n_features string, bin string, part string, offset string, uid string"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgXYZ09é", k=rng.randint(1, 8))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(120)]
    texts += [None, "", "  \n\n ", "don't  we'll\n\n\n x", "日本語 ελληνικά ١٢٣ ​<|endoftext|> é", "x" * 70 + " tail",
              " ".join(rng.choices(words, k=9000)), "one two " * 8]
    rows = [(k, t, "a", "b", "c", "d", "e") for k, t in enumerate(texts)]
    rows += [(None, "an unnamed text of a few words", *"abcde")] * 2 + [rows[3]] * 3
    return spark.createDataFrame(rows, TEXTS).repartition(5)


# -- clustering -----------------------------------------------------------------------

def brute_clusters(rows, k=8, rounds=10):
    """rows: (vec_id, integer vector); exact integers throughout."""
    def key(r):
        return (r[0] is None, "" if r[0] is None else hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])

    centres = [r[1] for r in sorted(rows, key=key)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), n) for n, c in enumerate(centres)) for _, x in rows]

    for _ in range(rounds):
        own = defaultdict(list)
        for (_, x), (_, n) in zip(rows, assign(), strict=True):
            own[n].append(x)
        for n, part in own.items():
            centres[n] = [sum(column) // len(part) for column in zip(*part, strict=True)]
    best = assign()
    inertia = Counter()
    for d, n in best:
        inertia[n] += d
    return Counter((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest())
                   for (i, _), (d, n) in zip(rows, best, strict=True))


def result(df):
    return Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


VECTORS = "vec_id long, embedding array<float>, cluster string, near string, x string"


def test_clusters_equal_brute_force_and_leave_out_broken_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(k, [float(np.float32(v)) for v in rng.normal(size=6)], "a", "b", "c") for k in range(90)]
    good += [good[4], good[4], (None, good[7][1], "a", "b", "c"), (200, [0.0] * 6, "a", "b", "c"), (201, [0.0] * 6, "a", "b", "c")]
    bad = [(300, None), (301, [1.0] * 5), (302, [1.0] * 7), (303, [1.0] * 5 + [None]), (304, [1.0] * 5 + [float("nan")]),
           (305, [1.0] * 5 + [float("-inf")]), (306, []), (307, [1.0] * 5 + [1e30])]
    df = spark.createDataFrame(good + [(i, v, "a", "b", "c") for i, v in bad], VECTORS).repartition(4)
    whole = [(r[0], [math.floor(1024 * v) for v in r[1]]) for r in good]
    assert result(centroids.clusters(df, dimensions=6)) == brute_clusters(whole)
    few = spark.createDataFrame(good[:3], VECTORS)
    assert result(centroids.clusters(few, dimensions=6)) == brute_clusters(whole[:3])
    none = centroids.clusters(df.where("vec_id >= 300"), dimensions=6)
    assert none.count() == 0 and none.columns == centroids.clusters(few, dimensions=6).columns


def test_clusters_of_equal_vectors_fall_to_the_smaller_number(spark):
    rows = [(k, [0.5] * 4, "a", "b", "c") for k in range(12)]
    out = centroids.clusters(spark.createDataFrame(rows, VECTORS), dimensions=4).collect()
    assert {r.cluster for r in out} == {0} and {r.distance for r in out} == {0}


def test_ptolemaic_bounds_hold_and_spare_checks():
    rng = np.random.default_rng(2)
    centres = rng.integers(-2000, 2000, (12, 16))
    x = np.concatenate([c + rng.integers(-60, 60, (50, 16)) for c in centres])
    moved = centres + rng.integers(-20, 20, centres.shape)
    pivots = centroids.spread(centres, 8)
    pairs = centroids.pivot_pairs(pivots)
    near = centroids.to_pivots(x, pivots)
    true = ((x[:, None, :] - moved[None]) ** 2).sum(axis=2)
    assert (centroids.lower_bounds(near, centroids.to_pivots(moved, pivots), pairs) <= true).all()
    which, best, checked = centroids.nearest(x, near, moved, pivots, pairs)
    assert (which == true.argmin(axis=1)).all() and (best == true.min(axis=1)).all()
    assert checked.mean() < 4


def test_bounds_never_exceed_distances_of_large_and_equal_components():
    rng = np.random.default_rng(3)
    x = rng.integers(-(1 << 27), 1 << 27, (200, 8))
    x[:50] = x[0]
    pivots = centroids.spread(x, 6)
    bound = centroids.lower_bounds(centroids.to_pivots(x, pivots), centroids.to_pivots(x[:20], pivots), centroids.pivot_pairs(pivots))
    true = ((x[:, None, :] - x[None, :20]) ** 2).sum(axis=2)
    assert (bound <= true).all()


# -- packing --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    with open(queries.TOKENIZER, encoding="utf-8") as f:
        return f.read()


def tokenizer(vocabulary):
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(vocabulary)
    t.encode_special_tokens = True
    return t


def test_words_of_the_rule_give_the_tokenizers_ids(vocabulary):
    ids, t, rng = packing.encoder(vocabulary), tokenizer(vocabulary), random.Random(9)
    alphabet = "ab Z09'\n\t\r\x0b\x1c\x85\xa0.,!?-_#é߿ЖΩ'sll‘’“”…—€日本ا١²½　\U0001f600<|endoftext|>"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)] + ["<|endoftext|>", "a" * 3000, " " * 50, "'S 's 'll'll"]
    for text in texts:
        assert np.frombuffer(ids(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_plain_character_is_split_as_the_tokenizer_splits_it(vocabulary):
    ids, t, odd = packing.encoder(vocabulary), tokenizer(vocabulary), re.compile(f"[^{packing.PLAIN}]")
    plain = [c for c in map(chr, range(0x2100)) if not odd.match(c)]
    assert len(plain) > 1000
    for c in plain:
        text = f"a{c}b {c}{c} 1{c}2"
        assert np.frombuffer(ids(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, hex(ord(c))


def test_the_plain_split_is_the_rules_split():
    """The faster split of plain texts gives the words of the rule, in any context."""
    import regex
    split, rule, rng = packing.plain_split(), regex.compile(packing.SPLIT).findall, random.Random(7)
    plain = re.findall(f"[{packing.PLAIN}]", "".join(map(chr, range(0x2100))))
    alphabet = ["'", "'s", "'ll", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "a", "é", "7", "²", "]", "^", "-", "\\", "’"] * 20 + plain
    for _ in range(20_000):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 12)))
        assert split(text) == rule(text), repr(text)
    assert split("".join(plain)) == rule("".join(plain))


def test_words_merged_once_stay_for_the_workers_next_task(vocabulary, monkeypatch):
    ids = packing.encoder(vocabulary)
    first = ids("merged but once, unquestionably")
    monkeypatch.setattr(packing.Merges, "__missing__", lambda self, w: pytest.fail(f"{w!r} was merged again"))
    assert packing.encoder(vocabulary)("merged but once, unquestionably") == first


def hold(rows, docs, vocabulary, length):
    """Whole documents, in pieces by the rule, in sequences without gaps or overflow; the number of sequences."""
    t = tokenizer(vocabulary)
    expected = Counter()
    for r in docs.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [0]
        for piece, (start, n) in enumerate(packing.cuts(len(ids), length)):
            expected[r.doc_id, piece, start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(sequences)


@pytest.mark.parametrize("length,part", [(2048, 8192), (64, 16), (200, 40)])
def test_packing_is_whole_gapless_and_near_the_bound(spark, docs, vocabulary, monkeypatch, length, part):
    monkeypatch.setattr(packing, "PART", part)
    rows = packing.packed(docs, vocabulary, length).collect()
    used = hold(rows, docs, vocabulary, length)
    bound = packing.lower_bound(np.bincount([r.length for r in rows], minlength=length + 1), length)
    assert bound <= used <= bound + (1 if part > 1000 else 5)


def test_packing_of_no_documents_and_of_many_empty_ones(spark, docs, vocabulary, monkeypatch):
    assert packing.packed(docs.where("doc_id < 0"), vocabulary).count() == 0
    monkeypatch.setattr(packing, "PART", 100)
    empty = spark.range(0, 900).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    rows = packing.packed(empty, vocabulary, 64).collect()
    assert len(rows) == 900 and len({r.sequence_id for r in rows}) == math.ceil(900 / 64)


def fewest(lengths, room):
    """Least number of bins, by trying all."""
    best = [len(lengths)]

    def place(at, bins):
        if len(bins) >= best[0]:
            return
        if at == len(lengths):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[at] <= room and bins[k] not in bins[:k]:
                place(at + 1, bins[:k] + [bins[k] + lengths[at]] + bins[k + 1:])
        place(at + 1, [*bins, lengths[at]])

    place(0, [])
    return best[0]


def test_lower_bounds_never_exceed_the_least_number_and_beat_the_total():
    rng, beats = random.Random(4), 0
    for _ in range(150):
        room = rng.choice([10, 24, 30])
        lengths = sorted((rng.randint(1, room) if rng.random() < 0.5 else rng.randint(room // 4, room // 2 + 2) for _ in range(9)), reverse=True)
        bound, least = packing.lower_bound(np.bincount(lengths, minlength=room + 1), room), fewest(lengths, room)
        assert bound <= least
        beats += bound > math.ceil(sum(lengths) / room)
        where, used = packing.best_fit(np.array(lengths), room)
        assert used >= least and (np.bincount(where, lengths) <= room).all()
    assert beats > 20


def test_a_repacked_partition_never_needs_more_sequences():
    rng = np.random.default_rng(6)
    for _ in range(50):
        lengths = rng.integers(1, 60, 80)
        where, offset, _ = packing.repacked(lengths, np.arange(80), 100)
        assert len(set(where.tolist())) <= 80 and (offset + lengths <= 100).all()
        again, _, _ = packing.repacked(lengths, where, 100)
        assert len(set(again.tolist())) <= len(set(where.tolist()))


# -- resampling -----------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def found(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_resample(rows, items):
    buckets = [[zlib.crc32(w.encode()) % 10000 for w in found(r.text)] for r in rows]
    own = Counter(itertools.chain.from_iterable(buckets))
    target = Counter(zlib.crc32(w.encode()) % 10000 for t in items for w in found(t))
    s, t = sum(own.values()), sum(target.values())
    gain = [math.floor(1000 * math.log((target[b] + 1) * (s + 10000) / ((own[b] + 1) * (t + 10000)))) for b in range(10000)]
    out = []
    for r, b in zip(rows, buckets, strict=True):
        weight = sum(gain[x] for x in b) // len(b) if b else 0
        h = int(hashlib.sha256(f"2024:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16)
        out.append([r.doc_id, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[:10 * len(able) // 100], 1):
        r[4] = rank
    return Counter(map(tuple, out))


def test_resampling_equals_brute_force(spark, docs):
    items = spark.createDataFrame([(1, "abc defg XYZ 09", "u"), (2, None, "u"), (3, "", "u"), (4, docs.where("doc_id = 5").first().text, "u")],
                                  "item_id long, text string, uid string")
    got = resampling.resampled(docs, items)
    assert dict(got.dtypes) == {c: "bigint" for c in ("doc_id", "n_features", "weight", "score", "rank")}
    assert Counter(map(tuple, got.collect())) == brute_resample(docs.collect(), [r.text for r in items.collect()])
    none = items.where("item_id < 0")
    assert Counter(map(tuple, resampling.resampled(docs, none).collect())) == brute_resample(docs.collect(), [])
    assert resampling.resampled(docs.where("doc_id < 0"), items).count() == 0


def test_a_repeated_row_keeps_its_ranks_apart(spark):
    rows = [(7, "w " * 25)] * 300 + [(k, "v " * 30) for k in range(100, 200)]
    got = resampling.resampled(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, "w")], "item_id long, text string"))
    ranks = sorted(r["rank"] for r in got.where("rank IS NOT NULL").collect())
    assert ranks == list(range(1, 41))


def test_hashes_and_sliced_sums_are_exact():
    rng = random.Random(8)
    words = [bytes(rng.choices(range(128, 256), k=rng.choice([1, 2, 7, 47, 48, 49, 300]))) for _ in range(200)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - np.array([len(w) for w in words])
    assert resampling.crc32(data, start, end).tolist() == [zlib.crc32(w) for w in words]
    r = np.random.default_rng(8)
    gain = r.integers(-20000, 9000, resampling.BUCKETS)
    sizes = [0, 3, 500, 0, 9000, 1]
    buckets = np.concatenate([np.sort(r.choice(resampling.BUCKETS, n, replace=False)) for n in sizes]).astype(np.int64)
    counts = r.integers(1, 70000, len(buckets)).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    expected = [int((gain[buckets[a:b]] * counts[a:b]).sum()) for a, b in itertools.pairwise(offsets)]
    assert resampling.sliced_sums(offsets, buckets, counts, resampling.gain_planes(gain)).tolist() == expected
