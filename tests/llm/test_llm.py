"""Training-data operators against brute force, on small fixtures with hard cases:
nulls, empty texts, repeated rows, clashing columns, empty tables."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import (decontamination, language_model, mixing, ngram_join, pseudonyms, quality_classifier, quality_rules,
                             token_counts, toxicity, url_reputation)
from ledgerlight.llm.common import in_fold

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, copies string, k1 string, label string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def texts(seed=3, n=150):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(400)]
    out = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(n)]
    for k in range(30):
        words = out[k].split()
        if len(words) > 20:
            words[rng.randrange(len(words))] = "Changed"
        out.append(" ".join(words))
    return out + out[:10] + [None, "", "  \n ", "one", "ONE", "a b c d"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", f"s{k % 4}" if k % 9 else None, 0, "x", "y", "z", "w") for k, t in enumerate(texts())]
    rows += [(None, "some text of nobody in particular here", None, None, None, None, None, None, None)] * 2 + [rows[3], rows[3]]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, int(k % 3 == 0)) for k in range(120)] + [(None, 1, 1), (5, None, None)],
                                 "doc_id long, quality int, toxic int")


def shingles(text):
    w = WORD.findall(lower(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def brute_classes(rows):
    sets = {}
    for r in rows:
        sets.setdefault(tuple(WORD.findall(lower(r.text))), shingles(r.text))
    sets.pop((), None)
    links, parent = Counter(), {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
            links[a] += 1
            links[b] += 1
            parent[find(a)] = find(b)
    return links, find


def test_join_matches_brute_force(docs):
    rows = docs.collect()
    links, find = brute_classes(rows)
    got = defaultdict(set)
    for r in ngram_join.near_duplicates(docs).collect():
        got[r.doc_id].add((r.class_id, r.n_links))
    classes = defaultdict(list)
    for r in rows:
        if key := tuple(WORD.findall(lower(r.text))):
            classes[find(key)].append(r.doc_id)
    for r in rows:
        key = tuple(WORD.findall(lower(r.text)))
        ids = [i for i in classes[find(key)] if i is not None] if key else [r.doc_id]
        assert got[r.doc_id] == {(min(ids) if ids else None, links[key])}


def test_blocks_of_an_unsplittable_group(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET", 8)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(base[:k] + [f"x{k}"] + base[k + 1:])) for k in range(50)]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    links, _ = brute_classes(spark.createDataFrame(rows, "doc_id long, text string").collect())
    assert {r.class_id for r in got} == {0}
    assert {r.doc_id: r.n_links for r in got} == {k: links[tuple(t.split())] for k, t in rows}


def test_sets_are_written_once(spark, monkeypatch):
    """The sets of the classes that are split are read where they lie, not dealt and written a second time."""
    written, write = [], ngram_join.materialize

    def noted(df, name, *more):
        if "tokens" in df.columns:
            written.append(name)
        return write(df, name, *more)

    monkeypatch.setattr(ngram_join, "materialize", noted)
    monkeypatch.setattr(ngram_join, "BUCKET", 8)
    rng = random.Random(5)
    shared = [f"w{k}" for k in range(60)]
    near = [" ".join(shared[:k] + [f"x{k}"] + shared[k + 1:]) for k in range(30)]
    passages = [" ".join(shared[:25] + rng.choices("abcdefghijklmn", k=40)) for _ in range(30)]
    pairs = [" ".join([f"p{k // 2}w{i}" for i in range(40)] + [f"y{k}"]) for k in range(20)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(near + passages + pairs)], "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(rows).collect()}
    assert written == ["sets"]
    links, find = brute_classes(rows.collect())
    keys = {r.doc_id: tuple(r.text.split()) for r in rows.collect()}
    heads = {}
    for k in sorted(keys):
        heads.setdefault(find(keys[k]), k)
    assert got == {k: (heads[find(key)], links[key]) for k, key in keys.items()}


def test_one_of_each_keeps_whole_rows(docs):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    links, find = brute_classes(docs.collect())
    keys = [find(tuple(WORD.findall(lower(r.text)))) for r in kept.collect() if WORD.search(r.text or "")]
    every = {find(tuple(WORD.findall(lower(r.text)))) for r in docs.collect() if WORD.search(r.text or "")}
    assert len(keys) == len(set(keys)) and set(keys) == every


@pytest.mark.parametrize("star,representatives,bucket", [(256, 8, 512), (4, 1, 512), (2, 2, 16)])
def test_ties_are_the_classes_of_all_links(spark, docs, monkeypatch, star, representatives, bucket):
    """Large buckets tied by a few representatives and the rest compared: the groups of the all-pairs join."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    step, chains = words[:120], []
    for k in range(60):                      # a chain: neighbours are similar, ends aren't
        step = step[1:] + [rng.choice(words)]
        chains.append(" ".join(step))
    group = [" ".join(words[:60] + [f"w{k}"]) for k in range(40)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(chains + group + texts())], "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "STAR", star)
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)
    monkeypatch.setattr(ngram_join, "STAR_REPRESENTATIVES", representatives)
    links, find = brute_classes(rows.collect())
    kept = [tuple(WORD.findall(lower(r.text))) for r in ngram_join.one_of_each(rows).collect()]
    heads = [find(key) for key in kept if key]
    expected = {find(tuple(WORD.findall(lower(r.text)))) for r in rows.collect() if WORD.findall(lower(r.text))}
    assert len(heads) == len(set(heads)) and set(heads) == expected


def test_a_shared_passage_is_set_aside_when_a_bucket_is_split():
    """Texts with a long passage in common go on by their own tokens, and near copies are left as a core."""
    import pyarrow as pa
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 2**31, 150)
    own = [np.concatenate([passage, rng.integers(0, 2**31, 150)]) for _ in range(40)]
    base = np.concatenate([passage, rng.integers(0, 2**31, 150)])
    near = [np.concatenate([base[:-10], rng.integers(0, 2**31, 10)]) for _ in range(40)]
    lists = [np.unique(x.astype(np.int32)) for x in own + near]
    usual = ngram_join._usual(pa.array([[x.tolist() for x in lists]], pa.list_(pa.list_(pa.int32()))))
    common = set(usual[0].as_py())
    assert set(passage.tolist()) <= common
    got = ngram_join._children(pa.array([5] * 80), pa.array([x.tolist() for x in lists], pa.list_(pa.int32())), pa.array([sorted(common)] * 80, pa.list_(pa.int32()))).to_pylist()
    assert not any(r["core"] for r in got[:40]) and all(r["core"] and not r["paths"] for r in got[40:])
    assert 1 < np.mean([len(r["paths"]) for r in got[:40]]) < 6
    assert len(set(itertools.chain.from_iterable(r["paths"] for r in got[:40]))) > 40       # no child holds them all


def test_masks_catch_every_placement_of_substitutions():
    w = decontamination.WINDOW
    for places in itertools.combinations(range(w), decontamination.SUBSTITUTIONS):
        assert any(all(o + k not in places for k, c in enumerate(m) if c == "1")
                   for m in decontamination.MASKS for o in range(w - len(m) + 1))


def test_leaks_match_brute_force(spark, docs):
    rng = random.Random(1)
    items = [(k, " ".join(f"q{rng.randrange(999)}" for _ in range(n))) for k, n in enumerate((15, 20, 40, 13, 6, 3))] + [(9, None), (10, "")]
    rows = docs.collect()
    planted = []
    for k, (_, t) in enumerate(items[:6]):
        w = t.split()
        for cut in (0, 2, 3, 4):
            v = list(w)
            for p in rng.sample(range(len(v)), min(cut, len(v))):
                v[p] = "other"
            planted.append((1000 + 10 * k + cut, f"{rows[k].text or ''} {' '.join(v).upper()} end of it"))
    planted = spark.createDataFrame(planted, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(planted, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for r in planted.collect():
        d = WORD.findall(lower(r.text))
        for item, t in items:
            w = WORD.findall(lower(t))
            span, need = (13, 10) if len(w) >= 13 else (len(w), len(w))
            for i in range(len(w) - span + 1 if w else 0):
                if any(sum(x == y for x, y in zip(d[j:j + span], w[i:i + span], strict=True)) >= need for j in range(len(d) - span + 1)):
                    want.add((r.doc_id, item))
    assert got == want and want
    blocked = decontamination.find_leaks(planted, spark.createDataFrame(items, "item_id long, text string"), block_words=20)
    assert {(r.doc_id, r.item_id) for r in blocked.collect()} == want
    assert decontamination.without_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).count() == docs.count()


def test_pseudonyms_round_trip_and_link(spark):
    t = ("4539578763621486 4539 5787 6362 1486 no 4539578763621487 Jo.Do@mail3.example.com JO.DO@MAIL3.EXAMPLE.COM 192.168.0.1 300.1.1.1 "
         "+1 (743) 555-3824 123-45-6789 666-12-1234 1980-02-29 29.02.1980 1981-02-29 GB82 WEST 1234 5698 7654 32")
    docs = spark.createDataFrame([(1, t, "a"), (2, t, "b"), (3, None, "c"), (4, "", None), (5, "plain 12 words", "d")], "doc_id long, text string, pairs string")
    out = {r.doc_id: r for r in pseudonyms.pseudonymised(docs, "k", count="n").collect()}
    words = out[1].text.split()
    assert out[1].text == out[2].text and out[3].text is None and out[4].text == "" and out[5].text == "plain 12 words"
    assert words[0] == "".join(words[1:5]) and words[0] != t.split()[0] and words[6] == "4539578763621487"
    digits = [int(c) for c in words[0]][::-1]
    assert (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0
    assert words[7].lower() == words[8].lower() and words[8].isupper() and "300.1.1.1" in words and "666-12-1234" in words and "1981-02-29" in words
    back = pseudonyms.reveal(pseudonyms.pseudonymised(docs, "k"), "k")
    assert {r.doc_id: r.text for r in back.collect()} == {r.doc_id: r.text for r in docs.collect()}
    other = {r.doc_id: r.text for r in pseudonyms.pseudonymised(docs, "another").collect()}
    assert other[1] != out[1].text


def iban(body):
    """``body`` (country and account) with its check digits."""
    number = "".join(str(int(c, 36)) for c in body[2:] + body[:2] + "00")
    return f"{body[:2]}{98 - int(number) % 97:02d}{body[2:]}"


def test_pseudonyms_beside_upper_case_words(spark):
    values = [iban(b) for b in ("ES21000418450200051332", "PL109010140000071219812874", "ROAAAA1B31007593840000", "SE50000000058398257466",
                                "CZ08000000192000145399", "HU117730161111101800000000", "BE539007547034", "NO86011117947",
                                "DE370400440532013000", "FR20041010050500013M02606", "MTMALT011000012345MTLCAST001S", "GBWEST12345698765432")]
    values += [" ".join(v[k:k + 4] for k in range(0, len(v), 4)) for v in values]
    values += ["+442079460958", "555 123 4567", "+44 2079460958", "+49 30 1234 56789", "+1 555 123 4567", "+15551234567", "555-123-4567"]
    rows = [(k, f"{before}{v}{after}") for k, (v, before, after) in enumerate(itertools.product(
        values, ("", "IBAN ", "QQ12 ABCD 1234 "), ("", " BIC CAIXESBB", " USD", " A1", ". OK")))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in pseudonyms.pseudonymised(docs, "k").collect()}
    new = {}
    for (k, t), (v, before, after) in zip(rows, itertools.product(values, ("", "IBAN ", "QQ12 ABCD 1234 "), ("", " BIC CAIXESBB", " USD", " A1", ". OK")), strict=True):
        if before.startswith("QQ") and not v[:2].isalpha():
            continue                                           # digits may continue an account of an unknown country
        got = out[k]
        assert got.startswith(before) and got.endswith(after), t
        own = got[len(before):len(got) - len(after)]
        assert own != v and len(own) == len(v) and new.setdefault(re.sub("[ -]", "", v), re.sub("[ -]", "", own)) == re.sub("[ -]", "", own), t
        if v[:2].isalpha():
            bare = own.replace(" ", "")
            assert iban(bare[:2] + bare[4:]) == bare and bare[:2] == v[:2]
    back = pseudonyms.reveal(pseudonyms.pseudonymised(docs, "k"), "k")
    assert {r.doc_id: r.text for r in back.collect()} == dict(rows)


def test_mix_meets_targets_and_reruns(docs):
    got = sorted(tuple(r) for r in mixing.plan(docs).na.fill(-1).collect())
    again = sorted(tuple(r) for r in mixing.plan(docs.repartition(3)).na.fill(-1).collect())
    assert got == again and len(got) == docs.count()
    rows = mixing.plan(docs).collect()
    assert all(r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in rows)
    size = Counter()
    for r in docs.collect():
        size[r.source] += len(WORD.findall(r.text or ""))
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    capped = set()
    while True:                                                # reshare the excess
        free = [s for s in size if s not in capped]
        level = (1.5 * sum(size.values()) - sum(2 * size[s] for s in capped)) / sum(weight[s] for s in free)
        if not (more := {s for s in free if 2 * size[s] < level * weight[s]}):
            break
        capped |= more
    target = {s: 2 * size[s] if s in capped else level * weight[s] for s in size}
    assert {r.source_size for r in rows} == set(size.values())
    for s in size:
        assert any(abs(r.target - target[s]) < 1e-6 for r in rows if r.source_size == size[s])
    assert abs(sum(r.taken for r in rows) - sum(target.values())) <= 60 * len(size)
    assert mixing.mixed(docs).agg(F.sum("taken")).first()[0] == sum(r.taken for r in rows)


def test_pivotal_rounding_keeps_sums_and_is_fair():
    rng = np.random.default_rng(0)
    size, p = rng.integers(1, 50, 40), rng.random(40)
    total = np.zeros(40)
    for _ in range(3000):
        out, held = mixing.settle(size, p, rng.random(40))
        assert abs((out * size).sum() - (p * size).sum()) < 1e-6
        if held is not None:
            out[held] = rng.random() < out[held]
        total += out
    assert np.abs(total / 3000 - p).max() < 0.05


def test_pieces_match_greedy_search():
    rng = random.Random(2)
    for _ in range(150):
        pieces = token_counts.marked_vocabulary(m + "".join(rng.choices("abc", k=rng.randint(1, 4))) for m in rng.choices(("", "##"), k=rng.randint(2, 14)))
        machine, known = token_counts.automaton(pieces), set(pieces)
        for _ in range(30):
            word = "".join(rng.choices("abc", k=rng.randint(1, 9))).encode()
            s, i, n = token_counts.START + word, 0, 0
            while i < len(s):
                j = next((j for j in range(len(s), i, -1) if s[i:j] in known), 0)
                if not j:
                    n = 1
                    break
                i, n = j, n + 1
            assert token_counts.pieces_of(word, *machine) == n


def test_statistics_match_brute_force(docs):
    for r, got in zip(sorted(docs.collect(), key=str), sorted(quality_rules.statistics(docs, ("doc_id", "text")).collect(), key=str), strict=True):
        t = got.text or ""
        w = WORD.findall(t)
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        seen = Counter(windows)
        covered = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(5)}
        assert (got.n_words, got.word_chars, got.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (got.n_symbols, got.n_dup_lines) == (sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)))


def test_rules_learn_a_threshold(spark):
    rows = [(k, " ".join(["word", "of", "text"] + [f"u{k}x{j}" for j in range(30 + k % 11)] + (["**"] * (5 + k % 7) if k % 4 == 0 else [])), int(k % 4 > 0)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    rules = quality_rules.train(docs.drop("quality"), docs.drop("text"))
    assert rules and any(c.feature == "symbols" for c in rules[0])
    out = quality_rules.judged(docs.drop("quality"), docs.drop("text")).join(docs, "doc_id").collect()
    assert all(r.kept == (r.quality == 1) for r in out if not r.base_failed)


def test_urls(spark, labels):
    urls = [(0, "HTTP://Blog.Example.NET/en/x?y"), (1, "http://example.net/enx"), (2, None), (3, "nothing"), (4, "http://a.org/fr/1"),
            (5, "https://example.com/de/2#a"), (6, "http://net"), (7, "http://notexample.com/de/"), (7, "http://notexample.com/de/")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.judged(
        spark.createDataFrame(urls, "page_id long, url string"), labels).collect()}
    assert got[0] == ("blog.example.net", "/en/x", "example.net/en/", "allow") and got[1][2:] == ("net/", "block")
    assert got[2][:3] == got[3][:3] == ("", "", None) and got[4][2:] == ("org/fr/", "allow") and got[5][2:] == ("example.com/de/", "block")
    assert got[6][:3] == ("net", "", None) and got[7][2] is None


def test_language_model_base_and_counts(docs):
    held = in_fold(5, 1)
    out = language_model.scored(docs, held).collect()
    rows = docs.select("doc_id", "text", held.alias("h")).collect()
    counts = Counter(w for r in rows if not r.h for w in [*WORD.findall(lower(r.text)), None])
    n, v = sum(counts.values()), len(counts)
    want = defaultdict(list)
    for r in rows:
        tokens = [*WORD.findall(lower(r.text)), None]
        want[r.doc_id].append((r.h, len(tokens), sum(counts[t] > 0 for t in tokens), n, sum(np.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)))
    for r in out:
        w = want[r.doc_id][0]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4] and abs(r.base_score - w[4]) < 1e-6 and r.score < 0
    assert sum(r.score for r in out) > sum(r.base_score for r in out) * 1.02


def test_every_training_text_moves_the_weights(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choices("abcdefghij", k=12))) for k in range(6000)]
    weights = []
    for changed in (None, 5, 2999, 4700):                # the same words in another order: counts stay
        own = [(k, " ".join(sorted(t.split())) if k == changed else t) for k, t in rows]
        docs = spark.createDataFrame(own, "doc_id long, text string").coalesce(2)
        counts = language_model.summary(language_model.count_tokens(docs, F.lit(True)))
        weights.append(np.concatenate([p.ravel() for p in language_model.train(docs, F.lit(True), counts).parts()]))
    assert all((weights[0] != w).any() for w in weights[1:])


def test_segments_match_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 14)
        place = sorted(rng.sample(range(n + 4), n))
        score = [rng.choice((-2.0, -1.0, 1.0, 1.5, 3.0)) for _ in place]
        whole = [dict(zip(place, score, strict=True)).get(k, -0.2) for k in range(place[-1] + 1)]
        best = max((sum(whole[a:b + 1]) for a in range(len(whole)) for b in range(a, len(whole))), default=0)
        got = toxicity.segments(np.array(place), np.array(score), 0.2)
        assert abs(max((s for *_, s in got), default=0.0) - max(best, 0.0)) < 1e-9
        assert all(abs(sum(whole[a:b + 1]) - s) < 1e-9 for a, b, s in got)
        assert all(x[1] < y[0] for x, y in itertools.pairwise(got))


def test_classifiers_on_hard_rows_and_held_out(spark, docs, labels):
    rows = [(k, (f"fine words number {k} here " * 3) + ("idiot scum " if k % 5 == 0 else "") + ("!! @@ " * 4 if k % 2 else "")) for k in range(400)]
    easy = spark.createDataFrame(rows, "doc_id long, text string")
    truth = spark.createDataFrame([(k, int(k % 2 == 0), int(k % 5 == 0)) for k in range(400)], "doc_id long, quality int, toxic int")
    model = quality_classifier.train(easy, truth, ~in_fold(5, 0))
    out = quality_classifier.scored(easy, model, "score").collect()
    assert np.mean([(r.score >= 0.3) == (r.doc_id % 2 == 0) for r in out]) > 0.98
    bad = toxicity.train(easy, truth, ~in_fold(4, 2))
    assert np.mean([(r.score >= 0.3) == (r.doc_id % 5 == 0) for r in toxicity.scored(easy, bad).collect()]) > 0.98
    assert toxicity.passages(easy, bad).count() >= 70
    for m, f in ((quality_classifier.train(docs, labels, F.lit(True)), quality_classifier.scored), (toxicity.train(docs, labels, F.lit(True)), toxicity.scored)):
        got = f(docs.drop("label"), m, "label").collect()
        assert len(got) == docs.count() and all(0 <= r.label <= 1 for r in got)


def test_empty_tables(spark, labels):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    items, no_labels = spark.createDataFrame([], "item_id long, text string"), labels.limit(0)
    assert ngram_join.near_duplicates(none).count() == 0 and ngram_join.one_of_each(none).count() == 0
    assert decontamination.find_leaks(none, items).count() == 0 and decontamination.without_leaks(none, items).count() == 0
    assert pseudonyms.pseudonymised(none).count() == 0 and mixing.plan(none).count() == 0 and mixing.mixed(none).count() == 0
    assert quality_rules.judged(none, no_labels).count() == 0
    assert url_reputation.judged(spark.createDataFrame([], "page_id long, url string"), no_labels).count() == 0
    assert language_model.scored(none, in_fold(5, 1)).count() == 0
    model, bad = quality_classifier.train(none, no_labels, F.lit(True)), toxicity.train(none, no_labels, F.lit(True))
    assert quality_classifier.scored(none, model, "s").count() == 0 and toxicity.scored(none, bad).count() == 0
