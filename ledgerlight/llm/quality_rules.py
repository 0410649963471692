"""Quality rules: statistics of whole texts and a learned decision list, in Spark expressions only.

``statistics`` counts words, characters, symbols, repeated lines and repeated
five-word windows of each text within its own row (no shuffle).  ``learn``
builds an ordered list of rules by sequential covering: a rule grows by the
threshold that gains most on two thirds of the labelled rows, is cut back to
its best prefix on the other third, and is kept if it is precise there; the
rows it covers leave, and the next rule grows on the rest.  Spark counts the
labelled rows per feature and bin; the driver only sees those counts.  The
list becomes a nested ``CASE WHEN``.

Null and empty texts have zero counts and fail the base rule.  Without
labelled rows of both kinds the list is empty and only the base rule rejects.
Repeated rows are judged alike.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import WORD, labelled_sample, let
from ledgerlight.plans.lineage import materialize

SPACE_RUN = r"[\x20\x09-\x0D]+"
WINDOW = 5
#: Labelled rows that the rules are learned from, at most (about).
MAX_LABELLED = 50_000
CUTS, MAX_RULES, MAX_CONDITIONS, MIN_PRECISION = 32, 12, 3, 0.9

#: Ratios that rules may use, over the counts of ``statistics``.
FEATURES = {
    "words": "CAST(n_words AS DOUBLE)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_words": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
}


def _count(text: Column, characters: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{characters}]+", "")).cast("bigint")


def statistics(documents: DataFrame, keep: tuple = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    the counts behind the other features."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))

    def repeated(h: Column) -> Column:
        """Words within windows that occur twice or more, from the hashes of the words."""
        windows = F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - WINDOW, F.lit(0))), lambda i: F.struct(
            F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]).alias("w"), i.alias("i")))
        again = let(F.sort_array(windows), lambda s: F.filter(s, lambda x, k: F.coalesce(F.get(s, k + 1)["w"] == x["w"], F.lit(False))
                    | F.coalesce(F.when(k > 0, F.get(s, k - 1)["w"]) == x["w"], F.lit(False))))
        places = F.sort_array(F.transform(again, lambda x: x["i"]))
        steps = let(places, lambda p: F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))))
        return F.when(F.size(h) >= WINDOW, F.aggregate(steps, F.lit(0), lambda a, b: a + b)).otherwise(0).cast("bigint")

    hashes = F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))
    words = let(hashes, lambda h: F.struct(F.size(h).cast("bigint").alias("n"), repeated(h).alias("repeated")))
    line_counts = let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("dup")))
    rows = documents.select(
        *keep, words.alias("w"), line_counts.alias("l"), F.length(F.regexp_replace(text, SPACE_RUN, "")).cast("bigint").alias("word_chars"),
        _count(text, "#*$%&|<>").alias("n_symbols"), _count(text, "A-Z").alias("n_capitals"),
        _count(text, "!?").alias("n_marks"), _count(text, "0-9").alias("n_digits"))
    return rows.select(*keep, F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines"),
                       F.col("w.repeated").alias("n_repeat_words"), F.col("l.n").alias("n_lines"), "n_capitals", "n_marks", "n_digits")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"({FEATURES[self.feature]} {'>' if self.above else '<='} {self.threshold!r}D)"


Rule = list[Condition]


def rule_sql(rule: Rule) -> str:
    return " AND ".join(c.sql() for c in rule)


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects a row, in order; null if none does."""
    out = F.lit(None).cast("int")
    for k in range(len(rules) - 1, -1, -1):
        out = F.when(F.expr(rule_sql(rules[k])), k + 1).otherwise(out)
    return out


def _best(counts: dict, cuts: dict, bad0: float, good0: float) -> tuple[float, Condition | None]:
    """The condition of the largest gain (FOIL) from counts of (feature, bin): (bad, good)."""
    best, choice = 0.0, None
    start = math.log2(bad0 / (bad0 + good0))
    for feature, points in cuts.items():
        at_most = [0, 0]
        for j, point in enumerate(points):
            bad, good = counts.get((feature, j), (0, 0))
            at_most = [at_most[0] + bad, at_most[1] + good]
            for above, (b, g) in ((False, at_most), (True, (bad0 - at_most[0], good0 - at_most[1]))):
                if b == 0:
                    continue
                gain = b * (math.log2(b / (b + g)) - start)
                # of equal thresholds the one nearest to the bad rows, which spares unseen good ones
                if gain > best + 1e-9 or (above and choice and choice.above and choice.feature == feature and gain > best - 1e-9):
                    best, choice = max(best, gain), Condition(feature, above, point)
    return best, choice


def learn(labelled: DataFrame) -> list[Rule]:
    """An ordered decision list from rows of ``statistics`` with ``label`` (1 is good) and ``doc_id``."""
    rows = materialize(labelled, "labelled").where(~base_failed()).select(
        (1 - F.col("label")).cast("bigint").alias("bad"), (F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) > 0).alias("grow"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks", "n_digits")
    shares = [F.lit(k / CUTS) for k in range(CUTS)]
    quantiles = rows.agg(*[F.expr(f"percentile_approx(CASE WHEN bad = {bad} THEN {f} END, array({', '.join(str(k / CUTS) for k in range(len(shares)))}), 1000)")
                           .alias(f"{name}_{bad}") for name, f in FEATURES.items() for bad in (0, 1)]).first()
    if any(quantiles[f"words_{bad}"] is None for bad in (0, 1)):
        return []
    cuts = {name: sorted(set(quantiles[f"{name}_0"]) | set(quantiles[f"{name}_1"])) for name in FEATURES}

    def numbered(name: str) -> Column:
        points = F.array(*[F.lit(float(c)) for c in cuts[name]])
        bin_ = let(F.expr(FEATURES[name]), lambda v: F.size(F.filter(points, lambda c: c < v)))
        return F.struct(F.lit(name).alias("feature"), bin_.alias("bin"))

    bins = F.array(*[numbered(name) for name in cuts])
    binned = materialize(rows.withColumn("bins", bins), "binned")
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        left = binned.where(verdict(rules).isNull())
        rule: Rule = []
        while len(rule) < MAX_CONDITIONS:
            covered = left.where("grow" + (" AND " + rule_sql(rule) if rule else ""))
            got = (covered.select("bad", F.explode("bins").alias("x")).groupBy("x.feature", "x.bin")
                   .agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).collect())
            counts = {(r.feature, r.bin): (r.bad, r.n - r.bad) for r in got}
            bad0 = sum(v[0] for k, v in counts.items() if k[0] == "words")
            good0 = sum(v[1] for k, v in counts.items() if k[0] == "words")
            if bad0 == 0 or (rule and good0 == 0):
                break
            gain, condition = _best(counts, cuts, bad0, good0)
            if condition is None or gain < 1.0:
                break
            rule.append(condition)
        if not rule:
            break
        prefixes = [rule[:k + 1] for k in range(len(rule))]
        sums = left.agg(*[F.sum(F.expr(f"CASE WHEN {part} AND {rule_sql(p)} THEN {value} ELSE 0 END")) for p in prefixes
                          for part in ("NOT grow", "grow") for value in ("bad", "1 - bad")]).first()
        sums = [0 if x is None else x for x in sums]
        scored = []
        for k, p in enumerate(prefixes):
            bad, good, grown_bad, grown_good = sums[4 * k:4 * k + 4]
            if bad + good == 0:                        # too few rows to prune on
                bad, good = grown_bad, grown_good
            scored.append(((bad - good) / max(1, bad + good), bad, -k, p, (bad + 0.5) / (bad + good + 1)))
        worth, bad, _, rule, precision = max(scored, key=lambda x: x[:3])
        if precision < MIN_PRECISION and not (bad < 5 and worth == 1.0):
            break
        # each threshold moves to the middle of the gap before the bad rows that the rule covers
        near = left.where(f"bad = 1 AND {rule_sql(rule)}").agg(*[F.expr(f"{'min' if c.above else 'max'}({FEATURES[c.feature]})") for c in rule]).first()
        rules.append([Condition(c.feature, c.above, (c.threshold + x) / 2) for c, x in zip(rule, near, strict=True)])
    return rules


def train(documents: DataFrame, labels: DataFrame, column: str = "quality", max_labelled: int = MAX_LABELLED) -> list[Rule]:
    chosen = labelled_sample(labels, column, F.lit(True), max_labelled)
    joined = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return learn(statistics(joined, ("doc_id", "label")))


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, the counts, base_failed, kept, rule) for each row of ``documents``."""
    rules = train(documents, labels)
    rows = statistics(documents)
    rule = verdict(rules)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base_failed().alias("base_failed"), (~base_failed() & rule.isNull()).alias("kept"), rule.alias("rule"))
