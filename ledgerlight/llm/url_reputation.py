"""URL filter: rules first, then empirical-Bayes host reputation, in Spark expressions only.

A page's outcome is the quality label of the document of its id (0 is bad).
Outcomes are summed per host (partial sums before the shuffle), registered
domain and suffix.  From the whole corpus down to the host, each unit's bad
rate is shrunk towards its parent's posterior mean by a beta prior whose
strength comes from the spread of the units' rates (method of moments for the
beta-binomial).  A host is blocked if the lower posterior bound of its bad rate
exceeds ``BLOCK_ABOVE``; a host without outcomes has its domain's posterior.

Pages join the reputation as a written table, one row a host: Spark broadcasts it
where it is small, and else splits the pages of a hot host at run time (no
aggregation follows the join).  Nothing is repeated per host.
Null urls and urls without ``://`` have an empty host and path and form one
unit; null labels don't count; an id with several labels has the largest;
repeated pages are judged alike, and each counts as an outcome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.plans.lineage import materialize

#: (host, path, verdict); a rule fits its host and all subdomains, the longest wins.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
BLOCK_ABOVE = 0.5
#: Standard deviations below the posterior mean (one-sided 95 %).
Z = 1.645
#: Common public suffixes of two labels.
DOUBLE_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "or.jp", "ne.jp", "com.br", "com.cn", "co.in", "co.nz", "co.za", "com.mx", "com.tr", "co.kr")
#: Bounds of the correlation of outcomes within a unit.
RHO = (0.0001, 0.9)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls without one."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def units(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; an address is its own domain."""
    name = F.regexp_replace(host, ":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    double = two.isin(*DOUBLE_SUFFIXES)
    address = name.rlike("^[0-9.]+$")
    suffix = F.when(address, "").when(double, two).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(address, name).when(double, F.substring_index(name, ".", -3)).otherwise(two)
    return domain, suffix


def _shrunk(rows: DataFrame, parent_mean: Column | None) -> DataFrame:
    """Posterior ``a``, ``b`` and ``mean`` of units (n, k) under their parents' means."""
    if parent_mean is None:
        return rows.withColumn("a", F.col("k") + 1.0).withColumn("b", F.col("n") - F.col("k") + 1.0).withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))
    rows = rows.withColumn("__m", parent_mean)
    has, p = F.col("n") > 0, F.col("k") / F.col("n")
    spread, count, pairs = rows.where(has).agg(
        F.sum(F.col("n") * (p - F.col("__m")) ** 2 / (F.col("__m") * (1 - F.col("__m")))), F.count("*"), F.sum(F.col("n") - 1)).first()
    rho = min(RHO[1], max(RHO[0], (spread - count) / pairs)) if pairs else RHO[1]
    strength = (1 - rho) / rho
    return (rows.withColumn("a", F.lit(strength) * F.col("__m") + F.col("k"))
            .withColumn("b", F.lit(strength) * (1 - F.col("__m")) + F.col("n") - F.col("k"))
            .withColumn("mean", F.col("a") / (F.col("a") + F.col("b"))).drop("__m"))


def reputation(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n, k, bad_rate, bad_at_least) of every host of ``pages`` (page_id, host)."""
    outcome = (labels.select("doc_id", F.col("quality").cast("int").alias("q")).where("doc_id IS NOT NULL AND q IS NOT NULL")
               .groupBy("doc_id").agg(F.max("q").alias("q")))
    known = pages.select("page_id", "host").join(outcome, F.col("page_id") == F.col("doc_id"), "left")
    domain, suffix = units(F.col("host"))
    hosts = (known.groupBy("host").agg(F.count("q").alias("n"), F.sum(F.when(F.col("q") == 0, 1).otherwise(0)).alias("k"))
             .withColumn("domain", domain).withColumn("suffix", suffix))
    hosts = materialize(hosts, "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    n, k = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    top = (k + 1.0) / (n + 2.0)
    suffixes = materialize(_shrunk(suffixes, F.lit(top)), "suffixes").select("suffix", F.col("mean").alias("above"))
    domains = materialize(_shrunk(domains.join(suffixes, "suffix"), F.col("above")), "domains").select("domain", "suffix", F.col("mean").alias("above"))
    hosts = _shrunk(hosts.join(domains, ["domain", "suffix"]), F.col("above"))
    total = F.col("a") + F.col("b")
    low = F.col("mean") - Z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (total + 1))
    return hosts.select("host", "n", "k", F.col("mean").alias("bad_rate"), low.alias("bad_at_least"))


def judged(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, n_outcomes) for each page."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = materialize(reputation(rows, labels), "reputation")
    joined = rows.join(known, "host")
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("bad_at_least") > BLOCK_ABOVE, "block").otherwise("allow")
    return joined.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"),
                         F.col("n").alias("n_outcomes"))
