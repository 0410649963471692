"""DuckDB statements for the training-data queries that SQL can express.

``op4``: all pairs of different texts that share a run of five words, compared
on their whole sets, and classes by repeated steps along the links.  ``op7``:
the rules and the beta posteriors, level by level.  ``op11``: each round of the
clustering as a join with its few centroids.  ``op13``: CRC-32 bit by bit over
the distinct words, gains by the counts of buckets.  The other queries return
learned scores, keyed digests or draws; ``tests/llm`` holds them against
brute-force versions.
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = "[^\\x20\\x09-\\x0D]+"

#: Equal texts are one node; rows without words are classes of their own.
_NGRAM_JOIN = f"""
WITH RECURSIVE
worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
named AS (
    SELECT w, min(doc_id) AS node, count(*) AS copies FROM worded WHERE len(w) > 0 GROUP BY w),
sets AS (
    SELECT node, list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS grams
    FROM named),
grams AS (SELECT node, len(grams) AS n, unnest(grams) AS g FROM sets),
links AS (
    SELECT a.node AS u, b.node AS v FROM grams a JOIN grams b ON a.g = b.g AND a.node <> b.node
    WHERE 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
    GROUP BY a.node, b.node, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))),
reached AS (
    SELECT node AS u, node AS v FROM named
    UNION
    SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u),
classes AS (SELECT u, min(v) AS class_id FROM reached GROUP BY u),
degree AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, coalesce(m.node, d.doc_id) AS copy_of,
       coalesce(m.copies, 1) AS n_copies, coalesce(g.n_links, 0) AS n_links
FROM worded d LEFT JOIN named m ON d.w = m.w LEFT JOIN classes c ON c.u = m.node LEFT JOIN degree g ON g.u = m.node"""


def _level(name: str, rows: str) -> str:
    """Posterior means of units (n, k) under their parents' means ``above``, the prior's strength by moments."""
    return f"""
{name}_rows AS ({rows}),
{name}_spread AS (
    SELECT sum(n * (k / n - above) ** 2 / (above * (1 - above))) AS spread, count(*) AS units, sum(n - 1) AS pairs
    FROM {name}_rows WHERE n > 0),
{name}_rho AS (
    SELECT CASE WHEN coalesce(pairs, 0) = 0 THEN 0.9 ELSE least(0.9, greatest(0.0001, (spread - units) / pairs)) END AS rho
    FROM {name}_spread),
{name} AS (
    SELECT *, ((1 - rho) / rho * above + k) / ((1 - rho) / rho + n) AS mean, (1 - rho) / rho + n AS total
    FROM {name}_rows, {name}_rho)"""


def _url_filter() -> str:
    from ledgerlight.llm.url_reputation import BLOCK_ABOVE, DOUBLE_SUFFIXES, RULES, Z
    doubles = ", ".join(f"'{s}'" for s in DOUBLE_SUFFIXES)
    fits = sorted(RULES, key=lambda r: -len(r[0] + r[1]))

    def case(value) -> str:
        return "CASE " + " ".join(
            f"WHEN (host = '{r[0]}' OR ends_with(host, '.{r[0]}')) AND starts_with(path, '{r[1]}') THEN '{value(r)}'" for r in fits) + " END"

    return f"""
WITH
rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
    SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
parsed AS (SELECT page_id, translate(raw, '{_UPPER}', '{_LOWER}') AS host, path FROM split),
outcome AS (
    SELECT doc_id, max(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
counted AS (
    SELECT host, count(q) AS n, count(*) FILTER (q = 0) AS k, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS p
    FROM parsed LEFT JOIN outcome ON page_id = doc_id GROUP BY host),
named AS (
    SELECT host, n, k, array_to_string(p, '.') AS name, array_to_string(p[-2:], '.') AS two, array_to_string(p[-3:], '.') AS three, p[-1] AS one
    FROM counted),
placed AS (
    SELECT host, n, k,
           CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name WHEN two IN ({doubles}) THEN three ELSE two END AS domain,
           CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN '' WHEN two IN ({doubles}) THEN two ELSE one END AS suffix
    FROM named),
{_level("suffixes", '''SELECT suffix, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k,
    (SELECT (coalesce(sum(k), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0) FROM placed)::DOUBLE AS above FROM placed GROUP BY suffix''')},
{_level("domains", '''SELECT p.domain, p.suffix, sum(p.n)::DOUBLE AS n, sum(p.k)::DOUBLE AS k, any_value(s.mean) AS above
    FROM placed p JOIN suffixes s USING (suffix) GROUP BY p.domain, p.suffix''')},
{_level("hosts", '''SELECT p.host, p.n::DOUBLE AS n, p.k::DOUBLE AS k, d.mean AS above
    FROM placed p JOIN domains d USING (domain, suffix)''')}
SELECT page_id, host, path, {case(lambda r: r[0] + r[1])} AS rule,
       coalesce({case(lambda r: r[2])},
                CASE WHEN h.mean - {Z} * sqrt(h.mean * (1 - h.mean) / (h.total + 1)) > {BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict,
       h.n::BIGINT AS n_outcomes
FROM parsed JOIN hosts h USING (host)"""


def _centroids() -> str:
    from ledgerlight.llm.centroids import CLUSTERS, DIMENSIONS, LIMIT, ROUNDS, SCALE, SEED
    steps = [f"""
vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)) AS x FROM embeddings
    WHERE len(embedding) = {DIMENSIONS}
      AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e::DOUBLE) AND abs({SCALE} * e::DOUBLE) < {LIMIT})) = {DIMENSIONS}),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id::VARCHAR) NULLS LAST, x) - 1 AS c, x FROM vectors
    ORDER BY c LIMIT {CLUSTERS})"""]
    for n in range(ROUNDS + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
    SELECT v.r, any_value(v.vec_id) AS vec_id, any_value(v.x) AS x, min({{'d': (list_dot_product(v.x, v.x)
        - 2 * list_dot_product(v.x, c.x) + list_dot_product(c.x, c.x))::BIGINT, 'c': c.c}}) AS best
    FROM vectors v, c{n} c GROUP BY v.r)""")
        if n < ROUNDS:
            steps.append(f"""
c{n + 1} AS MATERIALIZED (
    SELECT c{n}.c, coalesce(m.x, c{n}.x) AS x FROM c{n} LEFT JOIN (
        SELECT c, list(floor(s / n) ORDER BY place) AS x FROM (
            SELECT c, place, sum(e) AS s, count(*) AS n FROM (
                SELECT best.c AS c, unnest(x) AS e, unnest(range({DIMENSIONS})) AS place FROM a{n}) GROUP BY c, place) GROUP BY c) m
    ON m.c = c{n}.c)""")
    return "WITH" + ",".join(steps) + f"""
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance, sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia,
       sum(best.d) OVER ()::BIGINT AS inertia,
       (SELECT sha256(array_to_string(list_transform(c.x, lambda e: e::BIGINT), ',')) FROM c{ROUNDS} c WHERE c.c = best.c) AS centroid_sha256
FROM a{ROUNDS}"""


def _resample() -> str:
    from ledgerlight.llm.resampling import BUCKETS, MIN_WORDS, PERCENT, SEED
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    split = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{word}')"
    place = "strpos('0123456789ABCDEF', substr(x, {}, 1)) - 1"
    byte = f"(({place.format('2 * i + 1')}) * 16 + {place.format('2 * i + 2')})"
    return f"""
WITH
docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {split} AS w FROM documents),
items AS (SELECT {split} AS w FROM benchmark),
own AS MATERIALIZED (SELECT r, unnest(w) AS word FROM docs),
wanted AS MATERIALIZED (SELECT unnest(w) AS word FROM items),
hexed AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM own UNION SELECT word FROM wanted)),
bits AS (
    SELECT word, flatten(list_transform(range(length(x) // 2), lambda i: list_transform(range(8), lambda k: ({byte} >> k) & 1))) AS b FROM hexed),
hashed AS MATERIALIZED (
    SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, e: xor(c >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295) % {BUCKETS} AS bucket
    FROM bits),
s AS (SELECT bucket, count(*) AS n FROM own JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN hashed USING (word) GROUP BY bucket),
gains AS (
    SELECT b.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM own) + {BUCKETS}))::DOUBLE
        / ((coalesce(s.n, 0) + 1) * ((SELECT count(*) FROM wanted) + {BUCKETS}))::DOUBLE))::BIGINT AS gain
    FROM (SELECT unnest(range({BUCKETS})) AS bucket) b LEFT JOIN s ON s.bucket = b.bucket LEFT JOIN t ON t.bucket = b.bucket),
sums AS (SELECT r, sum(gain) AS total FROM own JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r),
weights AS (
    SELECT docs.r, doc_id, len(w) AS n_features, CASE WHEN len(w) = 0 THEN 0
        ELSE (total - (((total % len(w)) + len(w)) % len(w))) // len(w) END::BIGINT AS weight
    FROM docs LEFT JOIN sums USING (r)),
scored AS (
    SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
        / 4294967296::DOUBLE)))::BIGINT AS score FROM weights),
able AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * {PERCENT} // 100 THEN place END AS rank
FROM scored LEFT JOIN able USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {"op4_ngram_join": _NGRAM_JOIN, "op7_url_filter": _url_filter(), "op11_centroids": _centroids(), "op13_resample": _resample()}
