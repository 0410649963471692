"""DuckDB statements of every SQL-expressible query, for the correctness gate.

Each statement reads the driver's tables (registered as views) and restates
the adapters of ``ledgerlight.sources.fixtures`` as CTEs, then the query
itself, written independently of the Spark code.  Column names and types
are aligned with the Spark results (BIGINT counts, DOUBLE money, DATE months).
"""

from __future__ import annotations

import re

# --------------------------------------------------------------------------
# Adapters (same rules as ledgerlight.sources.fixtures)
# --------------------------------------------------------------------------

WS = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*"


def blank(expr: str) -> str:
    return f"regexp_full_match(CAST({expr} AS VARCHAR), '{WS}')"


def uuid5_sql(name: str) -> str:
    """v5 UUID text of a VARCHAR expression (DNS namespace)."""
    h = f"sha1(from_hex('6ba7b8109dad11d180b400c04fd430c8') || encode({name}))"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
            f"substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr({h}, 17, 1)), 1) || "
            f"substr({h}, 18, 3) || '-' || substr({h}, 21, 12))")


def row_uuid_sql(class_name: str, cols: list[str]) -> str:
    parts = [f"'{class_name}'"]
    for c in sorted(cols):
        v = f"CAST({c} AS VARCHAR)"
        parts.append(f"coalesce('|{c}=' || CAST(length({v}) AS VARCHAR) || ':' || {v}, '|{c}=~')")
    return uuid5_sql(" || ".join(parts))


CTES: dict[str, str] = {
    "stg_customers": """
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name
        FROM customer""",
    "stg_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status
        FROM orders""",
    "stg_payments": """
        SELECT l_orderkey * 10 + l_linenumber AS payment_id, l_orderkey AS order_id,
               (['credit_card', 'coupon', 'bank_transfer', 'gift_card', 'other'])[l_partkey % 5 + 1]
                   AS payment_method,
               CAST(round(l_extendedprice) AS BIGINT) AS amount
        FROM lineitem""",
    "sp_base": """
        SELECT o_orderkey AS subscription_id, o_custkey AS customer_id,
               CASE WHEN o_orderkey % 2 = 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE)
                    ELSE CAST(o_orderdate AS DATE) END AS start_date,
               10.0::DOUBLE * (o_orderkey % 5 + 1) AS monthly_amount
        FROM orders""",
    "stg_subscription_periods": """
        SELECT subscription_id, customer_id, start_date,
               CASE WHEN nxt IS NULL AND customer_id % 10 = 0 THEN NULL
                    WHEN nxt IS NULL THEN term_end
                    ELSE least(nxt, term_end) END AS end_date,
               monthly_amount
        FROM (SELECT *,
                     lead(start_date) OVER (PARTITION BY customer_id ORDER BY start_date, subscription_id) AS nxt,
                     CAST(start_date + to_months(CAST(subscription_id % 6 + 1 AS INTEGER)) AS DATE) AS term_end
              FROM sp_base)""",
    "stg_sessions": """
        SELECT event_id AS session_id, user_id AS customer_id, ts AS started_at,
               nullif(event_type, 'error') AS utm_medium,
               'src' || CAST(event_id % 4 AS VARCHAR) AS utm_source
        FROM events""",
    "stg_conversions": """
        SELECT user_id AS customer_id, max(ts) AS converted_at,
               round(arg_max(value, (ts, event_id)) * 100) / 100 AS revenue
        FROM events WHERE event_type = 'purchase' GROUP BY user_id""",
    "stg_comments": """
        SELECT CAST(conv_id AS VARCHAR) AS customer_id, text AS review_text,
               TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(turn AS INTEGER)) AS date
        FROM conversations WHERE role = 'user'""",
    "stg_calls": """
        SELECT split_part(p, '-', 1) AS customer_id, text AS transcript, p AS relative_path
        FROM (SELECT *, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) || '.wav' AS p
              FROM conversations WHERE role = 'assistant')""",
    "stg_training": """
        SELECT d.doc_id, d.text AS review_text, CAST(l.quality AS VARCHAR) AS label
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "stg_taxi": """
        SELECT event_id AS trip_id, user_id % 20 AS pickup_location_id,
               event_id % 15 AS dropoff_location_id, ts AS pickup_datetime,
               ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS dropoff_datetime,
               value / 10 AS trip_distance
        FROM events""",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with every adapter / helper CTE it needs, in order."""
    defs = dict(CTES)
    defs.update(extra or {})
    order: list[str] = []

    def visit(name: str, seen: set):
        if name in order:
            return
        if name in seen:
            raise ValueError(f"cycle at {name}")
        for dep in [n for n in defs if n != name and re.search(rf"\b{n}\b", defs[name])]:
            visit(dep, seen | {name})
        order.append(name)

    for name in [n for n in defs if re.search(rf"\b{n}\b", body)]:
        visit(name, set())
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({defs[n]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------

Q: dict[str, str] = {}
HELPERS: dict[str, str] = {}


def _q(key: str, body: str, **helpers: str) -> None:
    Q[key] = with_ctes(body, helpers or None)


# -- Order rollups ------------------------------------------------------------
# Payments are totalled per order first; every rollup then reads those totals.

_methods = ["credit_card", "coupon", "bank_transfer", "gift_card"]
HELPERS["paid_q"] = "SELECT order_id, map_from_entries(list((payment_method, cents))) AS by_method, " \
    "CAST(sum(cents) AS BIGINT) AS cents FROM (SELECT order_id, payment_method, CAST(sum(amount) AS BIGINT) " \
    "AS cents FROM stg_payments GROUP BY ALL) GROUP BY order_id"
HELPERS["order_facts_q"] = """
    SELECT customer_id, order_id, order_date, status, by_method, cents
    FROM stg_orders FULL JOIN paid_q USING (order_id)"""
HELPERS["customers_q"] = """
    SELECT customer_id, any_value(c.first_name) AS first_name, any_value(c.last_name) AS last_name,
           min(f.order_date) AS first_order, max(f.order_date) AS most_recent_order,
           nullif(count(f.order_date), 0) AS number_of_orders,
           CAST(sum(f.cents) AS BIGINT) / 100.0::DOUBLE AS customer_lifetime_value
    FROM stg_customers c LEFT JOIN order_facts_q f USING (customer_id) GROUP BY customer_id"""

_q("customer_orders", """
    SELECT customer_id, list_min(days) AS first_order, list_max(days) AS most_recent_order,
           CAST(len(days) AS BIGINT) AS number_of_orders
    FROM (SELECT customer_id, list(order_date) AS days FROM stg_orders GROUP BY customer_id)""")
_q("customer_payments", """
    SELECT customer_id, CAST(sum(cents) AS BIGINT) / 100.0::DOUBLE AS total_amount
    FROM order_facts_q WHERE cents IS NOT NULL GROUP BY customer_id""", **HELPERS)
_q("customers", "SELECT * FROM customers_q", **HELPERS)

_q("order_payments", "SELECT order_id, customer_id, order_date, status, " + ", ".join(
    f"CASE WHEN cents IS NOT NULL THEN coalesce(by_method['{m}'], 0) / 100.0::DOUBLE END AS {m}_amount"
    for m in _methods) + ", cents / 100.0::DOUBLE AS amount FROM order_facts_q WHERE status IS NOT NULL", **HELPERS)
_q("order_payments_pivot", "SELECT order_id, customer_id, order_date, status, " + ", ".join(
    f"CAST(by_method['{m}'] AS DOUBLE) AS {m}_amount" for m in _methods) +
    ", cents AS total_amount FROM order_facts_q WHERE status IS NOT NULL AND cents IS NOT NULL", **HELPERS)

# -- MRR, from its definitions -------------------------------------------------
# A customer's months are unnested from its own span; a period pays for the
# month starts it holds; the previous month is looked up by date.  Periods of
# a customer never overlap (see stg_subscription_periods), so a customer has
# one value per month.

HELPERS["span_q"] = """
    SELECT customer_id, date_trunc('month', min(start_date))::DATE AS date_month_start,
           date_trunc('month', max(end_date))::DATE AS date_month_end
    FROM stg_subscription_periods GROUP BY customer_id"""
HELPERS["span_months_q"] = """
    SELECT customer_id, (date_month_start + to_months(CAST(i AS INTEGER)))::DATE AS date_month
    FROM (SELECT *, unnest(range(date_diff('month', date_month_start, date_month_end))) AS i FROM span_q)"""
HELPERS["paid_months_q"] = """
    SELECT p.customer_id, p.monthly_amount,
           unnest(generate_series(date_trunc('month', p.start_date + INTERVAL 1 MONTH - INTERVAL 1 DAY)::TIMESTAMP,
                                  coalesce(p.end_date, s.date_month_end) - INTERVAL 1 DAY,
                                  INTERVAL 1 MONTH))::DATE AS date_month
    FROM stg_subscription_periods p JOIN span_q s USING (customer_id)"""
HELPERS["month_value_q"] = """
    SELECT customer_id, date_month, coalesce(monthly_amount, 0.0::DOUBLE) AS mrr
    FROM span_months_q LEFT JOIN paid_months_q USING (customer_id, date_month)"""
HELPERS["active_q"] = """
    SELECT customer_id, list_min(m) AS first_active_month, list_max(m) AS last_active_month
    FROM (SELECT customer_id, list(date_month) FILTER (mrr > 0) AS m FROM month_value_q GROUP BY customer_id)"""

_q("calendar_months", """
    SELECT CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH))
                AS DATE) AS date_month
    FROM (SELECT min(start_date) AS lo, max(greatest(start_date, coalesce(end_date, start_date))) AS hi
          FROM stg_subscription_periods)""")
_q("calendar_from_to", """
    SELECT (lo + to_months(CAST(unnest(range(date_diff('month', lo, hi) + 1)) AS INTEGER)))::DATE AS date_month
    FROM (SELECT date_trunc('month', min(o_orderdate))::DATE AS lo, date_trunc('month', max(o_orderdate))::DATE AS hi
          FROM orders)""")
_q("customer_span", "SELECT * FROM span_q", **HELPERS)
_q("customer_months", "SELECT * FROM span_months_q", **HELPERS)
_q("mrr_monthly", """
    SELECT v.date_month, customer_id, v.mrr, v.mrr > 0 AS is_active, a.first_active_month, a.last_active_month,
           a.first_active_month IS NOT DISTINCT FROM v.date_month AS is_first_month,
           a.last_active_month IS NOT DISTINCT FROM v.date_month AS is_last_month
    FROM month_value_q v JOIN active_q a USING (customer_id)""", **HELPERS)
# a customer's month against the month before; the row that closes its activity
# (worth 0 in the month after the last active one) follows that month's own
# value where there is one, else the last active month's
HELPERS["movement_q"] = """
    SELECT v.customer_id, v.date_month, v.mrr, coalesce(b.mrr, 0.0::DOUBLE) AS before,
           v.date_month IS NOT DISTINCT FROM a.first_active_month AS opens,
           v.date_month IS NOT DISTINCT FROM a.last_active_month AS closes, a.first_active_month, a.last_active_month
    FROM month_value_q v JOIN active_q a USING (customer_id)
    LEFT JOIN month_value_q b ON b.customer_id = v.customer_id AND b.date_month = v.date_month - INTERVAL 1 MONTH
    UNION ALL BY NAME
    SELECT a.customer_id, (a.last_active_month + INTERVAL 1 MONTH)::DATE AS date_month, 0.0::DOUBLE AS mrr,
           coalesce(same.mrr, latest.mrr) AS before, false AS opens, false AS closes,
           a.first_active_month, a.last_active_month
    FROM active_q a
    JOIN month_value_q latest ON latest.customer_id = a.customer_id AND latest.date_month = a.last_active_month
    LEFT JOIN month_value_q same
      ON same.customer_id = a.customer_id AND same.date_month = a.last_active_month + INTERVAL 1 MONTH"""
HELPERS["mrr_q"] = """
    SELECT md5(customer_id::VARCHAR) AS id, date_month, customer_id, mrr, mrr > 0 AS is_active,
           first_active_month, last_active_month, opens AS is_first_month, closes AS is_last_month,
           before > 0 AS previous_month_is_active, before AS previous_month_mrr, mrr - before AS mrr_change,
           -- by what the customer pays now (0: nothing) and paid before
           CASE sign(mrr)::INT * 2 + sign(before)::INT
                WHEN 1 THEN 'churn'
                WHEN 2 THEN if(opens, 'new', 'reactivation')
                WHEN 3 THEN if(opens, 'new', ['downgrade', NULL, 'upgrade'][sign(mrr - before)::INT + 2])
           END AS change_category,
           list_min([mrr, before]) AS renewal_amount
    FROM movement_q"""
_q("mrr", "SELECT * FROM mrr_q", **HELPERS)

# -- Attribution: a conversion's path as one ordered list ------------------------

def _paths_sql(days: int) -> str:
    """One row per conversion: its sessions of the last ``days`` days, oldest first."""
    return f"""
    SELECT c.customer_id, c.converted_at, c.revenue,
           list({{'id': s.session_id, 'at': s.started_at, 'medium': s.utm_medium, 'source': s.utm_source}}
                ORDER BY s.started_at, s.session_id) AS path
    FROM stg_conversions c JOIN stg_sessions s
      ON s.customer_id = c.customer_id
     AND s.started_at BETWEEN c.converted_at - to_days({days}) AND c.converted_at
    GROUP BY ALL"""


# the share of each step of a path of n steps: ends 40 %, the steps between share 20 %
HELPERS["touches_q"] = """
    SELECT t.id AS session_id, customer_id, t.at AS started_at, t.medium AS utm_medium, t.source AS utm_source,
           converted_at, revenue, n AS total_sessions, i AS session_index,
           (i = 1)::INT::DOUBLE AS first_touch_points, (i = n)::INT::DOUBLE AS last_touch_points,
           w AS forty_twenty_forty_points, 1.0::DOUBLE / n AS linear_points,
           if(i = 1, revenue, 0.0::DOUBLE) AS first_touch_revenue,
           if(i = n, revenue, 0.0::DOUBLE) AS last_touch_revenue,
           revenue * w AS forty_twenty_forty_revenue, revenue * (1.0::DOUBLE / n) AS linear_revenue
    FROM (SELECT *, if(n <= 2, 1.0::DOUBLE / n, if(i IN (1, n), 0.4::DOUBLE, 0.2::DOUBLE / (n - 2))) AS w
          FROM (SELECT customer_id, converted_at, revenue, unnest(path) AS t,
                       CAST(generate_subscripts(path, 1) AS BIGINT) AS i, CAST(len(path) AS BIGINT) AS n
                FROM paths_q))"""
_month = HELPERS | {"paths_q": _paths_sql(30)}
_q("attribution_touches", "SELECT * FROM touches_q", **_month)
_q("attribution_touches_1d", "SELECT * FROM touches_q", **HELPERS | {"paths_q": _paths_sql(1)})
_q("distinct_mediums", "SELECT DISTINCT coalesce(utm_medium, 'NONE') AS utm_medium FROM touches_q", **_month)
_q("pres_ad_spend", """
    SELECT utm_medium AS medium, CAST(sum(CAST(revenue AS DECIMAL(38,6))) AS DOUBLE) AS revenue FROM touches_q
    WHERE utm_medium IS NOT NULL AND revenue IS NOT NULL GROUP BY utm_medium""", **_month)
# The mediums of the events (a view can't hold a pivot over found values).
_mediums = ["NONE", "click", "purchase", "signup", "view"]
_q("revenue_by_medium", "SELECT utm_source AS source, " + ", ".join(
    f"CAST(sum(CAST(revenue AS DECIMAL(38,6))) FILTER (coalesce(utm_medium, 'NONE') = '{m}') AS DOUBLE) AS \"{m}\""
    for m in _mediums) + " FROM touches_q GROUP BY utm_source", **_month)

# -- Text cleaning, ids, import -------------------------------------------------

def clean_sql(source: str, cols: list[str], text_col: str, cls: str) -> str:
    keep = " AND ".join(f"{c} IS NOT NULL AND NOT {blank(c)}" for c in cols)
    sel = ", ".join(f"replace({c}, chr(10), '') AS {c}" if c == text_col else c for c in cols)
    return (f"SELECT *, {row_uuid_sql(cls, cols)} AS uuid FROM "
            f"(SELECT {sel} FROM ({source}) WHERE {keep})")


HELPERS["clean_training_q"] = clean_sql(
    "SELECT doc_id, review_text, label FROM stg_training", ["doc_id", "review_text", "label"],
    "review_text", "CommentTraining")
HELPERS["clean_comments_q"] = clean_sql(
    "SELECT customer_id, review_text, strftime(date, '%Y-%m-%dT%H:%M:%S-00:00') AS date FROM stg_comments",
    ["customer_id", "review_text", "date"], "review_text", "CustomerComment")
HELPERS["clean_calls_q"] = clean_sql(
    "SELECT customer_id, transcript, relative_path FROM stg_calls",
    ["customer_id", "transcript", "relative_path"], "transcript", "CustomerCall")
HELPERS["scored_comments_q"] = \
    "SELECT *, (length(review_text) % 129) / 128.0::DOUBLE AS sentiment FROM clean_comments_q"
HELPERS["scored_calls_q"] = \
    "SELECT *, (length(transcript) % 65) / 64.0::DOUBLE AS sentiment FROM clean_calls_q"
HELPERS["doc_objects_q"] = clean_sql(
    "SELECT text AS review_text, lang FROM documents", ["review_text", "lang"], "review_text", "Document")
HELPERS["labelled_objects_q"] = clean_sql(
    "SELECT text AS review_text, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    ["review_text", "lang"], "review_text", "Document")

_q("text_clean_training", "SELECT * FROM clean_training_q", **HELPERS)
_q("text_clean_comments", "SELECT * FROM clean_comments_q", **HELPERS)
_q("text_clean_calls", "SELECT * FROM clean_calls_q", **HELPERS)
_q("uuid5_ids", f"SELECT doc_id, {row_uuid_sql('Document', ['doc_id', 'lang', 'text'])} AS uuid FROM documents")
_q("import_new_only", """
    SELECT DISTINCT review_text, lang, uuid FROM doc_objects_q
    WHERE uuid NOT IN (SELECT uuid FROM labelled_objects_q)""", **HELPERS)

# -- Presentation tables ----------------------------------------------------------

HELPERS["sentiment_q"] = """
    SELECT cm.customer_id, coalesce(ca.calls_sentiment, 0.0::DOUBLE) AS calls_sentiment,
           cm.comments_sentiment, score AS sentiment_score,
           CASE WHEN score < 0 THEN 0 WHEN score >= 1 THEN 11
                ELSE CAST(floor(score * 10) AS BIGINT) + 1 END AS sentiment_bucket
    FROM (SELECT customer_id, avg(sentiment) AS calls_sentiment FROM scored_calls_q GROUP BY customer_id) ca
    RIGHT JOIN (SELECT customer_id, avg(sentiment) AS comments_sentiment
                FROM scored_comments_q GROUP BY customer_id) cm ON ca.customer_id = cm.customer_id,
    LATERAL (SELECT round((coalesce(ca.calls_sentiment, 0.0::DOUBLE) + cm.comments_sentiment) / 2, 4) AS score)"""
HELPERS["churn_q"] = """
    SELECT m.customer_id, c.first_name || ' ' || c.last_name AS name, c.clv, m.last_active_month,
           s.sentiment_score
    FROM (SELECT customer_id, first_name, last_name, round(customer_lifetime_value, 2) AS clv
          FROM customers_q) c
    RIGHT JOIN mrr_q m ON c.customer_id = m.customer_id
    LEFT JOIN sentiment_q s ON m.customer_id = TRY_CAST(s.customer_id AS BIGINT)
    WHERE c.clv IS NOT NULL AND m.change_category = 'churn'"""

_q("pres_sentiment", "SELECT * FROM sentiment_q", **HELPERS)
_q("pres_clv", """
    SELECT c.customer_id, c.first_name || ' ' || c.last_name AS name, c.first_order, c.most_recent_order,
           c.number_of_orders, round(c.customer_lifetime_value, 2) AS clv, s.sentiment_score
    FROM customers_q c LEFT JOIN sentiment_q s ON c.customer_id = TRY_CAST(s.customer_id AS BIGINT)
    WHERE round(c.customer_lifetime_value, 2) IS NOT NULL""", **HELPERS)
_q("pres_churn", "SELECT * FROM churn_q", **HELPERS)
_q("calls_drilldown", """
    SELECT TRY_CAST(customer_id AS BIGINT) AS customer_id, transcript, relative_path, sentiment,
           row_number() OVER (PARTITION BY TRY_CAST(customer_id AS BIGINT)
                              ORDER BY sentiment DESC NULLS LAST, relative_path) AS call_rank
    FROM scored_calls_q
    WHERE TRY_CAST(customer_id AS BIGINT) IN (SELECT customer_id FROM churn_q)""", **HELPERS)
_q("comments_top5", """
    SELECT customer_id, review_text, date, sentiment, comment_rank FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY sentiment DESC NULLS LAST, uuid)
                AS comment_rank
      FROM scored_comments_q) WHERE comment_rank <= 5""", **HELPERS)
_q("rename_all", """
    SELECT customer_id AS "CUSTOMER ID", transcript AS "TRANSCRIPT", relative_path AS "RELATIVE PATH",
           uuid AS "UUID", sentiment AS "SENTIMENT" FROM scored_calls_q""", **HELPERS)
_q("pred_like", "SELECT * FROM stg_payments WHERE payment_method LIKE 'bank\\_%' ESCAPE '\\'")

# -- Collections and search --------------------------------------------------------

HELPERS["coll_q"] = (f"SELECT {row_uuid_sql('Embedding', ['vec_id', 'label'])} AS uuid, vec_id, label, "
                     "embedding AS vector FROM embeddings")
HELPERS["centroid_q"] = """
    SELECT label AS query_id, list(m ORDER BY pos) AS c FROM (
      SELECT label, pos, avg(CAST(x AS DOUBLE)) AS m FROM (
        SELECT label, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS pos
        FROM embeddings) GROUP BY label, pos) GROUP BY label"""
HELPERS["topk_q"] = """
    SELECT query_id, rank, uuid, similarity FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, uuid) AS rank FROM (
        SELECT c.query_id, e.uuid,
               round(list_cosine_similarity(CAST(e.vector AS DOUBLE[]), c.c), 6) AS similarity
        FROM centroid_q c CROSS JOIN coll_q e)) WHERE rank <= 3"""
HELPERS["doc_tf_q"] = """
    SELECT doc_id, term, count(*) AS tf FROM (
      SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\pL\\pN]+')) AS term FROM documents)
    WHERE length(term) > 0 GROUP BY doc_id, term"""
HELPERS["doc_df_q"] = "SELECT term, count(*) AS df FROM doc_tf_q GROUP BY term"
HELPERS["n_docs_q"] = "SELECT CAST(count(*) AS DOUBLE) AS n FROM documents"
HELPERS["doc_w_q"] = """
    SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM (
      SELECT t.doc_id, t.term, t.tf * ln((n.n + 1.0) / (f.df + 1.0)) AS w
      FROM doc_tf_q t JOIN doc_df_q f ON t.term = f.term CROSS JOIN n_docs_q n)"""
HELPERS["query_w_q"] = """
    SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS qw FROM (
      SELECT t.item_id, t.term, t.tf * ln((n.n + 1.0) / (coalesce(f.df, 0) + 1.0)) AS w
      FROM (SELECT item_id, term, count(*) AS tf FROM (
              SELECT item_id, unnest(regexp_split_to_array(lower(text), '[^\\pL\\pN]+')) AS term
              FROM benchmark) WHERE length(term) > 0 GROUP BY item_id, term) t
      LEFT JOIN doc_df_q f ON t.term = f.term CROSS JOIN n_docs_q n)"""

_q("collection_flatten", "SELECT * FROM coll_q", **HELPERS)
_q("vector_topk", "SELECT * FROM topk_q", **HELPERS)
_q("vector_by_id", "SELECT * FROM coll_q WHERE uuid IN (SELECT uuid FROM topk_q WHERE rank = 1)", **HELPERS)
_q("text_embed", "SELECT doc_id, term, round(weight, 9) AS weight FROM doc_w_q", **HELPERS)
_q("text_search_top1", """
    SELECT item_id, rank, doc_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM (
        SELECT q.item_id, d.doc_id, round(sum(q.qw * d.weight), 6) AS score
        FROM query_w_q q JOIN doc_w_q d ON q.term = d.term GROUP BY q.item_id, d.doc_id))
    WHERE rank <= 1""", **HELPERS)

# -- Taxi ----------------------------------------------------------------------------

HELPERS["taxi_q"] = """
    SELECT trip_id, CAST(pickup_location_id AS VARCHAR) AS pickup_location_id,
           CAST(dropoff_location_id AS VARCHAR) AS dropoff_location_id,
           CAST(hour(pickup_datetime) AS INTEGER) AS hour, trip_distance,
           date_diff('second', pickup_datetime, dropoff_datetime) AS trip_duration_sec
    FROM stg_taxi"""
_q("taxi_transform", "SELECT * FROM taxi_q", **HELPERS)
_q("taxi_scaled", """
    SELECT trip_id, trip_distance, trip_distance / (SELECT max(abs(trip_distance)) FROM taxi_q)
           AS trip_distance_scaled FROM taxi_q""", **HELPERS)
_q("split_hash", """
    SELECT trip_id, b AS split_bucket, b < 70 AS is_train FROM (
      SELECT trip_id, CAST(CAST('0x' || substr(md5(CAST(trip_id AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 100
                           AS INTEGER) AS b
      FROM taxi_q)""", **HELPERS)

# -- Models: what holds of any right fit ---------------------------------------------

def in_train_sql(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT) % 100 < 70"


_categories = ["pickup_location_id", "dropoff_location_id", "hour_of_day"]
HELPERS["trips_q"] = f"""
    SELECT *, CAST(hour AS VARCHAR) AS hour_of_day, {in_train_sql('trip_id', 42)} AS is_train FROM taxi_q"""
HELPERS["trip_values_q"] = " UNION ALL ".join(
    f"SELECT {n} AS c, '{c}' AS category, trip_id, is_train, {c} AS value FROM trips_q" for n, c in enumerate(_categories))
HELPERS["places_q"] = """
    SELECT c, value, row_number() OVER (PARTITION BY c ORDER BY value) - 1 AS place
    FROM (SELECT DISTINCT c, value FROM trip_values_q WHERE is_train)"""
# a category takes its training values, one place for unseen values and one for invalid ones
HELPERS["widths_q"] = "SELECT c, count(*) + 2 AS width FROM places_q GROUP BY c"
_q("taxi_features", """
    SELECT trip_id, CAST((SELECT coalesce(sum(width), 0) FROM widths_q w WHERE w.c < v.c)
                         + coalesce(p.place, (SELECT width - 2 FROM widths_q w WHERE w.c = v.c)) AS INTEGER) AS position,
           1.0::DOUBLE AS value
    FROM trip_values_q v LEFT JOIN places_q p ON p.c = v.c AND p.value = v.value
    UNION ALL
    SELECT trip_id, CAST((SELECT sum(width) FROM widths_q) AS INTEGER) AS position,
           trip_distance / (SELECT max(abs(trip_distance)) FROM trips_q WHERE is_train) AS value
    FROM trips_q WHERE trip_distance != 0""", **HELPERS)
_q("taxi_model", """
    SELECT category, value, count(*) AS train_rows, 0.0::DOUBLE AS mean_residual
    FROM trip_values_q WHERE is_train GROUP BY category, value""", **HELPERS)
_q("taxi_predict", """
    SELECT pickup_location_id, hour_of_day, count(*) AS trips, count(*) AS predicted FROM trips_q
    GROUP BY pickup_location_id, hour_of_day""", **HELPERS)
_q("taxi_cross_counts", """
    SELECT is_train, pickup_location_id, dropoff_location_id, hour_of_day, count(*) AS trips,
           CAST(sum(trip_duration_sec) AS BIGINT) AS seconds
    FROM trips_q GROUP BY GROUPING SETS (
        (is_train), (is_train, pickup_location_id), (is_train, dropoff_location_id), (is_train, hour_of_day),
        (is_train, pickup_location_id, dropoff_location_id), (is_train, pickup_location_id, hour_of_day),
        (is_train, dropoff_location_id, hour_of_day))""", **HELPERS)
_q("registry_roundtrip", """
    SELECT pickup_location_id, count(*) AS trips, CAST(0 AS BIGINT) AS differ, CAST(2 AS BIGINT) AS metrics
    FROM trips_q GROUP BY pickup_location_id""", **HELPERS)
_q("sentiment_model", f"""
    SELECT CAST(label AS INTEGER) AS label, count(*) AS objects, label = '1' AS likely_positive
    FROM clean_training_q WHERE {in_train_sql('uuid', 1883)} GROUP BY label""", **HELPERS)
_q("sentiment_score", """
    SELECT uuid, true AS is_probability FROM clean_comments_q
    UNION ALL SELECT uuid, true FROM clean_calls_q""", **HELPERS)

HELPERS["length_scored_q"] = f"""
    SELECT row_number() OVER () AS n, {in_train_sql('uuid', 1883)} AS is_train, label = '1' AS positive,
           (length(review_text) % 129) / 128.0::DOUBLE AS score FROM clean_training_q"""
#: The share of (positive, negative) pairs that the score puts in order, equal scores counting half.
_q("length_auc", """
    SELECT p.is_train, count(DISTINCT p.n) AS positives, count(DISTINCT q.n) AS negatives,
           avg(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0.0 END)::DOUBLE AS auc
    FROM length_scored_q p JOIN length_scored_q q ON p.is_train = q.is_train AND p.positive AND NOT q.positive
    GROUP BY p.is_train""", **HELPERS)

# -- Sources, sinks, catalog: the data read back equals its source ------------------

_q("src_csv_roundtrip", "SELECT * FROM stg_customers")
_q("src_csv_multi", "SELECT * FROM stg_taxi")
HELPERS["files_q"] = """
    SELECT 'customer_group=' || folder || '/file=' || (before // 8192) AS name, folder, CAST(sum(size) AS BIGINT) AS size
    FROM (SELECT folder, size, CAST(coalesce(sum(size) OVER (PARTITION BY folder ORDER BY relative_path, transcript
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
          FROM (SELECT CAST(CAST(customer_id AS BIGINT) % 16 AS VARCHAR) AS folder, relative_path, transcript,
                       coalesce(strlen(transcript), 0) + 1 AS size FROM stg_calls))
    GROUP BY ALL"""
_q("src_file_listing", "SELECT * FROM files_q", **HELPERS)
_q("src_file_lookup", "SELECT * FROM files_q WHERE folder = '1'", **HELPERS)
_q("sink_new_table", """
    SELECT utm_medium AS medium, CAST(sum(CAST(revenue AS DECIMAL(38,6))) AS DOUBLE) AS revenue FROM touches_q
    WHERE utm_medium IS NOT NULL AND revenue IS NOT NULL GROUP BY utm_medium""", **_month)
_q("sink_overwrite", "SELECT * FROM customers_q", **HELPERS)
_q("catalog_ddl", "SELECT * FROM stg_customers")
_q("catalog_cleanup", "SELECT * FROM customers_q", **HELPERS)
_q("snapshot_restore", "SELECT * FROM coll_q", **HELPERS)


def _near_text_sql(prefix: str, corpus: str, k: int) -> tuple[str, dict]:
    """TF-IDF cosine top-k of benchmark passages over ``corpus`` (uuid, text)."""
    h = {
        f"{prefix}_tf": f"""
            SELECT uuid, term, count(*) AS tf FROM (
              SELECT uuid, unnest(regexp_split_to_array(lower(text), '[^\\pL\\pN]+')) AS term
              FROM ({corpus})) WHERE length(term) > 0 GROUP BY uuid, term""",
        f"{prefix}_df": f"SELECT term, count(*) AS df FROM {prefix}_tf GROUP BY term",
        f"{prefix}_n": f"SELECT CAST(count(*) AS DOUBLE) AS n FROM ({corpus})",
        f"{prefix}_w": f"""
            SELECT uuid, term, w / sqrt(sum(w * w) OVER (PARTITION BY uuid)) AS weight FROM (
              SELECT t.uuid, t.term, t.tf * ln((n.n + 1.0) / (f.df + 1.0)) AS w
              FROM {prefix}_tf t JOIN {prefix}_df f ON t.term = f.term CROSS JOIN {prefix}_n n)""",
        f"{prefix}_q": f"""
            SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS qw FROM (
              SELECT t.item_id, t.term, t.tf * ln((n.n + 1.0) / (coalesce(f.df, 0) + 1.0)) AS w
              FROM (SELECT item_id, term, count(*) AS tf FROM (
                      SELECT item_id, unnest(regexp_split_to_array(lower(text), '[^\\pL\\pN]+')) AS term
                      FROM benchmark) WHERE length(term) > 0 GROUP BY item_id, term) t
              LEFT JOIN {prefix}_df f ON t.term = f.term CROSS JOIN {prefix}_n n)""",
    }
    body = f"""
        SELECT item_id, rank, uuid, score FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, uuid) AS rank FROM (
            SELECT q.item_id, d.uuid, round(sum(q.qw * d.weight), 6) AS score
            FROM {prefix}_q q JOIN {prefix}_w d ON q.term = d.term GROUP BY q.item_id, d.uuid))
        WHERE rank <= {k}"""
    return body, h


_body, _h = _near_text_sql("cnt", "SELECT uuid, review_text AS text FROM clean_comments_q", 3)
_q("comments_near_text", _body, **HELPERS, **_h)
_body, _h = _near_text_sql("knt", "SELECT uuid, transcript AS text FROM clean_calls_q", 3)
_q("calls_near_text", _body, **HELPERS, **_h)
_body, _h = _near_text_sql("cqa", "SELECT uuid, review_text AS text FROM clean_comments_q", 1)
_q("comments_question_top1", _body, **HELPERS, **_h)
_body, _h = _near_text_sql("kqa", "SELECT uuid, transcript AS text FROM clean_calls_q", 1)
_q("calls_question_top1", _body, **HELPERS, **_h)


# Day-valued result columns are presented as midnight timestamps (see
# ``ledgerlight.queries.present``).
DATE_COLUMNS = {
    "customer_orders": ["first_order", "most_recent_order"],
    "customers": ["first_order", "most_recent_order"],
    "order_payments": ["order_date"],
    "order_payments_pivot": ["order_date"],
    "calendar_months": ["date_month"],
    "calendar_from_to": ["date_month"],
    "customer_span": ["date_month_start", "date_month_end"],
    "customer_months": ["date_month"],
    "mrr_monthly": ["date_month", "first_active_month", "last_active_month"],
    "mrr": ["date_month", "first_active_month", "last_active_month"],
    "pres_clv": ["first_order", "most_recent_order"],
    "pres_churn": ["last_active_month"],
    "sink_overwrite": ["first_order", "most_recent_order"],
    "catalog_cleanup": ["first_order", "most_recent_order"],
}


def _presented(key: str, sql: str) -> str:
    cols = DATE_COLUMNS.get(key)
    if not cols:
        return sql
    casts = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({casts}) FROM (\n{sql}\n)"


def oracle_sql() -> dict[str, str]:
    return {k: _presented(k, v) for k, v in Q.items()}
