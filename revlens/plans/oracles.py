"""Independent DuckDB SQL oracles for the registered queries.

Each oracle re-derives its answer from the supplied tables with plain SQL;
none reads anything the Spark side produced.  The review test bed is
re-derived here as the ``reviews`` CTE (see ``revlens.sources.testbed``).
"""

from __future__ import annotations

from revlens import params
from revlens.sources import testbed

NL = "chr(10)"

REVIEWS_CTE = f"""
d0 AS (
  SELECT doc_id, source, coalesce(text, '') AS text FROM documents
),
d1 AS (
  SELECT doc_id, source, text, strpos(text, {NL}) AS nl FROM d0
),
d2 AS (
  SELECT doc_id, source,
         CASE WHEN nl > 0 THEN substr(text, 1, nl - 1) ELSE text END AS t0,
         CASE WHEN nl > 0 THEN substr(text, nl + 1) ELSE '' END AS b0
  FROM d1
),
reviews AS (
  SELECT doc_id,
         source AS target,
         doc_id AS pos,
         CAST(doc_id // {testbed.PAGE_SPAN} + 1 AS INTEGER) AS page_no,
         CAST(DATE '2024-01-30' - CAST((doc_id // 20) % 30 AS INTEGER) AS DATE) AS date,
         nullif(CAST((doc_id // 7) % 6 AS INTEGER), 0) AS rating,
         CASE WHEN doc_id % 25 = 14 THEN NULL
              WHEN doc_id % 10 = 3 AND length(b0) > 20 THEN left(b0, 20) || '...'
              WHEN doc_id % 10 = 7 THEN t0 || '...'
              ELSE t0 END AS title,
         CASE WHEN doc_id % 25 = 9 THEN NULL
              WHEN doc_id % 25 = 4 THEN '{params.PLACEHOLDER_BODY}'
              ELSE b0 END AS body,
         CASE doc_id % 3
              WHEN 0 THEN ''
              WHEN 1 THEN 'https://img.example.com/r/' || doc_id || '/0.jpg'
              ELSE 'https://img.example.com/r/' || doc_id || '/0.jpg' || {NL} ||
                   'https://img.example.com/r/' || doc_id || '/1.jpg' END AS image,
         CASE WHEN doc_id % 4 = 0 THEN 'Verified Purchase' END AS badge,
         CASE WHEN doc_id % 11 <> 5 THEN CAST(doc_id % 60 AS VARCHAR) || ' BTU' END AS size
  FROM d2
)"""


def with_reviews(body: str) -> str:
    return f"WITH {REVIEWS_CTE}\n{body}"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rule_case(tag: str, pattern: str) -> str:
    p = _sql_str(pattern)
    return (f"CASE WHEN coalesce(rating >= 3, false) THEN 0 "
            f"WHEN coalesce(regexp_matches(lower(title), {p}), false) "
            f"OR coalesce(regexp_matches(lower(body), {p}), false) THEN 1 ELSE 0 END")


def _category(tags) -> str:
    parts = ", ".join(f"CASE WHEN \"{t}\" = 1 THEN {_sql_str(t)} END" for t in tags)
    return f"concat_ws(' / ', {parts})"


REVIEW_BASE = with_reviews("""
SELECT doc_id, target,
       regexp_extract('ACME ' || upper(target) || ' 8,000 BTU', '^\\s*(\\S+)', 1) AS manufacturer,
       'M-' || upper(target) AS model_no,
       'ACME ' || upper(target) || ' 8,000 BTU' AS model_description,
       date, rating, title, body, image, badge
FROM reviews
""")

RULE_LABELS = with_reviews(f"""
, labelled AS (
  SELECT doc_id, target, rating,
         {', '.join(f'{_rule_case(t, p)} AS "{t}"' for t, p in testbed.TEST_RULES)}
  FROM reviews
)
SELECT doc_id, target, rating, {', '.join(f'"{t}"' for t, _ in testbed.TEST_RULES)},
       {_category([t for t, _ in testbed.TEST_RULES])} AS category
FROM labelled
""")


RECENCY_FILTER = with_reviews("""
SELECT doc_id, target, page_no, date FROM reviews WHERE date >= DATE '2024-01-24'
""")

RECENCY_TAKEWHILE = with_reviews("""
, flagged AS (
  SELECT doc_id, target, page_no, date,
         max(CASE WHEN date < DATE '2024-01-24' THEN 1 ELSE 0 END)
           OVER (PARTITION BY target ORDER BY page_no, pos
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped
  FROM reviews
)
SELECT doc_id, target, page_no, date FROM flagged WHERE stopped = 0
""")

MULTI_SOURCE_UNION_DEDUPE = with_reviews("""
SELECT DISTINCT * FROM (
  SELECT target, date, rating, title, body, image, badge FROM reviews WHERE doc_id % 3 <> 0
  UNION ALL
  SELECT target, date, rating, title, body, image, badge FROM reviews WHERE doc_id % 3 <> 1
  UNION ALL
  SELECT target, date, rating, title, body, image, NULL AS badge FROM reviews WHERE doc_id % 3 = 2
) u
""")

SIZE_LOOKUP = with_reviews("""
, s2m AS (
  SELECT CAST(p_size AS VARCHAR) || ' BTU' AS size,
         'BR' || CAST(p_size AS VARCHAR) || '-' || CAST(min(p_partkey) AS VARCHAR) AS model_no,
         arg_min(p_name, p_partkey) AS model_description
  FROM part GROUP BY p_size
),
r AS (SELECT doc_id, target, replace('Size: ' || size, 'Size: ', '') AS size FROM reviews)
SELECT r.doc_id, r.target, r.size,
       CASE WHEN ascii(right(r.target, 1)) % 2 = 0 THEN 'M-' || upper(r.target)
            ELSE coalesce(s.model_no, r.size) END AS model_no,
       CASE WHEN ascii(right(r.target, 1)) % 2 = 0 THEN 'ACME ' || upper(r.target)
            ELSE coalesce(s.model_description, r.size) END AS model_description
FROM r LEFT JOIN s2m s ON r.size = s.size
""")

STRICT_LOOKUP = with_reviews("""
, m2d AS (SELECT p_type AS model_no, arg_min(p_name, p_partkey) AS model_description FROM part GROUP BY p_type),
r AS (
  SELECT doc_id, target,
         CAST(ascii(right(target, 1)) + 1000 AS VARCHAR) AS product_id,
         CASE ascii(right(target, 1)) % 7
              WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'LARGE' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'PROMO'
              WHEN 4 THEN 'SMALL' WHEN 5 THEN 'STANDARD' ELSE 'XL' END AS model_no
  FROM reviews
)
SELECT r.doc_id, r.target, r.product_id, r.model_no, m.model_description
FROM r JOIN m2d m ON r.model_no = m.model_no
""")


# ---------------------------------------------------------------------------
# Landed JSON layouts, re-derived straight from the review rows.
# ---------------------------------------------------------------------------
def _fails(fail: tuple) -> str:
    return "(" + " OR ".join(f"doc_id % {m} = {r}" for m, r in fail) + ")"


RATING = f"CAST(rating AS DOUBLE) + CASE WHEN doc_id % {testbed.HALF_RATING[0]} = {testbed.HALF_RATING[1]} THEN 0.5 ELSE 0 END AS rating"


def _cut_read(fail: tuple, limit: str | None) -> str:
    stop = f"date < DATE '{limit}'" if limit else "false"
    return f"""
, lw AS (SELECT *, 2 + ascii(right(target, 1)) % 3 AS cut FROM reviews),
flag AS (
  SELECT *, max(CASE WHEN {stop} THEN 1 ELSE 0 END)
              OVER (PARTITION BY target ORDER BY page_no, pos
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped
  FROM lw WHERE page_no < cut
),
kept AS (SELECT * FROM flag WHERE stopped = 0),
failed AS (SELECT DISTINCT target FROM kept WHERE {_fails(fail)})"""


WALMART_JSON_EXTRACT = with_reviews(_cut_read(testbed.WALMART_FAIL, None) + f"""
SELECT target, page_no, date, {RATING}, title, body, image
FROM kept WHERE target NOT IN (SELECT target FROM failed)
""")

LOWES_JSON_EXTRACT = with_reviews(_cut_read(testbed.LOWES_FAIL, "2024-01-24") + f"""
SELECT target, page_no, date, {RATING}, title, body, image
FROM kept WHERE target NOT IN (SELECT target FROM failed)
""")

STATEFUL_READ_STREAM = with_reviews(_cut_read(testbed.LOWES_FAIL, "2024-01-24").replace(
    "FROM reviews)", f"FROM reviews WHERE NOT ({_fails(testbed.LOWES_FAIL)}))") + f"""
SELECT target, page_no, date, {RATING}, title, body, image FROM kept
""")

FAILED_TARGETS_REPORT = with_reviews(_cut_read(testbed.LOWES_FAIL, "2024-01-24") + """
, cnt AS (SELECT target, count(*) AS n FROM kept GROUP BY target),
tg AS (SELECT DISTINCT target FROM reviews)
SELECT tg.target,
       CASE WHEN f.target IS NOT NULL THEN 'failed'
            WHEN coalesce(c.n, 0) > 0 THEN 'success' ELSE 'no new reviews' END AS status,
       CAST(CASE WHEN f.target IS NOT NULL THEN 0 ELSE coalesce(c.n, 0) END AS BIGINT) AS n_reviews
FROM tg LEFT JOIN failed f ON tg.target = f.target LEFT JOIN cnt c ON tg.target = c.target
""")

TARGET_TOTALS = with_reviews(_cut_read(testbed.LOWES_FAIL, "2024-01-24") + """
, cnt AS (SELECT target, count(*) AS n FROM kept GROUP BY target),
tg AS (SELECT DISTINCT target FROM reviews),
rep AS (
  SELECT tg.target,
         CASE WHEN f.target IS NOT NULL THEN 'failed'
              WHEN coalesce(c.n, 0) > 0 THEN 'success' ELSE 'no new reviews' END AS status,
         CASE WHEN f.target IS NOT NULL THEN 0 ELSE coalesce(c.n, 0) END AS n_reviews
  FROM tg LEFT JOIN failed f ON tg.target = f.target LEFT JOIN cnt c ON tg.target = c.target
)
SELECT CAST(count(*) AS BIGINT) AS targets,
       CAST(sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) AS BIGINT) AS succeeded,
       CAST(sum(CASE WHEN status = 'no new reviews' THEN 1 ELSE 0 END) AS BIGINT) AS no_new_reviews,
       CAST(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       CAST(coalesce(sum(n_reviews), 0) AS BIGINT) AS reviews
FROM rep
""")

LOWES_REQUEST_URLS = with_reviews(f"""
, lw AS (SELECT DISTINCT target, page_no, 2 + ascii(right(target, 1)) % 3 AS cut FROM reviews),
pg AS (
  SELECT target, CASE WHEN page_no >= cut THEN page_no + 1 ELSE page_no END AS page_no FROM lw
  UNION
  SELECT target, cut AS page_no FROM lw
)
SELECT target, page_no,
       replace({_sql_str(params.LOWES_SEARCH_URL)}, '{{}}', CAST(ascii(right(target, 1)) + 1000 AS VARCHAR))
         || CAST((page_no - 1) * {params.LOWES_PAGE_SIZE} AS VARCHAR) AS request_url
FROM pg
""")

PAGE_CUTOFF = with_reviews("""
SELECT DISTINCT target, CAST(page_no AS VARCHAR) AS page_label,
       page_no + CAST(CASE WHEN ascii(right(target, 1)) % 2 = 0 THEN floor((page_no - 1) / 2)
                           ELSE floor(page_no / 2) END AS INTEGER) AS seq
FROM reviews
""")


# ---------------------------------------------------------------------------
# Text, TF-IDF and Naive Bayes chain (no stemming), re-derived in SQL.
# ---------------------------------------------------------------------------
STOP_LIST = "[" + ", ".join(_sql_str(w) for w in params.EFFECTIVE_STOPWORDS) + "]"
ML_TAGS = testbed.TEST_ML_TAGS
ML_CANDIDATES = ["license", "low quality", "contact", "decimal", "toxic", "gap", "number"]


def composed_sql(title: str, body: str) -> str:
    t, b = f"coalesce({title}, '')", f"coalesce({body}, '')"
    return (f"CASE WHEN ends_with({t}, '...') AND contains({b}, left({t}, greatest(length({t}) - 3, 0))) "
            f"THEN {b} ELSE {t} || ' ' || {b} END")


def tokens_sql(title: str, body: str) -> str:
    x = f"regexp_replace(lower({composed_sql(title, body)}), '[^A-Za-z]', ' ', 'g')"
    for word, parts in params.TOKENIZER_SPLITS:
        x = f"regexp_replace({x}, '\\b{word}\\b', '{parts}', 'g')"
    toks = f"list_filter(string_split({x}, ' '), lambda t: t <> '')"
    return f"list_filter({toks}, lambda t: NOT list_contains({STOP_LIST}, t))"


def ngrams_sql(tokens: str) -> str:
    v = f"list_filter({tokens}, lambda t: length(t) >= {params.MIN_TOKEN_LEN})"
    return (f"list_concat({v}, list_transform(range(1, len({v})), "
            f"lambda i: {v}[i] || ' ' || {v}[i + 1]))")


CHAIN_CTES = f"""
, rv AS (
  SELECT doc_id, target, date, rating, title, body, image,
         {tokens_sql('title', 'body')} AS toks
  FROM reviews
),
rvn AS (SELECT *, {ngrams_sql('toks')} AS ngrams FROM rv),
lab AS (
  SELECT doc_id,
         CASE WHEN quality = 0 AND toxic = 1 THEN 'low quality / toxic'
              WHEN quality = 0 THEN 'low quality'
              WHEN toxic = 1 THEN 'toxic' ELSE '' END AS category
  FROM labels
),
train AS (
  SELECT l.doc_id, list_distinct(regexp_split_to_array(lower(trim(l.category)), '\\s+/\\s+')) AS tags, r.ngrams
  FROM lab l JOIN rvn r ON l.doc_id = r.doc_id
  WHERE lower(trim(l.category)) <> ''
),
n_train AS (SELECT count(*) AS n FROM train),
train_terms AS (SELECT doc_id, unnest(ngrams) AS term FROM train),
stats AS (
  SELECT term, CAST(count(*) AS BIGINT) AS total_count, CAST(count(DISTINCT doc_id) AS BIGINT) AS doc_freq
  FROM train_terms GROUP BY term
),
vocab AS (SELECT * FROM stats ORDER BY total_count DESC, term ASC LIMIT {params.MAX_FEATURES}),
idf AS (SELECT term, doc_freq, ln((1 + n) / (1 + doc_freq)) + 1 AS idf FROM vocab, n_train),
v_size AS (SELECT count(*) AS v FROM vocab),
doc_tf AS (
  SELECT d.doc_id, d.term, count(*) AS tf
  FROM (SELECT doc_id, unnest(ngrams) AS term FROM rvn) d JOIN vocab v ON d.term = v.term
  GROUP BY d.doc_id, d.term
),
raw_w AS (SELECT t.doc_id, t.term, t.tf * i.idf AS raw FROM doc_tf t JOIN idf i ON t.term = i.term),
norms AS (SELECT doc_id, sqrt(sum(raw * raw)) AS nrm FROM raw_w GROUP BY doc_id),
tfidf AS (SELECT w.doc_id, w.term, w.raw / n.nrm AS weight FROM raw_w w JOIN norms n ON w.doc_id = n.doc_id),
train_tf AS (
  SELECT d.doc_id, d.term, count(*) AS tf
  FROM train_terms d JOIN vocab v ON d.term = v.term GROUP BY d.doc_id, d.term
),
train_raw AS (SELECT t.doc_id, t.term, t.tf * i.idf AS raw FROM train_tf t JOIN idf i ON t.term = i.term),
train_norm AS (SELECT doc_id, sqrt(sum(raw * raw)) AS nrm FROM train_raw GROUP BY doc_id),
train_w AS (SELECT w.doc_id, w.term, w.raw / n.nrm AS weight FROM train_raw w JOIN train_norm n ON w.doc_id = n.doc_id),
tag_list AS (SELECT unnest([{', '.join(_sql_str(t) for t in ML_TAGS)}]) AS tag),
labelled AS (
  SELECT t.doc_id, g.tag, CAST(list_contains(t.tags, g.tag) AS INTEGER) AS cls FROM train t, tag_list g
),
class_n AS (SELECT tag, cls, count(*) AS n_c FROM labelled GROUP BY tag, cls),
term_sums AS (
  SELECT l.tag, l.cls, w.term, sum(w.weight) AS s
  FROM labelled l JOIN train_w w ON l.doc_id = w.doc_id GROUP BY l.tag, l.cls, w.term
),
class_tot AS (SELECT tag, cls, sum(s) AS total FROM term_sums GROUP BY tag, cls),
model AS (
  SELECT c.tag, c.cls, v.term,
         ln((coalesce(s.s, 0) + {params.NB_ALPHA}) / (coalesce(ct.total, 0) + {params.NB_ALPHA} * vs.v)) AS log_prob,
         ln(c.n_c / n.n) AS log_prior
  FROM class_n c CROSS JOIN vocab v CROSS JOIN v_size vs CROSS JOIN n_train n
  LEFT JOIN term_sums s ON s.tag = c.tag AND s.cls = c.cls AND s.term = v.term
  LEFT JOIN class_tot ct ON ct.tag = c.tag AND ct.cls = c.cls
),
priors AS (SELECT DISTINCT tag, cls, log_prior FROM model),
dots AS (
  SELECT w.doc_id, m.tag, m.cls, sum(w.weight * m.log_prob) AS dot
  FROM tfidf w JOIN model m ON w.term = m.term GROUP BY w.doc_id, m.tag, m.cls
),
scores AS (
  SELECT r.doc_id, p.tag, p.cls, p.log_prior + coalesce(d.dot, 0) AS score
  FROM rvn r CROSS JOIN priors p
  LEFT JOIN dots d ON d.doc_id = r.doc_id AND d.tag = p.tag AND d.cls = p.cls
),
raw_pred AS (
  SELECT doc_id, tag,
         CASE WHEN count(*) FILTER (WHERE cls = 1) = 0 THEN 0
              WHEN count(*) FILTER (WHERE cls = 0) = 0 THEN 1
              WHEN max(score) FILTER (WHERE cls = 1) > max(score) FILTER (WHERE cls = 0) THEN 1
              ELSE 0 END AS p
  FROM scores GROUP BY doc_id, tag
),
ml AS (
  SELECT r.doc_id,
         {', '.join(
             f"CASE WHEN coalesce(r.rating >= 3, false) OR r.body IS NULL OR r.body IN ('', {_sql_str(params.PLACEHOLDER_BODY)}) "
             f"THEN 0 ELSE max(p.p) FILTER (WHERE p.tag = {_sql_str(t)}) END AS \"{t}\""
             for t in ML_TAGS)}
  FROM rvn r JOIN raw_pred p ON r.doc_id = p.doc_id
  GROUP BY r.doc_id, r.rating, r.body
)"""


def chain(body: str) -> str:
    return with_reviews(CHAIN_CTES + "\n" + body)


COMPOSE_TEXT = with_reviews(f"""
SELECT doc_id, {composed_sql('title', 'body')} AS text FROM reviews
""")

CLEAN_TOKENS = with_reviews(f"""
SELECT doc_id, array_to_string({tokens_sql('title', 'body')}, ' ') AS clean FROM reviews
""")

TAG_VOCABULARY = chain("""
SELECT DISTINCT unnest(regexp_split_to_array(lower(trim(category)), '\\s+/\\s+')) AS tag
FROM lab WHERE lower(trim(category)) <> ''
""")

TAG_ONEHOT = chain(f"""
SELECT doc_id, {', '.join(f'CAST(list_contains(tags, {_sql_str(t)}) AS INTEGER) AS "{t}"' for t in ML_TAGS)}
FROM train
""")

TERM_STATS = chain("""
SELECT term, total_count, doc_freq FROM vocab
""")

TFIDF = chain("""
SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf
""")

NB_MODEL = chain("""
SELECT tag, cls, term, round(log_prob, 6) AS log_prob, round(log_prior, 6) AS log_prior FROM model
""")

NB_PREDICT = chain(f"""
SELECT doc_id, {', '.join(f'"{t}"' for t in ML_TAGS)} FROM ml
""")

_FLAG_RULES = dict(testbed.TEST_RULES)

PREDICT_LABELS_TAIL = f"""
, flagged AS (
  SELECT r.doc_id, r.target, r.date, r.rating, r.title, r.body, r.image,
         {', '.join(
             (f'{_rule_case(t, _FLAG_RULES[t])} AS "{t}"' if t in _FLAG_RULES else f'm."{t}" AS "{t}"')
             for t in ML_CANDIDATES)}
  FROM rvn r JOIN ml m ON r.doc_id = m.doc_id
)
SELECT *, {_category(ML_CANDIDATES)} AS category FROM flagged
"""
PREDICT_LABELS = chain(PREDICT_LABELS_TAIL)


def all_oracles() -> dict[str, str]:
    from revlens.plans.oracles_flows import ORACLES as FLOW_ORACLES
    from revlens.plans.oracles_html import ORACLES as HTML_ORACLES
    from revlens.plans.oracles_stem import ORACLES as STEM_ORACLES

    return {
        **HTML_ORACLES,
        **FLOW_ORACLES,
        **STEM_ORACLES,
        "review_base": REVIEW_BASE,
        "rule_labels": RULE_LABELS,
        "recency_filter": RECENCY_FILTER,
        "recency_takewhile": RECENCY_TAKEWHILE,
    "recency_window": RECENCY_TAKEWHILE,
        "multi_source_union_dedupe": MULTI_SOURCE_UNION_DEDUPE,
        "size_lookup": SIZE_LOOKUP,
        "strict_lookup": STRICT_LOOKUP,
        "walmart_json_extract": WALMART_JSON_EXTRACT,
        "lowes_json_extract": LOWES_JSON_EXTRACT,
        "stateful_read_stream": STATEFUL_READ_STREAM,
    "failed_targets_report": FAILED_TARGETS_REPORT,
        "page_cutoff": PAGE_CUTOFF,
        "target_totals": TARGET_TOTALS,
        "lowes_request_urls": LOWES_REQUEST_URLS,
        "compose_text": COMPOSE_TEXT,
        "clean_tokens": CLEAN_TOKENS,
        "tag_vocabulary": TAG_VOCABULARY,
        "tag_onehot": TAG_ONEHOT,
        "term_stats": TERM_STATS,
        "tfidf": TFIDF,
        "nb_model": NB_MODEL,
        "nb_predict": NB_PREDICT,
        "predict_labels": PREDICT_LABELS,
    }
