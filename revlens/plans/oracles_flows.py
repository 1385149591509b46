"""DuckDB oracles of the end-to-end flows, the round trips and the issue rules, from the source rows."""

from __future__ import annotations

from revlens import params
from revlens.plans.oracles import NB_PREDICT, RATING, _category, _cut_read, _rule_case, _sql_str, with_reviews
from revlens.plans.oracles_html import SPEC_MODEL, WS
from revlens.sources import testbed

CODE = "ascii(right(target, 1))"
MODEL = "CASE " + CODE + f" % {len(testbed.MODELS)} " + " ".join(
    f"WHEN {i} THEN {_sql_str(m)}" for i, m in enumerate(testbed.MODELS)) + " END"
M2D = "m2d AS (SELECT p_type AS model_no, arg_min(p_name, p_partkey) AS model_description FROM part GROUP BY p_type)"
COLUMNS = "target, manufacturer, model_no, model_description, date, rating, title, body, image, badge"


def _report(targets: str = "SELECT DISTINCT target FROM reviews") -> str:
    """Report over ``kept`` (rows read, before failures) and ``failed``."""
    return f"""
SELECT t.target, CASE WHEN f.target IS NOT NULL THEN 'failed' WHEN c.n > 0 THEN 'success' ELSE 'no new reviews' END AS status,
       CAST(CASE WHEN f.target IS NOT NULL THEN 0 ELSE coalesce(c.n, 0) END AS BIGINT) AS n_reviews
FROM ({targets}) t LEFT JOIN (SELECT DISTINCT target FROM all_failed) f USING (target)
LEFT JOIN (SELECT target, count(*) AS n FROM kept GROUP BY target) c USING (target)"""


_SECOND = "CASE (" + CODE + f" + 1) % {len(testbed.MODELS)} " + " ".join(
    f"WHEN {i} THEN {_sql_str(m)}" for i, m in enumerate(testbed.MODELS)) + " END"
_RUNS = f"""SELECT DISTINCT target, {MODEL} AS model_no FROM reviews
         UNION ALL SELECT DISTINCT target, {_SECOND} FROM reviews WHERE {CODE} % {testbed.SECOND_MODEL} = 0"""


def _run_report() -> str:
    """Report by run over ``kept`` (rows read), ``failed`` (targets) and ``meta`` (runs, ``lost`` without metadata)."""
    return """
SELECT m.target, m.model_no,
       CASE WHEN m.lost OR f.target IS NOT NULL THEN 'failed' WHEN c.n > 0 THEN 'success' ELSE 'no new reviews' END AS status,
       CAST(CASE WHEN m.lost OR f.target IS NOT NULL THEN 0 ELSE coalesce(c.n, 0) END AS BIGINT) AS n_reviews
FROM meta m LEFT JOIN (SELECT DISTINCT target FROM failed) f USING (target)
LEFT JOIN (SELECT target, count(*) AS n FROM kept GROUP BY target) c USING (target)"""


_LOWES = _cut_read(testbed.LOWES_FAIL, "2024-01-24") + f""",
{M2D},
meta AS (SELECT t.target, t.model_no, m.model_description, m.model_description IS NULL AS lost
         FROM ({_RUNS}) t LEFT JOIN m2d m USING (model_no))"""

LOWES_FLOW = with_reviews(_LOWES + f"""
SELECT DISTINCT CAST(NULL AS VARCHAR) AS manufacturer, model_no, model_description, date, {RATING}, title, body, image,
       CAST(NULL AS VARCHAR) AS badge
FROM kept JOIN meta USING (target) WHERE NOT lost AND target NOT IN (SELECT target FROM failed)
""")
LOWES_FLOW_REPORT = with_reviews(_LOWES + f"""
, rep AS ({_run_report()})
SELECT * FROM rep UNION ALL SELECT target || '-b', model_no, status, n_reviews FROM rep
""")

_WALMART = _cut_read(testbed.WALMART_FAIL, None) + f""",
meta AS (SELECT 'src' || CAST(p_partkey * 2 AS VARCHAR) AS target, p_name AS model_description,
                {SPEC_MODEL} AS model_no,
                regexp_extract(p_name, '^\\s*(\\S+)', 1) AS manufacturer FROM part),
all_failed AS (SELECT target FROM failed UNION SELECT target FROM reviews WHERE target NOT IN (SELECT target FROM meta))"""

WALMART_FLOW = with_reviews(_WALMART + f"""
, out AS (SELECT *, CAST(NULL AS VARCHAR) AS no_badge FROM kept JOIN meta USING (target)
          WHERE target NOT IN (SELECT target FROM all_failed))
SELECT target, manufacturer, model_no, model_description, date, {RATING}, title, body, image, no_badge AS badge FROM out
""")
WALMART_FLOW_REPORT = with_reviews(_WALMART + _report())

_TAKE = """
flag AS (SELECT *, max(CASE WHEN date < DATE '{limit}' THEN 1 ELSE 0 END) OVER (PARTITION BY target ORDER BY page_no, pos
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped FROM walked),
kept_once AS (SELECT * FROM flag WHERE stopped = 0)"""

_AMAZON = f"""
, walked AS (SELECT * FROM reviews WHERE NOT ({CODE} % 2 = 0 AND page_no >= 3)),
{_TAKE.format(limit="2024-01-24")},
kept AS (SELECT * FROM kept_once UNION ALL
         SELECT * FROM kept_once WHERE doc_id % {testbed.TWICE[0]} = {testbed.TWICE[1]}),
{M2D},
meta AS (SELECT t.target, t.model_no, m.model_description, t.model_no IS NOT NULL AND m.model_description IS NULL AS lost
         FROM (SELECT DISTINCT target, CASE WHEN {CODE} % 3 = 0 THEN model_no END AS model_no FROM ({_RUNS})) t
         LEFT JOIN m2d m USING (model_no)),
s2m AS (SELECT CAST(p_size AS VARCHAR) || ' BTU' AS size,
               'BR' || CAST(p_size AS VARCHAR) || '-' || CAST(min(p_partkey) AS VARCHAR) AS model_no,
               arg_min(p_name, p_partkey) AS model_description FROM part GROUP BY p_size),
failed AS (SELECT target FROM kept WHERE doc_id % {testbed.AMAZON_FAIL[0]} = {testbed.AMAZON_FAIL[1]} AND rating IS NOT NULL)"""

AMAZON_FLOW = with_reviews(_AMAZON + f"""
SELECT k.target, CAST(NULL AS VARCHAR) AS manufacturer,
       coalesce(n.model_no, s.model_no, k.size) AS model_no,
       CASE WHEN n.model_no IS NOT NULL THEN n.model_description ELSE coalesce(s.model_description, k.size) END AS model_description,
       k.date, k.rating, trim(k.title, {WS}) AS title, trim(k.body, {WS}) AS body, k.image, k.badge
FROM kept k JOIN meta n ON k.target = n.target LEFT JOIN s2m s ON k.size = s.size
WHERE NOT n.lost AND k.target NOT IN (SELECT target FROM failed)
""")
AMAZON_FLOW_REPORT = with_reviews(_AMAZON + _run_report())

_HOMEDEPOT = f"""
, walked AS (SELECT * FROM reviews),
{_TAKE.format(limit="2024-01-10")},
kept AS (SELECT * FROM kept_once),
meta AS (SELECT 'src' || CAST(p_partkey * 2 AS VARCHAR) AS target, p_brand || ' ' || p_name AS model_description,
                p_type || '-' || CAST(p_partkey AS VARCHAR) AS model_no,
                regexp_extract(p_brand || ' ' || p_name, '^\\s*(\\S+)', 1) AS manufacturer
         FROM part WHERE p_partkey % {testbed.META_SHORT[0]} <> {testbed.META_SHORT[1]}),
all_failed AS (
  SELECT target FROM kept WHERE doc_id % {testbed.HOMEDEPOT_FAIL[0]} = {testbed.HOMEDEPOT_FAIL[1]}
  UNION SELECT target FROM reviews WHERE target NOT IN (SELECT target FROM meta))"""

HOMEDEPOT_FLOW = with_reviews(_HOMEDEPOT + f"""
SELECT k.target, manufacturer, model_no, model_description, date,
       CASE WHEN doc_id % 2 = 1 AND rating >= 1 THEN rating - 1 ELSE coalesce(rating, 0) END AS rating,
       trim(title, {WS}) AS title, trim(body, {WS}) AS body, image, CAST(NULL AS VARCHAR) AS badge
FROM kept k JOIN meta USING (target) WHERE k.target NOT IN (SELECT target FROM all_failed)
""")
HOMEDEPOT_FLOW_REPORT = with_reviews(_HOMEDEPOT + _report())

TRAINING_CSV_ROUNDTRIP = with_reviews("""
, t AS (SELECT nullif(CASE WHEN quality = 0 AND toxic = 1 THEN 'low quality / toxic' WHEN quality = 0 THEN 'low quality'
                    WHEN toxic = 1 THEN 'toxic' ELSE '' END, '') AS category, title, body FROM labels JOIN reviews USING (doc_id))
SELECT category, count(*) AS n, CAST(sum(length(coalesce(title, ''))) AS BIGINT) AS title_chars,
       CAST(sum(length(coalesce(body, ''))) AS BIGINT) AS body_chars FROM t GROUP BY category
""")

LOWES_CONFIG_ROUNDTRIP = """
WITH t AS (SELECT p_type AS model_no, min(p_partkey) AS lo, max(p_partkey) AS hi, arg_min(p_name, p_partkey) AS model_description
           FROM part GROUP BY p_type),
u AS (SELECT model_no, model_description, unnest([lo, hi]) AS k FROM t)
SELECT model_no, 'https://www.lowes.com/pd/x/' || k AS url, CAST(k AS VARCHAR) AS product_id, model_description FROM u
"""

AMAZON_CONFIG_ROUNDTRIP = """
WITH t AS (SELECT p_type, min(p_partkey) AS lo, max(p_partkey) AS hi FROM part GROUP BY p_type)
SELECT p_type AS category, CAST(NULL AS VARCHAR) AS model_no, 'https://www.amazon.com/dp/' || lo AS url
FROM t WHERE length(p_type) % 2 = 1
UNION ALL SELECT p_type, 'A', 'https://www.amazon.com/dp/' || lo FROM t WHERE length(p_type) % 2 = 0
UNION ALL SELECT p_type, 'B', 'https://www.amazon.com/dp/' || hi FROM t WHERE length(p_type) % 2 = 0
"""

_TAGS = [t for t, _ in testbed.TEST_RULES]
VERSIONED_SINK_ROUNDTRIP = with_reviews(f"""
, flagged AS (SELECT doc_id, target, date, rating, {", ".join(f'{_rule_case(t, p)} AS "{t}"' for t, p in testbed.TEST_RULES)}
              FROM reviews),
done AS (SELECT doc_id, target, date, rating, {_category(_TAGS)} AS category FROM flagged)
SELECT *, category AS csv_category, rating AS csv_rating FROM done
""")

_ISSUES = [t for t, _ in params.RULES]
PHRASE = "[" + ", ".join(_sql_str(p) for p in testbed.PHRASES) + f"][CAST((doc_id // 2) % {len(testbed.PHRASES)} AS INTEGER) + 1]"
ISSUE_RULE_LABELS = with_reviews(f"""
, said AS (SELECT doc_id, rating,
                  CASE WHEN doc_id % 2 = 0 THEN {PHRASE} || ' ' || coalesce(title, '') ELSE title END AS title,
                  CASE WHEN doc_id % 2 = 1 THEN {PHRASE} || ' ' || coalesce(body, '') ELSE body END AS body FROM reviews),
flagged AS (SELECT doc_id, rating, {", ".join(f'{_rule_case(t, p)} AS "{t}"' for t, p in params.RULES)} FROM said)
SELECT *, {_category(_ISSUES)} AS category FROM flagged
""")

# ---------------------------------------------------------------------------
# Whole runs
# ---------------------------------------------------------------------------
def _said(title: str = "title", body: str = "body") -> str:
    return (f"CASE WHEN doc_id % 2 = 0 THEN {PHRASE} || ' ' || coalesce({title}, '') ELSE {title} END AS title, "
            f"CASE WHEN doc_id % 2 = 1 THEN {PHRASE} || ' ' || coalesce({body}, '') ELSE {body} END AS body")


def _labelled(rows: str) -> str:
    """Rule tags and the category of a review table."""
    return f"""
SELECT *, {_category(_ISSUES)} AS category
FROM (SELECT *, {", ".join(f'{_rule_case(t, p)} AS "{t}"' for t, p in params.RULES)} FROM {rows})"""


_NONE = "CAST(NULL AS VARCHAR)"
_LOWES_RUN = _cut_read(testbed.LOWES_FAIL, "2024-01-24") + f""",
{M2D},
meta AS (SELECT t.target, t.model_no, m.model_description, m.model_description IS NULL AS lost
         FROM ({_RUNS} UNION ALL SELECT {", ".join(map(_sql_str, testbed.NOT_LANDED))}) t LEFT JOIN m2d m USING (model_no)),
table_ AS (SELECT DISTINCT {_NONE} AS manufacturer, model_no, model_description, date, {RATING}, {_said()}, image, {_NONE} AS badge
           FROM kept JOIN meta USING (target) WHERE NOT lost AND target NOT IN (SELECT target FROM failed)),
rep AS ({_run_report()})"""
LOWES_RUN = with_reviews(_LOWES_RUN + _labelled("table_"))
LOWES_RUN_REPORT = with_reviews(_LOWES_RUN + "SELECT * FROM rep")
LOWES_RUN_TOTALS = with_reviews(_LOWES_RUN + """
SELECT count(*) AS targets, count(*) FILTER (status = 'success') AS succeeded, count(*) FILTER (status = 'no new reviews') AS no_new_reviews,
       count(*) FILTER (status = 'failed') AS failed, CAST(sum(n_reviews) AS BIGINT) AS reviews, (SELECT count(*) FROM table_) AS rows_written
FROM rep""")

_NUMBER = "CAST(substr(target, 4) AS BIGINT)"
AMAZON_RUN = with_reviews(f"""
, walked AS (SELECT * FROM reviews WHERE {CODE} % 2 = 0),
{_TAKE.format(limit="2024-01-24")},
kept AS (SELECT * FROM kept_once UNION ALL
         SELECT * FROM kept_once WHERE doc_id % {testbed.TWICE[0]} = {testbed.TWICE[1]}),
failed AS (SELECT target FROM kept WHERE doc_id % {testbed.AMAZON_FAIL[0]} = {testbed.AMAZON_FAIL[1]} AND rating IS NOT NULL),
table_ AS (SELECT {_NONE} AS manufacturer, 'AM-' || target AS model_no, p_name AS model_description, date, rating,
                  trim(title, {WS}) AS title, trim(body, {WS}) AS body, image, badge
           FROM (SELECT doc_id, target, date, rating, {_said()}, image, badge FROM kept)
           JOIN part ON p_partkey = {_NUMBER} + 1 WHERE p_partkey % 5 <> 0 AND target NOT IN (SELECT target FROM failed))
""" + _labelled("table_"))

WALMART_RUN = with_reviews(_cut_read(testbed.WALMART_FAIL, "2024-01-10") + f""",
meta AS (SELECT 'src' || p_partkey AS target, p_name AS model_description, {SPEC_MODEL} AS model_no,
                regexp_extract(p_name, '^\\s*(\\S+)', 1) AS manufacturer FROM part WHERE p_size % 4 <> 0 AND p_partkey % 3 <> 0),
table_ AS (SELECT manufacturer, model_no, model_description, date, {RATING}, {_said()}, image, {_NONE} AS badge
           FROM kept JOIN meta USING (target) WHERE target NOT IN (SELECT target FROM failed))
""" + _labelled("table_"))

HOMEDEPOT_RUN = with_reviews(f"""
, fetched AS (SELECT *, page_no + CASE WHEN {CODE} % 2 = 0 THEN (page_no - 1) // 2 ELSE page_no // 2 END AS seq FROM reviews),
walked AS (SELECT * FROM fetched WHERE NOT ({CODE} % 3 = 1 AND seq >= {testbed.NO_LABEL})),
{_TAKE.format(limit="2024-01-10")},
failed AS (SELECT target FROM kept_once WHERE doc_id % {testbed.HOMEDEPOT_FAIL[0]} = {testbed.HOMEDEPOT_FAIL[1]}),
meta AS (SELECT 'src' || p_partkey AS target, p_brand || ' ' || p_name AS model_description, p_type || '-' || p_partkey AS model_no,
                regexp_extract(p_brand || ' ' || p_name, '^\\s*(\\S+)', 1) AS manufacturer
         FROM part WHERE p_partkey % {testbed.META_SHORT[0]} <> {testbed.META_SHORT[1]} AND p_size % 3 <> 0)
SELECT manufacturer, model_no, model_description, date,
       CASE WHEN doc_id % 2 = 1 AND rating >= 1 THEN rating - 1 ELSE coalesce(rating, 0) END AS rating,
       trim(title, {WS}) AS title, trim(body, {WS}) AS body, image, {_NONE} AS badge
FROM kept_once JOIN meta USING (target) WHERE target NOT IN (SELECT target FROM failed)
""")

NEWEST_FIRST_SINK = with_reviews("SELECT date, count(*) AS n, true AS in_order FROM reviews GROUP BY date")

ORACLES = {
    "lowes_run": LOWES_RUN,
    "lowes_run_report": LOWES_RUN_REPORT,
    "lowes_run_totals": LOWES_RUN_TOTALS,
    "amazon_run": AMAZON_RUN,
    "walmart_run": WALMART_RUN,
    "homedepot_run": HOMEDEPOT_RUN,
    "newest_first_sink": NEWEST_FIRST_SINK,
    "lowes_flow": LOWES_FLOW,
    "lowes_flow_report": LOWES_FLOW_REPORT,
    "walmart_flow": WALMART_FLOW,
    "walmart_flow_report": WALMART_FLOW_REPORT,
    "amazon_flow": AMAZON_FLOW,
    "amazon_flow_report": AMAZON_FLOW_REPORT,
    "homedepot_flow": HOMEDEPOT_FLOW,
    "homedepot_flow_report": HOMEDEPOT_FLOW_REPORT,
    "training_csv_roundtrip": TRAINING_CSV_ROUNDTRIP,
    "lowes_config_roundtrip": LOWES_CONFIG_ROUNDTRIP,
    "amazon_config_roundtrip": AMAZON_CONFIG_ROUNDTRIP,
    "versioned_sink_roundtrip": VERSIONED_SINK_ROUNDTRIP,
    "saved_model_predict": NB_PREDICT,
    "issue_rule_labels": ISSUE_RULE_LABELS,
}
