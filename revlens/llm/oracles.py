"""DuckDB SQL of the training-data queries, written from the source rows."""

from revlens.llm import license_scan as _license
from revlens.llm import line_dedup as _lines
from revlens.llm import quality_rules as _rules
from revlens.llm import secret_scan as _secret


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"

#: Arguments of translate that lower-case A-Z, and the pattern of terms once that is done.
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERM = "'[0-9a-z\\x{80}-\\x{10FFFF}]+'"

OP2_EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

_KEPT_KINDS = ("assign", _secret.ASSIGN), ("access", _secret.ACCESS), ("hex", _secret.HEX)


def _pieces(kind: str, pattern: str, group: int, t: str = "t") -> str:
    """(doc_id, kind, pos, string, value): matches, placed by the text between them."""
    p = _text(pattern.replace("\\x20", " "))
    return f"""
    SELECT doc_id, '{kind}' AS kind, unnest(range(1, len(found) + 1)) AS k, between_, found, vals
    FROM (SELECT doc_id, string_split_regex({t}, {p}) AS between_, regexp_extract_all({t}, {p}, 0) AS found,
                 regexp_extract_all({t}, {p}, {group}) AS vals
          FROM texts WHERE regexp_matches({t}, {p}))"""


def _secret_sql() -> str:
    kinds = [_pieces("assign", _secret.ASSIGN, 2), _pieces("access", _secret.ACCESS, 0), _pieces("hex", _secret.HEX, 0)]
    for kind, chars, _ in _secret.ENTROPY:
        kinds.append(_pieces(kind, f"[{chars}]{{{_secret.WINDOW},}}", 0, "rest"))
    least = " ".join(f"WHEN '{kind}' THEN {_secret.most_sum(_secret.WINDOW, bits)}" for kind, _, bits in _secret.ENTROPY)
    rank = " ".join(f"WHEN '{kind}' THEN {i}" for i, kind in enumerate(_secret.KINDS))
    terms = ", ".join(map(str, _secret.count_terms(_secret.WINDOW)))
    harmless = " AND ".join(f"NOT regexp_matches(s, {_text(a)})" for a in _secret.ALLOWED)
    w, rest = _secret.WINDOW, "t"
    for word in _secret.SAMPLES:
        rest = f"regexp_replace({rest}, '{word}', '{' ' * len(word)}', 'gi')"
    return f"""
WITH texts AS (SELECT doc_id, t, {rest} AS rest FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
matched AS ({" UNION ALL ".join(kinds)}),
placed AS (SELECT doc_id, kind, found[k] AS s, vals[k] AS v,
                  list_sum(list_transform(between_[1:k], lambda x: length(x)))
                  + coalesce(list_sum(list_transform(found[1:k-1], lambda x: length(x))), 0) AS pos FROM matched),
base AS (SELECT doc_id, kind, pos AS lo, pos + length(s) AS hi FROM placed
         WHERE kind IN ('access', 'hex') OR kind = 'assign' AND length(v) >= 6),
wins AS (SELECT doc_id, kind, pos, s, unnest(range(0, length(s) - {w} + 1)) AS i FROM placed
         WHERE kind LIKE 'entropy%' AND {harmless}),
hot AS (SELECT doc_id, kind, pos, i FROM
          (SELECT doc_id, kind, pos, i, c, count(*) AS n FROM
             (SELECT doc_id, kind, pos, i, unnest(string_split(substr(s, i + 1, {w}), '')) AS c FROM wins)
           GROUP BY ALL)
        GROUP BY doc_id, kind, pos, i HAVING sum([{terms}][n + 1]) <= CASE kind {least} END),
islands AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id, kind, pos ORDER BY i) AS island FROM
             (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id, kind, pos ORDER BY i) <= {w} THEN 0 ELSE 1 END AS opens
              FROM hot)),
more AS (SELECT doc_id, kind, pos + min(i) AS lo, pos + max(i) + {w} AS hi FROM islands GROUP BY doc_id, kind, pos, island),
spans AS (SELECT doc_id, kind, lo, hi, CASE kind {rank} END AS rank, kind || ':' || lo || ':' || hi AS said
          FROM (SELECT * FROM base UNION ALL SELECT * FROM more)),
per_doc AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
                   count(*) FILTER (rank = 2) AS n_hex, count(*) FILTER (rank > 2) AS n_entropy,
                   string_agg(said, ',' ORDER BY lo, rank) FILTER (rank < 3) AS base, string_agg(said, ',' ORDER BY lo, rank) AS spans
            FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
FROM texts LEFT JOIN per_doc USING (doc_id)
"""


OP1_SECRET_SCAN = _secret_sql()


def _license_sql() -> str:
    known = ", ".join(f"{_text(s)}: {_text(i)}" for s, i in _license.SENTENCES.items())
    varying = " ".join(f"WHEN regexp_matches(s, {_text(p)}) THEN {_text(i)}" for p, i in _license.PATTERNS)
    steps, last = [], "seq"
    for k, (name, sequence) in enumerate(_license.RULES):
        literal = _text("|" + "||".join(sequence) + "|")
        steps.append(f"r{k} AS (SELECT doc_id, ids, CASE WHEN contains(rest, {literal}) THEN "
                     f"list_append(names, {_text(name)}) ELSE names END AS names, replace(rest, {literal}, '#') AS rest FROM {last})")
        last = f"r{k}"
    return f"""
WITH cut AS (SELECT doc_id, unnest(string_split(regexp_replace(coalesce(text, ''), '[.!?;:]+[ \\t\\n\\x0B\\f\\r]+',
                                                               chr(10), 'g'), chr(10))) AS s,
                    generate_subscripts(string_split(regexp_replace(coalesce(text, ''), '[.!?;:]+[ \\t\\n\\x0B\\f\\r]+',
                                                               chr(10), 'g'), chr(10)), 1) AS k FROM documents),
normal AS (SELECT doc_id, k, trim(regexp_replace(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^a-z0-9]+', ' ', 'g')) AS s FROM cut),
named AS (SELECT doc_id, k, coalesce(MAP {{{known}}}[s], CASE {varying} END) AS id FROM normal),
listed AS (SELECT doc_id, list(id ORDER BY k) FILTER (id IS NOT NULL) AS ids FROM named GROUP BY doc_id),
seq AS (SELECT doc_id, coalesce(ids, []) AS ids, CAST([] AS VARCHAR[]) AS names,
               '|' || array_to_string(list_transform(coalesce(ids, []), lambda i: i || '|'), '|') AS rest FROM listed),
{", ".join(steps)}
SELECT doc_id, array_to_string(ids, ',') AS sentences,
       coalesce(array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ','), '') AS licenses,
       CAST(len(ids) AS BIGINT) AS n_sentences,
       CAST(len(list_filter(string_split_regex(rest, '[|#]+'), lambda x: x <> '')) AS BIGINT) AS n_unmatched
FROM {last}
"""


OP5_LICENSE_SCAN = _license_sql()

OP8_LINE_DEDUP = f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
cut AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS pos FROM parts),
sizes AS (SELECT unnest(range(1, {_lines.WINDOW} + 1)) AS size),
wins AS (SELECT doc_id, size, unnest(range(0, len(lines) - size + 1)) AS pos, lines FROM parts, sizes),
texts AS (SELECT doc_id, size, pos, array_to_string(lines[pos + 1:pos + size], chr(10)) AS t FROM wins),
able AS (SELECT * FROM texts
         WHERE size = {_lines.WINDOW} OR len(regexp_extract_all(t, '[^ \\t\\n\\x0B\\f\\r]+')) >= {_lines.PASSAGE}),
later AS (SELECT doc_id, size, pos
          FROM (SELECT *, row_number() OVER (PARTITION BY size, t ORDER BY doc_id, pos) AS nth FROM able) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, pos + unnest(range(0, size)) AS pos FROM later),
marked AS (SELECT cut.*, gone.pos IS NOT NULL AS drop_ FROM cut LEFT JOIN gone USING (doc_id, pos)),
edged AS (SELECT *, drop_ AND NOT coalesce(lag(drop_) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM marked)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (drop_) AS n_removed, count(*) FILTER (opens) AS n_runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drop_), '')) AS kept_sha256
FROM edged GROUP BY doc_id
"""

OP11_HARD_NEGATIVES = """
WITH able AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
              FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
          FROM able a JOIN able b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 10
"""


def _rules_sql() -> str:
    rate, r = _rules.RISK / len(_rules.RULES), len(_rules.RULES)
    per = lambda part, whole, scale: f"least({_rules.TOP}, ({scale} * {part}) // nullif({whole}, 0))"
    length = per("word_chars", "n_words", 100)
    numbers = {"symbols": per("n_symbols", "word_chars", 1000), "long_words": length,
               "short_words": f"{_rules.TOP} - {length}", "dup_lines": per("n_dup_lines", "n_lines", 1000),
               "repeats": per("n_repeat_words", "n_words", 1000)}
    rows = " UNION ALL ".join(f"SELECT doc_id, lang, {i} AS place, '{rule}' AS rule, {numbers[rule]} AS number FROM counts WHERE NOT base_failed"
                              for i, rule in enumerate(_rules.RULES))
    return f"""
WITH texts AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
split AS (SELECT doc_id, lang, t, regexp_extract_all(t, '[^ \\t\\n\\x0B\\f\\r]+') AS words,
                 list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ \\t\\n\\x0B\\f\\r]')) AS lines FROM texts),
grams AS (SELECT doc_id, words[i:i + 2] AS g, i FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
counts AS (SELECT *, n_words < {_rules.LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM (
  SELECT doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id))),
numbers AS ({rows}),
folded AS (SELECT lang, rule, number, sum(quality) AS good, sum(1 - quality) AS bad
           FROM numbers JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IN (0, 1) GROUP BY doc_id
                              HAVING min(quality) = max(quality)) USING (doc_id) GROUP BY lang, rule, number),
steps AS (SELECT lang, rule, number, CAST(sum(good) OVER w AS BIGINT) AS k, sum(bad) OVER w AS bad,
                 CAST(sum(good) OVER (PARTITION BY lang, rule) AS BIGINT) AS n FROM folded
          WINDOW w AS (PARTITION BY lang, rule ORDER BY number DESC ROWS UNBOUNDED PRECEDING)),
tails AS (SELECT lang, rule, number, k, bad,
                 list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                          + i * ln({rate}) + (n - i) * ln(1 - {rate})))) AS tail
          FROM steps WHERE k < n * {rate} AND bad > 0),
cuts AS (SELECT lang, rule, arg_max(number, bad * {2 * _rules.TOP} + number) AS cutoff FROM tails
         WHERE tail <= {1 - _rules.CONFIDENCE} / ((SELECT count(*) FROM (SELECT DISTINCT lang FROM folded)) * {r}) GROUP BY lang, rule),
failed AS (SELECT doc_id, string_agg(n.rule, ',' ORDER BY place) AS failed_rules
           FROM numbers n JOIN cuts c ON n.lang IS NOT DISTINCT FROM c.lang AND n.rule = c.rule AND n.number >= c.cutoff GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules IS NULL AS kept, coalesce(failed_rules, '') AS failed_rules
FROM counts LEFT JOIN failed USING (doc_id)
"""


OP12_QUALITY_RULES = _rules_sql()

OP13_LEXICAL_SEARCH = f"""
WITH doc_terms AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), {_TERM})) AS t FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
tfs AS (SELECT doc_id, t, count(*) AS tf FROM doc_terms GROUP BY doc_id, t),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, whole GROUP BY t, docs),
sizes AS (SELECT doc_id, 75 + (25 * n * docs) // total AS m FROM lengths, whole),
asked AS (SELECT item_id, t, count(*) AS times
          FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), {_TERM})) AS t
                FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, t),
scored AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
           FROM asked JOIN weights USING (t) JOIN tfs USING (t) JOIN sizes USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 20
"""
