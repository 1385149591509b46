"""DuckDB oracle of Porter stemming, independent of the Python stemmer: words as consonant/vowel masks.

``V`` and ``C`` stand for the letters of a word; the measure is the number of ``VC`` in the mask without
repeats.  The mask of a beginning of a word is the beginning of its mask, so every step needs one mask.
"""

from __future__ import annotations

from revlens import params
from revlens.functions.stem import IRREGULAR
from revlens.plans import oracles
from revlens.plans.oracles import CHAIN_CTES, REVIEWS_CTE, _category, _rule_case, tokens_sql, with_reviews
from revlens.plans.oracles_flows import PHRASE


def _mask(w: str) -> str:
    x = f"regexp_replace(regexp_replace({w}, '[aeiou]', 'V', 'g'), '[b-df-hj-np-tv-xz]', 'C', 'g')"
    x = f"regexp_replace({x}, '^y', 'C')"
    for _ in range(4):      # runs of up to nine y
        x = f"replace(replace({x}, 'Cyy', 'CVC'), 'Vyy', 'VCV')"
    return f"replace(replace({x}, 'Cy', 'CV'), 'Vy', 'VC')"


def _measure(mask: str) -> str:
    x = f"regexp_replace(regexp_replace({mask}, 'V+', 'V', 'g'), 'C+', 'C', 'g')"
    return f"((length({x}) - length(replace({x}, 'VC', ''))) // 2)"


def _cut(x: str, n: int) -> str:
    return f"left({x}, length({x}) - {n})"


def _cvc(w: str, mask: str) -> str:
    return f"((right({mask}, 3) = 'CVC' AND right({w}, 1) NOT IN ('w', 'x', 'y')) OR {mask} = 'VC')"


def _rules(rules) -> str:
    """CASE over (suffix, replacement, condition or None): the first suffix that fits decides."""
    cases = []
    for suffix, new, cond in rules:
        done = f"{_cut('w', len(suffix))} || '{new}'"
        cases.append(f"WHEN ends_with(w, '{suffix}') THEN " + (f"CASE WHEN {cond} THEN {done} ELSE w END" if cond else done))
    return "CASE " + " ".join(cases) + " ELSE w END"


def _over(n: int, most: int) -> str:
    return f"{_measure(_cut('k', n))} > {most}"


def _step(name: str, source: str, expr: str) -> str:
    return (f"{name}_ AS (SELECT word, {expr} AS w FROM {source}), "
            f"{name} AS (SELECT word, w, {_mask('w')} AS k FROM {name}_)")


_S2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
       ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
       ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"),
       ("biliti", "ble"), ("fulli", "ful")]
_S3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
_S4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
       "ous", "ive", "ize"]

_STEP1B = f"""
CASE WHEN base IS NULL THEN w
     WHEN ends_with(base, 'at') OR ends_with(base, 'bl') OR ends_with(base, 'iz') THEN base || 'e'
     WHEN length(base) >= 2 AND right(base, 1) = substr(base, length(base) - 1, 1) AND right(kb, 1) = 'C'
       THEN CASE WHEN right(base, 1) IN ('l', 's', 'z') THEN base ELSE {_cut('base', 1)} END
     WHEN {_measure('kb')} = 1 AND {_cvc('base', 'kb')} THEN base || 'e' ELSE base END"""


def stem_ctes(words: str) -> str:
    """CTEs that end in ``stems(word, stem)`` for the distinct words of the relation ``words(word)``."""
    irregular = " ".join(f"WHEN '{w}' THEN '{s}'" for w, s in IRREGULAR.items())
    k1 = _cut("k", 1)
    return ", ".join([
        f"p0 AS (SELECT word, word AS w, {_mask('word')} AS k FROM {words})",
        _step("p1a", "p0", "CASE WHEN length(w) = 4 AND ends_with(w, 'ies') THEN " + _cut("w", 3) + " || 'ie' ELSE "
              + _rules([("sses", "ss", None), ("ies", "i", None), ("ss", "ss", None), ("s", "", None)]) + " END"),
        f"""p1b1 AS (SELECT word, CASE
               WHEN ends_with(w, 'ied') THEN {_cut('w', 3)} || CASE WHEN length(w) = 4 THEN 'ie' ELSE 'i' END
               WHEN ends_with(w, 'eed') THEN CASE WHEN {_over(3, 0)} THEN {_cut('w', 3)} || 'ee' ELSE w END ELSE w END AS w,
             CASE WHEN ends_with(w, 'ied') OR ends_with(w, 'eed') THEN NULL
                  WHEN ends_with(w, 'ed') AND contains({_cut('k', 2)}, 'V') THEN {_cut('w', 2)}
                  WHEN ends_with(w, 'ing') AND contains({_cut('k', 3)}, 'V') THEN {_cut('w', 3)} END AS base FROM p1a)""",
        f"p1b2 AS (SELECT *, {_mask('base')} AS kb FROM p1b1)",
        _step("p1b", "p1b2", _STEP1B),
        _step("p1c", "p1b", f"CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND right({k1}, 1) = 'C' THEN {_cut('w', 1)} || 'i' ELSE w END"),
        _step("p2a", "p1c", f"CASE WHEN ends_with(w, 'alli') AND {_over(4, 0)} THEN {_cut('w', 4)} || 'al' ELSE w END"),
        _step("p2", "p2a", _rules([(s, r, _over(len(s), 0)) for s, r in _S2] + [("logi", "log", _over(3, 0))])),
        _step("p3", "p2", _rules([(s, r, _over(len(s), 0)) for s, r in _S3])),
        _step("p4", "p3", _rules([(s, "", _over(len(s), 1) + (
            f" AND right({_cut('w', 3)}, 1) IN ('s', 't')" if s == "ion" else "")) for s in _S4])),
        _step("p5a", "p4", f"CASE WHEN ends_with(w, 'e') AND ({_over(1, 1)} OR ({_measure(k1)} = 1 AND NOT "
                           f"{_cvc(_cut('w', 1), k1)})) THEN {_cut('w', 1)} ELSE w END"),
        _step("p5b", "p5a", f"CASE WHEN ends_with(w, 'll') AND {_over(1, 1)} THEN {_cut('w', 1)} ELSE w END"),
        f"stems AS (SELECT word, CASE word {irregular} ELSE CASE WHEN length(word) <= 2 THEN word ELSE w END END AS stem FROM p5b)",
    ])


STEM_VOCAB = with_reviews(f"""
, words AS (SELECT DISTINCT unnest({tokens_sql('title', 'body')}) AS word FROM reviews),
{stem_ctes('words')}
SELECT word, stem FROM stems
""")

_PLAIN = f"""
, rv AS (
  SELECT doc_id, target, date, rating, title, body, image,
         {tokens_sql('title', 'body')} AS toks
  FROM reviews
),"""
assert CHAIN_CTES.startswith(_PLAIN)

_STEMMED = f"""
, rv0 AS (SELECT doc_id, target, date, rating, title, body, image, {tokens_sql('title', 'body')} AS toks FROM reviews),
rv1 AS (SELECT doc_id, unnest(toks) AS word, generate_subscripts(toks, 1) AS i FROM rv0),
words AS (SELECT DISTINCT word FROM rv1),
{stem_ctes('words')},
rv2 AS (SELECT doc_id, list(stem ORDER BY i) AS toks FROM rv1 JOIN stems USING (word) GROUP BY doc_id),
rv AS (SELECT rv0.* EXCLUDE (toks), coalesce(rv2.toks, []) AS toks FROM rv0 LEFT JOIN rv2 USING (doc_id)),"""

PREDICT_LABELS_STEMMED = with_reviews(_STEMMED + CHAIN_CTES[len(_PLAIN):] + "\n" + oracles.PREDICT_LABELS_TAIL)


def _default_tags() -> str:
    """The chain with the two trained tags' names, on the reviews with phrases."""
    low, toxic = params.TRAIN_TAGS
    chain = _STEMMED + CHAIN_CTES[len(_PLAIN):]
    for old, new in (("low quality", low), ("toxic", toxic)):
        for a in (f"'{old}'", f'"{old}"'):
            chain = chain.replace(a, a.replace(old, new))
    chain = chain.replace("'low quality / toxic'", f"'{low} / {toxic}'")
    said = REVIEWS_CTE.replace("\nreviews AS (", "\nplain AS (") + f""",
reviews AS (SELECT * REPLACE (
    CASE WHEN doc_id % 2 = 0 THEN {PHRASE} || ' ' || coalesce(title, '') ELSE title END AS title,
    CASE WHEN doc_id % 2 = 1 THEN {PHRASE} || ' ' || coalesce(body, '') ELSE body END AS body) FROM plain)"""
    rules = dict(params.RULES)
    tags = ", ".join(f'{_rule_case(t, rules[t])} AS "{t}"' if t in rules else f'm."{t}" AS "{t}"' for t in params.DEFAULT_TAGS)
    return f"""WITH {said}{chain}
, flagged AS (SELECT r.doc_id, {tags} FROM rvn r JOIN ml m ON r.doc_id = m.doc_id)
SELECT *, {_category(params.DEFAULT_TAGS)} AS category FROM flagged"""


ORACLES = {"stem_vocab": STEM_VOCAB, "predict_labels_stemmed": PREDICT_LABELS_STEMMED,
           "predict_default_tags": _default_tags()}
