"""Porter (1980) suffix stripping, with the common library extensions.

A small per-word helper.  Spark applies it to token arrays in Arrow batches
(``stem_tokens``): a batch's tokens stay in Arrow's buffers, only its distinct
words become Python strings, and a per-worker memo keeps their stems from
batch to batch; no token ever leaves its row.

Extensions to the published algorithm (those of the widely used Python
implementation's default mode):

* words of one or two letters are returned unchanged;
* a fixed pool of irregular forms;
* step 1a: a four-letter word ending in ``ies`` -> ``ie``;
* step 1b: ``ied`` -> ``ie`` for four-letter words, else ``i``;
* step 1c: ``y`` -> ``i`` only after a consonant, and only when the stem is
  longer than one letter;
* step 2: ``alli`` -> ``al`` is tried first and re-enters step 2; ``bli`` ->
  ``ble``; extra rules ``fulli`` -> ``ful`` and ``logi`` -> ``log``;
* cvc test also accepts a two-letter vowel-consonant stem.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FIXED VALUES: irregular forms of the library's default mode (form -> stem).
IRREGULAR = {
    "skies": "sky", "sky": "sky",
    "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news",
    "innings": "inning", "inning": "inning",
    "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning",
    "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

_VOWELS = set("aeiou")


def _cons(w: str, i: int) -> bool:
    # a "y" is what the letter before it is not; walk back over a run of them
    j = i
    while w[j] == "y" and j > 0:
        j -= 1
    return (w[j] not in _VOWELS) ^ ((i - j) % 2 == 1)


def _m(stem: str) -> int:
    """Porter's measure: number of vowel->consonant transitions."""
    n, prev_vowel = 0, False
    for i in range(len(stem)):
        c = _cons(stem, i)
        if c and prev_vowel:
            n += 1
        prev_vowel = not c
    return n


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    n = len(w)
    if n >= 3 and _cons(w, n - 3) and not _cons(w, n - 2) and _cons(w, n - 1) and w[-1] not in "wxy":
        return True
    return n == 2 and not _cons(w, 0) and _cons(w, 1)


def _first_rule(word: str, rules) -> str:
    """Apply the first rule whose suffix matches; if its condition fails the
    word is returned unchanged (later rules are not tried)."""
    for suffix, repl, cond in rules:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            return stem + repl if cond is None or cond(stem) else word
    return word


def _pos(stem: str) -> bool:
    return _m(stem) > 0


def _gt1(stem: str) -> bool:
    return _m(stem) > 1


def _step1a(w: str) -> str:
    if len(w) == 4 and w.endswith("ies"):
        return w[:-3] + "ie"
    return _first_rule(w, [("sses", "ss", None), ("ies", "i", None), ("ss", "ss", None), ("s", "", None)])


def _step1b(w: str) -> str:
    if w.endswith("ied"):
        return w[:-3] + ("ie" if len(w) == 4 else "i")
    if w.endswith("eed"):
        stem = w[:-3]
        return stem + "ee" if _m(stem) > 0 else w
    base = None
    for suffix in ("ed", "ing"):
        if w.endswith(suffix) and _has_vowel(w[: -len(suffix)]):
            base = w[: -len(suffix)]
            break
    if base is None:
        return w
    for suffix, repl in (("at", "ate"), ("bl", "ble"), ("iz", "ize")):
        if base.endswith(suffix):
            return base[: -len(suffix)] + repl
    if _double_cons(base):
        return base[:-1] if base[-1] not in "lsz" else base
    if _m(base) == 1 and _cvc(base):
        return base + "e"
    return base


def _step1c(w: str) -> str:
    if w.endswith("y") and len(w) > 2 and _cons(w, len(w) - 2):
        return w[:-1] + "i"
    return w


_STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
]


def _step2(w: str) -> str:
    if w.endswith("alli") and _pos(w[:-4]):
        return _step2(w[:-4] + "al")
    # 'logi' -> 'log': the 'l' stays with the stem for the measure test.
    return _first_rule(w, [(s, r, _pos) for s, r in _STEP2] + [("logi", "log", lambda s: _pos(w[:-3]))])


_STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
          ("ful", ""), ("ness", "")]

_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
          "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def _step3(w: str) -> str:
    return _first_rule(w, [(s, r, _pos) for s, r in _STEP3])


def _step4(w: str) -> str:
    rules = []
    for s in _STEP4:
        if s == "ion":
            rules.append((s, "", lambda st: _m(st) > 1 and st[-1:] in ("s", "t")))
        else:
            rules.append((s, "", _gt1))
    return _first_rule(w, rules)


def _step5a(w: str) -> str:
    if w.endswith("e"):
        stem = w[:-1]
        m = _m(stem)
        if m > 1 or (m == 1 and not _cvc(stem)):
            return stem
    return w


def _step5b(w: str) -> str:
    if w.endswith("ll") and _m(w[:-1]) > 1:
        return w[:-1]
    return w


@lru_cache(maxsize=1 << 18)
def porter_stem(word: str) -> str:
    w = word.lower()
    if w in IRREGULAR:
        return IRREGULAR[w]
    if len(w) <= 2:
        return w
    for step in (_step1a, _step1b, _step1c, _step2, _step3, _step4, _step5a, _step5b):
        w = step(w)
    return w


def _stem_lists(tokens: pa.Array) -> pa.Array:
    coded = tokens.flatten().dictionary_encode()
    stems = pa.array([porter_stem(w) for w in coded.dictionary.to_pylist()], pa.string())
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).cast(pa.int32())
    ends = pc.cumulative_sum(sizes)
    starts = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    return pa.ListArray.from_arrays(starts, stems.take(coded.indices), mask=tokens.is_null())


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(tokens: pa.Array) -> pa.Array:
    """Stem every token of every array in the batch (see ``session.small_batches``)."""
    return _stem_lists(tokens)


@F.pandas_udf(T.StringType())
def stem_word(words: pd.Series) -> pd.Series:
    """Stem one word per row (for vocabulary tables)."""
    return words.map(lambda w: None if w is None else porter_stem(w))
