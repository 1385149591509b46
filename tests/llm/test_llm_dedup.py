"""Exact, line, near and repeated-byte deduplication."""

import random

import llm_brute as brute
import numpy as np
from llm_fixtures import corpus, make, nothing, odd  # noqa: F401
from pyspark.sql import functions as F

from revlens.llm import common, exact_dedup, line_dedup, ngram_join, suffix_dedup


def test_exact_groups(make, corpus, odd, nothing):
    rows = {(r.doc_id, r.text_sha256): r for r in exact_dedup.exact_groups(odd, keep="largest").collect()}
    assert rows[1, brute.sha("")].keep_id == rows[2, brute.sha("")].keep_id == 2 and rows[2, brute.sha("")].group_size == 3
    abc = brute.sha("a b c d e f g")
    assert rows[11, abc].keep_id == 12 and rows[None, abc].keep_id == 12 and rows[12, abc].kept and not rows[11, abc].kept
    assert rows[14, brute.sha("y")].group_size == 2 and rows[14, brute.sha("y")].kept
    assert exact_dedup.exact_groups(odd).count() == odd.count()
    assert exact_dedup.exact_groups(nothing).count() == 0
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(make(corpus), keep="largest").collect()}
    last = {}
    for i, t in corpus:
        last[t] = max(i, last.get(t, i))
    assert got == {i: last[t] for i, t in corpus}
    kept = exact_dedup.drop_copies(make(corpus))
    assert kept.count() == len(last) and kept.columns == make(corpus).columns
    rows = make([(1, "a b"), (1, "a b"), (1, "a b"), (2, "c"), (3, "c"), (None, "d"), (None, "d")])
    same = rows.select("doc_id", "text")
    assert sorted((r.doc_id or 0, r.text) for r in exact_dedup.drop_copies(same).collect()) == [(0, "d"), (0, "d"), (1, "a b"), (2, "c")]


def test_exact_groups_survive_hash_collisions(make, corpus):
    weak = exact_dedup.exact_groups(make(corpus), keep="smallest", hash_fn=lambda t: F.substring(F.md5(t), 1, 1))
    good = exact_dedup.exact_groups(make(corpus), keep="smallest")
    assert sorted(map(str, weak.collect())) == sorted(map(str, good.collect()))
    same_length = make([(i, f"{i % 7}ab") for i in range(40)])
    clash = exact_dedup.exact_groups(same_length, hash_fn=lambda t: F.lit("h"))
    assert {(r.doc_id, r.keep_id, r.group_size) for r in clash.collect()} == {(i, i % 7, len(range(i % 7, 40, 7))) for i in range(40)}


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + k) for k in range(1, 40)] + [(700, 701), (701, 702), (702, 700), (9, 9)]
    df = spark.createDataFrame(edges * 2, "a long, b long")
    got = {r.node: r.component for r in common.connected_components(df).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{500 + k: 500 for k in range(40)}, **{700 + k: 700 for k in range(3)}, 9: 9}
    assert common.connected_components(df.limit(0)).count() == 0


def near_rows(seed=1):
    """Families of edited copies, a passage that many texts share, short texts and texts of few words."""
    rnd = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows, passage = [], rnd.choices(vocabulary, k=40)
    for family in range(12):
        base = rnd.choices(vocabulary, k=rnd.choice([12, 30, 80, 200]))
        for _ in range(rnd.choice([1, 2, 8, 25])):
            own = list(base)
            for _ in range(rnd.randrange(0, max(2, len(own) // 30))):
                own[rnd.randrange(len(own))] = rnd.choice(vocabulary)
            rows.append(" ".join(own))
    for _ in range(60):
        own = rnd.choices(vocabulary, k=rnd.choice([0, 3, 10, 60]))
        rows.append(" ".join(own[:5] + passage + own[5:]))
    rows += ["a b c d", "A b  c\nd", "a b c", "", "q", "q"] + [" ".join(rnd.choices("xyz", k=30)) for _ in range(20)]
    rnd.shuffle(rows)
    return [(7 * i + 3, t) for i, t in enumerate(rows)]


def test_near_duplicates_against_plain_python(make, corpus, monkeypatch):
    for rows in (near_rows(), near_rows(2), corpus):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(make(rows), block=7, members=5).collect()}
        assert got == brute.components(rows)
    monkeypatch.setattr(ngram_join, "FREQUENT", 50)   # the order of n-grams must not change the links
    rows = near_rows(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(make(rows)).collect()}
    assert got == brute.components(rows)


def test_near_duplicates_edges(odd, nothing):
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.near_duplicates(odd).collect()}
    assert got[1, 0] == 1 and got[2, 0] == 2 and got[3, 0] == 3          # empty sets link with nothing
    assert got[4, 1] == got[5, 1] == 4 and got[12, 3] == 11 and got[None, 3] == 11
    assert len({got[k] for k in got if k[0] in (6, 7, 8)}) == 1 and got[14, 1] == 14
    assert ngram_join.near_duplicates(nothing).count() == 0


def test_prefix_tree_finds_what_comparing_finds():
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 400, 60, dtype=np.uint64)
    sets = [np.unique(np.where(rnd.random(60) < p, rnd.integers(0, 400, 60, dtype=np.uint64), base)) for p in rnd.random(150) / 3]
    sets += [np.unique(base)[:k] for k in range(1, 40)]
    probe = np.unique(base)
    expected = [i for i, s in enumerate(sets)
                if 100 * len(np.intersect1d(s, probe)) >= 80 * len(np.union1d(s, probe))]
    assert sorted(ngram_join.PrefixTree(sets).linked(probe, 80)) == expected and expected


def test_repeated_bytes_against_plain_python(make, corpus):
    def got(df, **k):
        return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                for r in suffix_dedup.suffix_dedup(df, **k).collect()}

    rnd = random.Random(3)
    words = [f"wörd{i}" for i in range(500)]
    passage = " ".join(rnd.choices(words, k=60))
    rows = corpus[:80] + [(1000 + i, " ".join(rnd.choices(words, k=50)) + passage[i:400 - i] + " ".join(rnd.choices(words, k=9)))
                          for i in range(12)] + [(2000, "ab" * 300), (2001, "ab" * 110 + "c"), (2002, passage + " " + passage)]
    assert got(make(rows)) == brute.repeats(rows)
    assert got(make(rows), length=40, anchor=12) == brute.repeats(rows, 40)
    assert got(make(rows), hot=2) == brute.repeats(rows)                  # samples of many rows: counted, not gathered


def test_repeated_bytes_edges(odd, nothing):
    rows = suffix_dedup.suffix_dedup(odd).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: r for r in rows}
    assert got[1].n_bytes == 0 and got[1].kept_sha256 == brute.sha("")
    assert got[6].n_removed == got[6].n_bytes and got[8].n_removed == got[8].n_bytes - 4 and got[14].n_removed == 0
    assert suffix_dedup.suffix_dedup(nothing).count() == 0


def test_refinement_blocks_are_equal_prefixes():
    rnd = np.random.default_rng(1)
    symbols = rnd.integers(0, 2, (200, 12)).astype(np.int32)
    start = rnd.integers(0, 3, 200)
    for step, block in enumerate(suffix_dedup.refine(start, symbols)):
        keys = [(int(s), *map(int, row[:step])) for s, row in zip(start, symbols, strict=True)]
        assert len(set(zip(keys, block.tolist(), strict=True))) == len(set(keys)) == len(set(block.tolist()))


def test_line_runs_against_plain_python(make, corpus):
    rnd = random.Random(8)
    rows = corpus[:80] + [(1000 + i, "\n".join(rnd.choices(["a", "b", "c", "", "dd"], k=rnd.randrange(0, 40)))) for i in range(60)]
    for window in (2, 3, 5):
        got = {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, r.text) for r in line_dedup.line_dedup(make(rows), window).collect()}
        assert got == brute.line_runs(rows, window)


def test_line_runs_edges(odd, nothing):
    rows = line_dedup.line_dedup(odd).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: r for r in rows}
    assert got[1].text == "" and got[1].n_lines == 1 and got[14].n_removed == 0
    assert got[16].n_removed and got[17].n_lines == 5
    assert line_dedup.line_dedup(nothing).count() == 0


def test_long_passages_of_few_lines(make, corpus):
    long, other = (" ".join(f"{c}{i}" for i in range(50)) for c in "pq")
    half = " ".join(f"h{i}" for i in range(25))
    rows = [(1, f"a\n{long}\nb"), (2, long), (3, f"{long}\nmore"), (4, f"{half}\n{half}"), (5, f"{half}\n{half}"),
            (6, f"x\n{half}\ny"), (7, f"{other} {other}\r"), (8, f"{long}\n{long}\nz\n{long}"), (9, None), (10, long[:-4]),
            (11, long[:-4]), (12, f"{half}\n{half}\nend")]
    got = {r.doc_id: (r.n_removed, r.n_runs, r.text) for r in line_dedup.line_dedup(make(rows), words=50).collect()}
    assert got == {1: (0, 0, rows[0][1]), 2: (1, 1, ""), 3: (1, 1, "more"), 4: (0, 0, rows[3][1]), 5: (2, 1, ""),
                   6: (0, 0, rows[5][1]), 7: (0, 0, rows[6][1]), 8: (3, 2, "z"), 9: (0, 0, ""), 10: (0, 0, long[:-4]),
                   11: (0, 0, long[:-4]), 12: (2, 1, "end")}
    rnd = random.Random(4)
    lines = ["a", "b c", "", "d e f", "g h i j k", "é  é\té é"]
    rows = corpus[:80] + [(1000 + i, "\n".join(rnd.choices(lines, k=rnd.randrange(0, 30)))) for i in range(60)]
    for window, words in ((3, 50), (3, 4), (4, 6), (2, 5)):
        got = {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, r.text)
               for r in line_dedup.line_dedup(make(rows), window, words=words).collect()}
        assert got == brute.line_passages(rows, window, words)
