"""Ranked lexical search and hard negatives, against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import corpus, make, nothing, odd  # noqa: F401
from pyspark.sql import functions as F
from revlens.llm import hard_negatives as hard
from revlens.llm import lexical_search as lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, top=20):
    """Rows (item_id, rank, doc_id, score) of the documented formula."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n = [sum(c.values()) for _, c in counted]
    docs_, total = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        asked, scores = terms(text), []
        for (i, c), size in zip(counted, n):
            if size:
                m = 100 - 25 + (25 * size * docs_) // total
                s = sum(math.floor(1000 * math.log((2 * docs_ + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in asked if t in c)
                if s > 0:
                    scores.append((-s, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("tree, leaf", [(8192, 64), (40, 2), (7, 3)])
def test_search_against_plain_python(make, spark, corpus, monkeypatch, tree, leaf):
    # the workers import the module anew, so sizes are set in the tree test below; here blocks of items are small
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 30 * tree // 7)
    rnd = random.Random(tree)
    docs = corpus[:120] + [(500 + i, " ".join(rnd.choices("abcdefgh", k=rnd.randint(0, 12)))) for i in range(60)]
    docs += [(900, None), (901, ""), (902, "_- \x7f"), (903, "Ünïcode ünïcode 漢字 A-B_c9 x\x85y"), (None, docs[3][1]), (3, docs[3][1]), (3, docs[3][1])]
    items = [(i, " ".join(t.split()[5:25])) for i, t in corpus[:12]] + [
        (100, "a b c"), (101, "h h h A"), (102, None), (103, ""), (104, "nowhere_to_be_found zzzz9"), (105, "漢字 ÜNÏCODE a_b"),
        (106, docs[3][1]), (100, "a b c"), (107, "x\x85y"), (None, "c d")]
    assert found(lexical.search(make(docs), items_of(spark, items))) == ranked(docs, items)


def test_trees_of_any_shape_find_the_same():
    rnd = np.random.default_rng(4)
    rows = [np.unique(np.minimum(rnd.geometric(0.15, size=rnd.integers(1, 12)) - 1, 39)) for _ in range(300)] + [np.array([0, 1, 2])] * 150
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    rank, ids = np.concatenate(rows), rnd.permutation(len(rows))
    tf, m = rnd.integers(1, 5, len(rank)), rnd.integers(75, 140, len(rows))
    asked, w = np.array([0, 2, 5, 17, 39]), np.array([3, 700, 2000, 15_000, 4000])
    doc = np.repeat(np.arange(len(rows)), np.diff(first))
    exact = np.zeros(len(rows), np.int64)
    for r, x in zip(asked, w):
        on = rank == r
        np.add.at(exact, doc[on], lexical.gain(np.full(on.sum(), x), tf[on], m[doc[on]]))
    for leaf, depth in ((64, 12), (1, 12), (3, 2), (1, 1), (1000, 5)):
        tree = lexical.Tree(ids, m, first, rank, tf, 40, leaf, depth)
        for top in (1, 7, 400, 1000):
            best = lexical.Best(top)
            tree.search(asked, w, best)
            order = np.lexsort((ids, -exact))[:top]
            order = order[exact[order] > 0]
            assert best.score.tolist() == exact[order].tolist() and best.ids.tolist() == ids[order].tolist()
    # a bound is never below a score under its node
    tree = lexical.Tree(ids, m, first, rank, tf, 40, 4, 6)
    bounds = tree.bounds(np.arange(len(tree.low)), asked, w)
    sorted_scores = exact[np.argsort(ids)][tree.ids]
    assert all(bounds[k] >= sorted_scores[a:b].max() for k, (a, b) in enumerate(zip(tree.low, tree.high)))


def test_search_prunes():
    """Documents without the item's terms lie in subtrees that are never opened."""
    rows = [np.array([k % 20, 20 + k % 7]) for k in range(4000)]
    first = np.arange(0, 8001, 2)
    tree = lexical.Tree(np.arange(4000), np.full(4000, 100), first, np.concatenate(rows), np.ones(8000, np.int64), 40, 8)
    opened = []
    tree.leaf_scores = lambda leaf, *a, of=tree.leaf_scores: opened.append(leaf) or of(leaf, *a)
    best = lexical.Best(20)
    tree.search(np.array([3, 21]), np.array([1000, 2000]), best)
    assert len(best.ids) == 20 and sum(tree.high[x] - tree.low[x] for x in opened) < 400


def test_hash_collisions_do_not_match(monkeypatch):
    monkeypatch.setattr(lexical, "_hashes", lambda low, start, end: (end - start).astype(np.uint64) % np.uint64(2))
    words = lexical.Vocabulary(["ab", "abcd", "x", "xyz"])
    data = np.frombuffer(b"xyz ab x zz abcd abce", np.uint8)
    n, term, tf, first = lexical.restricted_vectors(data, np.array([0, len(data)]), words)
    assert (n.tolist(), term.tolist(), tf.tolist()) == ([6], [0, 1, 2, 3], [1, 1, 1, 1])


def test_search_edges(spark, odd, nothing):
    items = items_of(spark, [(1, "one two three"), (2, "w1x1 w2x2")])
    rows = found(lexical.search(odd, items))
    assert [r[2] for r in rows if r[0] == 1] == [4, 5] or {r[2] for r in rows if r[0] == 1} == {4, 5}
    assert {r[2] for r in rows if r[0] == 2} == {6, 7, 8}
    assert lexical.search(nothing, items).count() == 0
    assert lexical.search(odd, items.limit(0)).count() == 0


# ---------------------------------------------------------------------------
def negatives(rows):
    """Rows (anchor, positive, rank, negative, positive score, negative score) of the documented rule."""
    able = []
    for i, x, label in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        able.append((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * c) for c in x)))
    out = []
    for a, label, v in {r for r in able if r[0] % 100 == 0}:
        of = [(-sum(p * q for p, q in zip(v, w)), i, other) for i, other, w in able]
        for ps, p, _ in sorted(x for x in of if x[2] == label and x[1] != a)[:5]:
            fit = sorted((s, i) for s, i, other in of if other != label and 30 * -ps <= 100 * -s <= 90 * -ps)[:10]
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i) in enumerate(fit)]
    return sorted(out)


def embedded(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    return df.withColumns({c: F.lit(None).cast("string") for c in ("cells", "norm", "pack", "anchor", "score", "rank")})


def mined(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
                  for r in hard.hard_negatives(df).collect())


def clustered(n, dims, seed):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, dims)) / math.sqrt(dims)
    return [(i, [float(np.float32(c)) for c in centres[rnd.integers(12)] + rnd.normal(size=dims) * 0.08], int(rnd.integers(5)))
            for i in range(n)]


def test_negatives_against_plain_python(spark):
    rows = clustered(700, 16, 1)
    rows += [(5000 + i, rows[4][1], i % 3) for i in range(60)]                       # copies: equal scores
    rows += [(6000 + i, [0.0] * 16, 1) for i in range(101)]                          # anchors without length
    rows += [(7000, None, 1), (7001, [1.0] * 16, None), (7002, [float("nan")] * 16, 1), (7003, [float("inf")] + [0.0] * 15, 1),
             (7004, [None] * 16, 2), (None, [1.0] * 16, 1), (7005, [], 1), (7006, [0.5], 2), (7007, [0.1] * 40, 3),
             (7100, rows[4][1], 4), (7100, rows[4][1], 4), (-100, rows[9][1], 2)]
    assert mined(embedded(spark, rows)) == negatives(rows)


def test_negatives_at_other_sizes(spark, monkeypatch):
    """Many small buckets, blocks and shards, and anchors that are all the rows."""
    monkeypatch.setattr(hard, "SHARD", 2)
    monkeypatch.setattr(hard, "BUCKET", 8)
    rows = [(100 * i, x, label) for i, x, label in clustered(90, 8, 2)]
    assert mined(embedded(spark, rows)) == negatives(rows)


def test_feasible_ranges_lose_nothing_and_prune():
    rnd = np.random.default_rng(3)
    cells = np.rint(256 * np.concatenate([rnd.normal(size=(300, 6)), np.eye(6), -np.eye(6), np.zeros((2, 6))])).astype(np.int64)
    ids = np.arange(len(cells))

    class Row:
        pass

    row = Row()
    row.ids, row.labels, row.cells, row.n, row.width = ids.tobytes(), ids.tobytes(), cells.tobytes(), len(ids), 6
    pack, kept = hard.Pack(row), 0
    scores = cells @ cells.T
    for share in (0.2, 0.6, 0.9, 0.99):
        for a in range(len(ids)):
            need = share * pack.length[a] * pack.longest
            want = set(np.flatnonzero(scores[a] >= need).tolist())
            cosine = need / (pack.length[a] * pack.longest) if pack.length[a] else 0.0
            rows = hard.feasible(pack, pack.way[a], cosine - hard.SLACK)
            assert rows is None or want <= set(rows.tolist())
            kept += len(ids) if rows is None else len(rows)
    assert kept < 0.7 * 4 * len(ids) ** 2


def test_products_are_exact():
    for size in (10, 1 << 26, 1 << 31, 1 << 45):
        a, b = np.array([[size, -size + 1, 3]]), np.array([[size - 1, 5, -7], [size, size, size]])
        exact = [min(max(sum(int(x) * int(y) for x, y in zip(a[0], r)), -(1 << 63)), (1 << 63) - 1) for r in b]
        assert hard.products(a, b)[0].tolist() == exact


def test_negatives_of_nothing(spark):
    assert mined(embedded(spark, []).limit(0)) == []
    assert mined(embedded(spark, [(1, [0.1], 1), (2, [0.2], 2)])) == []              # no anchor
    assert mined(embedded(spark, [(100, [0.1], 1), (2, [0.2], 2)])) == []            # no positive
