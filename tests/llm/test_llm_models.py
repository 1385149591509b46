"""Quality classifier, language model, packing, decontamination and the pipeline."""

import itertools
import math
import random
import zlib

import duckdb
import llm_brute as brute
import numpy as np
import pytest
from llm_fixtures import SF01, corpus, make, nothing, odd  # noqa: F401

from revlens.llm import decontam, hmm_lm, packing, quality_crf


# --- quality -------------------------------------------------------------------------------------------

def test_chain_marginals_equal_enumeration():
    rnd = np.random.default_rng(2)
    chain = quality_crf.Chain(rnd.normal(size=3), rnd.normal(size=(2, 2)))
    features, first = rnd.normal(size=(7, 3)), np.array([0, 4, 5, 7])
    good, pairs, logs = chain.run(features, first)
    total = np.zeros((2, 2))
    for k, (lo, hi) in enumerate(itertools.pairwise(first.tolist())):
        weights = {}
        for ys in itertools.product((0, 1), repeat=hi - lo):
            e = sum(y * (features[lo + t] @ chain.weights) for t, y in enumerate(ys))
            weights[ys] = math.exp(e + sum(chain.pairs[a, b] for a, b in itertools.pairwise(ys)))
        z = sum(weights.values())
        assert math.isclose(logs[k], math.log(z), rel_tol=1e-9)
        for t in range(hi - lo):
            assert math.isclose(good[lo + t], sum(w for ys, w in weights.items() if ys[t]) / z, rel_tol=1e-9)
        for ys, w in weights.items():
            for a, b in itertools.pairwise(ys):
                total[a, b] += w / z
    assert np.allclose(pairs, total)


def test_lines_and_features():
    from revlens.llm import textkit
    import pyarrow as pa

    texts = ["", "a\n\nb", "\n", "go go go stop | x", "é!!"]
    data, offsets = textkit.buffers(pa.array(texts))
    starts, first = quality_crf.lines(data, offsets)
    assert np.diff(first).tolist() == [len(t.split("\n")) for t in texts]
    f = quality_crf.line_features(data, starts, first)
    assert f.shape == (sum(len(t.split("\n")) for t in texts), quality_crf.FEATURES) and np.isfinite(f).all()
    assert f[6, 0] == pytest.approx(2 / 5)       # repeated neighbours of "go go go stop | x"


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality_crf.quality(docs, labels).collect()}
    truth = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF01}/labels.parquet'").fetchall())
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (brute.fold(i, 5) == 0) for i, r in got.items())
    held = [i for i in truth if got[i].held_out]
    assert sum(got[i].predicted == truth[i] for i in held) >= 0.97 * len(held)
    assert not [i for i in truth if truth[i] and not got[i].predicted]       # no clean document goes


def test_quality_edges(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 1), (9, None), (None, 0), (13, 0), (16, 0)], "doc_id long, quality int")
    rows = quality_crf.quality(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert {r.score for r in quality_crf.quality(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_crf.quality(nothing, labels).count() == 0
    assert quality_crf.drop_bad(odd, labels.limit(0)).columns == odd.columns


# --- language model ------------------------------------------------------------------------------------

def plain_base(docs):
    import collections

    tokens = {i: [*brute.words(t), None] for i, t in docs}
    c = collections.Counter(w for i, ws in tokens.items() if brute.fold(i, 7) != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
            for i, ws in tokens.items()}


@pytest.mark.parametrize("top", [131_072, 40])
def test_language_model_scores(make, corpus, monkeypatch, top):
    monkeypatch.setattr(hmm_lm, "TOP", top)
    monkeypatch.setattr(hmm_lm, "OWN", 20)
    model = hmm_lm.HmmLanguageModel(make(corpus), states=4, rounds=3)
    assert model.log_likelihoods == sorted(model.log_likelihoods)            # Baum-Welch never gets worse
    rows = {r.doc_id: r for r in model.scores().collect()}
    for i, (n, known, total, base) in plain_base(corpus).items():
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, brute.fold(i, 7) == 2)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_cut_texts_count_every_token_and_move_once():
    rnd = np.random.default_rng(8)
    model = hmm_lm.Model.initial(3, np.full(5, 0.2))
    texts = [rnd.integers(0, 5, n).astype(np.uint16) for n in (1, 2, 7, 8, 9, 30, 16)]
    cut = [piece for q in texts for piece in hmm_lm.segments(q, 8)]
    assert [np.concatenate([p[int(on):] for p, on in hmm_lm.segments(q, 8)]).tolist() for q in texts] == [q.tolist() for q in texts]
    starts, moves, emits, _ = model.expected(*map(list, zip(*cut)))
    tokens = sum(map(len, texts))
    assert np.isclose(starts.sum(), len(texts)) and np.isclose(moves.sum(), tokens - len(texts)) and np.isclose(emits.sum(), tokens)
    assert np.allclose(emits.sum(axis=0), np.bincount(np.concatenate(texts), minlength=5))
    # without a cut nothing changes, and a piece that goes on has no start
    whole = model.expected(texts)
    assert all(np.allclose(a, b) for a, b in zip(whole, model.expected(texts, [False] * len(texts))))
    assert model.expected(texts, [True] * len(texts))[0].sum() == 0
    assert np.allclose(model.settled() @ model.move, model.settled())


def test_forward_and_expected_counts_equal_enumeration():
    rnd = np.random.default_rng(6)

    def shares(*shape):
        x = rnd.random(shape)
        return x / x.sum(axis=-1, keepdims=True)

    model = hmm_lm.Model(shares(3), shares(3, 3), shares(3, 5))
    sequences = [np.array(s) for s in ([0, 1, 2, 4], [3], [4, 4, 0])]
    starts, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for q, log in zip(sequences, model.log10_likelihood(sequences), strict=True):
        paths = {}
        for p in itertools.product(range(3), repeat=len(q)):
            w = model.start[p[0]] * math.prod(model.emit[s, o] for s, o in zip(p, q, strict=True))
            paths[p] = w * math.prod(model.move[a, b] for a, b in itertools.pairwise(p))
        z = sum(paths.values())
        assert math.isclose(log, math.log10(z), rel_tol=1e-9)
        for p, w in paths.items():
            starts[p[0]] += w / z
            for a, b in itertools.pairwise(p):
                moves[a, b] += w / z
            for s, o in zip(p, q, strict=True):
                emits[s, o] += w / z
    got = model.expected(sequences)
    assert np.allclose(got[0], starts) and np.allclose(got[1], moves) and np.allclose(got[2], emits)


def test_language_model_edges(odd, nothing):
    rows = hmm_lm.hmm_scores(odd, states=2, rounds=1).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r.score) and r.n_tokens >= 1 for r in rows)
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2, 3)] == [1, 1, 1] and not any(r.held_out for r in rows if r.doc_id is None)
    assert hmm_lm.hmm_scores(nothing, states=2, rounds=1).count() == 0


# --- packing -------------------------------------------------------------------------------------------

@pytest.mark.parametrize("memo", [600_000, 50])
def test_pieces_and_sequences(spark, make, corpus, memo, monkeypatch):
    monkeypatch.setattr(packing, "MEMO", memo)
    tokenizer = packing.load_tokenizer(None)
    rows = corpus + [
        (5000, "Don't stop,don't! (it's)'S x's,'s rock'n'roll \"quoted\"'ll a=b c<d E.G. v1.2.3 50% e-mail@ex.org _x_"),
        (5001, "\u00dcber stra\u00dfe\u2026, na\u00efve\u2014dash \u2018q\u2019s \u00a0nbsp a\u0338=\u0338 <\u0338 \u03a3\u03a3 \u0130 \ufb01 \u4f60\u597d,x"),
        (5002, "a<|endoftext|>b <|startoftext|> <|EndOfText|> plain"), (5003, "<|"), (5004, "s ,,,...!!! a,'re,b")]
    pdf = packing.pack(make(rows), shard=64).toPandas()
    by = dict(list(pdf.sort_values("start").groupby("doc_id")))
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        got = by[i]
        assert got.length.sum() == len(ids) and set(got.doc_tokens) == {len(ids)}
        for r in got.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    padded = 0
    for _, rows in pdf.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows.offset.tolist() == [0, *np.cumsum(rows.length)[:-1]] and rows.length.sum() <= 2048
        n = int(rows.length.sum())
        padded += 0 if n & (n - 1) == 0 else 2048 - n
    assert padded < 0.05 * pdf.length.sum()


def test_closest_sum_is_the_best_multiset():
    rnd = random.Random(4)
    for _ in range(300):
        lengths = [rnd.randrange(1, 30) for _ in range(rnd.randrange(0, 9))]
        free = rnd.randrange(0, 60)
        counts = {x: lengths.count(x) for x in lengths}
        taken = packing.closest_sum(counts, free)
        best = max(sum(c) for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if sum(c) <= free)
        assert sum(x * k for x, k in taken.items()) == best and all(k <= counts[x] for x, k in taken.items())
        used = {}
        for w in packing.fill(lengths, 32):
            assert sum(x * k for x, k in w.items()) <= 32
            for x, k in w.items():
                used[x] = used.get(x, 0) + k
        assert used == counts


def test_packing_edges(odd, nothing):
    pdf = packing.pack(odd, window=64).toPandas()
    assert (pdf.groupby("sequence_id").length.sum() <= 64).all()
    assert set(pdf[pdf.doc_id.isin([1, 2, 3])].doc_tokens) == {1}
    assert len(pdf[pdf.doc_id == 14]) == 2 and pdf.doc_id.isna().sum() >= 2
    assert packing.pack(nothing).count() == 0


# --- decontamination -----------------------------------------------------------------------------------

def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_matches_against_plain_python(spark, make):
    rnd = random.Random(12)
    vocabulary = [f"t{i}" for i in range(800)]
    bench = [(k, " ".join(rnd.choices(vocabulary, k=rnd.choice([3, 5, 12, 30, 60])))) for k in range(40)]
    rows = []
    for i in range(120):
        own = rnd.choices(vocabulary, k=rnd.randrange(0, 150))
        if i % 2:
            passage = bench[rnd.randrange(40)][1].split()
            for _ in range(rnd.randrange(0, 3)):
                passage[rnd.randrange(len(passage))] = "edited"
            at = rnd.randrange(0, len(own) + 1)
            own = own[:at] + passage + own[at:]
        rows.append((i, " ".join(own).upper()))
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in
           decontam.contaminated(make(rows), items(spark, bench)).collect()}
    expected = brute.contamination(rows, bench)
    assert got == expected and any(s < 1 for s, _ in expected.values())


def test_no_match_is_lost_whatever_the_radius_and_length(spark, make):
    rnd = random.Random(21)
    vocabulary = [f"t{i}" for i in range(5000)]
    bench = [(k, " ".join(rnd.choices(vocabulary, k=m))) for k, m in enumerate((1, 2, 4, 5, 6, 9, 25, 25, 25, 120, 700, 3000))]
    rows = []
    for i in range(60):
        passage = bench[i % len(bench)][1].split()
        for _ in range(rnd.randrange(0, 1 + len(passage) // 45)):            # near the limit for the long ones
            passage[rnd.randrange(len(passage))] = "edited"
        own = rnd.choices(vocabulary, k=rnd.randrange(0, 300))
        at = rnd.randrange(0, len(own) + 1)
        rows.append((i, " ".join(own[:at] + passage + own[at:])))
    expected = brute.contamination(rows, bench)
    assert len(expected) > 50 and {k for _, k in expected} == set(range(len(bench)))
    for radius in (0, decontam.RADIUS):
        got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in
               decontam.contaminated(make(rows), items(spark, bench), radius=radius).collect()}
        assert got == expected


def test_running_counts_give_the_fingerprints_and_windows(monkeypatch):
    rnd = np.random.default_rng(5)
    grams = rnd.integers(0, 50, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    monkeypatch.setattr(decontam, "SPAN", 37)
    for width in (1, 2, 16, 399, 400):
        starts = np.flatnonzero(rnd.random(400 - width + 1) < 0.7) if width < 399 else np.arange(400 - width + 1)
        rows = np.array([grams[a:a + width] for a in starts])
        assert (decontam.window_prints(grams, starts, width) == decontam.simhash(rows)).all()
        places = np.flatnonzero(rnd.random(400) < 0.2)
        for need in (1, 3, 40):
            want = [a for a in range(400 - width + 1) if ((places >= a) & (places < a + width)).sum() >= need]
            assert decontam.windows_with(places, 400, width, need).tolist() == want


def test_index_finds_every_item_within_the_radius():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choices("abcdefghij", k=20)) for _ in range(30)]
    index = decontam.Items(list(range(30)), texts, 5, 80, decontam.RADIUS)
    for i in range(30):
        for flips in (0, 5, decontam.RADIUS):
            p = int(index.prints[i])
            for b in rnd.sample(range(64), flips):
                p ^= 1 << b
            assert (0, i) in list(index.near(np.array([p], np.uint64), 16))


def test_parts_of_the_benchmark_give_the_same(spark, make, corpus, monkeypatch):
    bench = [(k, " ".join(t.split()[5:5 + 8 + k])) for k, (_, t) in enumerate(corpus[:12])]
    whole = sorted(map(str, decontam.contaminated(make(corpus), items(spark, bench)).collect()))
    monkeypatch.setattr(decontam, "PART_WORDS", 20)
    assert whole and sorted(map(str, decontam.contaminated(make(corpus), items(spark, bench)).collect())) == whole


def test_decontamination_edges(spark, odd, nothing):
    bench = items(spark, [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (3, ""), (None, "y"), (4, "y")])
    got = sorted((r.doc_id, r.item_id) for r in decontam.contaminated(odd, bench).collect())
    assert got == [(11, 1), (11, 1), (12, 1), (12, 1), (14, 4), (14, 4)]
    assert decontam.contaminated(nothing, bench).count() == 0 and decontam.contaminated(odd, bench.limit(0)).count() == 0
    kept = decontam.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} & {11, 12, 14} == set()


def test_short_items_match_inside_documents(spark, make):
    rnd = random.Random(6)
    vocabulary = [f"s{i}" for i in range(30)]
    bench = [(k, " ".join(rnd.choices(vocabulary, k=1 + k % 7))) for k in range(40)] + [(3, "S1 s2"), (None, "s1")]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(0, 60)))) for i in range(80)] + [(90, "s1 S2"), (91, None), (None, "s1 s2")]
    expected = {}
    for i, t in rows:
        own = (t or "").lower().split()
        for k, x in bench:
            item = x.lower().split()
            at = [a for a in range(len(own) - len(item) + 1) if own[a:a + len(item)] == item]
            if at and None not in (i, k) and len(item) < 5:
                expected.setdefault((i, k), []).append((at[0], len(item), 1.0))
    out = decontam.contaminated(make(rows), items(spark, bench), short_items=True).collect()
    got = {}
    for r in out:
        if r.n_words < 5 and r.distance == 0:
            got.setdefault((r.doc_id, r.item_id), []).append((r.start_word, r.n_words, r.similarity))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()} and len(expected) > 100
    long = [(k, t) for k, t in bench if len(t.split()) >= 5]
    assert {(r.doc_id, r.item_id, r.start_word) for r in out if r.n_words >= 5} == {
        (r.doc_id, r.item_id, r.start_word) for r in decontam.contaminated(make(rows), items(spark, long)).collect() if r.n_words >= 5}
    assert {r.doc_id for r in decontam.drop_contaminated(make(rows), items(spark, [(1, "s1")])).collect()} == {
        i for i, t in rows if i is None or "s1" not in (t or "").lower().split()}
