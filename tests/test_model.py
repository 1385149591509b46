"""TF-IDF and Naive Bayes numbers (FIXTURES 3.6), persistence and errors."""

import math

import pytest
from pyspark.sql import functions as F

from revlens.operators import label, nb, tfidf


def _train(spark):
    rows = [("leak water", None, "yes"), ("water water pan", None, "no"), ("", None, "")]
    return spark.createDataFrame(rows, "title string, body string, category string")


def test_tfidf_and_nb_goldens(spark):
    train = _train(spark)
    lab = nb.labelled_ngrams(train, stem=False).cache()
    vocab, table = nb.fit_table(lab, ["yes"])
    assert vocab.terms == ["leak", "leak water", "pan", "water", "water pan", "water water"]
    idf = dict(zip(vocab.terms, vocab.idf))
    assert idf["water"] == pytest.approx(1.0)
    assert idf["leak"] == pytest.approx(math.log(3 / 2) + 1)
    rows = lab.withColumn("doc_id", F.concat_ws(" ", "ngrams"))
    w = {(r["doc_id"], r["term"]): r["weight"] for r in tfidf.tfidf_long(rows, vocab).collect()}
    by_terms = {}
    for (d, t), v in w.items():
        by_terms.setdefault(d, {})[t] = v
    docs = sorted(by_terms.values(), key=len)
    assert docs[0] == pytest.approx({"leak": 0.631667, "leak water": 0.631667, "water": 0.449436}, abs=1e-6)
    assert docs[1] == pytest.approx({"pan": 0.446101, "water": 0.634809, "water pan": 0.446101,
                                     "water water": 0.446101}, abs=1e-6)
    lp = {(r["cls"], r["term"]): r["log_prob"] for r in table.collect()}
    prior = {r["cls"]: r["log_prior"] for r in table.collect()}
    assert prior[0] == pytest.approx(-0.693147, abs=1e-6) and prior[1] == pytest.approx(-0.693147, abs=1e-6)
    assert lp[(0, "leak")] == pytest.approx(-2.076075, abs=1e-6)
    assert lp[(0, "water")] == pytest.approx(-1.584549, abs=1e-6)
    assert lp[(1, "leak")] == pytest.approx(-1.553275, abs=1e-6)
    assert lp[(1, "pan")] == pytest.approx(-2.042878, abs=1e-6)
    assert lp[(1, "water")] == pytest.approx(-1.671703, abs=1e-6)


def _predict(spark, model, rows):
    df = spark.createDataFrame(rows, "id int, rating int, title string, body string")
    return {r["id"]: r["yes"] for r in label.predict_labels(df, ["yes"], model=model, rules=[], stem=False).collect()}


def test_predict_and_masks(spark, tmp_out):
    model = nb.fit(_train(spark), ["yes"], stem=False)
    rows = [(1, 1, None, "leak"), (2, 1, None, "pan"), (3, 1, None, "nothing known"), (4, 3, None, "leak"),
            (5, None, None, "leak"), (6, 1, "leak", None), (7, 1, "leak", ""),
            (8, 1, "leak", "Rating provided by a verified purchaser")]
    got = _predict(spark, model, rows)
    assert got == {1: 1, 2: 0, 3: 0, 4: 0, 5: 1, 6: 0, 7: 0, 8: 0}
    # a saved model predicts the same as the fresh one
    model.save(spark, tmp_out + "/model")
    loaded = nb.NBModel.load(spark, tmp_out + "/model", ["yes"])
    assert _predict(spark, loaded, rows) == got


def test_load_or_train(spark, tmp_out):
    path = tmp_out + "/m2"
    m = label.load_or_train(spark, ["yes"], path, _train(spark), stem=False)
    again = label.load_or_train(spark, ["yes"], path, None, stem=False)
    assert again.vocab.terms == m.vocab.terms
    with pytest.raises(FileNotFoundError):
        label.load_or_train(spark, ["other"], path, None)


def test_unknown_tag_is_an_error(spark):
    with pytest.raises(KeyError):
        nb.fit(_train(spark), ["no such tag"], stem=False)


def test_empty_vocabulary_is_an_error(spark):
    rows = [("1 2 3", None, "a")]
    with pytest.raises(ValueError):
        nb.fit(spark.createDataFrame(rows, "title string, body string, category string"), ["a"], stem=False)


def test_vocabulary_cap(spark):
    letters = "abcdefghijklmnopqrst"
    rows = [(" ".join(f"wq{letters[i]}{letters[j]}" for j in range(20)), None, "a") for i in range(20)]
    train = spark.createDataFrame(rows, "title string, body string, category string")
    model = nb.fit(train, ["a"], stem=False, max_features=50)
    assert len(model.vocab) == 50


def test_saving_one_tag_keeps_the_others_and_real_errors_show(spark, tmp_out):
    path = tmp_out + "/m3"
    nb.fit(_train(spark), ["yes"], stem=False).save(spark, path)
    nb.fit(_train(spark), ["no"], stem=False).save(spark, path)
    both = nb.NBModel.load(spark, path, ["yes", "no"])
    assert set(both.log_prior) == {("yes", 0), ("yes", 1), ("no", 0), ("no", 1)}
    with open(tmp_out + "/broken", "w") as f:
        f.write("not a table")
    with pytest.raises(Exception) as e:
        label.load_or_train(spark, ["yes"], tmp_out + "/broken", _train(spark), stem=False)
    assert not isinstance(e.value, FileNotFoundError)
    with open(tmp_out + "/broken") as f:
        assert f.read() == "not a table"          # nothing was overwritten


def test_stem_of_a_long_run_of_y():
    from revlens.functions.stem import porter_stem

    assert porter_stem("y" * 5000).startswith("y") and porter_stem("happy") == "happi" and porter_stem("toying") == "toy"


def test_frequent_terms_equal_the_full_count(spark, monkeypatch):
    import random

    from revlens.operators import tfidf

    rnd = random.Random(2)
    zipf = [[f"w{int(rnd.paretovariate(0.6)) % 5000}" for _ in range(rnd.randint(0, 60))] for _ in range(800)]
    flat = [[f"t{i * 7 + j}" for j in range(7)] for i in range(300)]           # every term once
    ties = [[f"k{j}" for j in range(40)] for _ in range(5)]
    for rows, most, tracked in ((zipf, 20, 200), (zipf, 20, 5000), (zipf, 3, 12), (flat, 10, 100), (ties, 10, 100), (ties, 50, 1000),
                                ([[]], 5, 100), ([None, ["a", "a", "b"]], 5, 100)):
        df = spark.createDataFrame([(r,) for r in rows], "ngrams array<string>").repartition(3)
        got = [tuple(r) for r in tfidf.frequent_terms(df, max_features=most, tracked=tracked).collect()]
        assert got == [tuple(r) for r in tfidf.top_terms(tfidf.term_stats(df), most).collect()]
    # frequent terms are found from the summary: nothing but candidates is ever grouped
    sizes, real = [], tfidf.term_stats
    monkeypatch.setattr(tfidf, "term_stats", lambda docs, col="ngrams": sizes.append(
        docs.select(F.explode(col)).distinct().count()) or real(docs, col))
    df = spark.createDataFrame([(r,) for r in zipf], "ngrams array<string>")
    tfidf.frequent_terms(df, max_features=5, tracked=2000)
    assert sizes and max(sizes) <= 5 * tfidf.CANDIDATES
