"""Text composition, cleaning, tokens and stems (FIXTURES 3.2, X3-X10)."""

from pyspark.sql import functions as F

from revlens.functions import stem, text
from revlens.operators import tfidf


def test_compose_and_tokens(spark):
    rows = [
        (1, "Great unit...", "Great unit for us", "Great unit for us", ["great", "unit", "us"]),
        (2, "Great unit...", "great unit for us", "Great unit... great unit for us",
         ["great", "unit", "great", "unit", "us"]),
        (3, "...", "Leaks", "Leaks", ["leaks"]),
        (4, "Don't buy", None, "Don't buy ", ["don", "buy"]),
        (5, None, "I cannot cool", " I cannot cool", ["not", "cool"]),
        (6, None, None, " ", []),
    ]
    df = spark.createDataFrame(rows, "id int, title string, body string, composed string, toks array<string>")
    out = df.select("id", "composed", "toks",
                    text.compose_text(F.col("title"), F.col("body")).alias("c"),
                    text.review_tokens(F.col("title"), F.col("body"), stem=False).alias("t")).collect()
    for r in out:
        assert r["c"] == r["composed"], r["id"]
        assert list(r["t"]) == list(r["toks"]), r["id"]


def test_ngrams_sizes(spark):
    df = spark.createDataFrame([(1, []), (2, ["a"]), (3, ["ab", "cd", "ef"])], "id int, t array<string>")
    out = {r["id"]: list(r["n"]) for r in df.select("id", text.uni_bigrams(F.col("t")).alias("n")).collect()}
    assert out == {1: [], 2: ["a"], 3: ["ab", "cd", "ef", "ab cd", "cd ef"]}


def test_vectorizer_drops_short_tokens_before_bigrams(spark):
    df = spark.createDataFrame([(1, ["ab", "x", "cd"])], "id int, t array<string>")
    out = text.with_ngrams(df, F.col("t")).collect()[0]["ngrams"]
    assert list(out) == ["ab", "cd", "ab cd"]


STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall",
    "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "rational": "ration", "digitizer": "digit",
    "radicalli": "radic", "differentli": "differ", "vietnamization": "vietnam", "predication": "predic",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl",
    "triplicate": "triplic", "formative": "form", "formalize": "formal", "electriciti": "electr",
    "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "inference": "infer", "airliner": "airlin", "adjustable": "adjust", "defensible": "defens",
    "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
    "adoption": "adopt", "communism": "commun", "activate": "activ", "effective": "effect",
    "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control",
    "roll": "roll", "dying": "die", "skies": "sky", "died": "die", "cried": "cri", "running": "run",
    "leaks": "leak", "cooling": "cool", "drained": "drain", "noisy": "noisi", "geology": "geolog",
    "news": "news", "innings": "inning", "succeed": "succeed", "is": "is", "a": "a",
}


def test_porter_goldens():
    bad = {w: (e, stem.porter_stem(w)) for w, e in STEMS.items() if stem.porter_stem(w) != e}
    assert not bad


def test_stem_udf_on_arrays(spark):
    df = spark.createDataFrame([(1, ["running", "leaks"]), (2, []), (3, None)], "id int, t array<string>")
    out = {r["id"]: r["s"] for r in df.select("id", stem.stem_tokens(F.col("t")).alias("s")).collect()}
    assert list(out[1]) == ["run", "leak"] and list(out[2]) == [] and out[3] is None


def test_stemmer_equals_its_sql():
    import duckdb

    from revlens.functions.stem import IRREGULAR, porter_stem
    from revlens.plans.oracles_stem import _S2, _S3, _S4, stem_ctes

    endings = ["", "s", "es", "ies", "sses", "ed", "eed", "ied", "ing", "y", "ly", "e", "ll", "logi", *(s for s, _ in _S2), *(s for s, _ in _S3), *_S4]
    heads = ["a", "tr", "by", "yy", "sky", "toy", "oat", "hop", "fail", "hiss", "tann", "oscill", "relat", "hopef", "yyy", "ayy"]
    words = sorted({h + e for h in heads for e in endings} | set(IRREGULAR) | {"nationalli", "is", "bi", "agreed", "plied", "died", "controll", "roll"})
    con = duckdb.connect()
    con.execute("CREATE TABLE w(word VARCHAR)")
    con.executemany("INSERT INTO w VALUES (?)", [(x,) for x in words])
    got = dict(con.execute(f"WITH {stem_ctes('w')} SELECT word, stem FROM stems").fetchall())
    assert got == {x: porter_stem(x) for x in words}


def test_stems_of_arrow_lists_keep_nulls_and_places(spark):
    import pyarrow as pa

    lists = [["cats", "ponies"], None, [], ["cats"] * 3, ["sky"], None, ["feed", "ties"]]
    wanted = [x and [stem.porter_stem(w) for w in x] for x in lists]
    array = pa.array(lists, pa.list_(pa.string()))
    assert stem._stem_lists(array).to_pylist() == wanted
    assert stem._stem_lists(array.slice(1, 5)).to_pylist() == wanted[1:6]           # a batch may be a slice
    assert stem._stem_lists(array.slice(0, 0)).to_pylist() == []
    assert stem._stem_lists(pa.array([None, None], pa.list_(pa.string()))).to_pylist() == [None, None]


def test_stemming_takes_texts_in_small_batches(spark):
    from revlens.operators import label, nb
    from revlens.session import BATCH_CONF, BATCH_ROWS

    before = spark.conf.get(BATCH_CONF)
    rows = spark.createDataFrame([("a", "b", "c", 1)], "title string, body string, category string, rating int")
    try:
        for make in (lambda: nb.labelled_ngrams(rows), lambda: text.with_review_ngrams(rows)):
            spark.conf.set(BATCH_CONF, "10000")
            assert make().count() == 1 and int(spark.conf.get(BATCH_CONF)) <= BATCH_ROWS
        model = nb.NBModel(tfidf.Vocabulary(["b"], [1], 1), ["t"], {("t", 0): 0.0}, {("t", 0): [0.0]})
        spark.conf.set(BATCH_CONF, "10000")
        assert label.predict_labels(rows, ["t"], model=model).count() == 1 and int(spark.conf.get(BATCH_CONF)) <= BATCH_ROWS
    finally:
        spark.conf.set(BATCH_CONF, before)
