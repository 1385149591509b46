"""Rule labels: literal goldens for the five issue patterns (FIXTURES 3.1)."""

import pytest
from pyspark.sql import functions as F

from revlens import params
from revlens.operators import rules

GOLDENS = [
    ("Too loud", {"sound"}),
    ("cloudy day", {"sound"}),
    ("nice sound", set()),
    ("makes a sound", {"sound"}),
    ("It blinks 88", {"8.8 error code"}),
    ("shows 8.8", {"8.8 error code"}),
    ("size 8x8", set()),
    ("88 then\nerror", set()),
    ("88\rthen error", {"8.8 error code"}),
    ("did not receive it", {"missing parts"}),
    ("another item to include", {"missing parts"}),
    ("not, receive", set()),
    ("notreceive", set()),
    ("i was confused", {"used unit"}),
    ("because i used it", {"used unit"}),
    ("Wi-Fi dropped", {"wifi"}),
    ("wi fi", set()),
]


def _label(spark, rows):
    df = spark.createDataFrame(rows, "id int, rating int, title string, body string")
    tags = [t for t, _ in params.RULES]
    out = rules.rule_labels(df).withColumn("category", rules.category_string(tags))
    return {r["id"]: r for r in out.collect()}


def test_rule_goldens(spark):
    rows = [(i, 1, text, None) for i, (text, _) in enumerate(GOLDENS)]
    got = _label(spark, rows)
    tags = [t for t, _ in params.RULES]
    for i, (text, expected) in enumerate(GOLDENS):
        hit = {t for t in tags if got[i][t] == 1}
        assert hit == expected, text


def test_rating_gate_and_nulls(spark):
    rows = [(1, 1, "Too loud", None), (2, 2, "Too loud", None), (3, 3, "Too loud", None),
            (4, 5, "Too loud", None), (5, None, "Too loud", None), (6, 1, None, "loud"),
            (7, 1, None, None), (8, 1, "did not", "receive it")]
    got = _label(spark, rows)
    assert [got[i]["sound"] for i in range(1, 7)] == [1, 1, 0, 0, 1, 1]
    assert all(got[7][t] == 0 for t, _ in params.RULES)
    assert got[7]["category"] == ""
    assert got[8]["missing parts"] == 0        # title and body are never concatenated


def test_category_in_candidate_order(spark):
    df = spark.createDataFrame([(1, 1, 0, 1)], "id int, a int, b int, c int")
    out = df.withColumn("category", rules.category_string(["c", "b", "a"])).collect()[0]
    assert out["category"] == "c / a"


def test_rule_labels_are_narrow(spark):
    df = spark.createDataFrame([(1, 1, "loud", None)], "id int, rating int, title string, body string")
    plan = rules.rule_labels(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_lazy_chain_rewrite_shapes():
    assert rules._commit_lazy_chains("blink.+?88|8\\.8") == "blink(?>.+?88)|8\\.8"
    assert rules._commit_lazy_chains("a.+?b.+?c") == "a(?>.+?b)(?>.+?c)"
    for untouched in ("(?:a).+?b", "a[bc].+?d", "nois|loud", "a\\|b.+?c", "a.*?b"):
        assert rules._commit_lazy_chains(untouched) == untouched


def test_lazy_chain_rewrite_is_the_same_predicate(spark):
    from conftest import SF01
    from revlens.sources.tables import table

    docs = table(spark, SF01, "documents").select(F.lower("text").alias("t"))
    for pat in ("the.+?tion.+?and", "an.+?the", "blink.+?88|88.+?error", "ou.+?ment.+?x"):
        fast = F.col("t").rlike(rules.java_pattern(pat))
        plain = F.col("t").rlike("(?dU)" + pat)
        assert docs.filter(fast != plain).count() == 0, pat
