"""Properties: labels never set for rating >= 3; partition count does not matter;
the category string and one-hot columns agree."""

from pyspark.sql import functions as F

from revlens.operators import label, nb
from revlens.sources import testbed
from revlens.sources.tables import table
from conftest import SF001

CANDS = ["license", "low quality", "contact", "decimal", "toxic", "gap", "number"]


def _run(spark, partitions):
    docs = table(spark, SF001, "documents").repartition(partitions)
    r = testbed.reviews(docs).select("doc_id", "rating", "title", "body")
    training = testbed.training_set(table(spark, SF001, "documents"), table(spark, SF001, "labels"))
    model = nb.fit(training, testbed.TEST_ML_TAGS, stem=False)
    return label.predict_labels(r, CANDS, model=model, rules=testbed.TEST_RULES, stem=False)


def test_label_properties(spark):
    a = _run(spark, 1).cache()
    assert a.filter(F.coalesce(F.col("rating") >= 3, F.lit(False))).filter(
        " + ".join(f"`{t}`" for t in CANDS) + " > 0").count() == 0
    for r in a.collect():
        assert r["category"] == " / ".join(t for t in CANDS if r[t] == 1)
    b = _run(spark, 7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
