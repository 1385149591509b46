"""Sinks (K1, K2, K6) and config/training sources."""

import json
import os

import pytest
from pyspark.errors import PySparkException

from revlens import sinks
from revlens.sources import config


def test_versioned_sink(spark, tmp_out):
    df = spark.createDataFrame([(1, "a")], "rating int, title string")
    base = os.path.join(tmp_out, "Reviews")
    assert sinks.write_versioned(df, base) == base
    assert sinks.write_versioned(df, base) == base + "1"
    assert sinks.write_versioned(df, base, fmt="csv") == base + "2"
    back = spark.read.option("header", True).csv(base + "2")
    assert back.columns == ["Rating", "Title"]


def test_totals(spark):
    rep = spark.createDataFrame([("a", "success", 3), ("b", "failed", 0), ("c", "no new reviews", 0)],
                                "target string, status string, n_reviews bigint")
    t = sinks.totals(rep).collect()[0]
    assert (t["targets"], t["succeeded"], t["failed"], t["no_new_reviews"], t["reviews"]) == (3, 1, 1, 1, 3)


def test_amazon_config(spark, tmp_out):
    cfg = {"urls": {"Window": "https://a/1", "Portable": {"M1": "https://a/2", "M2": "https://a/3"}},
           "size2model": {"8,000 BTU": ["M8", "desc8"]}, "model2desc": {"M1": "d1", "M2": "d2"}}
    p = os.path.join(tmp_out, "amazon_input.json")
    with open(p, "w") as f:
        json.dump(cfg, f)
    c = config.amazon_config(spark, p)
    t = sorted((r["category"], r["model_no"], r["url"]) for r in c["targets"].collect())
    assert t == [("Portable", "M1", "https://a/2"), ("Portable", "M2", "https://a/3"), ("Window", None, "https://a/1")]
    assert [tuple(r) for r in c["size2model"].collect()] == [("8,000 BTU", "M8", "desc8")]
    assert config.check_config_category(c["targets"], "Window").count() == 1
    with pytest.raises(PySparkException, match="invalid category: Nope"):        # when the plan runs
        config.check_config_category(c["targets"], "Nope").collect()


def test_lowes_config_and_training_csv(spark, tmp_out):
    p = os.path.join(tmp_out, "lowes_input.json")
    with open(p, "w") as f:
        json.dump({"urls": {"m1": ["https://x/pd/ac/1001", "https://x/pd/ac/1002"]}, "model2desc": {"m1": "d"}}, f)
    c = config.lowes_config(spark, p)
    assert sorted(r["product_id"] for r in c["targets"].collect()) == ["1001", "1002"]
    csv = os.path.join(tmp_out, "training.csv")
    with open(csv, "w") as f:
        f.write('Title,Body,Category,Extra\n"Loud","multi\nline, body",Sound / WiFi,1\n,,,2\n')
    t = config.training_csv(spark, csv).collect()
    assert t[0]["body"] == "multi\nline, body" and t[0]["category"] == "Sound / WiFi" and t[1]["category"] is None


def test_category_urls():
    assert config.resolve_category("homedepot", "Window").startswith("https://www.homedepot.com/")
    with pytest.raises(ValueError):
        config.resolve_category("walmart", "Fridge")
