"""revlens: customer-review analytics on Spark.

Landed review pages (HTML) and payloads (JSON) are parsed into one typed
review table, cut to a recency window, enriched from lookup tables,
deduplicated, and labelled with issue tags by regular-expression rules and a
TF-IDF + multinomial Naive Bayes model that is fitted and applied with
DataFrame aggregations.

Every public operator is a ``DataFrame -> DataFrame`` function so it composes
with ``DataFrame.transform``.
"""

__version__ = "0.1.0"
