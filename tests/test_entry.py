"""Driver contract: entry smoke run, registered queries and oracles."""

import __spark_entry__ as entry
from conftest import SF001


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "category" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    own = {q for q in entry.queries() if not q.startswith("op") and q != "pipeline"}
    assert own - set(entry.oracle_sql()) == set()


def test_queries_run_on_smallest_tables(spark):
    for name, fn in entry.queries().items():
        if name.startswith("op") or name == "pipeline":      # covered by the tests of their own folder
            continue
        df = fn(spark, SF001)
        assert df.columns, name
        df.write.format("noop").mode("overwrite").save()
