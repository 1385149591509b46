"""Fixtures of the training-data tests; imported by name (a second conftest would hide the first)."""

import pytest

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
#: Columns whose names operators use inside.
CLASH = ("n", "h", "token", "sig", "rep", "row", "block", "member", "label", "digest", "at", "first", "ids", "keep_id",
         "component", "shard", "print", "spans", "text_sha256", "word")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
TEXTS = [
    (1, None), (2, ""), (3, " \n\t \n"), (4, "one two three"), (5, "One  two\nTHREE"), (6, LONG), (7, LONG),
    (8, LONG + " tail"), (9, "password = abcdefgh and more words to follow here"), (10, "é😀 ü " * 60), (11, "a b c d e f g"),
    (12, "a b c d e f g"), (None, "a b c d e f g"), (None, None), (13, "x\n" * 50), (14, "y"), (14, "y"),
    (15, "Released under the MIT License."), (16, "same line here\n" * 5), (17, "\n\n\n\n")]


@pytest.fixture(scope="session")
def make(spark):
    """Rows of (id, text) as documents with columns of clashing names, null in some rows."""
    from revlens.llm.common import prepare

    prepare(spark)

    def build(rows):
        extra = ", ".join(f"{c} string" for c in CLASH)
        data = [(i, t, *((None if k % 2 else c) for c in CLASH)) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(data, f"doc_id long, text string, {extra}").repartition(3)

    return build


@pytest.fixture(scope="session")
def odd(make):
    return make(TEXTS)


@pytest.fixture(scope="session")
def nothing(make):
    return make([])


@pytest.fixture(scope="session")
def corpus():
    """(id, text) of the smallest supplied documents."""
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet' ORDER BY 1").fetchall()
