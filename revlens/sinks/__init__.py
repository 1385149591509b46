"""Sinks and reports (K1, K2, K5, K6).

The original tool wrote one spreadsheet.  Here the labelled table is written
as a dataset of many files by many tasks (no ``coalesce(1)``: one task must
never carry the whole table); CSV output carries the spreadsheet header
names.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from revlens import schemas

_Result = TypeVar("_Result")


def sheet_columns(df: DataFrame) -> DataFrame:
    """Rename engine columns to the spreadsheet names (tags keep their names)."""
    return df.select(*[F.col(f"`{c}`").alias(schemas.SHEET_NAMES.get(c, c)) for c in df.columns])


#: Largest number of rows in a file of an ordered table.
FILE_ROWS = 1_000_000


def ordered_newest_first(df: DataFrame, files: int | None = None) -> DataFrame:
    """O1: rows dealt to files by range, newest first (rows without a date last), and sorted within.  Rows of one date
    are dealt by a hash of the row, so a busy day fills several files instead of one task."""
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    by = [F.col("date").desc_nulls_last(), spread]
    dealt = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    return dealt.sortWithinPartitions(*by)


def write_reviews(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                  partition_by: list[str] | None = None, newest_first: bool = False, files: int | None = None,
                  seen: Observation | None = None, measures: dict[str, Column] | None = None) -> str:
    """K1: write the review table; ``fmt`` is ``parquet`` or ``csv`` (with header).  With ``newest_first`` the files in
    name order hold the reviews from the newest to the oldest, ``FILE_ROWS`` each at most.  ``seen`` takes ``measures``
    of the rows as they are written."""
    out = ordered_newest_first(df, files) if newest_first else df
    if seen is not None:           # behind the ordering, whose sampling reads its input once more
        out = out.observe(seen, *[c.alias(name) for name, c in measures.items()])
    out = sheet_columns(out) if fmt == "csv" else out
    w = out.write.mode(mode)
    if newest_first:
        w = w.option("maxRecordsPerFile", FILE_ROWS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format: {fmt}")
    return path


def _first_free(base: str, write: Callable[[str], _Result]) -> tuple[str, _Result]:
    """``write`` at ``base``, or ``base1``, ``base2``, ... - the first path not taken."""
    for version in count():
        path = base if version == 0 else f"{base}{version}"
        try:
            return path, write(path)
        except AnalysisException as e:
            if "already exists" not in str(e).lower() and "PATH_ALREADY_EXISTS" not in str(e):
                raise
    raise AssertionError("unreachable")


def write_versioned(df: DataFrame, base: str, fmt: str = "parquet", newest_first: bool = False) -> str:
    """K2: write to ``base``, or ``base1``, ``base2``, ... - the first path not
    taken - and return the path written."""
    return _first_free(base, lambda path: write_reviews(df, path, fmt, newest_first=newest_first))[0]


def write_measured(df: DataFrame, base: str, measures: dict[str, Column], fmt: str = "parquet",
                   newest_first: bool = False) -> tuple[str, dict]:
    """K2 + K6: ``write_versioned`` that also returns aggregates of the rows, measured by the write itself instead of
    another scan."""
    def write(path: str) -> dict:
        seen = Observation()
        write_reviews(df, path, fmt, newest_first=newest_first, seen=seen, measures=measures)
        return dict(seen.get)

    return _first_free(base, write)


def total_measures() -> dict[str, Column]:
    """K6: targets found, targets by status and reviews extracted, as aggregates of a report."""
    by_status = {"succeeded": "success", "no_new_reviews": "no new reviews", "failed": "failed"}
    return ({"targets": F.count(F.lit(1))}
            | {name: F.coalesce(F.sum(F.when(F.col("status") == status, 1).otherwise(0)), F.lit(0))
               for name, status in by_status.items()}
            | {"reviews": F.coalesce(F.sum("n_reviews"), F.lit(0))})


def totals(report: DataFrame) -> DataFrame:
    """K6: the totals of a report in one row."""
    return report.agg(*[c.alias(name) for name, c in total_measures().items()])
