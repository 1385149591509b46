"""Recency cut-offs and page-sequence cut-offs as set operations.

The original tool walks each product's pages newest first and stops at the
first review older than the limit.  Here a target's pages are rows, so a
"stop" becomes a per-target cut-off found with a grouped aggregate (partial
aggregation before the shuffle, so a hot target never lands in one task)
and applied with a join back on the target key.  The joined side has one row
per target; AQE turns the join into a broadcast join when that side is
measured small, and splits skewed partitions of the big side otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def recency_filter(df: DataFrame, earliest: Column | None, date_col: str = "date") -> DataFrame:
    """keep ``date >= earliest`` (inclusive); no limit when ``earliest`` is None."""
    if earliest is None:
        return df
    return df.filter(F.col(date_col) >= earliest)


def _order_key(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def take_while(df: DataFrame, stop: Column, key: str = "target",
               order: Sequence[str] = ("page_no", "pos")) -> DataFrame:
    """Keep each target's rows before its first row where ``stop`` is true.

    ``order`` gives the read order within a target.  Rows at or after the
    first stop row (in that order) are dropped, whatever their own values.
    """
    k = "__stop_at"
    stops = (df.filter(stop).groupBy(key)
             .agg(F.min(_order_key(order)).alias(k)))
    joined = df.join(stops, key, "left")
    return joined.filter(F.col(k).isNull() | (_order_key(order) < F.col(k))).drop(k)


def take_while_recent(df: DataFrame, earliest: Column | None, key: str = "target",
                      order: Sequence[str] = ("page_no", "pos"), date_col: str = "date") -> DataFrame:
    """the first too-old review stops its whole target; later rows are lost
    even if newer.  Equals ``recency_filter`` when pages are newest first."""
    if earliest is None:
        return df
    return take_while(df, F.col(date_col) < earliest, key, order)


def take_while_recent_window(df: DataFrame, earliest: Column | None, key: str = "target",
                             order: Sequence[str] = ("page_no", "pos"), date_col: str = "date") -> DataFrame:
    """The same cut-off as a running flag over an ordered window.

    Kept for small inputs and as a cross-check; the window puts one whole
    target in one task, so ``take_while_recent`` is the scalable form.
    """
    if earliest is None:
        return df
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stopped = F.max((F.col(date_col) < earliest).cast("int")).over(w)
    return df.withColumn("__stopped", stopped).filter(F.col("__stopped") == 0).drop("__stopped")


def pager_flags(pages: DataFrame, key: str = "target", seq_col: str = "seq", label_col: str = "page_label",
                wrap_label: str | None = "1") -> DataFrame:
    """each observation with ``__repeat`` (same label as the one fetched just before) and ``__ends``.

    With a ``wrap_label`` a repeat is only skipped, and the pager coming back to that label from another page
    ends the target; with None a repeat itself does (the address that did not change).  The previous fetch
    is found by an equi-join on ``seq - 1`` of narrow rows, so no target is ever sorted in one task.
    """
    prev = pages.select(F.col(key), (F.col(seq_col) + 1).alias(seq_col), F.col(label_col).alias("__prev"))
    p = pages.join(prev, [key, seq_col], "left")
    repeat = F.coalesce(F.col(label_col) == F.col("__prev"), F.lit(False))
    ends = repeat
    if wrap_label is not None:
        ends = ~repeat & F.col("__prev").isNotNull() & F.coalesce(F.col(label_col) == F.lit(wrap_label), F.lit(False))
    return p.select(*pages.columns, repeat.alias("__repeat"), ends.alias("__ends"))


def pager_cutoff(pages: DataFrame, key: str = "target", seq_col: str = "seq",
                 label_col: str = "page_label", wrap_label: str | None = "1") -> DataFrame:
    """pager observations in fetch order (``seq`` counts fetches 1, 2, ...) that are read: nothing from
    the first one that ends its target on, and no re-observation (see ``pager_flags``)."""
    flagged = pager_flags(pages, key, seq_col, label_col, wrap_label)
    return take_while(flagged, F.col("__ends"), key, (seq_col,)).filter(~F.col("__repeat")).drop("__repeat", "__ends")
