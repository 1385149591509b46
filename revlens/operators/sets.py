"""Union and dedupe."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Union aligning columns by name; a column missing in one frame is NULL there.

    Prefer one scan over all targets to many per-target frames: a long chain
    of unions makes a wide plan.  This is for the few per-layout frames.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("union_by_name needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedupe_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Full-row dedupe (NULLs compare equal).  Partial aggregation removes
    duplicates map-side before the shuffle, so a heavily repeated row costs
    one row per map task, not one per copy."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()
