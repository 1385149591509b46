"""Hard negatives for anchors of an embedding table, by coordinate pruning over length buckets.

Rows without an id, a label or a vector, or with a null or non-finite component, take no part.  Labels of ids
divisible by ``RELABEL`` move on by one; components become floor(256 * x).  Anchors are the rows whose id is divisible
by ``ANCHOR``.  Scores are integer inner products; higher ones come first, equal ones by smaller id.  An anchor's
positives are its first ``POSITIVES`` other rows (other ids) of its label; for each, the first ``NEGATIVES`` rows of other
labels whose score is 0.3 to 0.9 of the positive's are its hard negatives.

*Buckets.* Rows sorted by length (norm) are cut into buckets of at most ``BUCKET`` rows of similar length.  For every
coordinate a bucket has the list of its rows sorted by the coordinate's value in the row's direction.

*Pruning.* For an anchor that needs a score of at least t, a bucket's rows need the cosine c = t / (anchor's length x
largest length of the bucket); above 1 the bucket is skipped.  A row at an angle of at most arccos(c) from the anchor
has, in each coordinate, a value between cos(a + arccos c) and cos(a - arccos c), a being the anchor's own angle to that
axis.  These feasible ranges of the anchor's ``FOCUS`` largest coordinates are slices of the sorted lists; rows in all
of them are candidates, and only those get their exact product.  Ranges that keep most of a bucket prune nothing,
and the bucket's products with such anchors are one matrix product.  t is the score of the last wanted row so far:
it starts from what is known and rises bucket by bucket.  Two searches: positives, then negatives, whose windows follow.

Other defined cases: vectors of different lengths are compared as if filled with zeros; a row that repeats counts
as often as it comes, but equal anchors (id, label, vector) are one; products beyond 64 bits end at its limits.  An
anchor without a positive, or a positive without a negative, has no rows; an empty table gives an empty result.

Plan: rows are sorted by range into about equal parts (by length, id and content, so no length is hot) and written
as packed buckets; anchors, a hundredth of the rows, are packed into blocks.  Every block meets every shard of buckets
once (``BLOCK`` anchors x ``SHARD`` buckets in a task, the stated query set against all rows), by an equi-join on
(block, shard); of a task's results only the wanted few an anchor leave it, and a window with a limit merges them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import scratch

RELABEL, LABELS, ANCHOR, SCALE = 7, 10, 100, 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score in hundredths of its positive's.
LEAST, MOST = 30, 90
#: Rows of a bucket, buckets of a shard (on average), anchors of a block; a bucket's or block's cells are bounded too.
BUCKET, SHARD, BLOCK, FOCUS = 2048, 8, 4096, 3
BUCKET_CELLS, BLOCK_CELLS = 1 << 18, 1 << 20
MOST_TASKS = 50_000
#: Ranges that keep more than this share of a bucket prune nothing.
DENSE = 0.5
#: Slack for rounding in angles, far above double precision's error.
SLACK = 1e-9
WIDEST = 1 << 62

PACKED = "pack long, n int, width int, longest double, ids binary, labels binary, cells binary"
FOUND_POSITIVE = "anchor long, anchor_id long, score long, vec_id long"
FOUND_NEGATIVE = "anchor long, positive int, score long, vec_id long"


def vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows that take part: ``vec_id``, ``label``, ``cells`` (array of long), ``norm`` (squared length)."""
    raw = table.select(table[id_col].cast("long").alias("vec_id"), table[label_col].cast("long").alias("label"),
                       table[vector_col].cast("array<double>").alias("x"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", odd)
    label = F.when(F.col("vec_id") % RELABEL == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = raw.where(ok).select("vec_id", label.alias("label"), F.transform("x", lambda x: _floor(x)).alias("cells"))
    square = F.aggregate("cells", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.withColumn("norm", square)


def _floor(x: Column) -> Column:
    """floor(256 x), clipped to what a long can hold."""
    scaled = F.floor(F.least(F.greatest(x * SCALE, F.lit(-float(WIDEST))), F.lit(float(WIDEST))))
    return scaled.cast("long")


# ---------------------------------------------------------------------------
# Packing: rows of similar length in one row of binaries
# ---------------------------------------------------------------------------
def _pack(batches: Iterator[pa.RecordBatch], most_rows: int, most_cells: int) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0
    ids, labels, cells = [], [], []

    def packed() -> pa.RecordBatch:
        width = max(map(len, cells), default=0)
        grid = np.zeros((len(cells), width), np.int64)
        for i, c in enumerate(cells):
            grid[i, :len(c)] = c
        longest = float(np.sqrt((grid.astype(float) ** 2).sum(axis=1)).max()) if len(cells) else 0.0
        row = [[(part << 32) + made], [len(ids)], [width], [longest], [np.array(ids, np.int64).tobytes()],
               [np.array(labels, np.int64).tobytes()], [grid.tobytes()]]
        types = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)],
                                          names=["pack", "n", "width", "longest", "ids", "labels", "cells"])

    widest = 0
    for batch in batches:
        lists = batch.column("cells")
        off, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        for k, (i, label) in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist())):
            cell = flat[off[k]:off[k + 1]]
            wide = max(widest, len(cell))
            if ids and (len(ids) >= most_rows or (len(ids) + 1) * wide > most_cells):
                yield packed()
                made, ids[:], labels[:], cells[:], wide = made + 1, [], [], [], len(cell)
            widest = wide
            ids.append(i), labels.append(label), cells.append(cell)
    if ids:
        yield packed()


def packs(rows: DataFrame, most_rows: int, most_cells: int, parts: int, name: str) -> DataFrame:
    """Rows sorted by length into packed groups, each one row."""
    spread = rows.repartitionByRange(parts, F.col("norm").desc(), F.col("vec_id"), F.xxhash64("cells"))
    spread = spread.sortWithinPartitions(F.col("norm").desc(), "vec_id").select("vec_id", "label", "cells")
    return scratch(spread.mapInArrow(lambda b: _pack(b, most_rows, most_cells), PACKED), name)


# ---------------------------------------------------------------------------
# Search inside a task
# ---------------------------------------------------------------------------
class Pack:
    """Rows of one packed row: ids, labels, whole-number cells, lengths and (for buckets) sorted coordinate lists."""

    def __init__(self, row, lists: bool = True):
        self.ids, self.labels = np.frombuffer(row.ids, np.int64), np.frombuffer(row.labels, np.int64)
        self.cells = np.frombuffer(row.cells, np.int64).reshape(row.n, row.width)
        grid = self.cells.astype(float)
        self.length = np.sqrt((grid ** 2).sum(axis=1))
        self.longest = float(self.length.max(initial=0.0))
        self.way = grid / np.where(self.length > 0, self.length, 1.0)[:, None]
        if lists:
            self.order = np.argsort(self.way, axis=0, kind="stable")
            self.sorted = np.take_along_axis(self.way, self.order, axis=0)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(width, 1)
    if most < 1 << 53:
        return np.rint(a.astype(float) @ b.astype(float).T).astype(np.int64)     # all sums are exact doubles
    if most < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def feasible(bucket: Pack, way: np.ndarray, cosine: float) -> np.ndarray | None:
    """Rows of the bucket that lie in the feasible ranges of the focus coordinates; None if those keep most of it."""
    width = min(len(way), bucket.way.shape[1])
    if cosine <= 0 or not width:
        return None
    focus = np.argpartition(-np.abs(way[:width]), min(FOCUS, width) - 1)[:FOCUS]
    spread = math.acos(min(cosine, 1.0))
    angle = np.arccos(np.clip(way[focus], -1.0, 1.0))
    low = np.cos(np.minimum(angle + spread, np.pi)) - SLACK
    high = np.cos(np.maximum(angle - spread, 0.0)) + SLACK
    first = np.array([np.searchsorted(bucket.sorted[:, f], a) for f, a in zip(focus, low)])
    last = np.array([np.searchsorted(bucket.sorted[:, f], b, "right") for f, b in zip(focus, high)])
    best = int(np.argmin(last - first))
    if last[best] - first[best] > DENSE * len(bucket.ids):
        return None
    rows = bucket.order[first[best]:last[best], focus[best]]
    for f, a, b in zip(focus, low, high):
        value = bucket.way[rows, f]
        rows = rows[(value >= a) & (value <= b)]
    return rows


def scored(bucket: Pack, block: Pack, need: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, exact scores) for every anchor that the bucket may hold a row for; ``need``: the least score."""
    reach = block.length * bucket.longest
    cosine = np.where(reach > 0, need / np.where(reach > 0, reach, 1.0), np.where(need <= 0, 0.0, 2.0)) - SLACK
    dense = []
    for anchor in np.flatnonzero(cosine <= 1.0).tolist():
        rows = feasible(bucket, block.way[anchor], float(cosine[anchor]))
        if rows is None:
            dense.append(anchor)
        elif len(rows):
            yield anchor, rows, products(block.cells[anchor:anchor + 1], bucket.cells[rows])[0]
    everyone = np.arange(len(bucket.ids))
    for at in range(0, len(dense), 256):
        some = dense[at:at + 256]
        for anchor, score in zip(some, products(block.cells[some], bucket.cells)):
            yield anchor, everyone, score


def first_of(score: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` highest scores, equal ones by smaller id."""
    if len(score) > most:
        least = np.partition(score, len(score) - most)[len(score) - most]
        on = score >= least
        score, ids = score[on], ids[on]
    order = np.lexsort((ids, -score))[:most]
    return score[order], ids[order]


NOTHING = np.empty(0, np.int64)


def _buckets(packed: pd.DataFrame) -> Iterator[Pack]:
    """Longest rows first; the lists of one bucket are held at a time."""
    return map(Pack, packed.sort_values("longest", ascending=False).itertuples())


def _find_positives(anchors: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
    """One block against one shard: the best other rows of each anchor's label."""
    out = []
    for row in anchors.itertuples():
        block = Pack(row, lists=False)
        best = [(NOTHING, NOTHING)] * row.n
        need = np.full(row.n, -np.inf)
        for bucket in _buckets(packed):
            for anchor, rows, score in scored(bucket, block, need):
                ok = (bucket.labels[rows] == block.labels[anchor]) & (bucket.ids[rows] != block.ids[anchor]) & (score >= need[anchor])
                if ok.any():
                    had = best[anchor]
                    best[anchor] = first_of(np.append(had[0], score[ok]), np.append(had[1], bucket.ids[rows[ok]]), POSITIVES)
                    if len(best[anchor][0]) == POSITIVES:
                        need[anchor] = best[anchor][0][-1]
        out += [(row.pack * BLOCK + a, int(block.ids[a]), int(s), int(i)) for a, b in enumerate(best) for s, i in zip(*b)]
    return pd.DataFrame(out, columns=["anchor", "anchor_id", "score", "vec_id"])


def window(positive: int) -> tuple[int, int]:
    """Least and largest score of a positive's negatives."""
    return -((-LEAST * positive) // 100), (MOST * positive) // 100


def _find_negatives(anchors: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
    """One block (with its positives' scores) against one shard: the first negatives of each positive."""
    out = []
    for row in anchors.itertuples():
        block = Pack(row, lists=False)
        ranges: list[list[tuple[int, int]]] = [[] for _ in range(row.n)]
        for at, score in zip(row.at, row.scores):
            ranges[int(at)].append(window(int(score)))
        best = [[(NOTHING, NOTHING)] * len(of) for of in ranges]
        floor = [[float(low) if low <= high else np.inf for low, high in of] for of in ranges]
        need = np.array([min(of, default=np.inf) for of in floor])
        for bucket in _buckets(packed):
            for anchor, rows, score in scored(bucket, block, need):
                other = (bucket.labels[rows] != block.labels[anchor]) & (score >= need[anchor])
                if not other.any():
                    continue
                some, ids = score[other], bucket.ids[rows[other]]
                for k, (low, high) in enumerate(ranges[anchor]):
                    ok = (some >= low) & (some >= floor[anchor][k]) & (some <= high)
                    if ok.any():
                        had = best[anchor][k]
                        best[anchor][k] = first_of(np.append(had[0], some[ok]), np.append(had[1], ids[ok]), NEGATIVES)
                        if len(best[anchor][k][0]) == NEGATIVES:
                            floor[anchor][k] = float(best[anchor][k][0][-1])
                need[anchor] = min(floor[anchor])
        out += [(row.pack * BLOCK + a, k + 1, int(s), int(i)) for a, of in enumerate(best) for k, b in enumerate(of) for s, i in zip(*b)]
    return pd.DataFrame(out, columns=["anchor", "positive", "score", "vec_id"])


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def _meet(blocks: DataFrame, buckets: DataFrame, groups: int, shards: int, run, schema: str) -> DataFrame:
    """``run(blocks, buckets)`` once for every group of blocks (one, mostly) and shard of buckets: both sides are copied
    to the (group, shard) pairs and dealt by them, a task a pair."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("pack"), F.lit(n)).cast("int")
    parts = min(groups * shards, MOST_TASKS)
    left = blocks.withColumn("group", dealt(groups)).withColumn("shard", every(shards)).repartition(parts, "group", "shard")
    right = buckets.withColumn("shard", dealt(shards)).withColumn("group", every(groups)).repartition(parts, "group", "shard")
    return left.groupBy("group", "shard").cogroup(right.groupBy("group", "shard")).applyInPandas(run, schema)


def _parts(rows: int, most: int) -> int:
    return max(1, math.ceil(rows / most))


def _first(found: DataFrame, keys: list[str], most: int, name: str) -> DataFrame:
    """The first ``most`` rows of every key by falling score, equal ones by rising id; a task drops the rest before
    the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= most)


def hard_negatives(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``."""
    rows = vectors(table, id_col, vector_col, label_col)
    anchors = rows.where(F.col("vec_id") % ANCHOR == 0).dropDuplicates(["vec_id", "label", "cells"])
    buckets = packs(rows, BUCKET, BUCKET_CELLS, _parts(rows.count(), 4 * BUCKET), "buckets")
    blocks = packs(anchors, BLOCK, BLOCK_CELLS, _parts(anchors.count(), 4 * BLOCK), "anchors")
    shards, groups = _parts(buckets.count(), SHARD), max(1, blocks.count())
    near = _meet(blocks, buckets, groups, shards, lambda a, b: _find_positives(a, b), FOUND_POSITIVE)
    positives = scratch(_first(near, ["anchor"], POSITIVES, "positive"), "positives")
    known = positives.groupBy(F.expr(f"anchor div {BLOCK}").alias("pack")).agg(
        F.sort_array(F.collect_list(F.struct((F.col("anchor") % BLOCK).alias("at"), "positive", "score"))).alias("p"))
    known = blocks.join(known.select("pack", F.col("p.at").alias("at"), F.col("p.score").alias("scores")), "pack")
    far = _meet(known, buckets, groups, shards, lambda a, b: _find_negatives(a, b), FOUND_NEGATIVE)
    far = _first(far, ["anchor", "positive"], NEGATIVES, "rank")
    return far.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(
        positives.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"}), ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
