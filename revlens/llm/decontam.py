"""Benchmark decontamination: SimHash over item-sized windows, multi-index Hamming blocks, exact check.

For every benchmark item of m words, the windows of m words of a document are compared with the item
(a shorter document is one window).  A window and an item match when the weighted Jaccard similarity of
their ``size``-word shingles (multisets) is at least ``percent`` / 100.  Words are runs of other than ASCII
white space, A-Z lower-cased; an item with fewer words than ``size`` is one shingle, and is looked up in the
documents' windows of its own number of words (without ``short_items`` only a document that is the item as a whole
matches it).

Per (document, item) with a matching window one row is returned: the best window (largest similarity, then
first).  Documents and items without words, or without an id, match nothing; repeated rows are returned
as often as they occur; an empty table gives an empty result.

How a window is found:

1. A window that can match an item of as many shingles shares at least ``2 * percent / (100 + percent)`` of
   them with it.  A running count of the shingles that items of that size have leaves only windows that
   reach this bound.
2. Those windows get a 64-bit SimHash over their weighted shingles, from running counts of every bit, so a
   long item costs no more a window than a short one.  The fingerprints of all items are indexed by ``BLOCKS``
   blocks of bits: fingerprints within ``RADIUS`` differ in at most ``RADIUS // BLOCKS`` bits of some block, so
   each item is entered under every value within that many bits of its blocks, and a window looks up its own
   blocks: no item within the radius is missed.  These candidates, nearest first, are verified by the exact weighted
   similarity.
3. A match beyond the radius is unlikely (about 10 bits, with a deviation of 3, at a similarity of 0.8) but possible.
   So the windows of the first step are also counted against each single item of their size, and any that shares
   enough shingles with one is verified as well: nothing is lost, whatever the radius.

Items are numbered into parts of at most ``PART_WORDS`` words by Spark (an item is not cut); one part at a time goes
through the driver to the tasks, as one scan of the documents, and its matches are added to one written table.
Neither the plan nor what is held at once grows with the benchmark, and documents are never shuffled.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm import textkit
from revlens.llm.common import id_text, scratch, without
from revlens.session import ensure_checkpoint_dir

SIZE, PERCENT = 5, 80
#: Hamming radius of the search.  Two sets with weighted Jaccard similarity 0.8 differ in about 10 of
#: 64 bits (angle of cosine 0.89), with a deviation of 3.
RADIUS, BLOCKS = 23, 8
#: Words of benchmark text given to the tasks at once.
PART_WORDS = 50_000
#: Window starts whose bits are counted together (256 bytes a shingle).
SPAN = 1 << 12

_U = np.uint64


def _bits(block: int) -> tuple[int, int]:
    """First bit and width of a block."""
    width = 64 // BLOCKS
    return block * width, width


class Items:
    """Benchmark items with their shingles, fingerprints and multi-index, as sent to tasks."""

    def __init__(self, ids: list[int], texts: list[str], size: int, percent: int, radius: int, short_items: bool = False):
        self.size, self.percent, self.radius = size, percent, radius
        data, offsets = textkit.buffers(pa.array(texts, pa.string()))
        words = textkit.Words(data, offsets)
        grams, first = words.shingles(size)
        counts = np.diff(words.first)
        keep = [i for i in range(len(ids)) if counts[i] and ids[i] is not None]
        #: number of words, if under ``size`` -> hash of an item of so many words -> ids of such items
        self.short: dict[int, dict[int, list[int]]] = {}
        if short_items:
            for m in sorted({int(counts[i]) for i in keep if counts[i] < size}):
                own, at = words.shingles(m)
                for i in keep:
                    if counts[i] == m:
                        self.short.setdefault(m, {}).setdefault(int(own[at[i]]), []).append(ids[i])
            keep = [i for i in keep if counts[i] >= size]
        self.ids = [ids[i] for i in keep]
        self.words = counts[keep]
        self.grams = [grams[first[i]:first[i + 1]] for i in keep]
        self.weights = [Counter(g.tolist()) for g in self.grams]
        self.known = np.unique(np.concatenate(self.grams)) if keep else np.empty(0, np.uint64)
        self.low = np.zeros(1 << 22, bool)
        self.low[(self.known & _U((1 << 22) - 1)).astype(np.int64)] = True
        self.prints = np.array([simhash(g[None, :])[0] for g in self.grams], np.uint64)
        #: number of shingles of an item -> indices of such items, and which shingles these have
        self.by_count: dict[int, list[int]] = {}
        for i, g in enumerate(self.grams):
            self.by_count.setdefault(len(g), []).append(i)
        self.own = {n: np.isin(self.known, np.concatenate([self.grams[i] for i in members]))
                    for n, members in self.by_count.items()}
        #: indices of ``known`` that each item has
        self.has = [np.unique(np.searchsorted(self.known, g)) for g in self.grams]
        self.index: list[dict[int, list[int]]] = []
        for block in range(BLOCKS):
            shift, width = _bits(block)
            table: dict[int, list[int]] = {}
            for i, p in enumerate(self.prints.tolist()):
                value = (p >> shift) & ((1 << width) - 1)
                for flips in range(radius // BLOCKS + 1):
                    for at in combinations(range(width), flips):
                        table.setdefault(value ^ sum(1 << b for b in at), []).append(i)
            self.index.append(table)

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, which): shingles that any item has, as indices of ``known``."""
        at = np.flatnonzero(self.low[(grams & _U((1 << 22) - 1)).astype(np.int64)])
        if not len(at):
            return at, at
        near = np.minimum(np.searchsorted(self.known, grams[at]), len(self.known) - 1)
        hit = self.known[near] == grams[at]
        return at[hit], near[hit]

    def near(self, prints: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
        """(window, item) pairs within the radius, for items of ``n`` shingles."""
        wanted = set(self.by_count[n])
        for w, p in enumerate(prints.tolist()):
            found: set[int] = set()
            for block in range(BLOCKS):
                shift, width = _bits(block)
                found.update(self.index[block].get((p >> shift) & ((1 << width) - 1), ()))
            for i in found & wanted:
                if (p ^ int(self.prints[i])).bit_count() <= self.radius:
                    yield w, i


def simhash(rows: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each row of shingle hashes; a repeated shingle weighs as often as it occurs."""
    bits = np.unpackbits(np.ascontiguousarray(rows).astype("<u8").view(np.uint8).reshape(*rows.shape, 8), axis=2,
                         bitorder="little").reshape(*rows.shape, 64)
    ones = bits.sum(axis=1, dtype=np.int64)
    return np.packbits(2 * ones >= rows.shape[1], axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def window_prints(grams: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash of the windows of ``width`` shingles at ascending ``starts``, from running counts of each bit over
    stretches of at most ``SPAN`` window starts."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        end = int(np.searchsorted(starts, low + SPAN))
        stretch = np.ascontiguousarray(grams[low:int(starts[end - 1]) + width]).astype("<u8")
        bits = np.unpackbits(stretch.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.zeros((len(stretch) + 1, 64), np.int32)
        np.cumsum(bits, axis=0, dtype=np.int32, out=counts[1:])
        first = starts[at:end] - low
        ones = counts[first + width] - counts[first]
        out[at:end] = np.packbits(2 * ones >= width, axis=1, bitorder="little").view("<u8").reshape(-1)
        at = end
    return out


def windows_with(places: np.ndarray, length: int, width: int, need: int) -> np.ndarray:
    """Starts of the windows of ``width`` that hold ``need`` or more of the ascending ``places``."""
    if len(places) < need:
        return np.empty(0, np.int64)
    # each place from the need-th on closes the stretch of starts whose windows hold it and the need - 1 before it
    low = np.maximum(places[need - 1:] - width + 1, 0)
    high = np.minimum(places[:len(places) - need + 1], length - width)
    ok = low <= high
    inside = np.zeros(length - width + 2, np.int64)
    np.add.at(inside, low[ok], 1)
    np.add.at(inside, high[ok] + 1, -1)
    return np.flatnonzero(np.cumsum(inside) > 0)


def weighted_similarity(a: Counter, b: Counter) -> tuple[int, int]:
    """Weighted Jaccard similarity of two multisets, as (shared, all)."""
    shared = sum((a & b).values())
    return shared, sum(a.values()) + sum(b.values()) - shared


def _matches(items: Items):
    names = ["doc_id", "item_id", "start_word", "n_words", "shared", "total", "distance"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textkit.buffers(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for lo, _, d, o in textkit.runs(data, offsets):
                words = textkit.Words(d, o)
                grams, first = words.shingles(items.size)
                at, which = items.hits(grams)
                edge = np.searchsorted(at, first)
                for i in np.flatnonzero(np.diff(edge)):
                    if ids[lo + i] is not None:
                        mine = slice(edge[i], edge[i + 1])
                        rows.extend(_document(ids[lo + i], grams[first[i]:first[i + 1]],
                                              int(words.first[i + 1] - words.first[i]),
                                              at[mine] - first[i], which[mine], items))
                for m, table in items.short.items():
                    rows.extend(_short(ids[lo:], words, m, table))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def _short(ids: list, words: textkit.Words, m: int, table: dict[int, list[int]]) -> Iterator[tuple]:
    """First place of each item of ``m`` words, fewer than a shingle has, in each document."""
    known = np.array(sorted(table), np.uint64)
    grams, first = words.shingles(m)
    which = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    at = np.flatnonzero(known[which] == grams)
    doc = np.searchsorted(first, at, "right") - 1
    _, once = np.unique(doc * len(known) + which[at], return_index=True)
    for k in once.tolist():
        i = int(doc[k])
        if ids[i] is not None:
            for item in table[int(known[which[at[k]]])]:
                yield ids[i], item, int(at[k] - first[i]), m, 1, 1, 0


def _document(doc_id, grams, n_words, places, which, items: Items) -> Iterator[tuple]:
    """Best matching window of each item in one document."""
    for n, members in items.by_count.items():
        width = min(n, len(grams))     # a document shorter than the item is one window
        # window and item share at least this many shingles when they match
        need = -(-items.percent * (width + n) // (100 + items.percent))
        own = items.own[n][which]
        if own.sum() < need:
            continue
        starts = windows_with(places[own], len(grams), width, need)
        if not len(starts):
            continue
        prints = window_prints(grams, starts, width)
        near: dict[int, set[int]] = {}
        for w, i in items.near(prints, n):
            near.setdefault(i, set()).add(w)
        for i in members:
            mine = places[own][np.isin(which[own], items.has[i])]
            rest = np.searchsorted(starts, windows_with(mine, len(grams), width, need)).tolist()
            away = {w: (int(prints[w]) ^ int(items.prints[i])).bit_count() for w in near.get(i, set()).union(rest)}
            best: tuple | None = None
            for w in sorted(away, key=lambda w: (away[w], w)):
                start = int(starts[w])
                shared, total = weighted_similarity(Counter(grams[start:start + width].tolist()), items.weights[i])
                key = (-shared / total, start)
                if 100 * shared >= items.percent * total and (best is None or key < best[0]):
                    best = key, (doc_id, items.ids[i], start, min(int(items.words[i]), n_words), shared, total, away[w])
            if best:
                yield best[1]


def _parts(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[list[str]]]:
    """The items with their ``part``, written, and the parts to take together, of at most ``PART_WORDS`` words unless a
    single item has more."""
    words = F.size(F.split(F.col("text"), r"[ \t-\r]+")).cast("long")
    rows = scratch(id_text(benchmark, id_col, text_col).withColumn("words", words)
                   .withColumn("row", F.monotonically_increasing_id()).withColumn("slice", F.spark_partition_id()), "items")
    before = F.sum("words").over(Window.partitionBy("slice").orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    of = (F.coalesce(before, F.lit(0)) / PART_WORDS).cast("long")
    rows = scratch(rows.withColumn("part", F.format_string("%08d-%012d", "slice", of)), "item-parts")
    taken: list[list[str]] = [[]]
    held = 0
    for part, size in sorted((r.part, r.words) for r in rows.groupBy("part").agg(F.sum("words").alias("words")).collect()):
        if taken[-1] and held + size > PART_WORDS:
            taken.append([])
            held = 0
        taken[-1].append(part)
        held += size
    return rows, taken


MATCH = "doc_id long, item_id long, start_word long, n_words long, shared long, total long, distance long"


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", size: int = SIZE,
                 percent: int = PERCENT, radius: int = RADIUS, short_items: bool = True) -> DataFrame:
    """One row per document and item that match: ``doc_id``, ``item_id``, ``start_word``, ``n_words``,
    ``similarity``, ``distance`` (Hamming)."""
    spark, base = docs.sparkSession, id_text(docs, id_col, text_col)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/matches-{uuid.uuid4().hex}"
    spark.createDataFrame([], MATCH).write.parquet(path)
    rows, parts = _parts(benchmark, item_id_col, item_text_col)
    for part in parts:
        held = rows.where(F.col("part").isin(part)).select("doc_id", "text").collect()     # PART_WORDS bounds it
        items = Items([r.doc_id for r in held], [r.text for r in held], size, percent, radius, short_items)
        if items.ids or items.short:
            base.mapInArrow(_matches(items), MATCH).write.mode("append").parquet(path)
    return spark.read.schema(MATCH).parquet(path).select(
        "doc_id", "item_id", "start_word", "n_words", (F.col("shared") / F.col("total")).alias("similarity"), "distance")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` (all columns) that match no benchmark item, short items included."""
    return without(docs, contaminated(docs, benchmark, id_col, short_items=True).where("doc_id IS NOT NULL"), id_col)
