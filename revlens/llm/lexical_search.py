"""Ranked lexical search: every item's highest-scoring documents, by branch and bound over a document FP-tree.

Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased.  A document of n terms has
m = 75 + (25 * n * N) div L, a term the weight w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))); the score sums
w * ((10^9 * tf) div (1000 * tf + 12 * m)) over the item's terms, repeats included, in 64-bit integers.

*Tree.* Per document only terms of items are kept, most frequent in the corpus first (a restricted vector).  A
task sorts about ``TREE_DOCS`` vectors, so documents that share a path of the FP-tree are neighbours: a node is a
range of them.  Ranges of at most ``LEAF_DOCS``, or at ``DEPTH``, are leaves, which hold their postings by term.
Every node has the largest tf of each term below it and the smallest m.

*Search.* Per item, depth first: a node's bound is the score of a document with the subtree's largest tf of every
item term and its smallest m.  Children are visited best bound first, a subtree whose bound is below the item's 20th
best score so far is cut, and leaves are scored exactly from their postings.  The best of a task's trees are carried
from tree to tree, so the cut rises; a window over the tasks' winners (20 an item) gives the ranking.

Defined cases: null and empty texts have no terms; they and documents without an item's terms are never ranked, but all
rows count in the statistics as they come (N: those with a term).  Equal scores rank by ascending id, rows without
an id last; a repeated row is ranked as often as it comes.  Items that repeat in id and text are one; different
texts under one id are ranked apart; items without a known term have no rows.  Empty tables give an empty result.

Plan: no document is shuffled.  Items are taken in blocks of at most ``BLOCK_TERMS`` term occurrences (an item is not
cut): a block's vocabulary (bounded) goes to the tasks, one pass writes the restricted vectors, one reads them
for the frequencies, one searches.  All winners go to one written table, so the plan does not grow with the benchmark.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.common import id_text, scratch
from revlens.llm.textkit import BYTE_VALUE, LOWER, buffers, list_array, mix, powers, runs
from revlens.session import ensure_checkpoint_dir

#: Runs of other characters than these are terms.
NO_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM = np.ones(256, bool)
TERM[:128] = [chr(c).isalnum() for c in range(128)]

TOP = 20
TREE_DOCS, LEAF_DOCS, DEPTH = 8192, 64, 12
#: Postings a tree may hold, unless a single document has more.
TREE_POSTINGS = 2_000_000
#: Term occurrences of the items searched at a time.
BLOCK_TERMS = 200_000
NO_ID = (1 << 63) - 1

VECTOR = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
FOUND = "item bigint, doc_id bigint, score bigint"


# ---------------------------------------------------------------------------
# Terms of documents that items have
# ---------------------------------------------------------------------------
class Vocabulary:
    """Terms in a fixed order, found again in bytes by hash and compared byte by byte."""

    def __init__(self, terms: list[str]):
        coded = [t.encode() for t in terms]
        self.size = np.array([len(c) for c in coded], np.int64)
        self.data = np.frombuffer(b"".join(coded), np.uint8)
        self.at = np.concatenate([[0], np.cumsum(self.size)])[:-1].astype(np.int64)
        hashes = _hashes(self.data, self.at, self.at + self.size)
        # terms of one hash (none is likely) would be tried one after the other
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        equal = np.diff(np.flatnonzero(np.concatenate([[True], self.hashes[1:] != self.hashes[:-1], [True]]))) if len(coded) else [0]
        self.tries = int(max(equal, default=0))

    def find(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each word's term, or -1."""
        found = np.full(len(start), -1, np.int64)
        if not len(self.hashes) or not len(start):
            return found
        hashes = _hashes(low, start, end)
        slot = np.searchsorted(self.hashes, hashes)
        for _ in range(self.tries):
            inside = np.flatnonzero((slot < len(self.hashes)) & (found < 0))
            inside = inside[self.hashes[slot[inside]] == hashes[inside]]
            term = self.order[slot[inside]]
            same = self.size[term] == (end - start)[inside]
            inside, term = inside[same], term[same]
            size = self.size[term]
            first = np.concatenate([[0], np.cumsum(size)])
            step = np.arange(first[-1]) - np.repeat(first[:-1], size)
            differs = low[np.repeat(start[inside], size) + step] != self.data[np.repeat(self.at[term], size) + step]
            wrong = np.add.reduceat(np.append(differs, False).astype(np.int64), first[:-1]) if len(term) else np.empty(0, np.int64)
            found[inside[wrong == 0]] = term[wrong == 0]
            slot = slot + 1
        return found


def _hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = powers(len(low) + 1)
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[low] * up[:len(low)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def restricted_vectors(data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple:
    """Of a run of texts: terms a document (n), and flat (term, tf) with row starts, by term within a row."""
    low, docs = LOWER[data], len(offsets) - 1
    inside = TERM[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    if len(low):
        begins[1:] &= edge[1:-1] | ~inside[:-1]
        ends[:-1] &= edge[1:-1] | ~inside[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    term = vocabulary.find(low, start, end)
    doc = np.repeat(np.arange(docs), np.diff(first))
    known = term >= 0
    width = max(len(vocabulary.size), 1)
    keys, tf = np.unique(doc[known] * width + term[known], return_counts=True)
    return np.diff(first), keys % width, tf, np.searchsorted(keys // width, np.arange(docs + 1))


def _vector_batches(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        for row, end, part, off in runs(data, offsets):
            n, term, tf, first = restricted_vectors(part, off, vocabulary)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(row, end - row), pa.array(n.astype(np.int64)),
                list_array(term.astype(np.int32), first, pa.int32()), list_array(tf.astype(np.int32), first, pa.int32())],
                names=["doc_id", "n", "terms", "tfs"])


# ---------------------------------------------------------------------------
# The tree and its search (numpy, inside a task)
# ---------------------------------------------------------------------------
def gain(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Score of terms of weight w (times repeats); grows with tf, falls with m."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def _fold(key: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, starts of equal keys, largest tf of each)."""
    order = np.argsort(key, kind="stable")
    sorted_ = key[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(key) else np.empty(0, np.int64)
    return order, starts, np.maximum.reduceat(tf[order], starts) if len(key) else np.empty(0, np.int64)


class Tree:
    """FP-tree of restricted vectors.  ``first``: row starts of flat ``rank`` (most frequent term 0, ascending within
    a row) and ``tf``; every row has a term."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, first: np.ndarray, rank: np.ndarray, tf: np.ndarray, width: int,
                 leaf_docs: int = LEAF_DOCS, depth: int = DEPTH):
        self.width, docs = width, len(ids)
        counts = np.diff(first)
        path = np.full((docs, depth), -1, np.int64)
        for d in range(depth):
            has = counts > d
            path[has, d] = rank[first[:-1][has] + d]
        order = np.lexsort(path.T[::-1])
        self.ids, self.m, path = ids[order], m[order], path[order]
        place = np.empty(docs, np.int64)
        place[order] = np.arange(docs)
        # level by level: nodes are ranges with an equal path; small ones and the deepest are leaves
        low, high, parent, level = [0], [docs], [-1], [0]
        self.is_leaf, open_ = [], [0]
        for d in range(depth + 1):
            opened = []
            for node in open_:
                if high[node] - low[node] <= leaf_docs or d == depth:
                    continue
                column = path[low[node]:high[node], d]
                cuts = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1], [True]])) + low[node]
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    opened.append(len(low))
                    low.append(a), high.append(b), parent.append(node), level.append(d + 1)
            open_ = opened
        self.low, self.high = np.array(low), np.array(high)
        self.parent, level = np.array(parent), np.array(level)
        nodes = len(low)
        self.children = np.searchsorted(self.parent[1:], np.arange(nodes + 1)) + 1   # parents come in order
        self.is_leaf = self.children[1:] == self.children[:-1]
        leaves = np.flatnonzero(self.is_leaf)
        leaves = leaves[np.argsort(self.low[leaves])]
        leaf_of = np.repeat(leaves, (self.high - self.low)[leaves])
        at = np.repeat(place, counts)
        # postings by (leaf, term), then the largest tf up the tree, a level at a time
        key = leaf_of[at] * width + rank if docs else np.empty(0, np.int64)
        sort, starts, top = _fold(key, tf)
        self.at, self.tf = at[sort], tf[sort]
        keys, tops = [key[sort][starts]], [top]
        self.post_key, self.post_at = keys[0], np.append(starts, len(key))
        pending_key, pending_top = keys[0], top
        for d in range(depth, 0, -1):
            node = pending_key // width
            deep = level[node] == d
            up = self.parent[node[deep]] * width + pending_key[deep] % width
            sort, starts, best = _fold(up, pending_top[deep])
            made = up[sort][starts]
            keys.append(made), tops.append(best)
            pending_key = np.concatenate([pending_key[~deep], made])
            pending_top = np.concatenate([pending_top[~deep], best])
        key, top = np.concatenate(keys), np.concatenate(tops)
        order = np.argsort(key, kind="stable")
        self.key, self.top = key[order], top[order]
        lowest = np.minimum.reduceat(self.m, self.low[leaves]) if docs else np.empty(0, np.int64)
        self.least = np.full(nodes, np.iinfo(np.int64).max, np.int64)
        self.least[leaves] = lowest
        for node in range(nodes - 1, 0, -1):
            p = self.parent[node]
            self.least[p] = min(self.least[p], self.least[node])

    def bounds(self, nodes: np.ndarray, rank: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Largest score a document below each node can have."""
        want = nodes[:, None] * self.width + rank
        slot = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        tf = np.where(self.key[slot] == want, self.top[slot], 0)
        return gain(w, tf, self.least[nodes][:, None]).sum(axis=1)

    def leaf_scores(self, leaf: int, rank: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Exact scores of a leaf's documents."""
        want = leaf * self.width + rank
        slot = np.minimum(np.searchsorted(self.post_key, want), len(self.post_key) - 1)
        hit = self.post_key[slot] == want
        a, b = self.post_at[slot[hit]], self.post_at[slot[hit] + 1]
        size = b - a
        before = np.cumsum(size) - size
        flat = np.arange(size.sum()) + np.repeat(a - before, size)
        low = self.low[leaf]
        score = np.zeros(self.high[leaf] - low, np.int64)
        at = self.at[flat]
        np.add.at(score, at - low, gain(np.repeat(w[hit], size), self.tf[flat], self.m[at]))
        return score

    def search(self, rank: np.ndarray, w: np.ndarray, best: "Best") -> None:
        """Add this tree's documents to the item's best."""
        if not len(self.ids) or not len(rank):
            return
        stack = [(int(self.bounds(np.array([0]), rank, w)[0]), 0)]
        while stack:
            bound, node = stack.pop()
            if bound <= 0 or bound < best.least:
                continue
            if self.is_leaf[node]:
                score = self.leaf_scores(node, rank, w)
                ok = np.flatnonzero((score > 0) & (score >= best.least))
                if len(ok):
                    best.add(score[ok], self.ids[self.low[node] + ok])
                continue
            below = np.arange(self.children[node], self.children[node + 1])
            bounds = self.bounds(below, rank, w)
            below, bounds = below[bounds >= max(best.least, 1)], bounds[bounds >= max(best.least, 1)]
            order = np.argsort(bounds, kind="stable")          # the best is popped first
            stack.extend(zip(bounds[order].tolist(), below[order].tolist()))


class Best:
    """The highest scores of an item so far, equal ones by smaller id."""

    def __init__(self, top: int):
        self.top, self.score, self.ids, self.least = top, np.empty(0, np.int64), np.empty(0, np.int64), 0

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score))[:self.top]
        self.score, self.ids = score[order], ids[order]
        if len(order) == self.top:
            self.least = int(self.score[-1])


def _trees(batches: Iterator[pa.RecordBatch], to_rank: np.ndarray, docs: int, total: int, longest: int) -> Iterator[Tree]:
    """Trees over the vectors of a task; vectors without a term are left out."""
    parts: list[tuple] = []
    rows = postings = 0

    def built() -> Tree:
        ids, m, counts, rank, tf = (np.concatenate(p) for p in zip(*parts))
        row = np.repeat(np.arange(len(ids)), counts)
        order = np.lexsort((rank, row))
        return Tree(ids, m, np.concatenate([[0], np.cumsum(counts)]), rank[order], tf[order], len(to_rank))

    for batch in batches:
        lists = batch.column("terms")
        off = lists.offsets.to_numpy().astype(np.int64)
        term = lists.values.to_numpy(zero_copy_only=False)
        tf = batch.column("tfs").values.to_numpy(zero_copy_only=False)
        ids = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
        n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
        row = 0
        while row < len(ids):
            room = max(longest - postings, 0)
            end = min(row + max(TREE_DOCS - rows, 1), max(int(np.searchsorted(off, off[row] + room, "right")) - 1, row + 1), len(ids))
            a, b = off[row], off[end]
            counts = np.diff(off[row:end + 1])
            has = counts > 0
            if has.any():
                m = 75 + (25 * n[row:end][has] * docs) // total
                parts.append((ids[row:end][has], m, counts[has], to_rank[term[a:b]], tf[a:b].astype(np.int64)))
            rows, postings, row = rows + int(has.sum()), postings + int(b - a), end
            if rows >= TREE_DOCS or postings >= longest:
                yield built()
                parts, rows, postings = [], 0, 0
    if parts:
        yield built()


def _search_batches(batches: Iterator[pa.RecordBatch], items: list, to_rank: np.ndarray, docs: int, total: int,
                    top: int) -> Iterator[pa.RecordBatch]:
    best = [Best(top) for _ in items]
    for tree in _trees(batches, to_rank, docs, total, TREE_POSTINGS):
        for (_, rank, w), b in zip(items, best):
            tree.search(rank, w, b)
    numbers = [np.full(len(b.ids), number, np.int64) for (number, _, _), b in zip(items, best)]
    if numbers:
        ids = np.concatenate([b.ids for b in best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(numbers)), pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate([b.score for b in best]))],
            names=["item", "doc_id", "score"])


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct items, numbered: ``item``, ``item_id``, ``terms`` (repeats included), ``block``.  Numbers and blocks come
    from running counts over the items' own partitions, so no task orders them all."""
    text = F.translate(F.coalesce(items[text_col].cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = items.select(items[id_col].alias("item_id"), text.alias("text")).distinct()
    rows = scratch(rows.select("item_id", F.filter(F.split("text", NO_TERM), lambda t: t != "").alias("terms"))
                   .where("size(terms) > 0").withColumn("item", F.monotonically_increasing_id())
                   .withColumn("part", F.spark_partition_id()), "items")
    before = F.sum(F.size("terms").cast("long")).over(Window.partitionBy("part").orderBy("item").rowsBetween(
        Window.unboundedPreceding, -1))
    of = (F.coalesce(before, F.lit(0)) / BLOCK_TERMS).cast("long")
    return scratch(rows.withColumn("block", F.format_string("%08d-%012d", "part", of)), "item-blocks")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per item its ``top`` highest-scoring documents: ``item_id``, ``rank``, ``doc_id``, ``score``."""
    spark = docs.sparkSession
    base, numbered = id_text(docs, id_col, text_col), item_terms(items, item_col, item_text)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/found-{uuid.uuid4().hex}"
    spark.createDataFrame([], FOUND).write.parquet(path)
    sizes = numbered.groupBy("block").agg(F.sum(F.size("terms")).alias("terms")).collect()     # one row a block
    for blocks in _packed([(r.block, r.terms) for r in sizes]):
        rows = numbered.where(F.col("block").isin(blocks)).select("item", "terms").collect()     # BLOCK_TERMS bounds it
        block = _search_block(spark, base, [(r.item, r.terms) for r in rows], top)
        if block is not None:
            block.write.mode("append").parquet(path)
    found = spark.read.schema(FOUND).parquet(path)
    by_score = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _packed(sizes: list[tuple[str, int]]) -> Iterator[list[str]]:
    """Small blocks together, up to ``BLOCK_TERMS`` occurrences."""
    taken, terms = [], 0
    for block, size in sorted(sizes):
        if taken and terms + size > BLOCK_TERMS:
            yield taken
            taken, terms = [], 0
        taken, terms = [*taken, block], terms + size
    if taken:
        yield taken


def _search_block(spark: SparkSession, base: DataFrame, items: list[tuple[int, list[str]]], top: int) -> DataFrame | None:
    """The best documents of each task for some items; None without a document."""
    vocabulary = sorted({t for _, terms in items for t in terms})
    sent = spark.sparkContext.broadcast(Vocabulary(vocabulary))
    vectors = scratch(base.mapInArrow(lambda batches: _vector_batches(batches, sent.value), VECTOR), "vectors")
    stats = vectors.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("total")).first()
    docs, total = stats.docs, stats.total or 0
    if not docs:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        df[r.t] = r.df
    to_rank = np.empty(len(vocabulary), np.int64)
    to_rank[np.argsort(-df, kind="stable")] = np.arange(len(vocabulary))
    weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    number = {t: i for i, t in enumerate(vocabulary)}
    asked = []
    for item, terms in items:
        times = Counter(number[t] for t in terms)
        known = np.array([t for t in times if df[t]], np.int64)
        asked.append((item, to_rank[known], weight[known] * np.array([times[t] for t in known.tolist()], np.int64)))
    send = spark.sparkContext.broadcast((asked, to_rank))
    return vectors.where("size(terms) > 0").mapInArrow(
        lambda batches: _search_batches(batches, *send.value, docs, total, top), FOUND)
