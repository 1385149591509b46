"""Set-similarity self-join of documents on word n-grams with a prefix tree.

A document's set holds its distinct ``size``-word shingles (A-Z lower-cased, words are runs of other than
ASCII white space); with fewer words the whole sequence is the one member; without words or text the set
is empty and linked with nothing.  Two documents link when ``100 * |A and B| >= percent * |A or B|``.
Shingles are 64-bit hashes, sets are compared by 128-bit digests.  Rows without an id are left out; a
repeated id with different texts is linked through either; an empty table gives an empty result.

Plan (every step covers all documents):

1. One pass hashes the sets; equal sets fold to the smallest id (partial aggregation folds hot copies).
2. The global order of n-grams is (count among frequent ones, hash): frequent ones come last.  The
   frequent ones are counted over the corpus by chunk, and up to ``FREQUENT`` of the most common are given to
   the tasks.  That bound only affects speed: any one order gives the same links.
3. Sets that link share an n-gram among the first ``n - ceil(percent*n/100) + 1`` of either (the first
   levels of the tree); with a prefix longer by ``EXTRA`` per cent of n they share as many more.  Only
   prefixes are shuffled, and documents that share too few of theirs with any other are left out, such
   as those that only have a passage in common.
4. Per shared n-gram the document that shares most of its own prefix leads, and every other one is a
   candidate of the leader: linear in the n-grams.  After these are verified, the n-grams between
   documents still in different components are counted by pair, in blocks of documents of one leader;
   pairs that share enough of their prefixes to be able to link are verified too.  No link between
   components is lost, and pairs inside one are not expanded.
5. Verification is the prefix tree: the ordered sets of up to ``BLOCK`` candidates of one leader are
   a tree (sorted lists, shared beginnings walked once), the leader's set is matched along it, and a
   subtree is left as soon as the overlap so far plus what can still follow is too small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import textkit
from revlens.llm.common import broadcast_if_small, connected_components, id_text, most_frequent, scratch, without

SIZE, PERCENT = 5, 80
#: Per cent of the n-grams by which prefixes are longer than the least needed.
EXTRA = 5
#: n-grams whose corpus counts are given to every task: 16 bytes each, so 1 MB.
FREQUENT = 65_536
#: n-grams counted together before a chunk's counts are sent on, and the least count that is sent.
CHUNK, CHUNK_LEAST = 2_000_000, 2
#: Candidates of one leader that are verified together.
BLOCK = 256
#: Documents of a block whose pairs are counted with those of another.
MEMBERS = 1000


def prefix_size(n: int, percent: int) -> int:
    """Length of the prefix of an ordered set of ``n``: sets that link share ``1 + n * EXTRA // 100`` in theirs."""
    return n - -(-percent * n // 100) + 1 + n * EXTRA // 100


def ordered(values: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Distinct values in the global order: those that aren't frequent by hash, then the rest by count."""
    values = np.unique(values)
    keys, rank = frequent
    if not len(keys):
        return values
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    hot = keys[at] == values
    if not hot.any():
        return values
    return np.concatenate([values[~hot], values[hot][np.argsort(rank[at[hot]], kind="stable")]])


def _summaries(size: int):
    """Per document: id, set size, set digest; per chunk: n-grams that occur in several documents."""
    import hashlib

    def rows(ids, ns, sigs, tokens, counts):
        k = len(ids), len(tokens)
        return pa.RecordBatch.from_arrays([
            pa.array([*ids, *[None] * k[1]], pa.int64()),
            pa.array([*ns, *[None] * k[1]], pa.int64()), pa.array([*sigs, *[None] * k[1]], pa.binary()),
            pa.concat_arrays([pa.nulls(k[0], pa.int64()), pa.array(tokens, pa.int64())]),
            pa.concat_arrays([pa.nulls(k[0], pa.int64()), pa.array(counts, pa.int64())]),
        ], names=["doc_id", "n", "sig", "token", "seen"])

    def repeated(chunk):
        values, counts = np.unique(np.concatenate(chunk), return_counts=True)
        often = counts >= CHUNK_LEAST
        return textkit.signed(values[often]), counts[often]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = [], 0
        for batch in batches:
            data, offsets = textkit.buffers(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for lo, hi, d, o in textkit.runs(data, offsets):
                grams, first = textkit.Words(d, o).shingles(size)
                ns, sigs = [], []
                for i in range(hi - lo):
                    own = np.unique(grams[first[i]:first[i + 1]])
                    ns.append(len(own))
                    sigs.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    chunk.append(own)
                    held += len(own)
                yield rows(ids[lo:hi], ns, sigs, [], [])
                if held >= CHUNK:
                    yield rows([], [], [], *repeated(chunk))
                    chunk, held = [], 0
        if chunk:
            yield rows([], [], [], *repeated(chunk))

    return run


def _prefixes(size: int, percent: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textkit.buffers(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for lo, hi, d, o in textkit.runs(data, offsets):
                grams, first = textkit.Words(d, o).shingles(size)
                out_ids, ns, lists = [], [], []
                for i in range(hi - lo):
                    own = ordered(grams[first[i]:first[i + 1]], frequent)
                    n = len(own)
                    if n == 0 or ids[lo + i] is None:
                        continue
                    out_ids.append(ids[lo + i])
                    ns.append(n)
                    lists.append(own[:prefix_size(n, percent)])
                if out_ids:
                    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(out_ids, pa.int64()), pa.array(ns, pa.int64()),
                        textkit.list_array(textkit.signed(np.concatenate(lists)), starts, pa.int64())],
                        names=["doc_id", "n", "prefix"])

    return run


def _sets(size: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textkit.buffers(batch.column("text"))
            for lo, hi, d, o in textkit.runs(data, offsets):
                grams, first = textkit.Words(d, o).shingles(size)
                lists = [ordered(grams[first[i]:first[i + 1]], frequent) for i in range(hi - lo)]
                starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
                flat = np.concatenate(lists) if lists else np.empty(0, np.uint64)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo),
                    textkit.list_array(textkit.signed(flat), starts, pa.int64())], names=["doc_id", "grams"])

    return run


class PrefixTree:
    """Ordered sets as a prefix tree: the sets sorted as sequences; neighbours share their beginnings."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.common = [0] * len(sets)   # length of the beginning shared with the set before
        for at in range(1, len(sets)):
            a, b = sets[self.order[at - 1]], sets[self.order[at]]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.common[at] = int(differ[0]) if len(differ) else m

    def linked(self, probe: np.ndarray, percent: int) -> list[int]:
        """Indices of the sets that link with ``probe``."""
        known = np.sort(probe)
        least = -(-percent * len(probe) // 100)   # a linked set shares this many at least
        found: list[int] = []
        overlap = np.zeros(1, np.int64)   # overlap[d]: members of probe among the first d of the path
        stopped: int | None = None        # depth at which the last walk was given up
        for at, which in enumerate(self.order):
            own = self.sets[which]
            overlap = overlap[:self.common[at] + 1]   # what this set shares with the path walked so far
            depth = len(overlap) - 1
            need = self._need(len(own), len(probe), percent, least)
            if stopped is not None and depth >= stopped and overlap[stopped] + len(own) - stopped < need:
                continue                              # same subtree, still too little can follow
            rest = own[depth:]
            near = np.minimum(np.searchsorted(known, rest), len(known) - 1)
            overlap = np.concatenate([overlap, overlap[depth] + np.cumsum(known[near] == rest)])
            short = np.flatnonzero(overlap + np.arange(len(own), -1, -1) < need)
            stopped = int(short[0]) if len(short) else None
            if stopped is None:
                found.append(which)
            else:
                overlap = overlap[:stopped + 1]
        return found

    @staticmethod
    def _need(n: int, m: int, percent: int, least: int) -> int:
        """Smallest overlap of sets of n and m members that links them."""
        return max(least, -(-percent * (n + m) // (100 + percent)))


def _verify(percent: int):
    """Batches sorted by (a, block, probe first) -> links (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, probe, ids, sets = None, None, [], []

        def flush():
            if probe is None or not ids:
                return None
            hit = PrefixTree(sets).linked(probe, percent)
            if not hit:
                return None
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(hit), pa.int64()),
                                               pa.array([ids[i] for i in hit], pa.int64())], names=["a", "b"])

        for batch in batches:
            a, block, is_probe, b = (batch.column(c).to_pylist() for c in ("a", "block", "member", "b"))
            grams = batch.column("grams")
            off = grams.offsets.to_numpy()
            flat = grams.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(batch.num_rows):
                if (a[i], block[i]) != key:
                    out = flush()
                    if out is not None:
                        yield out
                    key, probe, ids, sets = (a[i], block[i]), None, [], []
                own = flat[off[i]:off[i + 1]].copy()
                if is_probe[i] == 0:
                    probe = own
                else:
                    ids.append(b[i])
                    sets.append(own)
        out = flush()
        if out is not None:
            yield out

    return run


def _pairs(percent: int):
    """Rows sorted by (lead, low, high, token) -> pairs of different components with their shared n-grams, if
    these and what they may share elsewhere can be enough."""

    def group(c: dict[str, np.ndarray]) -> np.ndarray | None:
        docs, first, at = np.unique(c["doc_id"], return_index=True, return_inverse=True)
        if len(docs) < 2:
            return None
        common = np.zeros((len(docs), len(docs)), np.int32)
        edges = np.flatnonzero(np.diff(c["token"], prepend=c["token"][0] - 1))
        for lo, hi in zip(edges, np.append(edges[1:], len(at)), strict=True):
            common[np.ix_(at[lo:hi], at[lo:hi])] += 1
        n, part, block, rows = (c[k][first] for k in ("n", "part", "block", "rows"))
        elsewhere = rows - np.bincount(at)     # a document's n-grams with other leaders
        rest = -(-percent * n // 100) - 1 - n * EXTRA // 100
        i, j = np.nonzero(np.triu(common, 1))
        fits = (part[i] != part[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        # even if all of these were shared too, a pair below this can't link
        least = -(-percent * (n[i] + n[j]) // (100 + percent)) - np.maximum(rest[i], rest[j])
        fits &= common[i, j] + np.minimum(elsewhere[i], elsewhere[j]) >= least
        if c["low"][0] != c["high"][0]:
            fits &= block[i] != block[j]
        i, j = i[fits], j[fits]
        return np.stack([docs[i], docs[j], common[i, j].astype(np.int64), n[i], n[j]]) if len(i) else None

    def flush(rows: pa.Table) -> pa.RecordBatch | None:
        columns = {k: rows.column(k).to_numpy() for k in rows.column_names}
        keys = np.stack([columns[k].astype(np.int64) for k in ("lead", "low", "high")])
        edges = np.flatnonzero(np.any(np.diff(keys, axis=1, prepend=keys[:, :1] - 1) != 0, axis=0))
        found = [group({k: v[lo:hi] for k, v in columns.items()})
                 for lo, hi in zip(edges, np.append(edges[1:], rows.num_rows), strict=True)]
        found = [f for f in found if f is not None]
        if not found:
            return None
        return pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(found, axis=1)],
                                          names=["a", "b", "common", "na", "nb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 100_000:                  # the last group may go on in the next batch
                rows = pa.Table.from_batches(held)
                keys = [rows.column(k).to_numpy() for k in ("lead", "low", "high")]
                cut = int(np.flatnonzero(np.all([k == k[-1] for k in keys], axis=0))[0])
                out = flush(rows.slice(0, cut)) if cut else None
                held = rows.slice(cut).to_batches()
                size = rows.num_rows - cut
                if out is not None:
                    yield out
        out = flush(pa.Table.from_batches(held)) if size else None
        if out is not None:
            yield out

    return run


class NgramJoin:
    """One run of the join over ``docs``; ``links`` and ``documents`` are its results."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SIZE, percent: int = PERCENT, block: int = BLOCK, members: int = MEMBERS):
        self.base = id_text(docs, id_col, text_col)
        self.size, self.percent, self.block, self.members = size, percent, block, members
        summaries = scratch(self.base.mapInArrow(
            _summaries(size), "doc_id long, n long, sig binary, token long, seen long"), "ngram-sets")
        self.sets = summaries.where("sig IS NOT NULL").select("doc_id", "n", "sig")
        seen = scratch(summaries.where("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen")), "ngram-seen")
        common = most_frequent(seen, "seen", FREQUENT).collect()
        common.sort(key=lambda r: (-r.seen, r.token))
        keys = np.array([r.token for r in common], np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.frequent = keys[order], (len(keys) - np.arange(len(keys)))[order]
        self.reps = self.sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("sig").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"))

    def _shared(self) -> DataFrame:
        """(token, doc_id, n, mine): prefix n-grams that at least two documents share; mine: how many
        such the document has."""
        prefixes = self.base.mapInArrow(_prefixes(self.size, self.percent, self.frequent),
                                        "doc_id long, n long, prefix array<long>")
        # of equal sets only the representative's prefix goes on
        prefixes = prefixes.join(self.reps.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
        posted = prefixes.select("doc_id", "n", F.explode_outer("prefix").alias("token"))
        count = F.count("*")
        shared = posted.withColumn("df", count.over(_by("token"))).where("df > 1").drop("df")
        shared = shared.withColumn("mine", count.over(_by("doc_id"))).where(
            F.col("mine") > F.floor(F.col("n") * EXTRA / 100))
        return scratch(shared.withColumn("df", count.over(_by("token"))).where("df > 1").drop("df"), "ngram-shared")

    def _can_link(self, n1: str, n2: str, common):
        """Sizes fit, and the n-grams shared within the prefixes leave enough room: beyond them at most
        the longer rest can be shared."""
        p = self.percent
        kept = [F.ceil(F.col(n) * p / 100) - 1 - F.floor(F.col(n) * EXTRA / 100) for n in (n1, n2)]
        need = F.ceil((F.col(n1) + F.col(n2)) * p / (100 + p))
        return ((F.least(n1, n2) * 100 >= F.greatest(n1, n2) * p)
                & (common >= need - F.greatest(*kept)))

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs (a, b) those that link."""
        ids = broadcast_if_small(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
        # one row an id: a repeated id has one representative text here
        sets = scratch(self.base.join(ids, "doc_id", "left_semi").mapInArrow(
            _sets(self.size, self.frequent), "doc_id long, grams array<long>"), "ngram-members")
        blocks = pairs.groupBy("a").agg(F.ceil(F.count("*") / self.block).alias("blocks"))
        placed = pairs.join(blocks, "a").select("a", "b", F.pmod(F.xxhash64("b"), "blocks").alias("block"))
        members = placed.join(sets.withColumnRenamed("doc_id", "b"), "b").select(
            "a", "block", F.lit(1).alias("member"), "b", "grams")
        probes = placed.select("a", "block").distinct().join(
            sets.withColumnRenamed("doc_id", "a"), "a").select(
            "a", "block", F.lit(0).alias("member"), F.col("a").alias("b"), "grams")
        return (members.union(probes).repartition("a", "block").sortWithinPartitions("a", "block", "member")
                .mapInArrow(_verify(self.percent), "a long, b long"))

    def links(self) -> DataFrame:
        """Verified links (a, b) between different sets: enough to connect every component."""
        shared = self._shared()
        lead = F.max(F.struct((F.col("mine") / F.col("n")).alias("share"), F.col("doc_id").alias("a"),
                              F.col("n").alias("na"), F.col("mine").alias("ma"))).over(_by("token"))
        led = (shared.withColumn("lead", lead).select("doc_id", "n", "mine", "lead.a", "lead.na", "lead.ma")
               .where("doc_id <> a").distinct())
        first = led.where(self._can_link("n", "na", F.least("mine", "ma"))).select("a", F.col("doc_id").alias("b"))
        found = scratch(self._verified(scratch(first, "ngram-pairs")), "ngram-links")
        label = connected_components(found)
        rest = shared.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
            "token", "doc_id", "n", "mine", F.coalesce("component", "doc_id").alias("part"))
        # an n-gram between documents that all are in one component already is done with
        top = F.max(F.struct((F.col("mine") / F.col("n")).alias("share"), F.col("doc_id").alias("lead"))).over(_by("token"))
        rest = rest.withColumns({"lo": F.min("part").over(_by("token")), "hi": F.max("part").over(_by("token")), "top": top})
        rest = rest.where("lo < hi").select("token", "doc_id", "n", "part", "top.lead",
                                            F.count("*").over(_by("doc_id")).alias("rows"))
        rest = scratch(rest, "ngram-rest")
        pairs = self._crossing(rest).groupBy("a", "b").agg(
            F.sum("common").alias("common"), F.first("na").alias("na"), F.first("nb").alias("nb"))
        left = scratch(pairs.where(self._can_link("na", "nb", F.col("common"))).select("a", "b"), "ngram-pairs")
        if left.limit(1).count():
            found = found.union(scratch(self._verified(left), "ngram-links"))
        return found

    def _crossing(self, rest: DataFrame) -> DataFrame:
        """(a, b, common, na, nb): how many n-grams of one leader two documents of different components share,
        without pairs that can't link whatever they share with other leaders.

        The n-grams of a leader are counted together, so a pair comes out once a leader and not once an
        n-gram; documents of a leader are handled in blocks of about ``self.members``, each with each."""
        docs = rest.select("lead", "doc_id").distinct().groupBy("lead").agg(
            F.ceil(F.count("*") / self.members).cast("int").alias("blocks"))
        placed = rest.join(docs, "lead").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        placed = placed.select("lead", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                               "token", "doc_id", "n", "part", "block", "rows")
        return (placed.repartition("lead", "low", "high").sortWithinPartitions("lead", "low", "high", "token")
                .mapInArrow(_pairs(self.percent), "a long, b long, common long, na long, nb long"))

    def documents(self) -> DataFrame:
        """Per row: ``doc_id``, ``n_shingles``, ``component_id``."""
        label = connected_components(self.links())
        whole = (self.reps.join(label.withColumnRenamed("node", "rep"), "rep", "left")
                 .select("sig", "n", F.coalesce("component", "rep").alias("component")))
        # the size is part of the key, so both sides are exchanged for the join and a hot set can be split
        rows = self.sets.join(whole, ["sig", "n"], "left")
        return rows.select("doc_id", F.col("n").alias("n_shingles"),
                           F.coalesce("component", "doc_id").alias("component_id"))


def _by(column: str):
    from pyspark.sql import Window

    return Window.partitionBy(column)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = SIZE, percent: int = PERCENT, block: int = BLOCK, members: int = MEMBERS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links)."""
    return NgramJoin(docs, id_col, text_col, size, percent, block, members).documents()


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that are the smallest id of their component."""
    found = near_duplicates(docs, id_col, text_col)
    return without(docs, found.where("doc_id <> component_id"), id_col)
