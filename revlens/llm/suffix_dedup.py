"""Suffix-array deduplication: every byte covered by a repeated ``length``-byte string is removed.

Texts are UTF-8 bytes (null: empty); matches never cross documents, may lie in the same document and may
overlap; strings are judged on the input.  Texts shorter than ``length`` lose nothing.  Ids are unique but
for rows that repeat as a whole, which are copies of each other; rows without an id only count as copies
of equal texts.  An empty table gives an empty result.

The suffixes of the whole corpus are never sorted again.  The work is split so that no task holds more
than a bucket:

1. *Sampling.* Of every ``length``-byte string the ``anchor``-byte substring with the least hash is sampled
   (winnowing), so equal strings have equal samples at the same place.  Samples that occur once can't
   lie in a repeated string.  One text of equal texts goes on (its copies are removed whole).
2. *Shards.* Samples that occur again are sent, with the bytes around them, to the bucket of their hash.
   What comes from one map task is a shard of the sparse Burrows-Wheeler transform of that bucket: for
   every sampled suffix the bytes that follow and the bytes that precede it.
3. *Merge by interleave refinement.* Shards of a bucket are interleaved by the sample, then refined byte
   by byte: rows that agree so far form a block, a step splits each block by the next byte, and the step
   at which two neighbours part is their common prefix.  This is done to the right and, over the
   preceding bytes, to the left.  Rows alone in their block are finished and leave the refinement.
4. *Repeated intervals.* A string that starts l bytes before the sample is repeated when another row is
   in the same block after l steps to the left and after ``length`` - anchor - l steps to the right.

Buckets are bounded: equal surroundings fold to one row with a count before they are shuffled, and a sample
with more than ``hot`` different surroundings is not gathered in a task; the strings around it are exploded
and counted with partial aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import textkit
from revlens.llm.common import id_text, scratch
from revlens.session import discard

LENGTH, ANCHOR = 200, 80
#: Different surroundings of one sample that a task may gather.
HOT = 20_000
#: Rows that a task refines together.
REFINE = 10_000

_U = np.uint64


def _slide(values: np.ndarray, width: int, best) -> np.ndarray:
    """best (minimum or maximum ufunc) of every ``width`` neighbours, by block prefixes and suffixes."""
    n = len(values)
    worst = np.iinfo(values.dtype).max if best is np.minimum else np.iinfo(values.dtype).min
    padded = np.full(-(-n // width) * width, worst, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).reshape(-1)
    back = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(back[:n - width + 1], ahead[width - 1:n])


def sampled(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the sampled ``anchor``-byte strings of a run of documents.

    A position is sampled when its hash is the least among those of some ``length``-byte string; every
    position that ties is, so the choice depends on the string alone."""
    n, span = len(data), length - anchor + 1
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    up, down = textkit.powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(textkit.BYTE_VALUE[data] * up[:n], out=sums[1:])
    hashes = textkit.mix((sums[anchor:] - sums[:-anchor]) * down[:n - anchor + 1])
    least = _slide(hashes, span, np.minimum)                 # by start of the length-byte string
    inside = np.zeros(n + 1, np.int64)                       # starts whose string lies in one document
    sizes = np.diff(offsets)
    long_ = sizes >= length
    np.add.at(inside, offsets[:-1][long_], 1)
    np.add.at(inside, offsets[:-1][long_] + sizes[long_] - length + 1, -1)
    valid = np.cumsum(inside)[:len(least)] > 0
    least = np.where(valid, least, 0)
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    reach = _slide(padded, span, np.maximum)                 # by position of the anchor
    at = np.flatnonzero((reach[:len(hashes)] == hashes) & (hashes != 0))
    return at, hashes[at]


def _samples(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textkit.buffers(batch.column("text"))
            for lo, hi, d, o in textkit.runs(data, offsets):
                at, hashes = sampled(d, o, length, anchor)
                first = np.searchsorted(at, o)
                local = at - np.repeat(o[:-1], np.diff(first)) if len(at) else at
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo),
                    textkit.list_array(textkit.signed(hashes), first, pa.int64()),
                    textkit.list_array(local.astype(np.int32), first, pa.int32())],
                    names=["doc_id", "hashes", "places"])

    return run


def _cut(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, step: int) -> pa.Array:
    """Binary rows data[start], data[start + step], ... of the given sizes."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(starts - step * ends[:-1], sizes) + step * np.arange(ends[-1])
    return pa.Array.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data[at].tobytes())])


def _surroundings(length: int, anchor: int):
    """Bytes around each sample that occurs again: to the right from its start, to the left from there reversed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textkit.buffers(batch.column("text"))
            for i in range(batch.num_rows):     # one document at a time: its samples are bounded by its length
                text = data[offsets[i]:offsets[i + 1]]
                hashes, places = (batch.column(c)[i].values for c in ("hashes", "places"))
                at = np.minimum(places.to_numpy(zero_copy_only=False).astype(np.int64), len(text))
                yield pa.RecordBatch.from_arrays([
                    hashes, pa.array(np.full(len(at), batch.column("doc_id")[i].as_py(), np.int64)), places,
                    _cut(text, at, np.minimum(length, len(text) - at), 1),
                    _cut(text, at - 1, np.minimum(length - anchor, at), -1)],
                    names=["hash", "doc_id", "place", "right", "left"])

    return run


def _matrix(column: pa.Array, skip: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, sizes): bytes from ``skip`` on as rows of 0..255; beyond the end every row has a symbol of its
    own, which equals nothing."""
    data, offsets = textkit.buffers(column)
    size = np.clip(np.diff(offsets) - skip, 0, width)
    inside = np.arange(width)[None, :] < size[:, None]
    out = np.broadcast_to((256 + np.arange(len(size), dtype=np.int32))[:, None], inside.shape).copy()
    ends = np.cumsum(size)
    at = np.repeat(offsets[:-1] + skip - np.concatenate([[0], ends])[:-1], size) + np.arange(ends[-1] if len(ends) else 0)
    out[inside] = data[at]
    return out, size


def refine(block: np.ndarray, symbols: np.ndarray) -> Iterator[np.ndarray]:
    """Interleave refinement: the block of every row before the first symbol and after each one.

    A step splits the blocks by the next symbol.  A row that is alone in its block stays so."""
    block = np.unique(block, return_inverse=True)[1].astype(np.int32)
    yield block
    spread = int(symbols.max(initial=0)) + 1
    counts = np.bincount(block, minlength=1)
    live = np.flatnonzero(counts[block] > 1)
    for step in range(symbols.shape[1]):
        if len(live):
            block = block.copy()
            top = int(block.max()) + 1
            _, inverse, size = np.unique(block[live].astype(np.int64) * spread + symbols[live, step],
                                         return_inverse=True, return_counts=True)
            block[live] = top + inverse
            live = live[size[inverse] > 1]
        yield block


def repeated(keys: np.ndarray, rights: pa.Array, lefts: pa.Array, counts: np.ndarray, length: int,
             anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows of surroundings, each standing for ``counts`` samples: how far the repeated strings reach to the
    left of the sample and to the right of its start; -1 where none does."""
    reach = length - anchor
    start = np.unique(keys, return_inverse=True)[1]
    symbols, fits_right = _matrix(rights, anchor, reach)
    right = list(refine(start, symbols))
    symbols, fits_left = _matrix(lefts, 0, reach)
    far_left, far_right = np.full(len(keys), -1), np.full(len(keys), -1)
    for step, left in enumerate(refine(start, symbols)):
        other = right[reach - step]
        fits = np.flatnonzero((fits_left >= step) & (fits_right >= reach - step))
        if not len(fits):
            continue
        _, inverse = np.unique(left[fits].astype(np.int64) * (int(other.max()) + 1) + other[fits],
                               return_inverse=True)
        hit = fits[np.bincount(inverse, weights=counts[fits])[inverse] > 1]
        far_left[hit] = step                                           # steps grow: the last one is the farthest
        far_right[hit] = np.maximum(far_right[hit], length - step)     # and the first reaches farthest right
    return far_left, far_right


def _merge(length: int, anchor: int):
    """Surroundings sorted by sample -> (hash, around, to_left, to_right): what repeated strings cover."""

    def flush(rows: pa.Table):
        if not rows.num_rows:
            return None
        rows = rows.combine_chunks()
        column = {c: rows.column(c).combine_chunks() for c in rows.column_names}
        left, right = repeated(column["hash"].to_numpy(), column["right"], column["left"],
                               column["copies"].to_numpy(), length, anchor)
        hit = np.flatnonzero(left >= 0)
        return pa.RecordBatch.from_arrays([
            column["hash"].take(pa.array(hit)), column["around"].take(pa.array(hit)), pa.array(left[hit], pa.int32()),
            pa.array(right[hit], pa.int32())], names=["hash", "around", "to_left", "to_right"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows >= REFINE:               # the last sample may go on in the next batch
                keys = held.column("hash").to_numpy()
                cut = int(np.flatnonzero(keys == keys[-1])[0])
                out = flush(held.slice(0, cut))
                held = held.slice(cut)
                if out is not None:
                    yield out
        out = flush(held) if held is not None else None
        if out is not None:
            yield out

    return run


def _strings(length: int, anchor: int):
    """Every string around the samples of a hot one: (digest, doc_id, start)."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, place, right, left in zip(*(batch.column(c).to_pylist() for c in
                                                    ("doc_id", "place", "right", "left")), strict=True):
                text = left[::-1] + right
                for at in range(len(text) - length + 1):
                    if at <= len(left):
                        rows.append((hashlib.blake2b(text[at:at + length], digest_size=16).digest(), doc_id,
                                     place - len(left) + at))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                columns, [pa.binary(), pa.int64(), pa.int64()], strict=True)], names=["digest", "doc_id", "low"])

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, spans) -> what is left of the text."""
    import hashlib

    for batch in batches:
        data, offsets = textkit.buffers(batch.column("text"))
        raw = data.tobytes() if batch.num_rows else b""
        rows = []
        for i, (doc_id, spans) in enumerate(zip(batch.column("doc_id").to_pylist(),
                                                batch.column("spans").to_pylist(), strict=True)):
            text = raw[offsets[i]:offsets[i + 1]]
            merged: list[list[int]] = []
            for low, high in sorted((s["low"], s["high"]) for s in spans):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            kept, at = [], 0
            for low, high in merged:
                kept.append(text[at:low])
                at = high
            left = b"".join([*kept, text[at:]])
            rows.append((doc_id, len(text) - len(left), len(merged), hashlib.sha256(left).hexdigest(), left))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                         names=["doc_id", "n_removed", "n_spans", "kept_sha256", "kept"])


class SuffixDedup:
    """One run over ``docs``."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 anchor: int = ANCHOR, hot: int = HOT):
        if not 8 <= anchor <= length // 2:
            raise ValueError("anchor must have 8 bytes and half of length at most")
        self.base = id_text(docs, id_col, text_col)
        self.length, self.anchor, self.hot = length, anchor, hot
        rows = self.base.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                                F.sha2("text", 256).alias("digest"))
        self.rows = scratch(rows, "suffix-rows")
        groups = self.rows.groupBy("digest", "n_bytes").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
        self.groups = scratch(groups, "suffix-groups")

    def samples(self) -> DataFrame:
        """(doc_id, hash, place) of the samples that occur at least twice among different texts."""
        found = self.base.mapInArrow(_samples(self.length, self.anchor),
                                     "doc_id long, hashes array<long>, places array<int>")
        reps = self.groups.where((F.col("n_bytes") >= self.length) & F.col("rep").isNotNull()).select(
            F.col("rep").alias("doc_id"))
        self.sampled = scratch(found.join(reps, "doc_id", "left_semi"), "suffix-samples")
        found = self.sampled.select(
            "doc_id", F.explode_outer(F.arrays_zip(F.col("hashes").alias("hash"), F.col("places").alias("place"))).alias("s"))
        found = found.where("s IS NOT NULL").select("doc_id", "s.hash", "s.place")
        again = found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
        # a second key, so that both sides are exchanged for the join and adaptive execution can split a hot sample
        part = F.pmod(F.col("hash"), F.lit(7)).alias("part")
        return found.select("*", part).join(again.select("*", part), ["hash", "part"]).drop("part")

    def spans(self) -> tuple[DataFrame, DataFrame]:
        """(texts, spans): texts of the documents with samples that occur again; covered (doc_id, low, high)."""
        by_doc = self.samples().groupBy("doc_id").agg(F.collect_list(F.struct("hash", "place")).alias("s")).select(
            "doc_id", F.col("s.hash").alias("hashes"), F.col("s.place").alias("places"))
        texts = scratch(self.base.join(by_doc, "doc_id"), "suffix-texts")
        discard(self.sampled)
        around = texts.select("doc_id", "text", "hashes", "places").mapInArrow(
            _surroundings(self.length, self.anchor),
            "hash long, doc_id long, place int, right binary, left binary")
        same = F.xxhash64("right", "left").alias("around")    # beside the sample's own hash: 128 bits
        different = scratch(around.groupBy("hash", "right", "left").agg(F.count("*").cast("double").alias("copies"))
                            .select("hash", same, "right", "left", "copies"), "suffix-around")
        heat = different.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > self.hot).select("hash")
        hot = scratch(heat, "suffix-hot")
        reached = scratch(different.join(hot, "hash", "left_anti").repartition("hash").sortWithinPartitions("hash")
                          .mapInArrow(_merge(self.length, self.anchor),
                                      "hash long, around long, to_left int, to_right int"), "suffix-reached")
        discard(different)
        spans = around.select("doc_id", "place", "hash", same).join(reached, ["hash", "around"]).select(
            "doc_id", (F.col("place") - F.col("to_left")).cast("long").alias("low"),
            (F.col("place") + F.col("to_right")).cast("long").alias("high"))
        if hot.limit(1).count():
            strings = scratch(around.join(hot, "hash", "left_semi").mapInArrow(
                _strings(self.length, self.anchor), "digest binary, doc_id long, low long"), "suffix-strings")
            often = strings.distinct().groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
            again = strings.join(often, "digest", "left_semi")
            spans = spans.union(again.select("doc_id", "low", (F.col("low") + self.length).alias("high")).distinct())
        return texts.select("doc_id", "text"), scratch(spans, "suffix-spans")

    def kept(self) -> DataFrame:
        """Of the documents that lose bytes but have no equal: ``doc_id``, ``n_removed``, ``n_spans``,
        ``kept_sha256``, ``kept`` (the remaining bytes)."""
        texts, spans = self.spans()
        by_doc = spans.groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
        return texts.join(by_doc, "doc_id").mapInArrow(
            _kept, "doc_id long, n_removed long, n_spans long, kept_sha256 string, kept binary")

    def documents(self) -> DataFrame:
        """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""
        nothing = F.sha2(F.lit(""), 256)
        kept = self.kept().drop("kept")
        whole = (F.col("copies") > 1) & (F.col("n_bytes") >= self.length)
        # the length is part of the key: both sides are exchanged, and a hot text can be split
        rows = self.rows.join(self.groups, ["digest", "n_bytes"], "left").join(
            kept, "doc_id", "left")
        return rows.select(
            "doc_id", "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(whole, nothing).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""
    return SuffixDedup(docs, id_col, text_col, length, anchor, hot).documents()
