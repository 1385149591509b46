"""Packing of tokenised documents into fixed windows by minimum bin slack.

A document's ids are its tokens (no special tokens added) and one end id.  A null text counts as empty and
is the end id alone.  Documents are cut at multiples of the window; whole windows are sequences of their
own, and the remaining lengths are packed: the longest one left opens a window, and a bitset subset-sum
dynamic programme over the lengths left finds the multiset whose sum is closest to what is still free;
backtracking gives how many pieces of each length that takes.  A sequence is padded to the window, except
when its length is a power of two; so in the tail of a shard exact powers of two are split off first.

Tokens are computed once, where the text is.  The vocabulary's pattern cuts at white space and between an
ASCII letter and punctuation (but an apostrophe), so every distinct piece is encoded once by a worker and
the ids of a text are put together from these.  Only (id, start, length, checksum) go on.  Pieces are dealt to shards of about ``SHARD`` by a hash, so shards
stay bounded at any size and every shard is packed on its own.

Rows keep their id, null or repeated; pieces of equal length are dealt out in the order of (id, start,
checksum), so the result is the same on every run.  An empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from typing import ClassVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import textkit
from revlens.llm.common import id_text, scratch

WINDOW, END_ID = 2048, 1
TOKENIZER = "word_bpe_49k.json"
#: Pieces of one shard, about.
SHARD = 8192
#: Distinct words whose ids a worker remembers.
MEMO = 600_000
#: A text that may hold a special token of the vocabulary is encoded as a whole.
SPECIAL = b"<|"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"


def load_tokenizer(path: str | None):
    """The tokenizer in a file; by default the public vocabulary of this name on the worker itself."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    return Tokenizer.from_file(path)


class WordIds:
    """Token ids of words, each distinct word encoded once."""

    #: By file, kept while the worker lives: tasks that follow know the words already.
    kept: ClassVar[dict[str | None, WordIds]] = {}

    def __init__(self, path: str | None):
        self.tokenizer = load_tokenizer(path)
        self.slot: dict[int, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.at = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.used = 0

    @classmethod
    def of(cls, path: str | None) -> WordIds:
        if path not in cls.kept:
            cls.kept[path] = cls(path)
        return cls.kept[path]

    def _add(self, hashes: list[int], words: list[str]) -> None:
        for h, encoding in zip(hashes, self.tokenizer.encode_batch(words, add_special_tokens=False), strict=True):
            ids, k = encoding.ids, len(self.slot)
            if k == len(self.at):
                self.at, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.size))
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.ids[self.used:self.used + len(ids)] = ids
            self.at[k], self.size[k] = self.used, len(ids)
            self.used += len(ids)
            self.slot[h] = k

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): ids of document i, with the end id, are ids[first[i]:first[i+1]]."""
        words = textkit.Words(data, offsets, parts=True)
        distinct, where, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        keys = distinct.tolist()
        new = [j for j, h in enumerate(keys) if h not in self.slot]
        used = self.used
        if new:
            low = words.low.tobytes()
            start, end = words.start[where[new]].tolist(), words.end[where[new]].tolist()
            self._add([keys[j] for j in new], [low[a:b].decode() for a, b in zip(start, end, strict=True)])
        slots = np.fromiter((self.slot[h] for h in keys), np.int64, len(keys))[inverse]
        size = self.size[slots]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(self.at[slots] - ends[:-1], size) + np.arange(ends[-1])]
        if len(self.slot) > MEMO:       # full: what this run added is dropped again
            for j in new:
                del self.slot[keys[j]]
            self.used = used
        first = ends[words.first]
        return np.insert(ids, first[1:], end_id), first + np.arange(len(first))


def _pieces(path: str | None, window: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.of(path)
        for batch in batches:
            data, offsets = textkit.buffers(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for lo, hi, d, o in textkit.runs(data, offsets):
                tokens, first = words.encode(d, o, end_id)
                tokens = tokens.astype("<u4", copy=False)
                raw = d.tobytes()
                special = SPECIAL in raw
                for i in range(hi - lo):
                    own = tokens[first[i]:first[i + 1]]
                    if special and SPECIAL in raw[o[i]:o[i + 1]]:
                        whole = words.tokenizer.encode(raw[o[i]:o[i + 1]].decode(), add_special_tokens=False).ids
                        own = np.array([*whole, end_id], "<u4")
                    for start in range(0, len(own), window):
                        part = own[start:start + window]
                        rows.append((ids[lo + i], start, len(part), zlib.crc32(part.tobytes()), len(own)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def closest_sum(counts: dict[int, int], free: int) -> dict[int, int]:
    """How many of each length give the largest sum up to ``free``; bit s of the set is "s can be made"."""
    reach, mask, steps = 1, (1 << (free + 1)) - 1, []
    for length in sorted((x for x in counts if counts[x] > 0 and x <= free), reverse=True):
        for _ in range(min(counts[length], free // length)):
            grown = (reach | (reach << length)) & mask
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
        if reach >> free & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + 1
            total -= length
    return taken


def fill(lengths: list[int], window: int) -> list[dict[int, int]]:
    """Windows as counts of lengths; every length is used exactly as often as it occurs."""
    counts: dict[int, int] = {}
    for x in lengths:
        counts[x] = counts.get(x, 0) + 1
    left, out = sum(lengths), []

    def take(chosen: dict[int, int]) -> None:
        nonlocal left
        for x, k in chosen.items():
            counts[x] -= k
            if not counts[x]:
                del counts[x]
            left -= x * k
        out.append(chosen)

    while counts:
        if left < window:   # the tail: powers of two need no padding
            power = 1 << (left.bit_length() - 1)
            while power:
                chosen = closest_sum(counts, power)
                if sum(x * k for x, k in chosen.items()) == power:
                    take(chosen)
                    break
                power >>= 1
            else:
                take(dict(counts))
            continue
        longest = max(counts)
        counts[longest] -= 1
        chosen = closest_sum(counts, window - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        take(chosen)
    return out


def _pack(window: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        length = pdf["length"].to_numpy()
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        whole = np.flatnonzero(length == window)
        sequence[whole] = np.arange(len(whole))
        rest = np.flatnonzero(length < window)
        waiting: dict[int, list[int]] = {}
        for i in rest[::-1].tolist():
            waiting.setdefault(int(length[i]), []).append(i)
        for at, chosen in enumerate(fill(length[rest].tolist(), window), start=len(whole)):
            filled = 0
            for size in sorted(chosen, reverse=True):
                for _ in range(chosen[size]):
                    i = waiting[size].pop()
                    sequence[i], offset[i] = at, filled
                    filled += size
        pdf["sequence_id"] = (int(key[0]) << 32) + sequence
        pdf["offset"] = offset
        return pdf[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         window: int = WINDOW, end_id: int = END_ID, shard: int = SHARD) -> DataFrame:
    """Per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    base = id_text(docs, id_col, text_col)
    pieces = scratch(base.mapInArrow(_pieces(tokenizer, window, end_id), PIECES), "pieces")
    shards = max(1, -(-pieces.count() // shard))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(_pack(window), PACKED)
