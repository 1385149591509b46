"""Quality classifier: a linear-chain conditional random field labels every line of a text good or bad.

Lines are what newlines separate (an empty or null text is one empty line).  A line's features are counts of
byte classes, words, repeated neighbour words and its length, and the main ones of the line before and the
line after.  The chain has two states; forward-backward gives every line's probability to be good, and the
document's score is their average weighted by line length (in bytes, plus one).

Only documents are labelled, so in training every line has its document's label.  The field is fitted on a
bounded sample (about ``SAMPLE`` labelled documents that a hash of their id picks, cut into segments of
``SEGMENT`` lines, of which about ``SEGMENTS`` are used); every other step covers all rows and whole texts.  Rows whose crc32(id as text) modulo
``folds`` is 0 are held out of training.  Labels, ids and other columns are never inputs of a score.

A row without an id is scored and never trained on; a label that is null is ignored, of several labels of
an id the least counts; without labelled rows every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm import textkit
from revlens.llm.common import broadcast_if_small, id_text, scratch, without

FOLDS, THRESHOLD = 5, 0.3
#: Labelled documents used for fitting, lines of a training segment, and segments used.
SAMPLE, SEGMENT, SEGMENTS = 6000, 64, 12_000

_KINDS = ("lower", "upper", "digit", "space", "stop", "bar", "bang", "symbol", "punct", "beyond")


def _kinds() -> np.ndarray:
    table = np.full(256, _KINDS.index("punct"), np.int64)
    table[128:] = _KINDS.index("beyond")
    for kind, chars in (("space", b" \t\r\n\v\f"), ("stop", b".,;:?'\"-()"), ("bar", b"|"), ("bang", b"!"),
                        ("symbol", b"#$%&*@+=<>~^/\\_{}[]")):
        table[list(chars)] = _KINDS.index(kind)
    table[48:58], table[65:91], table[97:123] = (_KINDS.index(k) for k in ("digit", "upper", "lower"))
    return table


KIND = _kinds()
#: Features of the line itself that its neighbours see too.
SHARED = 8
OWN = SHARED + 12
FEATURES = OWN + 2 * SHARED + 2


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line starts and the end, first line of every document)."""
    breaks = np.flatnonzero(data == 10)
    count = np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1
    first = np.concatenate([[0], np.cumsum(count)])
    starts = np.empty(first[-1] + 1, np.int64)
    starts[-1] = len(data)
    rest = np.ones(first[-1], bool)
    rest[first[:-1]] = False
    starts[first[:-1]] = offsets[:-1]
    starts[:-1][rest] = breaks + 1
    return starts, first


def line_features(data: np.ndarray, starts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of FEATURES numbers a line, all of the order of 1."""
    n = len(starts) - 1
    size = np.diff(starts)
    of = np.repeat(np.arange(n), size)
    kinds = np.bincount(of * len(_KINDS) + KIND[data], minlength=n * len(_KINDS)).reshape(n, -1)
    share = kinds / np.maximum(size, 1)[:, None]
    words = textkit.Words(data, starts)
    hashes = words.hashes()
    again = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) > 1:
        again[2:] = np.cumsum((hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1]))
        again[1] = 0
    count = np.diff(words.first)
    pairs = np.maximum(count - 1, 1)
    same = np.where(count > 1, again[words.first[1:]] - again[np.minimum(words.first[:-1] + 1, len(hashes))], 0) / pairs
    letters = np.maximum(kinds[:, 0] + kinds[:, 1], 1)
    per_word = kinds / np.maximum(count, 1)[:, None]
    k = {name: i for i, name in enumerate(_KINDS)}
    shared = [same, same > 0.2, np.minimum(per_word[:, k["symbol"]], 4) / 2, np.minimum(per_word[:, k["bar"]], 2),
              kinds[:, k["upper"]] / letters, np.minimum(per_word[:, k["bang"]], 3), share[:, k["digit"]], np.log1p(size) / 5]
    own = [np.ones(n), share[:, k["lower"]], share[:, k["upper"]], share[:, k["space"]], share[:, k["stop"]],
           share[:, k["beyond"]], share[:, k["punct"]], count == 0, count == 1, kinds[:, k["upper"]] > 0.5 * letters,
           np.minimum((size - kinds[:, k["space"]]) / np.maximum(count, 1), 30) / 10, np.minimum(per_word[:, k["stop"]], 2)]
    shared = np.stack([np.asarray(x, float) for x in shared], axis=1)
    before, after = np.zeros_like(shared), np.zeros_like(shared)
    before[1:], after[:-1] = shared[:-1], shared[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    opens, ends = np.zeros(n), np.zeros(n)
    opens[first[:-1]], ends[first[1:] - 1] = 1, 1
    return np.column_stack([shared, *own, before, after, opens, ends])


@dataclass
class Chain:
    """Weights of a line's features for the label good, and of pairs of neighbouring labels (bad 0, good 1)."""

    weights: np.ndarray
    pairs: np.ndarray

    def run(self, features: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probability of good by line, expected pairs, log normaliser by sequence) by forward-backward,
        all sequences side by side, the longest first."""
        score = features @ self.weights
        top = np.maximum(score, 0)
        local = np.exp(np.stack([-top, score - top], axis=1))
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        size, begin = size[order], first[:-1][order]
        steps = int(size[0]) if len(size) else 0
        running = np.searchsorted(-size, -np.arange(steps), "left").tolist()
        move = np.exp(self.pairs)
        ahead, scale = np.empty((len(features), 2)), np.ones(len(features))
        now = np.empty((0, 2))
        for t, n in enumerate(running):
            at = begin[:n] + t
            now = local[at] if not t else (now[:n] @ move) * local[at]
            total = now.sum(axis=1)
            now = now / total[:, None]
            ahead[at], scale[at] = now, total
        expected, back = np.zeros((2, 2)), np.ones((len(size), 2))
        good = np.empty(len(features))
        for t in range(steps - 1, -1, -1):
            at = begin[:running[t]] + t
            if t + 1 < steps:
                n = running[t + 1]
                nxt = begin[:n] + t + 1
                follow = local[nxt] * back[:n] / scale[nxt][:, None]
                expected += ahead[begin[:n] + t].T @ follow
                back[:n] = follow @ move.T
            good[at] = ahead[at, 1] * back[:running[t], 1]
        logs = np.zeros(len(size))
        logs[order] = np.add.reduceat(np.log(scale) + top, first[:-1])[order] if len(size) else 0
        return np.clip(good, 0, 1), expected * move, logs


def fit(features: np.ndarray, first: np.ndarray, labels: np.ndarray, ridge: float = 1e-5, rounds: int = 200) -> Chain:
    """Weights of largest penalised likelihood of the label sequences, by limited-memory BFGS."""
    n_features = features.shape[1]
    size = np.diff(first)
    by_line = np.repeat(labels, size)
    observed = features.T @ by_line
    stay = np.zeros((2, 2))
    stay[0, 0], stay[1, 1] = (size[labels == 0] - 1).sum(), (size[labels == 1] - 1).sum()

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        chain = Chain(x[:n_features], x[n_features:].reshape(2, 2))
        good, expected, logs = chain.run(features, first)
        value = logs.sum() - observed @ chain.weights - (stay * chain.pairs).sum()
        slope = np.concatenate([features.T @ good - observed, (expected - stay).ravel()])
        return value / len(labels) + ridge / 2 * (x @ x), slope / len(labels) + ridge * x

    x = np.zeros(n_features + 4)
    value, slope = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, used = slope.copy(), []
        for s, y in reversed(past):
            a = (s @ q) / (s @ y)
            q -= a * y
            used.append(a)
        if past:
            s, y = past[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, float(np.linalg.norm(q)))
        for (s, y), a in zip(past, reversed(used), strict=True):
            q += s * (a - (y @ q) / (s @ y))
        step = 1.0
        while step > 1e-6:
            moved = x - step * q
            new_value, new_slope = loss(moved)
            if new_value <= value - 1e-4 * step * (q @ slope):
                break
            step /= 2
        else:
            break
        s, y = moved - x, new_slope - slope
        if s @ y > 1e-12:
            past = [*past[-9:], (s, y)]
        done = value - new_value < 1e-7
        x, value, slope = moved, new_value, new_slope
        if done:
            break
    return Chain(x[:n_features], x[n_features:].reshape(2, 2))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training documents -> (doc_id, at, label, features) by segment of lines."""
    for batch in batches:
        data, offsets = textkit.buffers(batch.column("text"))
        ids, labels = batch.column("doc_id").to_pylist(), batch.column("label").to_pylist()
        rows = []
        for lo, hi, d, o in textkit.runs(data, offsets):
            starts, first = lines(d, o)
            features = line_features(d, starts, first).astype(np.float32)
            for i in range(hi - lo):
                for at in range(first[i], first[i + 1], SEGMENT):
                    rows.append((ids[lo + i], int(at - first[i]), labels[lo + i],
                                 features[at:min(at + SEGMENT, first[i + 1])].tobytes()))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
            columns, [pa.int64(), pa.int64(), pa.int32(), pa.binary()], strict=True)],
            names=["doc_id", "at", "label", "features"])


def _scores(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textkit.buffers(batch.column("text"))
            for lo, hi, d, o in textkit.runs(data, offsets):
                starts, first = lines(d, o)
                good, _, _ = chain.run(line_features(d, starts, first), first)
                weight = np.diff(starts) + 1.0
                score = np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo),
                                                  pa.array(np.clip(score, 0, 1))], names=["doc_id", "score"])

    return run


def held_out(id_: Column, folds: int) -> Column:
    """Rows kept out of training: crc32 of the id as text is a multiple of ``folds`` (no id: kept out too)."""
    return F.coalesce(F.pmod(F.crc32(id_.cast("string")), F.lit(folds)) == 0, F.lit(True))


def _share(rows: DataFrame, most: int, *key: str) -> DataFrame:
    """All rows, or of more than ``most`` the share that a hash of the key picks: about ``most`` of them, the
    same on every run, without a sort."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(*key), F.lit(1_000_000)) < int(1_000_000 * most / n))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", folds: int = FOLDS, sample: int = SAMPLE) -> Chain:
    """The field fitted on at most ``sample`` labelled documents outside the held-out fold."""
    known = (labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
             .where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label")))
    chosen = broadcast_if_small(_share(known.where(~held_out(F.col("doc_id"), folds)), sample, "doc_id"))
    segments = scratch(id_text(docs, id_col, text_col).join(chosen, "doc_id").select("doc_id", "text", "label")
                       .mapInArrow(_segments, "doc_id long, at long, label int, features binary"), "quality-segments")
    rows = _share(segments, SEGMENTS, "doc_id", "at").collect()
    rows.sort(key=lambda r: (r.doc_id, r.at, r.label, r.features))
    if not rows:
        return Chain(np.zeros(FEATURES), np.zeros((2, 2)))
    parts = [np.frombuffer(r.features, np.float32).reshape(-1, FEATURES) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return fit(np.concatenate(parts).astype(float), first, np.array([int(r.label > 0) for r in rows]))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", folds: int = FOLDS, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    chain = train(docs, labels, id_col, text_col, label_col, folds)
    scored = id_text(docs, id_col, text_col).mapInArrow(_scores(chain), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_bad(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier accepts.  An id goes when all its rows are rejected."""
    bad = (quality(docs, labels, id_col, text_col).groupBy("doc_id").agg(F.max("predicted").alias("best"))
           .where("best = 0 AND doc_id IS NOT NULL"))
    return without(docs, bad, id_col)
