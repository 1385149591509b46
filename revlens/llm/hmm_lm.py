"""Hidden Markov language model: Baum-Welch over all training rows, exact scaled forward likelihoods.

Tokens are words (runs of other than ASCII white space, A-Z lower-cased) and one end per text; a null text
counts as empty and is the end alone.  Rows whose crc32(id as text) modulo ``folds`` is ``held`` are held
out; a row without an id is not.  An empty table gives an empty result; without training rows all counts
are 0.  Rows keep their ids, null or repeated.

Model.  A latent state emits a token class, the class a word.  The ``OWN`` most frequent words and the end
are classes of their own; every other word is in the class of its last three bytes (``TAILS`` of them),
which emits it with probability (c + 1) / (N_class + V_class + 1), c being its count in all training
texts and the last 1 standing for all unseen words.  The classes bound the size of the model, the counts cover the whole
vocabulary and grow with it.

Steps, all over the whole table:

1. Word counts: counted per chunk in the tasks, summed by word (one shuffle), written as a table.
2. Up to ``TOP`` of the most frequent words and their counts go to every task (12 bytes each, 1.6 MB).  Texts become class
   sequences, written once; words beyond ``TOP`` are joined with the count table by word.
3. Baum-Welch: each round, tasks run scaled forward-backward over their sequences (training texts cut into
   consecutive segments of ``SEGMENT`` tokens) and send expected counts, which are summed across
   partitions; the driver gets states x classes numbers and normalises them.
4. Scaled forward recursion over every whole text gives its exact likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import textkit
from revlens.llm.common import most_frequent, scratch

STATES, OWN, TAILS, TOP = 8, 8192, 256, 131_072
ROUNDS, SEGMENT = 4, 64
#: Tokens counted together in a task.
CHUNK = 4_000_000
#: Segments that run side by side.
LANES = 4096
END = textkit.mix(np.array([2], np.uint64))[0]


def tails(words: textkit.Words) -> np.ndarray:
    """Class of the last three bytes of every word, 0..TAILS-1."""
    key = np.zeros(len(words.start), np.uint64)
    for back in (1, 2, 3):
        at = words.end - back
        key = key * np.uint64(257) + np.where(at >= words.start, words.low[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1),
                                              np.uint64(0))
    return (textkit.mix(key) % np.uint64(TAILS)).astype(np.int32)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hash, class and count per chunk; the end has class -1."""
    chunk: list[tuple[np.ndarray, np.ndarray]] = []
    held = ends = 0

    def flush():
        hashes, classes = (np.concatenate(x) for x in zip(*chunk, strict=True))
        words, first, counts = np.unique(hashes, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(textkit.signed(words)), pa.array(classes[first], pa.int32()),
                                           pa.array(counts, pa.int64())], names=["word", "tail", "seen"])

    for batch in batches:
        data, offsets = textkit.buffers(batch.column("text"))
        ends += batch.num_rows
        for _, _, d, o in textkit.runs(data, offsets):
            words = textkit.Words(d, o)
            chunk.append((words.hashes(), tails(words)))
            held += len(words.start)
            if held >= CHUNK:
                yield flush()
                chunk, held = [], 0
    chunk.append((np.full(ends, END, np.uint64), np.full(ends, -1, np.int32)))
    yield flush()


@dataclass
class Vocabulary:
    """What every task knows of the corpus: the most frequent words, and totals by class."""

    words: np.ndarray     # sorted hashes of the most frequent words (and the end)
    counts: np.ndarray
    classes: np.ndarray   # class of each
    mass: np.ndarray      # log10 of N_class + V_class + 1, by tail class
    total: int
    size: int

    @property
    def n_classes(self) -> int:
        return OWN + TAILS + 1


def _encoded(vocabulary: Vocabulary):
    """Texts -> class sequences, the parts of the scores that the task knows, and the words it doesn't."""
    names = ["row", "doc_id", "held_out", "classes", "n_tokens", "known", "log_count", "log_inside", "rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        end_at = int(np.searchsorted(vocabulary.words, END)) if vocabulary.size else 0
        has_end = vocabulary.size > 0 and end_at < len(vocabulary.words) and vocabulary.words[end_at] == END
        end_count = int(vocabulary.counts[end_at]) if has_end else 0
        for batch in batches:
            data, offsets = textkit.buffers(batch.column("text"))
            for lo, hi, d, o in textkit.runs(data, offsets):
                words = textkit.Words(d, o)
                hashes, tail = words.hashes(), tails(words)
                classes = (OWN + tail).astype(np.uint16)
                log_count, inside = np.zeros(len(hashes)), -vocabulary.mass[tail]
                known = np.zeros(len(hashes), bool)
                if len(vocabulary.words):
                    at = np.minimum(np.searchsorted(vocabulary.words, hashes), len(vocabulary.words) - 1)
                    known = vocabulary.words[at] == hashes
                    hit = at[known]
                    log_count[known] = np.log10(vocabulary.counts[hit] + 1.0)
                    classes[known] = vocabulary.classes[hit]
                    own = vocabulary.classes[hit] < OWN
                    inside[known] = np.where(own, 0.0, inside[known] + log_count[known])
                first, n = words.first, hi - lo

                def per_doc(values, first=first):
                    sums = np.concatenate([[0], np.cumsum(values)])
                    return sums[first[1:]] - sums[first[:-1]]

                sequence = np.insert(classes, first[1:], np.uint16(OWN + TAILS))
                bounds = (first + np.arange(n + 1)) * 2
                rare_sum = np.concatenate([[0], np.cumsum(~known)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + np.arange(n), pa.int64()), batch.column("doc_id").slice(lo, n),
                    batch.column("held_out").slice(lo, n),
                    pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()),
                                                           pa.py_buffer(sequence.astype("<u2").tobytes())]),
                    pa.array(np.diff(first) + 1, pa.int64()), pa.array(per_doc(known) + (end_count > 0), pa.int64()),
                    pa.array(per_doc(log_count) + np.log10(end_count + 1.0)), pa.array(per_doc(inside)),
                    textkit.list_array(textkit.signed(hashes[~known]), rare_sum[first], pa.int64())], names=names)
                row += n

    return run


@dataclass
class Model:
    start: np.ndarray       # states
    move: np.ndarray        # states x states
    emit: np.ndarray        # states x classes

    @staticmethod
    def initial(states: int, class_share: np.ndarray, seed: int = 7) -> Model:
        """States that mostly stay, with class shares scattered around those of the corpus."""
        noise = np.exp(np.random.default_rng(seed).normal(size=(states, len(class_share))))
        emit = class_share * noise
        move = np.full((states, states), 0.05 / max(1, states - 1))
        np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
        return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True))

    def settled(self) -> np.ndarray:
        """Shares of the states far from a text's start."""
        share = np.full(len(self.start), 1 / len(self.start))
        for _ in range(100):
            share = share @ self.move
        return share / share.sum()

    def expected(self, sequences: list[np.ndarray], goes_on: list[bool] | None = None
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts (start, move, emit) and log likelihood: scaled forward-backward over sequences
        that run side by side, the longest first, so those still running are a prefix.

        A sequence that ``goes_on`` starts in mid-text with the token before it, which stands for the cut: its state is
        no start and its emission is not counted, but the move from it is."""
        s, c = self.emit.shape
        order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        size = np.array([len(sequences[i]) for i in order])
        inner = np.array([goes_on is not None and goes_on[i] for i in order])
        steps = int(size[0])
        seen = np.zeros((steps, len(order)), np.int64)
        for lane, i in enumerate(order):
            seen[:size[lane], lane] = sequences[i]
        running = np.searchsorted(-size, -np.arange(steps), "left")   # lanes longer than t
        by_class = np.ascontiguousarray(self.emit.T)
        forward, scale = np.zeros((steps, len(order), s)), np.ones((steps, len(order)))
        now = np.where(inner[:, None], self.settled(), self.start) * by_class[seen[0]]
        for t in range(steps):
            n = running[t]
            if t:
                now = (forward[t - 1, :n] @ self.move) * by_class[seen[t, :n]]
            total = now.sum(axis=1)
            forward[t, :n], scale[t, :n] = now / total[:, None], total
        moves, emits = np.zeros((s, s)), np.zeros(c * s)
        after = np.ones((len(order), s))
        columns = np.arange(s)
        for t in range(steps - 1, -1, -1):
            n = running[t]
            if t + 1 < steps and running[t + 1]:
                m = running[t + 1]
                ahead = by_class[seen[t + 1, :m]] * after[:m] / scale[t + 1, :m, None]
                moves += forward[t, :m].T @ ahead
                after[:m] = ahead @ self.move.T
            share = forward[t, :n] * after[:n]
            if t == 0:
                share = np.where(inner[:, None], 0.0, share)
            emits += np.bincount((seen[t, :n, None] * s + columns).ravel(), share.ravel(), c * s)
        starts = (forward[0] * after)[~inner].sum(axis=0)
        return starts, moves * self.move, emits.reshape(c, s).T, float(np.log(scale).sum() - np.log(scale[0, inner]).sum())

    def updated(self, starts, moves, emits, class_share: np.ndarray) -> Model:
        """Normalised counts, smoothed towards the shares of the corpus."""
        emits = emits + 10.0 * class_share
        return Model((starts + 1) / (starts + 1).sum(), (moves + 1) / (moves + 1).sum(axis=1, keepdims=True),
                     emits / emits.sum(axis=1, keepdims=True))

    def log10_likelihood(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact log10 probability of whole sequences by the scaled forward recursion."""
        order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        size = np.array([len(sequences[i]) for i in order])
        flat = np.concatenate([sequences[i] for i in order]).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(size)])[:-1]
        running = np.searchsorted(-size, -np.arange(int(size[0])), "left")
        by_class = np.ascontiguousarray(self.emit.T)
        total = np.zeros(len(order))
        now = self.start[None, :] * by_class[flat[first]]
        for t, n in enumerate(running.tolist()):
            if t:
                now = (now[:n] @ self.move) * by_class[flat[first[:n] + t]]
            scale = now.sum(axis=1)
            total[:n] += np.log10(scale)
            now = now / scale[:, None]
        out = np.empty(len(order))
        out[order] = total
        return out


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, "<u2") for b in column.to_pylist()]


def segments(sequence: np.ndarray, size: int) -> list[tuple[np.ndarray, bool]]:
    """A text in pieces of ``size`` tokens; every piece but the first has the token before it in front."""
    return [(sequence[max(at - 1, 0):at + size], at > 0) for at in range(0, len(sequence), size)]


def _expected_counts(model: Model, segment: int):
    """Class sequences of training rows -> expected counts of this task, as (place, value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, c = model.emit.shape
        total = np.zeros(s + s * s + s * c + 1)
        for batch in batches:
            cut = [piece for q in _sequences(batch.column("classes")) for piece in segments(q, segment)]
            for at in range(0, len(cut), LANES):
                starts, moves, emits, log = model.expected(*map(list, zip(*cut[at:at + LANES], strict=True)))
                total += np.concatenate([starts, moves.ravel(), emits.ravel(), [log]])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["place", "value"])

    return run


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(model.log10_likelihood(_sequences(batch.column("classes"))))],
                    names=["row", "log_classes"])

    return run


class HmmLanguageModel:
    """Learned from the rows of ``docs`` that are not held out; scores all of them."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2,
                 states: int = STATES, rounds: int = ROUNDS, segment: int = SEGMENT):
        ids = docs[id_col].cast("long")
        base = docs.select(
            ids.alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
            F.coalesce(F.pmod(F.crc32(ids.cast("string")), F.lit(folds)) == held, F.lit(False)).alias("held_out"))
        counted = base.where(~F.col("held_out")).select("text").mapInArrow(_counts, "word long, tail int, seen long")
        self.words = scratch(counted.groupBy("word").agg(F.sum("seen").alias("c"), F.min("tail").alias("tail")), "hmm-words")
        self.vocabulary = self._vocabulary()
        self.encoded = scratch(base.mapInArrow(
            _encoded(self.vocabulary), "row long, doc_id long, held_out boolean, classes binary, n_tokens long, "
            "known long, log_count double, log_inside double, rare array<long>"), "hmm-sequences")
        self.model, self.log_likelihoods = self._train(states, rounds, segment)

    def _vocabulary(self) -> Vocabulary:
        sums = self.words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        top = most_frequent(self.words.where("tail >= 0"), "c", TOP).collect()
        top.sort(key=lambda r: (-r.c, r.word))
        end = self.words.where(F.col("tail") == -1).collect()       # one row at most
        classes = [*range(min(OWN, len(top))), *(OWN + r.tail for r in top[OWN:])]
        rows = [*zip(top, classes, strict=True), *((r, OWN + TAILS) for r in end)]
        words = np.array([r.word for r, _ in rows], np.int64).view(np.uint64)
        order = np.argsort(words)
        counts = np.array([r.c for r, _ in rows], np.int64)
        self.class_counts = np.zeros(OWN + TAILS + 1)
        for (r, k) in rows:
            if k < OWN or k == OWN + TAILS:
                self.class_counts[k] += r.c
        own = [r.word for r in top[:OWN]]
        spark = self.words.sparkSession
        own = spark.createDataFrame([(w,) for w in own], "word long")     # OWN rows at most
        by_tail = (self.words.where("tail >= 0").join(F.broadcast(own), "word", "left_anti")
                   .groupBy("tail").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect())
        mass = np.ones(TAILS)
        for r in by_tail:
            mass[r.tail] = r.c + r.v + 1
            self.class_counts[OWN + r.tail] = r.c
        return Vocabulary(words[order], counts[order], np.array([k for _, k in rows], np.uint16)[order],
                          np.log10(mass), int(sums[0]), int(sums[1]))

    def _train(self, states: int, rounds: int, segment: int) -> tuple[Model, list[float]]:
        share = (self.class_counts + 0.5) / (self.class_counts + 0.5).sum()
        model, s, c = Model.initial(states, share), states, len(share)
        training = self.encoded.where(~F.col("held_out")).select("classes")
        logs = []
        for _ in range(rounds):
            counts = np.zeros(s + s * s + s * c + 1)
            rows = (training.mapInArrow(_expected_counts(model, segment), "place long, value double")
                    .groupBy("place").agg(F.sum("value").alias("value"))).collect()   # states x classes rows at most
            for r in rows:
                counts[r.place] = r.value
            logs.append(float(counts[-1]))
            model = model.updated(counts[:s], counts[s:s + s * s].reshape(s, s), counts[s + s * s:-1].reshape(s, c), share)
        return model, logs

    def scores(self) -> DataFrame:
        """Per row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
        v = self.vocabulary
        rare = self.encoded.select("row", F.explode("rare").alias("word")).join(self.words, "word").groupBy("row").agg(
            F.sum(F.log10(F.col("c") + 1)).alias("rare_log"), F.count("*").alias("rare_known"))
        classes = self.encoded.select("row", "classes").mapInArrow(_scored(self.model), "row long, log_classes double")
        rows = (self.encoded.drop("classes", "rare").join(classes, "row").join(rare, "row", "left"))
        rare_log = F.coalesce("rare_log", F.lit(0.0))
        return rows.select(
            "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(v.total).cast("long").alias("train_tokens"),
            (F.col("log_count") + rare_log - F.col("n_tokens") * F.lit(float(np.log10(v.total + v.size + 1)))).alias("base_score"),
            (F.col("log_classes") + F.col("log_inside") + rare_log).alias("score"))


def hmm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Scores of every row of ``docs`` under the model that its training rows give."""
    return HmmLanguageModel(docs, id_col, text_col, **options).scores()
