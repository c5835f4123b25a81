"""Quality classifier: a factorisation machine.

Features of a text are its hashed words (log counts, normalised), structure
statistics (shares of byte classes and of each punctuation mark, repetition of
words and lines, word shapes) and its length, the statistics by fixed logarithmic
bins.  Their pairwise interactions have a low-rank form, scored in linear time:
``1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)``.

Training (numpy, Adam) uses at most about ``TRAIN_ROWS`` labelled documents,
chosen by a hash of doc_id among those that may be learned from: a documented bound, the
only one here.

Defined cases: a null text counts as empty and is scored like any other; if
nothing can be learned from, every score is 0.5, and with labels of one class the
smoothed share of it; null labels and labels of no document are ignored, a document with
several labels has the smallest; an empty table gives an empty result; repeated
rows are scored alike; extra columns pass through :func:`score`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.common import held_out
from graphloom.llm.shingles import word_hashes

WORD_BITS = 15
RANK = 8
TRAIN_ROWS = 8000
EPOCHS = 6
#: Small samples are gone through more often.
MIN_STEPS = 400
BATCH = 64
THRESHOLD = 0.3
BINS = 12

_PUNCTUATION = np.array([c for c in range(33, 127) if not chr(c).isalnum()])
_CLASS = np.full(256, 5, np.uint8)  # non-ASCII
_CLASS[:128] = 3  # punctuation and control
_CLASS[[*range(48, 58)]] = 2
_CLASS[[*range(65, 91)]] = 0
_CLASS[[*range(97, 123)]] = 1
_CLASS[[9, 11, 12, 13, 32]] = 4
_CLASS[10] = 6
_SPACE = (_CLASS == 4) | (_CLASS == 6)
_TAILS = np.zeros(256, bool)
_TAILS[list(b".,;:?!)'\"")] = True
#: byte classes, punctuation marks, and the other statistics of _statistics
_N_STATS = 7 + len(_PUNCTUATION) + 10
SIZE = (1 << WORD_BITS) + _N_STATS * BINS
#: Bytes of text taken at a time; a longer text is taken alone.
STEP = 1 << 18


def _share_bin(x: np.ndarray) -> np.ndarray:
    """Bins of shares: 0 for none, then doubling from 1/1024 on."""
    return np.minimum(np.floor(np.log2(x * 1024 + 1)), BINS - 1).astype(np.int64)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring ``bounds``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def features(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indices, values, bounds) of the features of some texts (UTF-8 bytes): text ``i`` has those from bounds[i] to bounds[i + 1]."""
    n_docs = len(texts)
    newline = np.array([10], np.uint8)
    data = np.concatenate([part for t in texts for part in (t, newline)])  # a gap, so that no word reaches into the next text
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate([[0], ends])
    length = np.maximum(1, np.diff(bounds) - 1)
    words = word_hashes(data)
    gap = _SPACE[data].view(np.int8)
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    edge = edge if gap[0] else np.concatenate([[0], edge])
    start, stop = edge[::2], edge[1::2]
    word_bounds = np.searchsorted(start, bounds)
    n_words = np.diff(word_bounds)
    k = np.maximum(1, n_words)
    doc = np.repeat(np.arange(n_docs), n_words)

    keys, counts = np.unique((doc.astype(np.int64) << WORD_BITS) | (words & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64), return_counts=True)
    key_bounds = np.searchsorted(keys, np.arange(n_docs + 1, dtype=np.int64) << WORD_BITS)
    values = np.log1p(counts)
    norm = np.sqrt(np.maximum(np.diff(np.concatenate([[0.0], np.cumsum(values * values)])[key_bounds]), 1e-18))
    values = values / np.repeat(norm, np.diff(key_bounds))

    histogram = np.bincount(np.repeat(np.arange(n_docs) << 8, np.diff(bounds)) + data, minlength=n_docs << 8).reshape(n_docs, 256)
    histogram[:, 10] -= 1  # the gap
    classes = histogram @ (_CLASS[:, None] == np.arange(7)).astype(np.int64)
    kind = _CLASS[data]
    upper, lower = (np.concatenate([[0], np.cumsum(kind == c, dtype=np.int32)]) for c in (0, 1))
    shouted = (upper[stop] - upper[start] > 1) & (lower[stop] == lower[start])
    tail = data[stop - 1]
    marked = _CLASS[tail] == 3
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    most = np.array([counts[lo:hi].max() if hi > lo else 0 for lo, hi in zip(key_bounds, key_bounds[1:], strict=False)])
    lines = [t.tobytes().split(b"\n") for t in texts]
    full = [[x for x in ls if x.strip()] for ls in lines]
    shares = np.stack(
        [
            np.diff(key_bounds) / k,
            most / k,
            _sums(same, word_bounds) / k,
            np.array([1 - len(set(f)) / max(1, len(f)) for f in full]),
            _sums(shouted, word_bounds) / k,
            _sums(marked, word_bounds) / k,
            _sums(marked & ~_TAILS[tail], word_bounds) / k,
            np.minimum(1.0, np.array([len(ls) for ls in lines]) / k),
        ],
        1,
    )
    scales = np.stack([np.log2(n_words + 1), _sums(stop - start, word_bounds) / k], 1)
    binned = np.concatenate([_share_bin(classes / length[:, None]), _share_bin(histogram[:, _PUNCTUATION] / length[:, None]), _share_bin(shares), np.minimum(scales, BINS - 1).astype(np.int64)], 1)
    stats = (1 << WORD_BITS) + np.arange(_N_STATS) * BINS + binned

    # the words' features of every text, then its statistics
    out_bounds = key_bounds + np.arange(n_docs + 1) * _N_STATS
    out = np.empty(out_bounds[-1], np.int64)
    x = np.full(out_bounds[-1], 2 / np.sqrt(_N_STATS), np.float32)
    at = np.arange(len(keys)) + np.repeat(np.arange(n_docs) * _N_STATS, np.diff(key_bounds))
    out[at], x[at] = keys & ((1 << WORD_BITS) - 1), values
    out[(out_bounds[1:, None] - _N_STATS) + np.arange(_N_STATS)] = stats
    return out, x, out_bounds


def _steps(texts: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The texts, in order, in groups of about ``STEP`` bytes."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > STEP:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t) + 64
    if group:
        yield group


@dataclass
class FactorisationMachine:
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def probabilities(self, texts: list[np.ndarray]) -> np.ndarray:
        """The probability of label 1 of each text (UTF-8 bytes)."""
        if not len(self.weight):
            return np.full(len(texts), 1 / (1 + np.exp(-self.bias)))
        return np.concatenate([self._of(*features(group)) for group in _steps(texts)] or [np.zeros(0)])

    def _of(self, places: np.ndarray, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        vx = self.factors[places] * x[:, None]
        total = np.add.reduceat(vx, bounds[:-1])
        z = self.bias + np.add.reduceat(self.weight[places] * x, bounds[:-1]) + 0.5 * (total**2 - np.add.reduceat(vx * vx, bounds[:-1])).sum(1)
        return 1 / (1 + np.exp(-np.clip(z.astype(float), -30, 30)))


def constant(p: float) -> FactorisationMachine:
    return FactorisationMachine(float(np.log(p / (1 - p))), np.zeros(0, np.float32), np.zeros((0, RANK), np.float32))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 5) -> FactorisationMachine:
    """Fit to sparse rows and 0/1 labels by logistic loss."""
    positive = (labels.sum() + 1) / (len(labels) + 2)
    if len(np.unique(labels)) < 2:
        return constant(positive) if len(labels) else constant(0.5)
    rng = np.random.default_rng(seed)
    params = {"b": np.array([np.log(positive / (1 - positive))]), "w": np.zeros(SIZE), "v": rng.normal(0, 0.02, (SIZE, RANK))}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    step = 0
    epochs = max(EPOCHS, -(-MIN_STEPS * BATCH // len(rows)))
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            chosen = order[at : at + BATCH]
            places = np.concatenate([rows[i][0] for i in chosen])
            x = np.concatenate([rows[i][1] for i in chosen]).astype(float)
            starts = np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in chosen])[:-1]])
            row = np.repeat(np.arange(len(chosen)), [len(rows[i][0]) for i in chosen])
            vx = params["v"][places] * x[:, None]
            total = np.add.reduceat(vx, starts)
            z = params["b"][0] + np.add.reduceat(params["w"][places] * x, starts) + 0.5 * (total**2 - np.add.reduceat(vx**2, starts)).sum(1)
            delta = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[chosen]) / len(chosen)
            own = delta[row] * x
            grads = {"b": np.array([delta.sum()]), "w": np.bincount(places, own, SIZE) + 1e-5 * params["w"]}
            pull = own[:, None] * (total[row] - vx)
            grads["v"] = np.stack([np.bincount(places, pull[:, f], SIZE) for f in range(RANK)], 1) + 1e-5 * params["v"]
            step += 1
            rate = 0.02 * (1 - epoch / (epochs + 1))
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                params[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return FactorisationMachine(float(params["b"][0]), params["w"].astype(np.float32), params["v"].astype(np.float32))


def _bytes(text: pa.Scalar) -> np.ndarray:
    buffer = text.as_buffer() if text.is_valid else None
    return np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality") -> FactorisationMachine:
    """The machine for ``docs`` (doc_id, text) and ``labels`` (doc_id, target)."""
    usable = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg((F.min(target) > 0).cast("int").alias("label"))
    n = usable.count()
    share = int(min(1.0, TRAIN_ROWS / max(1, n)) * 1_000_000)
    # the sample is bounded, so it can be broadcast
    chosen = F.broadcast(usable.where(F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1_000_000)) < share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for group in _steps([_bytes(t) for t in batch.column("text")]):
                places, x, bounds = features(group)
                found += [(places[lo:hi], x[lo:hi]) for lo, hi in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([p.astype(np.int32).tobytes() for p, _ in found], pa.binary()), pa.array([x.tobytes() for _, x in found], pa.binary())],
                names=["doc_id", "label", "places", "vals"],
            )

    sample = docs.select("doc_id", "text").join(chosen, "doc_id").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "label")
    rows = sample.mapInArrow(run, "doc_id string, label int, places binary, vals binary").collect()
    rows.sort(key=lambda r: (len(r.doc_id), r.doc_id, bytes(r.places)))  # whole numbers in their order
    parsed = [(np.frombuffer(r.places, np.int32).astype(np.int64), np.frombuffer(r.vals, np.float32)) for r in rows]
    return train(parsed, np.array([r.label for r in rows], float))


def score(docs: DataFrame, machine: FactorisationMachine) -> DataFrame:
    """``docs`` (any columns, with text) with ``score``, the probability of label 1."""
    columns = [f for f in docs.schema if f.name != "score"]
    names = [f.name for f in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = machine.probabilities([_bytes(t) for t in batch.column("text")])
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(scores, pa.float64())], names=[*names, "score"])

    return docs.select(*names).mapInArrow(run, T.StructType([*columns, T.StructField("score", T.DoubleType())]))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns."""
    found = score(docs.select("doc_id", "text"), fit(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
