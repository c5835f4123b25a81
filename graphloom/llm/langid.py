"""Language identification: a byte convolutional network.

Filters of several widths slide over the UTF-8 bytes of fixed-length windows,
max pooling keeps each filter's strongest response, a softmax names the
language.  A one-hot byte times a filter is a row of a table, so the convolution
is a sum of looked-up rows.  The whole text is cut into windows of ``WINDOW``
bytes; the log-probabilities of all its windows are averaged.

Training (numpy, Adam) uses at most about ``TRAIN_PER_LANG`` documents a
language, chosen by a hash of doc_id among those that may be learned from, and
``TRAIN_WINDOWS`` windows at hashed places of each: a documented bound, the only
one here.  The model has a fixed size.

Defined cases: ``und`` with score 0 for null texts and texts without letters; if
nothing can be learned from, every other text is ``und`` too; null labels are
never learned; an empty table gives an empty result; repeated rows are judged
alike; extra columns pass through :func:`identify`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.common import reserved, held_out

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
TRAIN_PER_LANG = 600
TRAIN_WINDOWS = 3
EPOCHS = 6
BATCH = 64
UNKNOWN = "und"


@dataclass
class ByteCNN:
    languages: list[str]
    tables: dict[int, np.ndarray]  # width -> (width, 256, FILTERS)
    bias: np.ndarray  # one per filter of every width
    weight: np.ndarray  # filters x languages
    offset: np.ndarray

    def responses(self, windows: np.ndarray, width: int) -> np.ndarray:
        """(window, place, filter) responses of the filters of one width."""
        table, places = self.tables[width], windows.shape[1] - width + 1
        out = table[0][windows[:, :places]]
        for k in range(1, width):
            out += table[k][windows[:, k : k + places]]
        return out

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        pooled = np.empty((len(windows), len(WIDTHS) * FILTERS), np.float32)
        for at in range(0, len(windows), 16):  # a few at a time stay in the processor's cache
            for j, width in enumerate(WIDTHS):
                pooled[at : at + 16, j * FILTERS : (j + 1) * FILTERS] = self.responses(windows[at : at + 16], width).max(1)
        return log_softmax(np.maximum(pooled + self.bias, 0) @ self.weight + self.offset)


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def train(windows: np.ndarray, labels: list[str], seed: int = 7) -> ByteCNN:
    """A network fit to byte windows (n, WINDOW) and their languages."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    n_filters = len(WIDTHS) * FILTERS
    params = {f"t{w}": rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    params |= {"bias": np.zeros(n_filters, np.float32), "weight": rng.normal(0, 0.2, (n_filters, len(languages))).astype(np.float32), "offset": np.zeros(len(languages), np.float32)}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    share = np.bincount(y, minlength=len(languages)) / len(y)
    balance = (1 / (len(languages) * share))[y].astype(np.float32)
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at : at + BATCH]
            x, t = windows[rows], y[rows]
            model = ByteCNN(languages, {w: params[f"t{w}"] for w in WIDTHS}, params["bias"], params["weight"], params["offset"])
            pooled, places = [], []
            for w in WIDTHS:
                r = model.responses(x, w)
                p = r.argmax(1)
                places.append(p)
                pooled.append(np.take_along_axis(r, p[:, None], 1)[:, 0])
            hidden = np.maximum(np.concatenate(pooled, 1) + params["bias"], 0)
            prob = np.exp(log_softmax(hidden @ params["weight"] + params["offset"]))
            prob[np.arange(len(t)), t] -= 1
            delta = (prob * balance[rows][:, None] / len(t)).astype(np.float32)
            grads = {"weight": hidden.T @ delta + 1e-4 * params["weight"], "offset": delta.sum(0)}
            back = (delta @ params["weight"].T) * (hidden > 0)
            grads["bias"] = back.sum(0)
            for j, w in enumerate(WIDTHS):
                g = np.zeros_like(params[f"t{w}"])
                part = back[:, j * FILTERS : (j + 1) * FILTERS]
                for k in range(w):  # only the winning place of each filter has a gradient
                    bytes_there = np.take_along_axis(x, places[j] + k, 1)
                    np.add.at(g[k], (bytes_there, np.arange(FILTERS)[None, :].repeat(len(t), 0)), part)
                grads[f"t{w}"] = g
            step += 1
            rate = 0.01 * (1 - epoch / (EPOCHS + 1))
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] = (params[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return ByteCNN(languages, {w: params[f"t{w}"] for w in WIDTHS}, params["bias"], params["weight"], params["offset"])


def windows_of(data: np.ndarray) -> np.ndarray:
    """All consecutive windows of a text's bytes; the last is padded by going on from the start."""
    n = -(-len(data) // WINDOW)
    return np.resize(data, n * WINDOW).reshape(n, WINDOW)


def _training_rows(docs: DataFrame) -> DataFrame:
    """(lang, window) of the bounded sample."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    rate = F.floor(F.least(F.lit(1.0), F.lit(float(TRAIN_PER_LANG)) / F.col("count")) * 1_000_000)
    # a row for each language
    rates = F.broadcast(usable.groupBy("lang").count().select("lang", rate.alias("rate")))
    chosen = usable.join(rates, "lang").where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_000)) < F.col("rate")).select("doc_id", "lang", "text")

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, found = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                rng = np.random.default_rng(len(data))
                for start in sorted({int(x) for x in rng.integers(0, max(1, len(data) - WINDOW + 1), TRAIN_WINDOWS)}):
                    langs.append(lang)
                    found.append(windows_of(data[start : start + WINDOW])[0].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], names=["lang", "window"])

    return chosen.mapInArrow(cut_out, "lang string, window binary")


def fit(docs: DataFrame) -> ByteCNN | None:
    """The network for ``docs`` (doc_id, text, lang); None if there is nothing to learn from."""
    rows = sorted((r.lang, bytes(r.window)) for r in _training_rows(docs).collect())
    if not rows:
        return None
    return train(np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW), [lang for lang, _ in rows])


def _scores(model: ByteCNN, texts: list[np.ndarray]) -> tuple[list[str], list[float]]:
    """The language of each text and its probability, from the mean log-probabilities of its windows."""
    names, scores = [], []
    for data in texts:
        if len(data) == 0:
            names.append(UNKNOWN)
            scores.append(0.0)
            continue
        total, n = np.zeros(len(model.languages)), 0
        for at in range(0, len(data), 256 * WINDOW):  # bounds the memory for very long texts
            got = model.log_probabilities(windows_of(data[at : at + 256 * WINDOW]))
            total, n = total + got.sum(0, dtype=np.float64), n + len(got)
        p = np.exp(log_softmax((total / n)[None])[0])
        names.append(model.languages[int(p.argmax())])
        scores.append(float(min(1.0, p.max())))
    return names, scores


def identify(docs: DataFrame, model: ByteCNN | None = None, lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` (any columns, with doc_id, text and lang) with the columns ``lang_pred`` and ``score``; fits a network unless given one.

    Columns of ``docs`` that have these two names are replaced.
    """
    model = model or fit(docs)
    columns = [f for f in docs.schema if f.name.lower() not in (lang_pred.lower(), score.lower())]
    schema = T.StructType([*columns, T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())])
    letters = reserved(docs.columns, "__letters")
    names = [f.name for f in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = batch.column(letters).to_pylist()
            empty = np.zeros(0, np.uint8)
            texts = [np.frombuffer(t.as_buffer(), np.uint8) if good and model is not None else empty for t, good in zip(batch.column("text"), ok, strict=True)]
            langs, scores = _scores(model, texts) if model is not None else ([UNKNOWN] * len(ok), [0.0] * len(ok))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, lang_pred, score]
            )

    marked = docs.select(*(f"`{n}`" for n in names), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias(letters))
    return marked.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    model = fit(docs)
    texts = docs.select("doc_id", "text")
    found = identify(texts, model) if model is not None else texts.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The documents whose language is known (not ``und``, score >= ``least``); all columns unchanged, whatever their names."""
    pred = reserved(docs.columns, "__lang_pred")
    score = reserved(docs.columns, "__lang_score")
    return identify(docs, None, pred, score).where((F.col(pred) != UNKNOWN) & (F.col(score) >= least)).select(*(f"`{c}`" for c in docs.columns))
