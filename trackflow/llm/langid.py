"""Language identification by a convolutional network over bytes, trained here.

A text is cut into windows of ``WINDOW`` bytes. Bytes are embedded, filters of several widths run
over each window, the largest answer of each filter is kept, and a softmax gives the languages.
A text's probabilities are the mean over all its windows, weighted by their bytes.

The model learns from a bounded sample of labelled rows (``SAMPLE``; one random passage of
``PASSAGE`` characters of each), drawn over the whole table by a hash of the row. All rows are
predicted on whole texts; the label, the source and the id are no inputs of a prediction.

Defined results: ``und`` with score 0 for a null text, one without letters, and every text when
nothing labelled was there to learn from. Rows with a null id or label are never learned from.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.llm.shared import text_rows

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
SAMPLE = 4_000
PASSAGE = 1_024
EPOCHS = 6
BATCH = 64
RATE = 0.004
FOLDS = 5
WINDOWS_AT_ONCE = 256
TEXT_AT_ONCE = 200_000
UNKNOWN = "und"


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo the number of folds; fold 0 is held out."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "utf-8")) % FOLDS


def training_sample(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``lang, passage`` of at most ``size`` labelled rows outside the held-out fold."""
    order = F.xxhash64("doc_id", "lang")
    labelled = (fold() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    # A first cut by hash, so that no task sends more than its share of the sample.
    rows = docs.where(labelled).count()
    share = min(1.0, (1.25 * size + 100) / max(rows, 1))
    highest = F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1)
    start = F.pmod(F.xxhash64("lang", "doc_id"), F.greatest(F.char_length("text") - PASSAGE, F.lit(1)))
    return (
        docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang")
        .where(labelled & (order <= highest))
        .select(
            "lang",
            F.col("text").substr(start.cast("int") + 1, F.lit(PASSAGE)).alias("passage"),
            order.alias("order"),
            "doc_id",
        )
        .orderBy("order", "doc_id", "lang", "passage")
        .limit(size)
        .select("lang", "passage")
    )


def windows(data: bytes) -> np.ndarray:
    """Rows of WINDOW bytes; the last one is filled with zeros."""
    rows = -(-len(data) // WINDOW)
    return np.frombuffer(data.ljust(rows * WINDOW, b"\0"), np.uint8).reshape(rows, WINDOW)


class Network:
    """Embedding, filters of all widths in one matrix (narrow ones end in zeros), softmax."""

    def __init__(self, classes: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        wide, count = max(WIDTHS) * EMBEDDING, FILTERS * len(WIDTHS)
        self.classes = classes
        self.reach = np.zeros((wide, count), np.float32)
        for n, width in enumerate(WIDTHS):
            self.reach[: width * EMBEDDING, n * FILTERS : (n + 1) * FILTERS] = 1
        self.weights = {
            "embedding": rng.normal(0, 0.5, (256, EMBEDDING)),
            "filters": rng.normal(0, 0.25, (wide, count)) * self.reach,
            "bias": np.zeros(count),
            "out": rng.normal(0, 0.15, (count, len(classes))),
            "out_bias": np.zeros(len(classes)),
        }
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def patches(self, data: np.ndarray) -> np.ndarray:
        wide = max(WIDTHS)
        padded = np.pad(data, ((0, 0), (0, wide - 1)))
        embedded = self.weights["embedding"][padded]
        a, b, c = embedded.strides
        shape = (len(data), WINDOW, wide * EMBEDDING)
        view = np.lib.stride_tricks.as_strided(embedded, shape, (a, b, c))
        return np.ascontiguousarray(view).reshape(-1, shape[2])

    def pooled(self, patches: np.ndarray) -> np.ndarray:
        return (patches @ self.weights["filters"]).reshape(-1, WINDOW, self.reach.shape[1])

    def softmax(self, peak: np.ndarray) -> np.ndarray:
        hidden = np.maximum(peak + self.weights["bias"], 0)
        raw = hidden @ self.weights["out"] + self.weights["out_bias"]
        raw = np.exp(raw - raw.max(axis=1, keepdims=True))
        return raw / raw.sum(axis=1, keepdims=True)

    def predict(self, data: np.ndarray) -> np.ndarray:
        parts = [
            self.softmax(self.pooled(self.patches(data[at : at + WINDOWS_AT_ONCE])).max(axis=1))
            for at in range(0, len(data), WINDOWS_AT_ONCE)
        ]
        return np.vstack(parts)

    def gradients(self, data: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> dict:
        patches = self.patches(data)
        answers = self.pooled(patches)
        place = answers.argmax(axis=1)
        peak = np.take_along_axis(answers, place[:, None], 1)[:, 0]
        open_ = peak + self.weights["bias"]
        hidden = np.maximum(open_, 0)
        error = self.softmax(peak)
        error[np.arange(len(data)), wanted] -= 1
        error *= weight[wanted][:, None] / len(data)
        back = (error @ self.weights["out"].T) * (open_ > 0)
        row = np.arange(len(data))[:, None]
        chosen = patches.reshape(len(data), WINDOW, -1)[row, place]
        filters = np.einsum("nfp,nf->pf", chosen, back) * self.reach
        to_patch = back[:, :, None] * self.weights["filters"].T[None]
        padded = np.pad(data, ((0, 0), (0, max(WIDTHS) - 1)))
        embedding = np.zeros_like(self.weights["embedding"])
        for step in range(max(WIDTHS)):
            part = to_patch[:, :, step * EMBEDDING : (step + 1) * EMBEDDING]
            np.add.at(embedding, padded[row, place + step], part)
        return {
            "embedding": embedding,
            "filters": filters,
            "bias": back.sum(axis=0),
            "out": hidden.T @ error,
            "out_bias": error.sum(axis=0),
        }


def train(sample: list[tuple[str, str]], seed: int = 0) -> Network | None:
    """A network from (language, passage) pairs; None without any. Adam, rare languages weighted."""
    classes = sorted({lang for lang, _ in sample})
    data, wanted = [], []
    for lang, passage in sample:
        if passage:
            cut = windows(passage.encode())
            data.append(cut)
            wanted += [classes.index(lang)] * len(cut)
    if not data:
        return None
    rows, answers = np.vstack(data), np.array(wanted)
    share = np.bincount(answers, minlength=len(classes)).astype(np.float32)
    weight = (np.sqrt(share.max() / np.maximum(share, 1))).astype(np.float32)
    network = Network(classes, seed)
    rng = np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in network.weights.items()}
    spread = {k: np.zeros_like(v) for k, v in network.weights.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            step += 1
            for k, g in network.gradients(rows[pick], answers[pick], weight).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                spread[k] = 0.999 * spread[k] + 0.001 * g * g
                high = np.sqrt(spread[k] / (1 - 0.999**step)) + 1e-8
                network.weights[k] -= (RATE * mean[k] / (1 - 0.9**step) / high).astype(np.float32)
    return network


def fit(docs: DataFrame, size: int = SAMPLE) -> Network | None:
    return train([(r[0], r[1]) for r in training_sample(docs, size).collect()])


def _predictions(network: Network, texts: list[str]) -> list[tuple[str, float]]:
    """Each text's language and probability; windows of many texts go through in one batch."""
    data = [text.encode() for text in texts]
    cut = [windows(x) for x in data]
    found = network.predict(np.vstack(cut))
    out, at = [], 0
    for raw, rows in zip(data, cut, strict=True):
        held = np.full(len(rows), WINDOW, np.float64)
        held[-1] = len(raw) - WINDOW * (len(rows) - 1)
        mean = (found[at : at + len(rows)] * held[:, None]).sum(axis=0) / held.sum()
        at += len(rows)
        best = int(mean.argmax())
        out.append((network.classes[best], float(min(mean[best], 1.0))))
    return out


def prediction(network: Network | None, text: Column) -> Column:
    """``lang_pred`` and ``score`` of a text column, for rows that keep their other columns."""

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(_answers(network, texts.fillna("")), columns=["lang_pred", "score"])

    return run(text)


def _answers(network: Network | None, texts: Iterable[str]) -> list[tuple[str, float]]:
    """Predictions in the order of the texts; windows go through the network in bounded batches."""
    answers: list[tuple[str, float]] = []
    places: list[int] = []
    held: list[str] = []

    def flush() -> None:
        if held:
            for place, answer in zip(places, _predictions(network, held), strict=True):
                answers[place] = answer
        places.clear()
        held.clear()

    size = 0
    for text in texts:
        answers.append((UNKNOWN, 0.0))
        if network and any(map(str.isalpha, text)):
            places.append(len(answers) - 1)
            held.append(text)
            size += len(text)
        if size >= TEXT_AT_ONCE:
            flush()
            size = 0
    flush()
    return answers


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every document."""
    source = text_rows(docs)
    shipped = docs.sparkSession.sparkContext.broadcast(network)
    key_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            answers = _answers(model, (text.as_py() for text in batch.column(1)))
            langs, scores = zip(*answers, strict=True) if answers else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return source.mapInArrow(run, f"doc_id {key_type}, lang_pred string, score double")
