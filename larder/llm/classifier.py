"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import filtered, give_back, only, slices, utf8
from larder.llm.tokens import hashed_ngrams

BITS, THRESHOLD = 18, 0.7
#: The fit uses this many labelled rows at most: those with the smallest hash of doc_id.
FIT_ROWS, EPOCHS = 12_000, 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.1, 0.1
#: Weights: a bucket each, the share of repeated n-grams, the bias.
SIZE = (1 << BITS) + 2


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features as bucket numbers and values: damped counts of n-grams scaled to length one, the log of n-grams per distinct
    n-gram, and the bias."""
    grams, counts = np.unique(hashed_ngrams(text, BITS), return_counts=True)
    values = 1.0 + np.log(counts)
    if len(values):
        values /= np.sqrt((values * values).sum())
    repeats = np.log(counts.sum() / len(counts)) if len(counts) else 0.0
    return np.append(grams, (SIZE - 2, SIZE - 1)), np.append(values, (repeats, 1.0))


def train(examples: list[tuple[bytes, int]]) -> np.ndarray:
    """Weights from examples in the given order, by per-coordinate FTRL-proximal updates."""
    z, n = np.zeros(SIZE), np.zeros(SIZE)

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    sparse = [(*features(text), label) for text, label in examples]
    for _ in range(EPOCHS):
        for at, x, label in sparse:
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -35.0, 35.0))) - label) * x
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[at] = zi + g - sigma * w
            n[at] = ni + g * g
    return weights(z, n)


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Weights learnt from labelled documents that are not held out, ``fit_rows`` of them at most, in one task.

    Rows without a label of 0 or 1, and all but one label of a document, are left out (the smallest label counts). Without any
    labelled row all weights are 0, which scores 0.5.
    """
    marked = only(labels, doc_id="doc_id", label="quality").filter("label IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    one = marked.groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    order = F.xxhash64("doc_id")
    # A bounded sample, so a bounded broadcast.
    chosen = F.broadcast(one.orderBy(order, "doc_id").limit(fit_rows))
    docs = only(documents, doc_id="doc_id", text="text").select("doc_id", utf8(F.col("text")).alias("text"))
    sample = docs.join(chosen, "doc_id").select("doc_id", "label", "text", order.alias("order"), F.lit(0).alias("all"))

    def run(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["order", "doc_id", "text"]).drop_duplicates("doc_id").head(fit_rows)
        w = train(list(zip(frame["text"], frame["label"], strict=True)))
        give_back()  # the examples' features
        return pd.DataFrame({"w": [w.astype(np.float32).tobytes()]})

    found = sample.groupBy("all").applyInPandas(run, "w binary").collect()
    return np.frombuffer(bytes(found[0].w), np.float32) if found else np.zeros(SIZE, np.float32)


def probability(text: bytes, weights: np.ndarray) -> float:
    at, x = features(text)
    return float(1.0 / (1.0 + np.exp(-np.clip(weights[at].astype(np.float64) @ x, -35.0, 35.0))))


def score(documents: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted of every document, from its whole text alone.

    A null or empty text is scored by the bias. Repeated rows give repeated rows, other columns are ignored.
    """
    docs = only(documents, doc_id="doc_id", text="text").select("doc_id", utf8(F.col("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, "text"):
            out = [probability(text, weights) for text in some.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.mapInArrow(run, f"doc_id {kind}, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``score`` of every row of ``documents`` with the weights that ``fit`` learns from ``labels``: repeated rows give repeated rows, an empty table gives none, and
    without any usable label every score is 0.5."""
    return score(documents, fit(documents, labels))


def kept_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, training: DataFrame | None = None) -> DataFrame:
    """The rows of ``documents`` that score at least ``threshold``, with all their columns.

    The fit uses ``training``, or ``documents`` themselves without it. Rows that an earlier rule has filtered hold few examples of label 0. Repeated rows stay or go
    together, null and empty texts are scored by the bias, an empty table stays empty; without any usable label nothing reaches 0.7, and no row is kept.
    """
    weights = fit(documents if training is None else training, labels)
    return filtered(documents, lambda text: probability(text, weights) >= threshold)
