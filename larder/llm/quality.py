"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio of a trusted target against the raw corpus."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import PACKED_BYTES, filtered, only, sequence_hashes, slices, utf8, word_hashes
from larder.llm.tokens import hashed_ngrams

#: Buckets of the two multinomials (2 ** BITS), rows they are sent in, and pseudo-counts that pull rare buckets to a ratio of 1.
BITS, SLICES, SMOOTHING = 18, 64, 20.0
#: A document whose mean log ratio is below this is rejected.
THRESHOLD = -0.3
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5

_SYMBOLS = b"#*$%&|<>"
_SPACE = b"\t\n\x0b\x0c\r "
#: UTF-8 continuation bytes and white space: what is left has one byte for each code point in words.
_NOT_WORD_CHARS = bytes(range(0x80, 0xC0)) + _SPACE


def base_counts(text: bytes) -> dict:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = 0
    windows = sequence_hashes(word_hashes(words), WINDOW)
    if len(windows) > 1:
        ordered = np.sort(windows)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            at = np.flatnonzero(np.isin(windows, twice))
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + WINDOW, -1)
            repeated = int((np.cumsum(edge) > 0).sum())
    return {
        "n_words": len(words),
        "word_chars": len(text.translate(None, _NOT_WORD_CHARS)),
        "n_symbols": len(text) - len(text.translate(None, _SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated,
    }


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for some in slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([some.column(0), pa.array([pack.compress(t) for t in some.column(1).to_pylist()], pa.binary())], ["doc_id", "text"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all n-grams of a task's documents and of its trusted ones, one row for each slice of buckets."""
    total = np.zeros((2, 1 << BITS), np.uint32)
    waiting: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
    seen = False

    def add() -> None:
        for k, grams in enumerate(waiting):
            if grams:
                total[k] += np.bincount(np.concatenate(grams), minlength=1 << BITS).astype(np.uint32)
                grams.clear()

    unpack = zstandard.ZstdDecompressor()
    for some in slices(batches, "text", max_bytes=PACKED_BYTES):
        held = 0
        for data, trusted in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
            seen = True
            grams = hashed_ngrams(unpack.decompress(data), BITS)
            held += len(grams)
            waiting[0].append(grams)
            if trusted:
                waiting[1].append(grams)
            if held > 2_000_000:
                add()
                held = 0
        add()
    if seen:
        parts = total.reshape(2, SLICES, -1)
        data = [zlib.compress(np.ascontiguousarray(parts[:, k]).tobytes(), 1) for k in range(SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(data, pa.binary())], ["slice", "counts"])


def _add(key: tuple, group: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros((2, (1 << BITS) // SLICES), np.int64)
    for frame in group:
        for data in frame["counts"]:
            total += np.frombuffer(zlib.decompress(data), np.uint32).reshape(total.shape)
    yield pd.DataFrame({"slice": [key[0]], "counts": [total.tobytes()]})


def fit_ratio(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> np.ndarray:
    """Log ratio per bucket, trusted against raw, from every document: the trusted target are all documents labelled 1.

    What reaches the driver are the 2 ** BITS pairs of counts, whatever the corpus. Counts are added up inside each task first.
    A bucket that was never or rarely seen has a ratio near 0; without any trusted document all ratios are 0.
    """
    docs = only(documents, doc_id=doc_id, text=text).select("doc_id", utf8(F.col("text")).alias("text"))
    docs = docs.mapInArrow(_packed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text binary")
    trusted = only(labels, doc_id=doc_id, quality=quality).filter("quality = 1").select("doc_id").distinct().withColumn("trusted", F.lit(True))
    # Labels grow with the corpus, so texts meet them in a shuffle at every size, compressed.
    flagged = docs.join(trusted.hint("merge"), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counts = flagged.mapInArrow(_count, "slice int, counts binary").groupBy("slice").applyInPandas(_add, "slice int, counts binary")
    raw, target = np.zeros(1 << BITS), np.zeros(1 << BITS)
    width = (1 << BITS) // SLICES
    for row in counts.collect():
        pair = np.frombuffer(bytes(row.counts), np.int64).reshape(2, -1)
        raw[row.slice * width : (row.slice + 1) * width] = pair[0]
        target[row.slice * width : (row.slice + 1) * width] = pair[1]
    if not target.sum():
        return np.zeros(1 << BITS, np.float32)
    share = target.sum() / raw.sum()
    return np.log((target + SMOOTHING * share) / ((raw + SMOOTHING) * share)).astype(np.float32)


def mean_ratio(text: bytes, ratio: np.ndarray) -> float:
    """The mean log ratio of a text's n-grams, to 6 digits; 0 without any."""
    grams = hashed_ngrams(text, BITS)
    return round(float(ratio[grams].sum(dtype=np.float64) / len(grams)), 6) if len(grams) else 0.0


_SCORED = "doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double"


def score(documents: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's base counts, ratio (mean log ratio of its n-grams), base_failed and kept.

    Kept are documents that pass the base rule and whose ratio, rounded to 6 digits, is not below ``threshold``. A null text is
    empty and fails the base rule; a text without n-grams has ratio 0. Repeated rows give repeated rows, other columns are ignored, an
    empty table gives none.
    """
    docs = only(documents, doc_id=doc_id, text=text).select("doc_id", utf8(F.col("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, "text"):
            rows = []
            for data in some.column(1).to_pylist():
                rows.append(base_counts(data) | {"ratio": mean_ratio(data, ratio)})
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            columns = [pa.array([r[n] for r in rows], pa.int64()) for n in names] + [pa.array([r["ratio"] for r in rows], pa.float64())]
            yield pa.RecordBatch.from_arrays([some.column(0), *columns], ["doc_id", *names, "ratio"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.mapInArrow(run, _SCORED.format(id=kind))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))


def quality_rules(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``score`` of every row of ``documents`` with the ratio of its own corpus: repeated rows give repeated rows (and count each time), an empty table gives none."""
    return score(documents, fit_ratio(documents, labels), threshold)


def kept_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``documents`` that the rules keep, with all their columns and without a shuffle of them. Repeated rows stay or go together, null and empty
    texts go, an empty table stays empty; without a document labelled 1 only the base rule decides."""
    ratio = fit_ratio(documents, labels)

    def good(data: bytes) -> bool:
        counts = base_counts(data)
        failed = counts["n_words"] < MIN_WORDS or 100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
        return not failed and mean_ratio(data, ratio) >= threshold

    return filtered(documents, good, text)
