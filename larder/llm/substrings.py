"""Substring dedup: passages that share an anchor meet in a shard, whose FM-index gives the matching statistics of each of them."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import MULTIPLIERS, PACKED_BYTES, give_back, mixed, only, sequence_hashes, slices, unused, utf8, with_column, word_hashes
from larder.llm.fm_index import FMIndex, matching_lengths
from larder.session import cut

#: Words in a window that must not recur, and in the runs whose hashes choose a window's anchor.
WINDOW, GRAM = 35, 8
#: Words that a shard's index holds on average; an anchor with more distinct passages than HOT is dealt out by windows.
SHARD_WORDS, HOT = 250_000, 8_192
#: Bytes of cut out passages that a task holds before it passes them on.
SENT_BYTES = 2 << 20


def passages(words: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, content hash, first window and number of windows of each passage of a text.

    A window's anchor is the smallest hash, the leftmost among equals, of the runs of GRAM words inside it, so equal windows have equal
    anchors at equal places. A passage are the consecutive windows with one anchor, ``window - GRAM + 1`` at most. Every window lies in exactly one.
    """
    empty = np.empty(0, np.int64)
    if len(words) < window:
        return empty, empty, empty, empty
    hashed = word_hashes(words)
    grams = sequence_hashes(hashed, GRAM)
    inside = window - GRAM + 1
    at = np.lib.stride_tricks.sliding_window_view(grams, inside).argmin(axis=1) + np.arange(len(grams) - inside + 1)
    start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    count = np.diff(np.append(start, len(at)))
    # Hash of the passage's words: differences of one running sum, brought to a common power of the multiplier.
    power = np.cumprod(np.full(len(words), MULTIPLIERS[1], np.uint64), dtype=np.uint64)
    back = np.cumprod(np.full(len(words), pow(MULTIPLIERS[1], -1, 1 << 64), np.uint64), dtype=np.uint64)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed * power, dtype=np.uint64)])
    content = mixed((running[start + count + window - 1] - running[start]) * back[start] + count.astype(np.uint64))
    return grams[at[start]].view(np.int64), content.view(np.int64), start, count


def _kept_digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _key(text: bytes) -> bytes:
    return xxhash.xxh3_128_digest(text)


def _cover(n: int, starts: list[int], masks: list[int], window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that is marked in its passage's mask."""
    edge = np.zeros(n + 1, np.int64)
    for start, mask in zip(starts, masks, strict=True):
        offset = start + np.flatnonzero((mask >> np.arange(window, dtype=np.int64)) & 1)
        np.add.at(edge, offset, 1)
        np.add.at(edge, offset + window, -1)
    return np.cumsum(edge[:-1]) > 0


def search_shard(texts: list[bytes], weights: np.ndarray, window: int = WINDOW) -> list[int]:
    """For each passage, a bit for every window of it that recurs among the passages of the shard.

    ``weights`` counts how often a passage stands in the corpus as a whole. Passages of weight one are streamed against the
    index of all; in the others every window is known to recur, as the passage does, but the index holds them for the rest.
    """
    words = [t.split(b" ") for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    codes, _ = pd.factorize(np.array([x for w in words for x in w], object))
    # A word found once cannot be in a window found twice: like a separator, it ends every search.
    often = np.bincount(codes) > 1
    symbol = np.where(often, np.cumsum(often), 0)[codes]
    first = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    place = np.repeat(first, sizes) + np.arange(len(symbol)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text[place] = symbol
    heavy = np.repeat(weights > 1, sizes + 1)
    index = FMIndex(text, window)
    counts = sizes - window + 1
    alone = np.flatnonzero(weights == 1)
    own = np.repeat(alone, counts[alone])
    offset = np.arange(len(own)) - np.repeat(np.cumsum(counts[alone]) - counts[alone], counts[alone])
    lengths = matching_lengths(index, text, first[own] + offset + window - 1, window, heavy)
    masks = np.where(weights > 1, (np.int64(1) << counts) - 1, 0)
    found = lengths >= window
    np.bitwise_or.at(masks, own[found], np.int64(1) << offset[found])
    return masks.tolist()


def repeated_windows(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three written tables: documents (doc_id, text_key, n_words, whole_sha256), texts with anything to compare (text_key, text compressed)
    and marks (text_key, marks: array of passage start and mask of recurring windows)."""
    docs = only(documents, doc_id=doc_id, text=text).select("doc_id", utf8(F.col("text")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, "text"):
            keys, sizes, digests, lists = [], [], [], ([], [], [], [])
            for data in some.column(2).to_pylist():
                words = data.split()
                keys.append(_key(data))
                sizes.append(len(words))
                digests.append(_kept_digest(words))
                for to, values in zip(lists, passages(words, window), strict=True):
                    to.append(values)
            columns = [pa.array(x, pa.list_(kind)) for x, kind in zip(lists, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*some.columns[:2], pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), *columns],
                ["row", "doc_id", "text_key", "n_words", "whole_sha256", "anchor", "content", "start", "windows"],
            )

    schema = f"row long, doc_id {kind}, text_key binary, n_words long, whole_sha256 string, anchor array<long>, content array<long>, start array<int>, windows array<int>"
    marked = cut(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(scan, schema))
    found = marked.select("row", F.inline(F.arrays_zip("anchor", "content", "start", "windows")))
    # An anchor found once has no window that recurs. Written out, so that a hot anchor's rows can be split in the join.
    shared = cut(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"))
    places = cut(found.join(shared, "anchor"))
    distinct = cut(
        places.groupBy("anchor", "content").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "start")).alias("first"), F.first("windows").alias("windows")
        )
    )
    words = distinct.agg(F.sum(F.col("windows") + window - 1).alias("words")).first().words or 0
    shards = max(1, math.ceil(words / SHARD_WORDS))
    hot = cut(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("anchor", F.lit(True).alias("hot")))
    sources = distinct.join(hot, "anchor", "left").groupBy(F.col("first.row").alias("row")).agg(
        F.collect_list(F.struct("anchor", "content", "n", F.col("first.start").alias("start"), "windows", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("sources")
    )
    # One row stands for all copies of a text; it carries whatever passages any of the copies was chosen as the source of.
    keys = marked.select("row", "text_key", "doc_id")
    needed = places.select("row").distinct().join(keys, "row").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    listed = sources.join(keys, "row").groupBy("text_key").agg(F.flatten(F.collect_list("sources")).alias("sources"))
    needed = cut(needed.join(listed, "text_key", "left"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for some in slices(batches, "text"):
            data = some.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([_key(t) for t in data], pa.binary()), some.column(0), pa.array([pack.compress(t) for t in data], pa.binary())], ["text_key", "id", "text"]
            )

    sent = docs.mapInArrow(packed, f"text_key binary, id {kind}, text binary")
    both = sent.join(needed.withColumnRenamed("text_key", "key"), (F.col("text_key") == F.col("key")) & F.col("id").eqNullSafe(F.col("doc_id")))
    texts = cut(both.select("text_key", "text", "sources"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        names = ["shard", "anchor", "content", "n", "shift", "words"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for some in slices(batches, "text", max_bytes=PACKED_BYTES):
            rows: list[tuple] = []
            held = 0
            for data, wanted in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                words = unpack.decompress(data).split()
                for p in wanted or ():
                    if not p["hot"]:
                        piece = b" ".join(words[p["start"] : p["start"] + p["windows"] + window - 1])
                        rows.append((p["anchor"] % shards, p["anchor"], p["content"], p["n"], 0, piece))
                        held += len(piece)
                        continue
                    for k in range(p["windows"]):
                        piece = b" ".join(words[p["start"] + k : p["start"] + k + window])
                        rows.append((xxhash.xxh64_intdigest(piece) % shards, p["anchor"], p["content"], p["n"], k, piece))
                        held += len(piece)
                if held > SENT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    pieces = texts.filter("sources IS NOT NULL").select("text", "sources").mapInArrow(cut_out, "shard int, anchor long, content long, n long, shift int, words binary")

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        masks = search_shard(frame["words"].tolist(), frame["n"].to_numpy(np.int64), window)
        give_back()  # the shard's words and index
        out = frame[["anchor", "content"]].assign(mask=np.array(masks, np.int64) << frame["shift"].to_numpy(np.int64))
        return out[out["mask"] != 0]

    masks = cut(pieces.groupBy("shard").applyInPandas(search, "anchor long, content long, mask long").groupBy("anchor", "content").agg(F.bit_or("mask").alias("mask")))
    marks = places.join(masks, ["anchor", "content"]).groupBy("row").agg(F.collect_list(F.struct("start", "mask")).alias("marks"))
    one = marks.join(keys, "row").groupBy("text_key").agg(F.min(F.struct("row", "marks")).alias("m")).select("text_key", F.col("m.marks").alias("marks"))
    return marked.select("doc_id", "text_key", "n_words", "whole_sha256"), texts.select("text_key", "text"), cut(one)


def _changed(texts: DataFrame, marks: DataFrame, window: int, with_text: bool) -> DataFrame:
    """(text_key, n_removed, kept_sha256 and, if asked for, kept) of every text that loses words, written out."""
    result = "text_key binary, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for some in slices(batches, "text", max_bytes=PACKED_BYTES):
            removed, digests, kept = [], [], []
            for data, found in zip(some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True):
                words = unpack.decompress(data).split()
                gone = _cover(len(words), [m["start"] for m in found], [m["mask"] for m in found], window)
                left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                removed.append(len(words) - len(left))
                digests.append(_kept_digest(left))
                kept.append(b" ".join(left).decode() if with_text else None)
            columns = [some.column(0), pa.array(removed, pa.int64()), pa.array(digests, pa.string())] + [pa.array(kept, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays(columns, ["text_key", "n_removed", "kept_sha256"] + ["kept"] * with_text)

    return cut(texts.join(marks, "text_key").select("text_key", "text", "marks").mapInArrow(keep, result).dropDuplicates(["text_key"]))


def remove_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words joined by one space) of every document.

    Every word covered by a window of ``window`` words that also starts anywhere else goes, in all its places; windows are
    judged on the input. A null, empty or shorter text has no window and keeps its words. Repeated rows are
    copies: all their windows go. Other columns are ignored, an empty table gives no rows. Windows are matched by 64-bit hashes only to bring
    them together; what recurs is decided on the words themselves, except that passages equal in both of two 64-bit hashes are one.
    """
    marked, texts, marks = repeated_windows(documents, doc_id, text, window)
    out = marked.join(_changed(texts, marks, window, False), "text_key", "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )


def cleaned_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``documents`` with the kept words, joined by one space, as the text of those that lose words; no row and no other text changes."""
    marked, texts, marks = repeated_windows(documents, doc_id, text, window)
    key, kept = unused(documents, "text_key"), unused(documents, "kept")
    changed = _changed(texts, marks, window, True).select(F.col("text_key").alias(key), F.col("kept").alias(kept))
    joined = with_column(documents, key, "binary", _key, text).join(changed, key, "left")
    return joined.withColumn(text, F.coalesce(kept, text)).select(documents.columns)
