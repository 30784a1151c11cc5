"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Odd 64-bit multipliers for hashes of word sequences, all arithmetic modulo 2 ** 64.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named input columns under fixed names, whatever else ``df`` holds: ``only(df, id="doc_id")``."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def unused(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores in front, so that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def utf8(text: Column) -> Column:
    """The text's bytes for Python workers; a null text is empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of every word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that low bits depend on all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sequence_hashes(words: np.ndarray, n: int, multiplier: int = MULTIPLIERS[0]) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` consecutive word hashes; empty if there are fewer."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out *= np.uint64(multiplier)
        out += words[k : k + len(out)]
    return mixed(out)


#: Bytes of text that a Python worker takes out of a batch at a time.
SLICE_BYTES = 2 << 20
#: The same of compressed text.
PACKED_BYTES = 1 << 19


def give_back() -> None:
    """Return what Arrow's pool and the allocator keep free to the system: Python workers are reused, and an idle one would hold on to the most it ever needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], *columns: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in stretches of rows whose ``columns`` (text, bytes) hold ``max_bytes`` at most, or of one row; what is
    kept free is given back when a task ends."""
    for batch in batches:
        sizes = np.full(batch.num_rows, 64, np.int64)
        for name in columns:
            sizes += pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = upto[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(upto, before + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch
    give_back()


def _encoded(text: pa.Array) -> list[bytes]:
    return pc.fill_null(text.cast(pa.binary()), b"").to_pylist()


def filtered(documents: DataFrame, keep: Callable[[bytes], bool], text: str = "text") -> DataFrame:
    """The rows whose text (its bytes; null: empty) ``keep`` accepts, with all their columns as they are."""
    at = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, text):
            good = [keep(t) for t in _encoded(some.column(at))]
            yield some.filter(pa.array(good, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def with_column(documents: DataFrame, name: str, kind: str, value: Callable[[bytes], object], text: str = "text") -> DataFrame:
    """``documents`` and one more column, made from the bytes of its text (null: empty)."""
    at = documents.columns.index(text)
    added = documents.withColumn(name, F.lit(None).cast(kind))
    arrow = to_arrow_schema(added.schema).field(name).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, text):
            made = pa.array([value(t) for t in _encoded(some.column(at))], arrow)
            yield pa.RecordBatch.from_arrays([*some.columns, made], [*some.schema.names, name])

    return documents.mapInArrow(run, added.schema)
