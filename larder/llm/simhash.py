"""SimHash near-duplicates: fingerprints of word shingles, linked through blocks that close fingerprints must share."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import only, slices, unused, utf8, with_column
from larder.operators.components import connected_components
from larder.session import cut

SHINGLE, SEED, MAX_BITS = 3, 42, 3
#: Twice as many blocks as bits may differ: three of the six are then equal, which leaves about 32 bits in a key.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: A key with more fingerprints than this is dealt out as pairs of tiles.
TILE = 2048


def masks() -> list[int]:
    """For each choice of equal blocks, the bits a key keeps. Two fingerprints with at most MAX_BITS bits apart share a key."""
    blocks, at = [], 0
    for width in BLOCKS:
        blocks.append(((1 << width) - 1) << at)
        at += width
    return [sum(kept) for kept in combinations(blocks, len(BLOCKS) - MAX_BITS)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit k is set if it is in over half of the hashes of the shingles, repeats included; 0 without a word."""
    words = text.lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(s, SEED) for s in shingles])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    total = np.zeros(64, np.int64)
    for start in range(0, len(rows), 255):  # counts fit a byte, which is many times faster to add up
        total += np.unpackbits(rows[start : start + 255], axis=1).sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * total > len(rows)).tobytes(), "big")


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) of every whole text; a null text is empty."""
    docs = only(documents, doc_id=doc_id, text=text).select("doc_id", utf8(F.col("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, "text"):
            found = np.array([fingerprint(t) for t in some.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def _chained(fps: np.ndarray, nodes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the members of each connected group of a bucket in a chain, fewer than there are members."""
    label = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits
    while True:
        low = np.where(near, label[None, :], len(fps)).min(axis=1)
        low = low[low]
        if (low == label).all():
            break
        label = low
    order = np.lexsort((nodes, label))
    same = label[order][1:] == label[order][:-1]
    return nodes[order][:-1][same], nodes[order][1:][same]


def _verified(mask: np.ndarray, key: np.ndarray, pair: np.ndarray, fp: np.ndarray, node: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Edges of whole buckets (mask, key, tile pair), whose rows lie one after another."""
    fp = fp.view(np.uint64)
    new = np.ones(len(mask), bool)
    new[1:] = (mask[1:] != mask[:-1]) | (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(mask)))
    us, vs = [], []
    # Buckets of two to four: pairs at a distance of one, two and three rows, for all buckets at once.
    bucket = np.repeat(np.arange(len(first)), size)
    small = size <= 4
    for d in (1, 2, 3):
        at = np.flatnonzero((bucket[d:] == bucket[:-d]) & small[bucket[d:]])
        at = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= max_bits]
        us.append(node[at])
        vs.append(node[at + d])
    for k in np.flatnonzero(size > 4):
        s = slice(first[k], first[k] + size[k])
        u, v = _chained(fp[s], node[s], max_bits)
        us.append(u)
        vs.append(v)
    u, v = np.concatenate(us), np.concatenate(vs)
    edges = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(edges[:, 0], pa.int64()), pa.array(edges[:, 1], pa.int64())], ["u", "v"])


def _link(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Verify the pairs inside the buckets of a task, whose rows come sorted by bucket: a batch at a time, its last bucket, which may go on,
        kept for the next."""
        kept: list[np.ndarray] | None = None
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            if kept is not None:
                columns = [np.concatenate(c) for c in zip(kept, columns, strict=True)]
            mask, key, pair = columns[:3]
            before = np.flatnonzero((mask != mask[-1]) | (key != key[-1]) | (pair != pair[-1]))
            whole = int(before[-1]) + 1 if len(before) else 0
            if whole:
                yield _verified(*[c[:whole] for c in columns], max_bits)
            kept = [c[whole:].copy() for c in columns]
        if kept is not None:
            yield _verified(*kept, max_bits)

    return run


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``nodes`` (fp, node): a chain through every group that a bucket connects."""
    keep = F.array(*[F.struct(F.lit(i).alias("mask"), F.lit(m - (1 << 64) if m >> 63 else m).alias("bits")) for i, m in enumerate(masks())])
    keyed = nodes.select("fp", "node", F.explode(keep).alias("m")).select(
        F.col("m.mask").alias("mask"), F.col("m.bits").bitwiseAND(F.col("fp")).alias("key"), "fp", "node"
    )
    sizes = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = cut(keyed.join(sizes, ["mask", "key"]))
    run, schema = _link(max_bits), "u long, v long"
    usual = shared.filter(F.col("n") <= TILE).select("mask", "key", F.lit(0).alias("pair"), "fp", "node")
    # Beyond a tile: each row goes to the pairs of tiles that hold its own, so every pair of rows meets in one of them.
    tiles = F.ceil(F.col("n") / (TILE // 2)).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    met = F.transform(F.sequence(F.lit(0), tiles - 1), lambda t: F.least(t, own) * tiles + F.greatest(t, own))
    large = shared.filter(F.col("n") > TILE).select("mask", "key", F.explode(met).alias("pair"), "fp", "node")
    found = [
        rows.repartition("mask", "key", "pair").sortWithinPartitions("mask", "key", "pair", "fp").mapInArrow(run, schema) for rows in (usual, large)
    ]
    return found[0].unionByName(found[1])


def _grouped(marks: DataFrame, max_bits: int) -> DataFrame:
    """(fp, node, component) of every distinct fingerprint in (doc_id, fp), written out."""
    nodes = cut(marks.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")))
    return cut(connected_components(links(nodes, max_bits), nodes, []).select("fp", "node", "component"))


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id: the smallest doc_id reachable by fingerprints at most ``max_bits`` apart.

    Equal fingerprints are one node, so copies make no pairs. Null and empty texts have fingerprint zero, linked like any
    other. Repeated rows give repeated rows. A null doc_id is returned; it never names a group, so a group of such rows alone
    links with nothing and has a null component. Other columns are ignored.
    """
    marks = cut(fingerprints(documents, doc_id, text))
    groups = _grouped(marks, max_bits)
    found = marks.join(groups.select("fp", "component"), "fp", "left")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def kept_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``documents`` for each group of near-duplicates, that of the smallest doc_id, with all its columns.

    Of repeated rows one stays. Rows of a null doc_id count as copies only by their fingerprint: one stays if no other row has it.
    """
    signed = lambda t: int(np.uint64(fingerprint(t)).view(np.int64))
    fp = unused(documents, "fp")
    marked = cut(with_column(documents, fp, "long", signed, text))
    groups = _grouped(marked.select(F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp")), max_bits)
    first = groups.filter("node = component").select(F.col("fp").alias(fp), F.col("node").alias(doc_id))
    named = marked.join(first, [fp, doc_id], "left_semi")
    unnamed = marked.filter(F.col(doc_id).isNull()).join(groups.select(F.col("fp").alias(fp)), fp, "left_anti")
    return named.unionByName(unnamed).dropDuplicates([fp, doc_id]).select(documents.columns)
