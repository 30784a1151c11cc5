"""Centrality of products in the co-occurrence graph (undirected weighted edges a < b)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.session import cut, drop_cut


def both_directions(edges: DataFrame, a: str, b: str, weight: str) -> DataFrame:
    forward = edges.select(F.col(a).alias("src"), F.col(b).alias("dst"), F.col(weight).alias("w"))
    backward = edges.select(F.col(b).alias("src"), F.col(a).alias("dst"), F.col(weight).alias("w"))
    return forward.unionByName(backward)


def degree_centrality(edges: DataFrame, a: str = "product_a", b: str = "product_b", weight: str = "n_pairs") -> DataFrame:
    """Neighbours and summed edge weight of every product."""
    return (
        both_directions(edges, a, b, weight)
        .groupBy(F.col("src").alias("product_id"))
        .agg(F.count(F.lit(1)).alias("degree"), F.sum("w").alias("weighted_degree"))
    )


# Nodes of a block on average, and the most blocks.
BLOCK_NODES, MAX_BLOCKS = 50_000, 4_096


def _packed_edges(shares: DataFrame, nodes: DataFrame) -> DataFrame:
    """(src_block, dst_block, part, srcs, dsts, weights): edges between two blocks as arrays of places in them, written once."""
    name = lambda side: nodes.select(F.col("node").alias(side), F.col("block").alias(f"{side}_block"), F.col("at").alias(f"{side}_at"))
    placed = shares.join(name("src"), "src").join(name("dst"), "dst")

    def pack(batches):
        for pdf in batches:
            for (a, b), part in pdf.groupby(["src_block", "dst_block"], sort=False):
                yield pd.DataFrame([{
                    "src_block": a, "dst_block": b, "srcs": part["src_at"].to_numpy(np.int32).tobytes(), "dsts": part["dst_at"].to_numpy(np.int32).tobytes(),
                    "weights": part["share"].to_numpy(np.float64).tobytes(),
                }])

    ordered = placed.select("src_block", "dst_block", "src_at", "dst_at", "share").repartition("src_block", "dst_block").sortWithinPartitions("src_block", "dst_block")
    return cut(ordered.mapInPandas(pack, "src_block int, dst_block int, srcs binary, dsts binary, weights binary"))


def _sent(batches):
    """What the nodes of a block pass on to those of another: one array of sums for each pair of blocks."""
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            srcs, dsts = np.frombuffer(r.srcs, np.int32), np.frombuffer(r.dsts, np.int32)
            passed = np.frombuffer(r.ranks, np.float64)[srcs] * np.frombuffer(r.weights, np.float64)
            yield pd.DataFrame([{"block": r.dst_block, "sums": np.bincount(dsts, passed).tobytes()}])


def _received(base: float, damping: float):
    def add(key: tuple, sent: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        before = np.frombuffer(old["ranks"].iloc[0], np.float64)
        total = np.zeros(len(before))
        for data in sent["sums"]:
            part = np.frombuffer(data, np.float64)
            total[: len(part)] += part
        ranks = base + damping * total
        return pd.DataFrame([{"block": key[0], "ranks": ranks.tobytes(), "change": float(np.abs(ranks - before).sum())}])

    return add


def pagerank(
    edges: DataFrame,
    a: str = "product_a",
    b: str = "product_b",
    weight: str = "n_pairs",
    damping: float = 0.85,
    iterations: int = 20,
    residual: float = 1e-9,
    block_nodes: int = BLOCK_NODES,
) -> DataFrame:
    """Weighted PageRank, in at most ``iterations`` rounds or until all ranks together change by ``residual`` at most; every product of an undirected graph has an outgoing edge.

    Nodes are dealt out to blocks and edges packed by pair of blocks, once. The packed edges stay where they are, kept by the block they start
    from; in a round only the blocks' ranks and one array of sums per pair of blocks move.
    """
    links = both_directions(edges, a, b, weight)
    out = links.groupBy("src").agg(F.sum("w").cast("double").alias("total"))
    shares = cut(links.join(out, "src").select("src", "dst", (F.col("w") / F.col("total")).alias("share")))
    nodes = shares.select(F.col("src").alias("node")).distinct()
    n = nodes.count()
    if not n:
        return nodes.select(F.col("node").alias("product_id"), F.lit(0.0).alias("rank"))
    blocks = max(1, min(MAX_BLOCKS, -(-n // block_nodes)))
    order = W.partitionBy("block").orderBy("node")
    nodes = cut(nodes.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")).withColumn("at", F.row_number().over(order) - 1))
    packed = _packed_edges(shares, nodes)
    # Kept in place by source block, which the ranks then join without moving the edges again; what an executor loses is read again.
    placed = packed.repartition("src_block").persist(StorageLevel.MEMORY_AND_DISK)
    base = (1.0 - damping) / n
    first = F.udf(lambda m: np.full(m, 1.0 / n).tobytes(), "binary")  # one call a block
    ranks = cut(nodes.groupBy("block").agg(F.count(F.lit(1)).cast("int").alias("n")).select("block", first("n").alias("ranks")))
    schema = "block int, ranks binary, change double"
    for _ in range(iterations):
        joined = placed.join(ranks.select(F.col("block").alias("src_block"), "ranks"), "src_block")
        sent = joined.select("dst_block", "srcs", "dsts", "weights", "ranks").mapInPandas(_sent, "block int, sums binary")
        grown = cut(sent.groupBy("block").cogroup(ranks.groupBy("block")).applyInPandas(_received(base, damping), schema))
        drop_cut(ranks)
        ranks = grown
        if ranks.agg(F.sum("change")).first()[0] <= residual:
            break
    placed.unpersist()

    def unpack(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                values = np.frombuffer(r.ranks, np.float64)
                yield pd.DataFrame({"block": np.int32(r.block), "at": np.arange(len(values), dtype=np.int32), "rank": values})

    found = ranks.select("block", "ranks").mapInPandas(unpack, "block int, at int, rank double")
    return nodes.join(found, ["block", "at"]).select(F.col("node").alias("product_id"), "rank")
