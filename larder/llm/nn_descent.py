"""Embedding near-duplicates by NN-descent: a neighbour graph refined through neighbours of neighbours, audited for recall."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import only
from larder.operators.components import connected_components
from larder.session import cut

THRESHOLD = 0.93
#: Neighbours in a list before it is enlarged.
LIST = 16
#: Hash tables that the first graph comes from, rows in one of their blocks, reverse neighbours in one group.
TABLES, BLOCK, REVERSE = 6, 256, 64
#: Rows in a tile of saturated vectors.
TILE = 1024
ROUNDS, MIN_CHANGE = 6, 0.001
#: Vectors with links, counted by brute force, that recall is measured on, the recall asked for, and how often tables and lists are doubled for it.
AUDIT, RECALL, ATTEMPTS = 256, 0.99, 3
#: Vectors that one pass of the audit compares with all others.
DRAW = 4096
#: What stands for the worst cosine of a list that is not full: less than any cosine, more than that of a vector with itself in ``_best``.
OPEN = -1.5

_EDGE = "node long, other long, sim double"


def _unit(rows: list[bytes], width: str) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), width).reshape(len(rows), -1).astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _planes(seed: int, size: int, bits: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((size, bits))


def _codes(x: np.ndarray, table: int, bits: int) -> np.ndarray:
    """The signs of ``bits`` random projections, as a number."""
    if not bits:
        return np.zeros(len(x), np.int64)
    return ((x @ _planes(table, x.shape[1], 40)[:, :bits]) > 0) @ (1 << np.arange(bits, dtype=np.int64))


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[dict[str, list]]:
    """The runs of rows with equal first ``keys`` columns of a sorted partition, one at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = list(zip(*(batch.column(k).to_pylist() for k in range(keys)), strict=True))
        begin = 0
        for at in range(batch.num_rows):
            if names[at] != last:
                if at > begin:
                    held.append(batch.slice(begin, at - begin))
                if held:
                    yield pa.Table.from_batches(held).to_pydict()
                held, begin, last = [], at, names[at]
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held).to_pydict()


def _rows(out: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*out, strict=True) if out else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names)


def _best(sims: np.ndarray, nodes: np.ndarray, k: int, worst: np.ndarray) -> pa.RecordBatch:
    """(node, other, sim): for each row of a block its ``k`` most similar others, without those below ``worst`` of the row."""
    np.fill_diagonal(sims, -2.0)
    if sims.shape[1] > k:
        top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    else:
        top = np.broadcast_to(np.arange(sims.shape[1]), sims.shape)
    values = np.take_along_axis(sims, top, axis=1)
    row, at = np.nonzero(values >= worst[:, None])
    columns = [pa.array(nodes[row], pa.int64()), pa.array(nodes[top[row, at]], pa.int64()), pa.array(values[row, at], pa.float64())]
    return pa.RecordBatch.from_arrays(columns, ["node", "other", "sim"])


def _flat(graph: DataFrame) -> DataFrame:
    return graph.select("node", F.explode("near").alias("e")).select("node", F.col("e.other").alias("other"), F.col("e.sim").alias("sim"))


def _merged(edges: DataFrame, k: int) -> DataFrame:
    """(node, near): the ``k`` best of all edges (node, other, sim) of a node, most similar first, ties by the smaller other."""
    order = lambda a, b: F.when(a.sim > b.sim, -1).when(a.sim < b.sim, 1).when(a.other < b.other, -1).when(a.other > b.other, 1).otherwise(0)
    # Two products of the same vectors may differ in their last digits; the others are made distinct by name.
    best = edges.groupBy("node", "other").agg(F.max("sim").alias("sim"))
    return best.groupBy("node").agg(F.slice(F.array_sort(F.collect_list(F.struct("sim", "other")), order), 1, k).alias("near"))


def vectors(embeddings: DataFrame, vec_id: str, embedding: str, label: str) -> tuple[DataFrame, str]:
    """(vec_id, cell, key, vec) of every row; ``cell`` is null for what links with nothing. Cells are labels and lengths. Also the number format."""
    rows = only(embeddings, vec_id=vec_id, embedding=embedding, label=label)
    width = "<f4" if rows.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    rows = rows.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tag, values in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                usable = tag is not None and values and None not in values and all(map(math.isfinite, values)) and any(values)
                data = (np.array(values) + 0.0).astype(width).tobytes() if usable else None  # adding 0 makes -0 the same as 0
                if data is not None:
                    x = np.frombuffer(data, width).astype(np.float64)
                    usable = 0.0 < float(x @ x) < math.inf
                name = f"{len(values)}:{tag}" if usable else None
                out.append((name, xxhash.xxh3_128_digest(name.encode() + b"\0" + data) if usable else None, data if usable else None))
            found = _rows(out, [pa.string(), pa.binary(), pa.binary()], ["cell", "key", "vec"])
            yield pa.RecordBatch.from_arrays([batch.column(0), *found.columns], ["vec_id", "cell", "key", "vec"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return cut(rows.mapInArrow(run, f"vec_id {kind}, cell string, key binary, vec binary")), width


def _sized(nodes: DataFrame, by: str) -> DataFrame:
    """(by, rows) written out."""
    return cut(nodes.groupBy(by).agg(F.count(F.lit(1)).alias("rows")))


def _blocks(nodes: DataFrame, width: str, tables: list[int], block: int) -> DataFrame:
    """(table, cell, code, part, node, vec): the nodes of a cell by the signs of projections, about ``block`` rows each; what shares a
    code in larger numbers is dealt out evenly."""
    sized = nodes.join(_sized(nodes, "cell"), "cell").select("cell", "rows", "node", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, rows = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy(zero_copy_only=False)
            data = batch.column(3).to_pylist()
            codes = np.zeros((len(cells), len(tables)), np.int64)
            for cell in set(cells):
                at = np.flatnonzero(cells == cell)
                x = _unit([data[k] for k in at], width)
                bits = max(0, min(40, round(math.log2(rows[at[0]] / block)))) if rows[at[0]] > block else 0
                for t, table in enumerate(tables):
                    codes[at, t] = _codes(x, table, bits)
            lists = pa.array(codes.tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), lists], ["cell", "node", "vec", "codes"])

    coded = cut(sized.mapInArrow(run, "cell string, node long, vec binary, codes array<long>")).select("cell", "node", "vec", F.posexplode("codes").alias("table", "code"))
    counts = cut(coded.groupBy("table", "cell", "code").agg(F.count(F.lit(1)).alias("rows")))
    parts = F.ceil(F.col("rows") / (2.0 * block))
    return coded.join(counts, ["table", "cell", "code"]).select("table", "cell", "code", F.pmod(F.xxhash64("node", "table"), parts).alias("part"), "node", "vec")


def _first_graph(nodes: DataFrame, width: str, tables: list[int], k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, 4):
            x, names = _unit(g["vec"], width), np.array(g["node"], np.int64)
            yield _best(x @ x.T, names, k, np.full(len(names), OPEN))

    keys = ["table", "cell", "code", "part"]
    blocks = _blocks(nodes, width, tables, BLOCK).repartition(*keys).sortWithinPartitions(*keys)
    return blocks.mapInArrow(run, _EDGE)


def _descend(graph: DataFrame, nodes: DataFrame, width: str, k: int) -> DataFrame:
    """Candidates (node, other, sim) from one round: all that are neighbours of one node, in either direction, are compared with each
    other. What is less similar than all of a full list is left out, as merging would drop it."""
    edges = _flat(graph).select("node", "other")
    back = edges.select(F.col("other").alias("pivot"), F.col("node").alias("member"))
    counts = cut(back.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")))
    parts = F.ceil(F.col("n") / float(REVERSE)).cast("int")
    # The reverse neighbours of a hub are dealt out, and its own list goes to each part.
    spread = back.join(counts, "pivot").select("pivot", F.pmod(F.xxhash64("member"), parts).cast("int").alias("part"), "member")
    own = edges.union(graph.select("node", F.col("node").alias("other"))).join(counts, F.col("node") == F.col("pivot"), "left").select(
        F.col("node").alias("pivot"), F.explode(F.sequence(F.lit(0), F.coalesce(parts, F.lit(1)) - 1)).alias("part"), F.col("other").alias("member")
    )
    members = spread.union(own).distinct()
    worst = graph.select("node", F.when(F.size("near") >= k, F.element_at("near", -1).sim).otherwise(OPEN).alias("worst"))
    known = cut(nodes.select("node", "vec").join(worst, "node", "left").select(F.col("node").alias("member"), F.coalesce("worst", F.lit(OPEN)).alias("worst"), "vec"))
    placed = members.join(known, "member").select("pivot", "part", "member", "worst", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[pa.RecordBatch] = []
        for g in _groups(batches, 2):
            if len(g["vec"]) > 1:
                x = _unit(g["vec"], width)
                out.append(_best(x @ x.T, np.array(g["member"], np.int64), k, np.array(g["worst"])))
            if len(out) > 500:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out = []
        yield from out

    return placed.repartition("pivot", "part").sortWithinPartitions("pivot", "part", "member").mapInArrow(run, _EDGE)


def neighbour_graph(nodes: DataFrame, width: str, tables: list[int], k: int, start: DataFrame | None = None) -> DataFrame:
    """(node, near) after as many rounds as change more than MIN_CHANGE of the lists' entries."""
    first = _first_graph(nodes, width, tables, k)
    graph = cut(_merged(first if start is None else first.unionByName(_flat(start)), k))
    for _ in range(ROUNDS):
        grown = cut(_merged(_descend(graph, nodes, width, k).unionByName(_flat(graph)), k))
        size = _flat(grown).count()
        new = _flat(grown).join(_flat(graph), ["node", "other"], "left_anti").count()
        graph = grown
        if new <= MIN_CHANGE * size:
            break
    return graph


def _tiles(saturated: DataFrame, width: str) -> DataFrame:
    """(tile, nodes, mults, vecs): saturated vectors packed by cell and signs, TILE / 2 rows on average and 2 * TILE at most by far."""
    blocks = _blocks(saturated, width, [0], TILE // 2).join(saturated.select("node", "mult"), "node")
    tile = F.struct("cell", "code", "part")
    packed = blocks.groupBy(F.xxhash64(tile).alias("tile")).agg(F.sort_array(F.collect_list(F.struct("node", "mult", "vec"))).alias("r"))
    return packed.select("tile", F.col("r.node").alias("nodes"), F.col("r.mult").alias("mults"), F.col("r.vec").alias("vecs"))


def _tile_links(tiles: DataFrame, pairs: DataFrame, width: str, threshold: float) -> DataFrame:
    """(a, b, node, links, chain) per pair of tiles: how many vectors of the other one a node links with, and another node it is linked to.

    Following ``chain`` connects whatever the pair of tiles connects.
    """
    left = tiles.select(F.col("tile").alias("a"), F.col("nodes").alias("na"), F.col("mults").alias("ma"), F.col("vecs").alias("va"))
    right = tiles.select(F.col("tile").alias("b"), F.col("nodes").alias("nb"), F.col("mults").alias("mb"), F.col("vecs").alias("vb"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "ma", "va", "nb", "mb", "vb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                a, b, na, ma, va, nb, mb, vb = (c[0].as_py() for c in batch.slice(at, 1).columns)
                near = _unit(va, width) @ _unit(vb, width).T >= threshold
                if a == b:
                    np.fill_diagonal(near, False)
                out = []
                sides = [(near, na, nb, mb)] if a == b else [(near, na, nb, mb), (near.T, nb, na, ma)]
                for side, own, others, mults in sides:
                    links, first = side @ np.array(mults, np.int64), side.argmax(axis=1)
                    # Linked to the first one of the other tile; what these edges leave apart is joined below.
                    out += [(a, b, own[k], int(links[k]), others[first[k]]) for k in np.flatnonzero(side.any(axis=1))]
                out += [(a, b, u, 0, v) for u, v in _spanning(near, na, nb, a == b)]
                if out:
                    yield _rows(out, [pa.int64()] * 5, ["a", "b", "node", "links", "chain"])

    return rows.mapInArrow(run, "a long, b long, node long, links long, chain long")


def _spanning(near: np.ndarray, rows: list[int], columns: list[int], same: bool) -> list[tuple[int, int]]:
    """Edges that, with those of every row and column to its first neighbour, connect all that ``near`` connects: one per two groups that
    stay apart and yet touch."""
    n, m = near.shape
    row, column = np.arange(n), np.arange(n) if same else n + np.arange(m)
    edges: list[tuple[int, int]] = []
    parent = list(range(n + m))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k in np.flatnonzero(near.any(axis=1)):
        parent[find(int(row[k]))] = find(int(column[near[k].argmax()]))
    for k in np.flatnonzero(near.any(axis=0)):
        parent[find(int(column[k]))] = find(int(row[near[:, k].argmax()]))
    while True:
        r, c = np.array([find(int(x)) for x in row]), np.array([find(int(x)) for x in column])
        apart = near & (r[:, None] != c[None, :])
        if not apart.any():
            return edges
        for k in np.flatnonzero(apart.any(axis=1)):
            j = int(apart[k].argmax())
            if find(int(row[k])) != find(int(column[j])):
                parent[find(int(row[k]))] = find(int(column[j]))
                edges.append((rows[k], columns[j]))


def _saturated_links(saturated: DataFrame, pairs: DataFrame, width: str, threshold: float) -> DataFrame:
    """All links between saturated vectors, by pairs of tiles: first those that the lists connect, then neighbours of neighbouring tiles,
    until a round adds no pair with a link."""
    tiles = cut(_tiles(saturated, width))
    at = cut(tiles.select("tile", F.explode("nodes").alias("node")))
    touching = pairs.join(at.withColumnRenamed("node", "u").withColumnRenamed("tile", "a"), "u").join(
        at.withColumnRenamed("node", "v").withColumnRenamed("tile", "b"), "v"
    ).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    todo = cut(touching.union(tiles.select(F.col("tile").alias("a"), F.col("tile").alias("b"))).distinct())
    tried, found = todo, cut(_tile_links(tiles, todo, width, threshold))
    while True:
        linked = cut(found.select("a", "b").distinct())
        both = linked.union(linked.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        wider = both.join(both.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select(F.least("a", "c").alias("a"), F.greatest("a", "c").alias("b"))
        todo = cut(wider.distinct().join(tried, ["a", "b"], "left_anti"))
        if todo.isEmpty():
            return found
        tried, found = cut(tried.union(todo)), cut(found.unionByName(_tile_links(tiles, todo, width, threshold)))


def _links(graph: DataFrame, nodes: DataFrame, width: str, threshold: float, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node, links), edges (u, v), from the lists and, among saturated vectors, from their tiles, and these saturated ones (node)."""
    near = graph.select("node", F.filter("near", lambda e: e.sim >= threshold).alias("near")).filter(F.size("near") > 0)
    full = cut(near.filter(F.size("near") >= k).select("node"))
    pairs = cut(
        near.select("node", F.explode("near.other").alias("other")).select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v")).distinct()
    )
    flags = full.withColumn("full", F.lit(True))
    both = pairs.join(flags.select(F.col("node").alias("u"), F.col("full").alias("fu")), "u", "left").join(
        flags.select(F.col("node").alias("v"), F.col("full").alias("fv")), "v", "left"
    )
    dense = F.coalesce(F.col("fu") & F.col("fv"), F.lit(False))
    both = cut(both.select("u", "v", dense.alias("dense")))
    usual = both.filter("NOT dense").select("u", "v")
    ends = usual.union(usual.select(F.col("v").alias("u"), F.col("u").alias("v"))).toDF("node", "other")
    counted = ends.join(nodes.select(F.col("node").alias("other"), "mult"), "other").select("node", F.col("mult").alias("links"))
    edges = usual
    if not full.isEmpty():
        tiled = _saturated_links(nodes.join(full, "node"), both.filter("dense").select("u", "v"), width, threshold)
        counted = counted.unionByName(tiled.select("node", "links"))
        edges = edges.union(tiled.select(F.greatest("node", "chain").alias("u"), F.least("node", "chain").alias("v")).distinct())
    return cut(counted.groupBy("node").agg(F.sum("links").alias("links"))), cut(edges), full


def _there(drawn: list, nodes: DataFrame, width: str, threshold: float) -> DataFrame:
    """(node, there): all links of the vectors ``drawn`` (node, cell, vec) that have any, by comparing them with all others."""
    by_cell: dict[str, tuple[np.ndarray, list[bytes]]] = {}
    for cell in {r.cell for r in drawn}:
        own = [r for r in drawn if r.cell == cell]
        by_cell[cell] = (np.array([r.node for r in own], np.int64), [bytes(r.vec) for r in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = {cell: _unit(data, width) for cell, (_, data) in by_cell.items()}
        total = {cell: np.zeros(len(ids), np.int64) for cell, (ids, _) in by_cell.items()}
        for batch in batches:
            cells, names = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy(zero_copy_only=False)
            mults, data = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_pylist()
            for cell in set(cells) & set(by_cell):
                of = np.flatnonzero(cells == cell)
                for begin in range(0, len(of), TILE):
                    at = of[begin : begin + TILE]
                    near = units[cell] @ _unit([data[k] for k in at], width).T >= threshold
                    near &= by_cell[cell][0][:, None] != names[at][None, :]
                    total[cell] += near @ mults[at]
        out = [(int(n), int(c)) for cell, (ids, _) in by_cell.items() for n, c in zip(ids, total[cell], strict=True) if c]
        yield _rows(out, [pa.int64(), pa.int64()], ["node", "there"])

    return nodes.select("cell", "node", "mult", "vec").mapInArrow(run, "node long, there long").groupBy("node").agg(F.sum("there").alias("there"))


def _recall(counts: DataFrame, nodes: DataFrame, width: str, threshold: float, full: DataFrame | None = None) -> float:
    """Share of its links that a vector with links has in ``counts``: the mean over AUDIT such vectors, or all if there are fewer, of the
    saturated ones (``full``) and of the others; the smaller of both.

    Vectors are drawn by their hash, DRAW at a time, until AUDIT of them turn out to have links or none is left; so 1 without a link
    means that all vectors were compared. What is broadcast has about DRAW rows.
    """
    names = nodes.select("node", "cell", "vec")
    parts = [names] if full is None else [names.join(full, "node", "left_anti"), names.join(full, "node", "left_semi")]
    place = F.pmod(F.xxhash64("node"), F.lit(1 << 31)) / float(1 << 31)
    shares = []
    for part in parts:
        rows, begin, size, linked, found = part.count(), 0.0, AUDIT, 0, 0.0
        while rows and begin < 1.0 and linked < AUDIT:
            end = begin + size / rows
            drawn = part.filter((place >= begin) & (place < end)).collect()
            if drawn:
                there = _there(drawn, nodes, width, threshold).join(counts, "node", "left")
                share = F.least(F.lit(1.0), F.coalesce("links", F.lit(0)) / F.col("there"))
                got = there.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(share), F.lit(0.0)).alias("share")).first()
                linked, found = linked + got.n, found + got.share
            begin, size = end, min(4 * size, DRAW)
        if linked:
            shares.append(found / linked)
    return min(shares, default=1.0)


def near_duplicates(
    embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD,
    k: int = LIST, tables: int = TABLES, recall: float = RECALL,
) -> DataFrame:
    """vec_id, n_links, component_id, kept and audited_recall of every vector, linked at a cosine of ``threshold`` inside its label.

    Equal vectors of a label are one node. The first graph comes from blocks of equal projection signs; rounds of NN-descent refine it; lists
    hold ``k`` neighbours. A node whose list is full of links is saturated: its list is enlarged to all saturated vectors in tiles that touch
    its own, so there is no cap on links. Lists hold the most similar vectors however far they are, as a way to what is close. The audit counts
    all links of AUDIT saturated vectors and of AUDIT others that have any; while either group has less than ``recall`` of them, lists are
    doubled and tables added. If that is not enough after ATTEMPTS times, it is an error: no incomplete links go out. Where hardly any vector
    has a link the audit compares nearly all pairs of a cell.

    A vector that is null, empty, zero, or holds a null or a number that is not finite, or whose label is null, links with nothing: n_links
    0, its own component, kept. Vectors of unequal length do not link. Repeated rows are vectors of their own and equal. A null vec_id
    names no component: it has the one it is linked to, or null. Other columns are ignored; an empty table gives no rows.
    """
    rows, width = vectors(embeddings, vec_id, embedding, label)
    usable = rows.filter("cell IS NOT NULL AND vec_id IS NOT NULL")
    nodes = cut(usable.groupBy("key").agg(F.min("vec_id").cast("long").alias("node"), F.count(F.lit(1)).alias("mult"), F.first("cell").alias("cell"), F.first("vec").alias("vec")))
    graph, used, share = None, 0, 0.0
    for attempt in range(ATTEMPTS + 1):
        graph = neighbour_graph(nodes, width, list(range(used, tables)), k, graph)
        counts, edges, full = _links(graph, nodes, width, threshold, k)
        share = _recall(counts, nodes, width, threshold, full)
        if share >= recall:
            break
        if attempt == ATTEMPTS:
            raise RuntimeError(f"the audit finds {share:.4f} of the links with {tables} tables and lists of {k}, less than {recall}")
        used, tables, k = tables, 2 * tables, 2 * k
    groups = connected_components(edges, nodes.select("node", "key", "mult"), [])
    found = cut(groups.join(counts, "node", "left").select("key", "component", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("links")))
    return _per_vector(rows.select("vec_id", "key").join(found, "key", "left"), F.lit(share))


def _per_vector(joined: DataFrame, share: Column) -> DataFrame:
    component = F.coalesce("component", F.col("vec_id").cast("long"))
    return joined.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"), share.alias("audited_recall"),
    )
