"""Mixture-controlled packing: deficit round-robin over source queues, worked out in closed form from running totals."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.bpe import encoder, vocabulary_path
from larder.llm.common import PACKED_BYTES, only, slices, utf8
from larder.session import cut

SEQUENCE, PACKET, END_ID = 2048, 512, 1
#: Packets in a group of rounds that one task puts in order, and the most groups; both shape the plan and not the result.
GROUP_PACKETS, MAX_GROUPS = 2000, 50_000


def tokenized(documents: DataFrame, path: str, doc_id: str, text: str, source: str) -> DataFrame:
    """row, doc_id, queue, tokens and ids (packed, compressed, the end id left out), written once so that ``row`` stays what it is."""
    docs = only(documents, doc_id=doc_id, text=text, source=source).select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        _queue(F.col("source")).alias("queue"),
        utf8(F.col("text")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        words, pack = encoder(path), zstandard.ZstdCompressor(level=1)
        for some in slices(batches, "text"):
            ids = [words.encode(t) for t in some.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*some.columns[:3], pa.array([len(x) + 1 for x in ids], pa.int64()), pa.array([pack.compress(x.tobytes()) for x in ids], pa.binary())],
                ["row", "doc_id", "queue", "tokens", "ids"],
            )

    return cut(docs.mapInArrow(run, f"row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, queue string, tokens long, ids binary"))


def _queue(source: Column) -> Column:
    """The queue's name; that of a null source is empty."""
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source.cast("string")))


def _served(targets: Mapping[str | None, float], bases: DataFrame, whole: int) -> Callable[[Column, Column, Column], Column]:
    """Share of all tokens that is out when token ``done`` of a queue's ``total`` is, under target proportions.

    While a queue has tokens, it is served at the rate of its target, all at the same virtual time v: a queue with target w and t tokens has
    had min(t, w v), and it is dry at v = t / w, after which the others go on in proportion. Sources without a target share what the targets leave of 1 in the
    proportion of their tokens, like one queue; where nothing is left, they come when all others are dry.
    """
    named = {"" if k is None else f"={k}": float(w) for k, w in targets.items()}
    if any(not math.isfinite(w) or w <= 0 for w in named.values()) or sum(named.values()) > 1 + 1e-9:
        raise ValueError("targets are positive and add up to 1 at most")
    known = bases.filter(F.col("queue").isin(list(named))).select("queue", "total").distinct().collect()  # a row for each target at most
    had = {r.queue: r.total for r in known}
    left = max(0.0, 1.0 - sum(named.values()))
    others = whole - sum(had.values())
    lanes = [(had[q], w) for q, w in named.items() if q in had] + ([(others, left)] if others and left > 1e-9 else [])

    def share(queue: Column, done: Column, total: Column) -> Column:
        rate = F.lit(None).cast("double")
        for q, w in named.items():
            rate = F.when(queue == q, F.lit(w)).otherwise(rate)
        at = F.when(rate.isNotNull(), done / rate)
        if left > 1e-9:
            at = F.coalesce(at, done / total * (others / left))
        out = sum((F.least(F.lit(float(t)), at * w) for t, w in lanes), F.lit(0.0))
        # Without a rate of its own: behind all that has one.
        return F.coalesce(out, whole - others + done / total * float(others)) / float(whole)

    return share


def layout(lengths: DataFrame, sequence: int = SEQUENCE, packet: int = PACKET, targets: Mapping[str | None, float] | None = None) -> DataFrame:
    """Pieces (row, start, length, sequence_id, offset) of rows with (row, queue, tokens).

    A round gives each queue its share of one sequence, its quantum; a queue sends its head packet (at most ``packet`` tokens of
    a document) once the quanta so far cover what it has sent and half of that packet, and carries the rest as its deficit. So the round of
    a packet whose middle is token c of its queue's t is ceil(c * rounds / t) - 1: no queue needs to know another one's state, and
    running totals by part of the input carry every deficit across windows and partitions. With ``targets`` the quanta follow these instead of the queues' shares of the input.
    """
    spark = lengths.sparkSession
    # Running totals in each queue, in two steps: a hot queue is spread over all parts of the input.
    part = F.shiftright("row", 33)
    cells = cut(lengths.groupBy("queue", part.alias("part")).agg(F.sum("tokens").alias("tokens"), F.sum(F.ceil(F.col("tokens") / packet)).alias("packets")))
    whole = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("packets"), F.lit(0)).alias("packets")).first()
    rounds = max(1, math.ceil(whole.tokens / sequence))
    groups = max(1, min(MAX_GROUPS, whole.packets // GROUP_PACKETS))
    parts = Window.partitionBy("queue").orderBy("part")
    bases = cells.select(
        "queue", "part", (F.sum("tokens").over(parts) - F.col("tokens")).alias("base"),
        F.sum("tokens").over(Window.partitionBy("queue")).alias("total"),
    )
    inside = Window.partitionBy("queue", "part").orderBy("row")
    queued = lengths.withColumn("part", part).withColumn("upto", F.sum("tokens").over(inside)).join(bases, ["queue", "part"])
    starts = F.sequence(F.lit(0).cast("long"), F.col("tokens") - 1, F.lit(packet).cast("long"))
    packets = queued.select("row", "queue", "tokens", (F.col("base") + F.col("upto") - F.col("tokens")).alias("before"), "total", F.explode(starts).alias("start"))
    packets = packets.withColumn("length", F.least(F.lit(packet).cast("long"), F.col("tokens") - F.col("start")))
    middle = F.col("before") + F.col("start") + F.col("length") / 2.0
    share = middle / F.col("total") if targets is None else _served(targets, bases, whole.tokens)(F.col("queue"), middle, F.col("total"))
    packets = packets.withColumn("round", F.ceil(share * float(rounds)) - 1).withColumn("group", F.floor(F.col("round") * groups / float(rounds)).cast("int"))
    packets = cut(packets.select("row", "queue", "start", "length", "round", "group"))
    # Places in the one stream of tokens, in two steps again.
    sums = packets.groupBy("group").agg(F.sum("length").alias("length")).orderBy("group").collect()  # MAX_GROUPS rows at most
    bases_of, at = [], 0
    for r in sums:
        bases_of.append((r.group, at))
        at += r.length
    group_bases = F.broadcast(spark.createDataFrame(bases_of, "group int, base long"))
    order = Window.partitionBy("group").orderBy("round", "queue", "row", "start")
    placed = packets.withColumn("upto", F.sum("length").over(order)).join(group_bases, "group").withColumn("at", F.col("base") + F.col("upto") - F.col("length"))
    room = F.least(F.col("length"), sequence - F.col("at") % sequence)
    pieces = F.array(
        F.struct(F.col("start").alias("start"), room.alias("length"), F.col("at").alias("at")),
        F.struct((F.col("start") + room).alias("start"), (F.col("length") - room).alias("length"), (F.col("at") + room).alias("at")),
    )
    return placed.select("row", F.explode(pieces).alias("p")).filter("p.length > 0").select(
        "row", F.col("p.start").alias("start"), F.col("p.length").alias("length"),
        F.floor(F.col("p.at") / sequence).alias("sequence_id"), (F.col("p.at") % sequence).alias("offset"),
    )


def pack(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", path: str | None = None,
    sequence: int = SEQUENCE, packet: int = PACKET, end_id: int = END_ID, targets: Mapping[str | None, float] | None = None,
) -> DataFrame:
    """Pieces of token sequences: doc_id, start, length, doc_tokens, sequence_id, offset and ids (little-endian unsigned 32-bit).

    Each document is its ids and then ``end_id``; it is cut freely, and every id lies in exactly one piece. All sequences but the last
    are full. After every round each source has had its share of all tokens, up to half a packet; with ``targets`` (proportions by source, null included, of 1 together at
    most) its target share of them, as long as it has tokens: what a dry source leaves goes to the others in proportion. A null source is a queue of its
    own; a null or empty text is the end id alone; repeated rows are documents of their own, and a null doc_id is kept. An empty table
    gives no rows, and other columns are ignored.
    """
    path = path or vocabulary_path()
    tokens = tokenized(documents, path, doc_id, text, source)
    pieces = layout(tokens.select("row", "queue", "tokens"), sequence, packet, targets)
    lists = pieces.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces"))
    both = tokens.select("row", "doc_id", "tokens", "ids").join(lists, "row").select("doc_id", "tokens", "ids", "pieces")
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    kind = tokens.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, width = zstandard.ZstdDecompressor(), encoder(path).width
        for some in slices(batches, "ids", max_bytes=PACKED_BYTES):
            out: list[tuple] = []
            for k, (tokens_, data, pieces_) in enumerate(zip(some.column(1).to_pylist(), some.column(2).to_pylist(), some.column(3).to_pylist(), strict=True)):
                ids = np.append(np.frombuffer(unpack.decompress(data), width), end_id).astype("<u4")
                for p in pieces_:
                    a, n = p["start"], p["length"]
                    out.append((k, a, n, tokens_, p["sequence_id"], p["offset"], ids[a : a + n].tobytes()))
            if out:
                at, *rest = zip(*out, strict=True)
                columns = [pa.array(c, pa.int64()) for c in rest[:-1]] + [pa.array(rest[-1], pa.binary())]
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(at)), *columns], names)

    return both.mapInArrow(run, f"doc_id {kind.simpleString()}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
