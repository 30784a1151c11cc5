"""Sharding by sampled splitters, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from larder.llm.common import only
from larder.session import cut

#: Ranges per shard, samples drawn per range, rounds of subdivision. The driver holds RANGES * SAMPLES boundaries at most.
RANGES_PER_SHARD, SAMPLES_PER_RANGE, ROUNDS = 32, 16, 3
#: A range with more than this many times the mean bytes or rows of a range is overfull.
OVERFULL = 2.0


def _bounds(rows: DataFrame, keys: list[str], bounds: list[str]) -> Column:
    """Boundaries held as JSON texts, as one constant array."""
    kind = ArrayType(rows.select(*keys).schema)
    return F.from_json(F.lit(f"[{','.join(bounds)}]"), kind)


def _position(rows: DataFrame, keys: list[str], bounds: list[str]) -> Column:
    """How many of the sorted ``bounds`` lie below a row's keys: a binary search without Python."""
    if not bounds:
        return F.lit(0)
    key, array = F.struct(*keys), _bounds(rows, keys, bounds)
    steps = F.from_json(F.lit(str([1 << k for k in reversed(range(len(bounds).bit_length()))])), "array<int>")

    def step(at: Column, size: Column) -> Column:
        to = at + size
        return F.when((to <= len(bounds)) & (F.get(array, to - 1) < key), to).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def _sampled_bounds(rows: DataFrame, keys: list[str], total: int, wanted: int) -> list[str]:
    """Splitters at equal steps of weight through a sample of keys drawn in proportion to size.

    A row is drawn with probability size / (total / draws); what is larger than that step is always drawn and keeps its own
    weight. The draw is a hash of the key, so that it is the same on every attempt. About ``wanted * SAMPLES_PER_RANGE`` rows
    are drawn, whatever the input's size.
    """
    step = max(1.0, total / (wanted * SAMPLES_PER_RANGE))
    uniform = F.pmod(F.xxhash64(*keys, F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.filter(uniform < F.col("size") / step).select(
        F.struct(*keys).alias("key"), F.greatest(F.col("size").cast("double"), F.lit(step)).alias("w")
    ).orderBy("key").select(F.to_json("key").alias("key"), "w").collect()
    weight = sum(r.w for r in drawn)
    bounds: list[str] = []
    seen, k = 0.0, 1
    for r in drawn:
        seen += r.w
        while k < wanted and seen >= weight * k / wanted:
            k += 1
            if not bounds or bounds[-1] != r.key:
                bounds.append(r.key)
    return bounds


def range_shards(df: DataFrame, keys: list[str], size: str, shards: int = 8) -> DataFrame:
    """Add ``shard`` (0 .. shards - 1) and ``slot`` (from 0 without gaps inside a shard) by ranges of ``keys``.

    Size-weighted samples of the keys give quantile splitters; rows go to the ranges between them. Ranges found overfull once
    their bytes and rows are known are sampled again on their own and subdivided. The shard of a row follows from the exact
    bytes before it, so shards differ by about one row's size; order inside and between shards is that of ``keys``.

    ``keys`` should be as good as unique: rows alike in all of them, down to repeated rows, stay in one range in any order. A hot
    first key is no harm as the later ones split it. Null keys sort first; a null or negative size counts as zero. An empty table
    gives no rows. Other columns ride along whatever their names, so pass only what is wanted; old columns ``shard`` and ``slot`` are replaced.
    """
    carried = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    named = [f"k{i}" for i in range(len(keys))]
    rows = cut(
        df.select(
            *[F.col(k).alias(n) for k, n in zip(keys, named, strict=True)],
            F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("size"), F.struct(*carried).alias("record"),
        )
    )
    keys = named
    whole = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    total, wanted = max(1, whole.bytes), shards * RANGES_PER_SHARD
    bounds = _sampled_bounds(rows, keys, total, wanted)
    for attempt in range(ROUNDS + 1):
        ranged = rows.withColumn("_range", _position(rows, keys, bounds))
        sums = {r._range: (r.bytes, r.rows) for r in ranged.groupBy("_range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()}
        full = {k: max(b / total, n / max(1, whole.rows)) * wanted for k, (b, n) in sums.items()}
        full = {k: x for k, x in full.items() if x > OVERFULL and sums[k][1] > 1}
        if not full or attempt == ROUNDS:
            break
        # One sample for all overfull ranges together, as many draws for each as its excess asks for.
        inside = ranged.filter(F.col("_range").isin(list(full)))
        need = math.ceil(sum(full.values()))
        by_rows = inside.withColumn("size", F.greatest(F.col("size"), F.lit(max(1, total // max(1, whole.rows)))))
        heavy = sum(max(sums[k][0], sums[k][1] * max(1, total // max(1, whole.rows))) for k in full)
        more = _sampled_bounds(by_rows.drop("_range"), keys, heavy, 2 * need)
        both = rows.sparkSession.range(1).select(F.explode(F.array_sort(F.array_distinct(_bounds(rows, keys, [*bounds, *more])))).alias("key"))
        grown = [r.key for r in both.select(F.to_json("key").alias("key")).collect()]
        if len(grown) == len(bounds):
            break
        bounds = grown

    offsets, b, n = [], 0, 0
    for k in sorted(sums):
        offsets.append((k, b, n))
        b, n = b + sums[k][0], n + sums[k][1]
    # One row per range, bounded by the number of splitters.
    starts = F.broadcast(rows.sparkSession.createDataFrame(offsets, "_range int, _bytes long, _rows long"))
    w = Window.partitionBy("_range").orderBy(*keys, "size")
    placed = (
        ranged.withColumn("_n", F.row_number().over(w))
        .withColumn("_b", F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .join(starts, "_range")
        .withColumn("_before", F.col("_bytes") + F.col("_b") - F.col("size"))
        .withColumn("_row", F.col("_rows") + F.col("_n") - 1)
        .withColumn("shard", F.least(F.floor(F.col("_before") * float(shards) / float(total)), F.lit(shards - 1)).cast("int"))
    )
    placed = cut(placed.select("record", "shard", "_row"))
    firsts = F.broadcast(placed.groupBy("shard").agg(F.min("_row").alias("_first")))  # one row per shard
    return placed.join(firsts, "shard").select("record.*", "shard", (F.col("_row") - F.col("_first")).alias("slot"))


def document_shards(documents: DataFrame, shards: int = 8, group: str = "source") -> DataFrame:
    """Shards of near equal bytes over documents, ordered by (``group``, doc_id): doc_id, size, text_crc32, law, shard, slot,
    grown_shard. The texts themselves are not moved. A null text has no bytes; size is its bytes plus 1.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    digest = only(documents, doc_id="doc_id", text="text", group=group).select(
        "group", "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return range_shards(digest, ["group", "doc_id"], "size", shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "group",
    )
