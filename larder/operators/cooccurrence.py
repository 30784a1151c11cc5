"""Products that appear together: time-proximity counts, session frequencies, two-item rules, itemsets."""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import lookup_constant
from larder.operators.sessions import SESSION_GAP, micros, whole_bins
from larder.session import PART_ROWS, broadcast_if_within, cut, drop_cut, tasks_of

TILE_ITEMS = 1000
HOT_PAIRS = 1_000_000
# Row pairs of a leaf that are formed; above that its rows are compared by digits.
LEAF_PAIRS = 4096
BIN = ["event_type", "household_id", "bin"]


def pairs_within(
    rows: DataFrame, keys: list[str], item: str, carried: list[str] | None = None, tile_items: int = TILE_ITEMS
) -> DataFrame:
    """Item pairs a < b that share the keys; ``rows`` holds each (keys, item) once.

    The result must be aggregated by the caller, so that the pairs are added up before they are shuffled. The items of
    a group larger than ``tile_items`` are hashed into tiles and every pair of tiles becomes a join key of its own:
    no task meets more than ``tile_items`` squared pairs of one group.
    """
    carried = carried or []
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > tile_items)
    if sizes.isEmpty():
        left = rows.withColumnsRenamed({c: f"{c}_a" for c in [item, *carried]})
        right = rows.withColumnsRenamed({c: f"{c}_b" for c in [item, *carried]})
        joined = left.join(right, keys)
    else:
        large = cut(sizes.select(*keys, F.ceil(F.col("_n") / tile_items).cast("int").alias("_tiles")))
        tiled = rows.join(broadcast_if_within(large), keys, "left").withColumn(
            "_tiles", F.coalesce("_tiles", F.lit(1))
        )
        tiled = tiled.withColumn("_own", F.pmod(F.xxhash64(item), F.col("_tiles")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
        left = tiled.select(
            *keys, *[F.col(c).alias(f"{c}_a") for c in [item, *carried]], F.col("_own").alias("_ta"), other.alias("_tb")
        )
        right = tiled.select(
            *keys, *[F.col(c).alias(f"{c}_b") for c in [item, *carried]], other.alias("_ta"), F.col("_own").alias("_tb")
        )
        joined = left.join(right, [*keys, "_ta", "_tb"]).drop("_ta", "_tb")
    return joined.filter(F.col(f"{item}_a") < F.col(f"{item}_b"))


def _ordered(left: str, right: str) -> list[Column]:
    return [F.least(left, right).alias("product_a"), F.greatest(left, right).alias("product_b")]


def proximity_pairs(movements: DataFrame, deltas: Mapping[str, int] = SESSION_GAP, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """How many pairs of events of a household and type, of products a < b, lie at most delta seconds apart.

    ``deltas`` gives the seconds by event type. With bins as long as delta, events of one bin are always close and
    events two bins apart never are. Pairs inside a bin are counted from product totals. For neighbouring bins the
    later event must not have the larger offset: bins of moderate size are joined directly, and where the two sizes
    multiply to more than ``hot_pairs`` the offsets are compared digit by digit from product totals, so no event pair
    is ever formed there.
    """
    widths = {kind: delta * 1_000_000 for kind, delta in deltas.items()}
    time, width = micros(F.col("timestamp")), lookup_constant(F.col("event_type"), widths)
    # Written once: every part below reads it. Events of one product at one time are one row with their number.
    events = cut(
        movements.filter(F.col("event_type").isin(list(deltas)) & F.col("product_id").isNotNull())
        .groupBy(
            "event_type",
            "household_id",
            whole_bins(time, width).alias("bin"),
            F.pmod(time, width).cast("bigint").alias("offset"),
            F.col("product_id").alias("product"),
        )
        .agg(F.count(F.lit(1)).alias("w"))
    )
    same = (
        pairs_within(events.groupBy(*BIN, "product").agg(F.sum("w").alias("n")), BIN, "product", ["n"])
        .groupBy("event_type", *_ordered("product_a", "product_b"))
        .agg(F.sum(F.col("n_a") * F.col("n_b")).alias("n"))
    )

    sizes = events.groupBy(*BIN).agg(F.count(F.lit(1)).alias("n"))
    after = sizes.withColumn("bin", F.col("bin") - 1).withColumnRenamed("n", "n_after")
    hot = cut(sizes.join(after, BIN).filter(F.col("n") * F.col("n_after") > hot_pairs))
    left, right = events, events.withColumn("bin", F.col("bin") - 1)
    parts = [same]
    largest = hot.agg(F.max(F.greatest("n", "n_after"))).first()[0]
    if largest:
        marked = broadcast_if_within(hot.select(*BIN))
        bits = (max(widths.values()) - 1).bit_length()
        parts += _digit_pairs(left.join(marked, BIN, "left_semi"), right.join(marked, BIN, "left_semi"), bits, largest)
        left, right = left.join(marked, BIN, "left_anti"), right.join(marked, BIN, "left_anti")
    parts.append(_met(left, right, BIN))
    totals = reduce(DataFrame.unionByName, parts).groupBy("event_type", "product_a", "product_b")
    return totals.agg(F.sum("n").alias("n_pairs"))


def _met(left: DataFrame, right: DataFrame, group: list[str]) -> DataFrame:
    """Counts of right.offset <= left.offset by product pair, from the rows of each group."""
    return (
        left.alias("l")
        .join(right.alias("r"), group)
        .filter(F.col("r.offset") <= F.col("l.offset"))
        .filter(F.col("l.product") != F.col("r.product"))
        .groupBy("event_type", *_ordered("l.product", "r.product"))
        .agg(F.sum(F.col("l.w") * F.col("r.w")).alias("n"))
    )


def _digit_pairs(left: DataFrame, right: DataFrame, bits: int, largest: int, leaf_pairs: int = LEAF_PAIRS) -> list[DataFrame]:
    """Counts of right.offset <= left.offset by product pair, in parts to be added up.

    Only as many leading digits are compared as tell the rows of the ``largest`` bin apart on average. What shares all of them is a leaf of a few rows,
    which are joined directly; in leaves that would make more than ``leaf_pairs`` the other digits are compared too.
    """
    depth = min(bits, max(1, largest.bit_length()))
    parts = [_digit_totals(left, right, bits, range(depth))]
    leaf = F.expr(f"shiftright(offset, CAST({bits - depth} AS INT))").alias("leaf")
    group = [*BIN, "leaf"]
    left, right = left.select("*", leaf), right.select("*", leaf)
    n_left = left.groupBy(*group).agg(F.count(F.lit(1)).alias("n_left"))
    n_right = right.groupBy(*group).agg(F.count(F.lit(1)).alias("n_right"))
    crowded = cut(n_left.join(n_right, group).filter(F.col("n_left") * F.col("n_right") > leaf_pairs).select(*group))
    if not crowded.isEmpty():
        marked = broadcast_if_within(crowded)
        parts.append(_digit_totals(left.join(marked, group, "left_semi"), right.join(marked, group, "left_semi"), bits, range(depth, bits + 1)))
        left, right = left.join(marked, group, "left_anti"), right.join(marked, group, "left_anti")
    return [*parts, _met(left, right, group)]


def _digit_totals(left: DataFrame, right: DataFrame, bits: int, levels: range) -> DataFrame:
    """Counts by product pair of right.offset < left.offset where the first binary digit that differs is one of ``levels``, and of equal offsets for the
    level ``bits``; from product totals.

    Of two different offsets the smaller one has a 0 at the first binary digit where they differ, so each pair meets
    under exactly one common prefix; equal offsets meet under the full number.
    """
    spread_levels = F.explode(F.sequence(F.lit(levels[0]), F.lit(levels[-1]))).alias("level")
    group = [*BIN, "level", "prefix"]

    def totals(side: DataFrame, digit: int, name: str) -> DataFrame:
        spread = side.select("*", spread_levels)
        own = F.expr(f"shiftright(offset, CAST({bits - 1} - level AS INT)) & 1")
        kept = spread.filter((F.col("level") == bits) | (F.when(F.col("level") < bits, own) == digit))
        prefix = F.expr(f"shiftright(offset, CAST({bits} - level AS INT))")
        return kept.groupBy(*BIN, "level", prefix.alias("prefix"), F.col("product").alias(name)).agg(F.sum("w").alias(f"n_{name}"))

    return (
        totals(left, 1, "p")
        .join(totals(right, 0, "q"), group)
        .filter(F.col("p") != F.col("q"))
        .groupBy("event_type", *_ordered("p", "q"))
        .agg(F.sum(F.col("n_p") * F.col("n_q")).alias("n"))
    )


def pair_frequency(windows: DataFrame, keys: list[str], item: str) -> DataFrame:
    """Share of the windows in which both items appear; ``windows`` holds each (keys, item) once."""
    total = windows.select(*keys).distinct().agg(F.count(F.lit(1))).scalar()
    pairs = pairs_within(windows, keys, item).groupBy(f"{item}_a", f"{item}_b").agg(F.count(F.lit(1)).alias("n_windows"))
    return pairs.withColumn("frequency", F.col("n_windows").cast("double") / total)


def frequent_items(rows: DataFrame, item: str, min_count: int) -> DataFrame:
    """Items of at least ``min_count`` baskets; ``rows`` holds each (basket, item) once."""
    return rows.groupBy(item).agg(F.count(F.lit(1)).alias("n_item")).filter(F.col("n_item") >= min_count)


def _basket_rows(baskets: DataFrame, basket: str, item: str, part_rows: int) -> tuple[DataFrame, int, int]:
    """Each (basket, item) once, written; the number of baskets; and the rows of the table."""
    rows = baskets.select(F.col(basket).alias("basket"), F.col(item).alias("item"))
    n_rows = rows.count()
    with tasks_of(rows.sparkSession, n_rows, part_rows):
        rows = cut(rows.distinct())
        return rows, rows.select("basket").distinct().count(), n_rows


def _kept_rows(rows: DataFrame, n_rows: int, least: int, part_rows: int) -> tuple[DataFrame, DataFrame, int]:
    """The frequent items; the rows that hold them, written; and the rows that tasks are cut by: those of the table or a quarter of the item pairs in what
    is left of its baskets, whichever are more."""
    with tasks_of(rows.sparkSession, n_rows, part_rows):
        items = cut(frequent_items(rows, "item", least))
        kept = cut(rows.join(items.select("item"), "item", "left_semi")) if least > 1 else rows
        sizes = kept.groupBy("basket").agg(F.count(F.lit(1)).cast("double").alias("n"))
        quarter = sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 8)).first()[0]
    return items, kept, max(n_rows, int(quarter or 0))


def pair_rules(baskets: DataFrame, basket: str, item: str, min_count: int = 1, part_rows: int = PART_ROWS) -> DataFrame:
    """Rules a -> b from item pairs in at least ``min_count`` baskets, with support, confidence and lift.

    A pair is never more frequent than its rarer item, so rare items leave before any pair is formed. A task takes about ``part_rows`` rows, so that its
    memory does not grow with the baskets.
    """
    rows, n_baskets, n_rows = _basket_rows(baskets, basket, item, part_rows)
    items, kept, weight = _kept_rows(rows, n_rows, min_count, part_rows)
    with tasks_of(rows.sparkSession, weight, part_rows):
        pairs = (
            pairs_within(kept, ["basket"], "item")
            .groupBy("item_a", "item_b")
            .agg(F.count(F.lit(1)).alias("n_pair"))
            .filter(F.col("n_pair") >= min_count)
        )
        both = cut(pairs).select(
            F.explode(F.array(F.struct(F.col("item_a").alias("antecedent"), F.col("item_b").alias("consequent")),
                              F.struct(F.col("item_b").alias("antecedent"), F.col("item_a").alias("consequent")))).alias("rule"),
            "n_pair",
        ).select("rule.*", "n_pair")
        count_a = items.select(F.col("item").alias("antecedent"), F.col("n_item").alias("n_a"))
        count_b = items.select(F.col("item").alias("consequent"), F.col("n_item").alias("n_b"))
        joined = cut(both.join(count_a, "antecedent").join(count_b, "consequent"))
    n, total = F.col("n_pair").cast("double"), F.lit(float(n_baskets))
    return joined.select(
        "antecedent",
        "consequent",
        "n_pair",
        (n / total).alias("support"),
        (n / F.col("n_a")).alias("confidence"),
        (n * total / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"),
    )


# Baskets of a slice: the baskets of an itemset are kept as one sorted list of 32-bit numbers for each slice.
SLICE_BASKETS = 1 << 16


def _grown(sets: DataFrame, size: int, least: int) -> DataFrame:
    """(items, slice, tids, n) of the frequent itemsets of ``size`` items, from those with one item less.

    Two sets that agree in all but their last item give one of ``size``: its baskets are those of both, met slice by slice. A set all of whose subsets
    are frequent is the only candidate; equal prefixes meet in the join, and hot ones are split by slices.
    """
    head = F.slice("items", 1, size - 2)
    x = sets.select(head.alias("head"), "slice", F.element_at("items", -1).alias("last_x"), F.col("tids").alias("tids_x"))
    y = sets.select(head.alias("head"), "slice", F.element_at("items", -1).alias("last_y"), F.col("tids").alias("tids_y"))
    met = x.join(y, ["head", "slice"]).filter("last_x < last_y")
    made = met.select(F.concat("head", F.array("last_x", "last_y")).alias("items"), "slice", F.array_intersect("tids_x", "tids_y").alias("tids")).filter(F.size("tids") > 0)
    made = cut(made)
    kept = made.groupBy("items").agg(F.sum(F.size("tids")).alias("n")).filter(F.col("n") >= least)
    return cut(made.join(kept, "items").select("items", "slice", "tids", "n"))


def frequent_itemsets(baskets: DataFrame, basket: str, item: str, least: int, part_rows: int = PART_ROWS) -> tuple[DataFrame, int]:
    """(items, n) of every itemset that ``least`` baskets hold, items in order, and the number of baskets.

    Pairs are counted where their baskets are (large baskets in tiles); larger sets by meeting the lists of baskets of two smaller ones, so that no basket
    is ever gathered. Lists cover a slice of the baskets each, and a task takes about ``part_rows`` rows, so neither grows with the input.
    """
    rows, n_baskets, n_rows = _basket_rows(baskets, basket, item, part_rows)
    items, kept, weight = _kept_rows(rows, n_rows, least, part_rows)
    with tasks_of(rows.sparkSession, weight, part_rows):
        return _itemsets(items, kept, least, n_baskets), n_baskets


def _itemsets(items: DataFrame, kept: DataFrame, least: int, n_baskets: int) -> DataFrame:
    pairs = pairs_within(kept, ["basket"], "item")
    counted = pairs.groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    found = [items.select(F.array("item").alias("items"), F.col("n_item").alias("n"))]
    counted = cut(counted)
    if counted.isEmpty():
        return found[0]
    found.append(counted.select(F.array("item_a", "item_b").alias("items"), "n"))
    # Larger sets only hold baskets of frequent pairs that share an item with another one.
    ends = counted.groupBy(F.col("item_a").alias("item_a")).agg(F.count(F.lit(1)).alias("shared")).filter("shared > 1").select("item_a")
    useful = cut(counted.join(ends, "item_a").select("item_a", "item_b", "n"))
    if useful.isEmpty():
        return found[0].unionByName(found[1])
    held = pairs.join(useful, ["item_a", "item_b"])
    # A basket's slice, whatever the baskets' names are.
    slices = max(1, -(-n_baskets // SLICE_BASKETS))
    place = F.pmod(F.xxhash64("basket"), F.lit(slices)).cast("int")
    sets = cut(held.groupBy("item_a", "item_b", "n", place.alias("slice")).agg(F.collect_list("basket").alias("tids")).select(F.array("item_a", "item_b").alias("items"), "slice", "tids", "n"))
    size = 3
    while True:
        grown = _grown(sets, size, least)
        drop_cut(sets)
        sets = grown
        level = cut(sets.groupBy("items").agg(F.first("n").alias("n")))
        if level.isEmpty():
            break
        found.append(level)
        size += 1
    return reduce(DataFrame.unionByName, found)


def itemset_rules(
    baskets: DataFrame, basket: str, item: str, min_confidence: float, min_support: float = 0.0, min_count: int = 1,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Rules with one consequent over itemsets of any size, in at least ``min_count`` baskets and ``min_support`` of all baskets."""
    rows, n_baskets, n_rows = _basket_rows(baskets, basket, item, part_rows)
    least = max(1, min_count, math.ceil(min_support * n_baskets - 1e-9))
    n = F.lit(float(max(1, n_baskets)))
    items, kept, weight = _kept_rows(rows, n_rows, least, part_rows)
    with tasks_of(rows.sparkSession, weight, part_rows):
        sets = cut(_itemsets(items, kept, least, n_baskets))
        each = sets.filter(F.size("items") > 1).select(F.col("items").alias("all"), F.col("n").alias("n_all"), F.explode("items").alias("one"))
        rules = each.select(F.array_remove("all", F.col("one")).alias("left"), "one", "n_all")
        left = sets.select(F.col("items").alias("left"), F.col("n").alias("n_left"))
        one = sets.filter(F.size("items") == 1).select(F.col("items")[0].alias("one"), F.col("n").alias("n_one"))
        share = F.col("n_all").cast("double") / F.col("n_left")
        joined = cut(rules.join(left, "left").filter(share >= min_confidence).join(one, "one"))
    return joined.select(
        F.concat_ws(",", F.transform("left", lambda x: x.cast("string"))).alias("antecedent"),
        F.col("one").cast("string").alias("consequent"),
        share.alias("confidence"),
        (F.col("n_all") * n / (F.col("n_left").cast("double") * F.col("n_one"))).alias("lift"),
        (F.col("n_all") / n).alias("support"),
    )
