"""What a task takes stays as it is when the input grows."""

import datetime as dt
import random
from collections import Counter

import pytest

from larder.operators import cooccurrence as C
from larder.session import tasks_of


@pytest.fixture
def parts(spark, monkeypatch):
    """The number of shuffled parts in force at every write of the co-occurrence operators."""
    seen, cut = [], C.cut
    monkeypatch.setattr(C, "cut", lambda df: seen.append(int(spark.conf.get("spark.sql.shuffle.partitions"))) or cut(df))
    return seen


@pytest.mark.parametrize("leaf_pairs", [0, 4, 4096])
def test_leaves_and_digits_count_the_same(spark, monkeypatch, leaf_pairs):
    """Repeated times, and few digits before the leaves: rows compared by digits stay a few times the events."""
    monkeypatch.setattr(C._digit_pairs, "__defaults__", (leaf_pairs,))
    levels, totals = [], C._digit_totals
    monkeypatch.setattr(C, "_digit_totals", lambda a, b, bits, some: levels.append(some) or totals(a, b, bits, some))
    rng, start = random.Random(leaf_pairs), dt.datetime(2024, 1, 1)
    rows = [(rng.choice(["IN", "OUT"]), rng.randint(0, 1), rng.randint(1, 5), start + dt.timedelta(seconds=rng.randrange(0, 14400, rng.choice([1, 600])))) for _ in range(160)]
    rows += rows[:40]
    found = C.proximity_pairs(spark.createDataFrame(rows, "event_type string, household_id int, product_id long, timestamp timestamp_ntz"), hot_pairs=0)
    got = {(r.event_type, r.product_a, r.product_b): r.n_pairs for r in found.collect()}
    want = Counter((a[0], a[2], b[2]) for a in rows for b in rows if a[:2] == b[:2] and a[2] < b[2] and abs((a[3] - b[3]).total_seconds()) <= C.SESSION_GAP[a[0]])
    assert got == want
    assert len(levels[0]) <= 7 < 32


def lines(spark, n):
    """Baskets of three items each, every set of three in two baskets."""
    return spark.range(n).selectExpr("id DIV 3 AS basket", "(id DIV 6) * 3 + id % 3 AS item")


def test_settings_come_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ZeroDivisionError), tasks_of(spark, 1000, 100) as n:
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n) == "10"
        1 / 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_tasks_of_pair_rules_follow_the_rows(spark, parts):
    assert C.pair_rules(lines(spark, 900), "basket", "item", 2, part_rows=100).count() == 900
    assert parts and set(parts) == {9}
    assert C.pair_rules(lines(spark, 1800), "basket", "item", 2, part_rows=100).count() == 1800
    assert parts[-1] == 18


def test_large_baskets_count_by_their_pairs(spark, parts):
    """60 items in each of three baskets are 5,310 pairs, of which a task takes 400."""
    rows = spark.range(180).selectExpr("id % 3 AS basket", "id DIV 3 AS item")
    assert C.pair_rules(rows, "basket", "item", 2, part_rows=100).count() == 60 * 59
    assert parts[-1] == 14


def test_rare_items_of_a_large_basket_are_no_pairs(spark, parts):
    rows = lines(spark, 90).unionByName(spark.range(1000).selectExpr("-1L AS basket", "1000 + id AS item"))
    assert C.pair_rules(rows, "basket", "item", 2, part_rows=100).count() == 90
    assert set(parts) == {11}


def test_tasks_of_itemset_rules_follow_the_rows(spark, parts):
    rules = C.itemset_rules(lines(spark, 900), "basket", "item", 0.1, min_count=2, part_rows=100)
    assert rules.count() == 900 + 450  # ordered pairs, and three rules of each triple
    assert set(parts) == {9}
