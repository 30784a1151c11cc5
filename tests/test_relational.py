import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from larder.functions import scalars as S
from larder.operators import aggregates as A
from larder.operators import cooccurrence as C
from larder.operators import features as FT
from larder.operators import joins as J
from larder.operators import ledger as L
from larder.operators import quality as Q
from larder.operators import sessions as SE
from larder.operators.running import running_sums
from larder.sources import tables as T

TS = dt.datetime


def movement(row_id, kind, qty, ts, expiry=None, household=1, stock="s", product=7, label=None):
    label = label or ("Purchase" if kind == "IN" else "Consumption")
    return (row_id, str(row_id), household, stock, product, "p", kind, qty, ts, expiry, label)


SCHEMA = (
    "row_id long, event_id string, household_id int, stock_id string, product_id long, product_name string, "
    "event_type string, quantity int, timestamp timestamp_ntz, expiry_date date, classification string"
)


def log(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_score_borders(spark):
    rows = spark.createDataFrame([(0.0,), (49.9,), (50.0,), (149.99,), (150.0,), (299.9,), (300.0,), (None,), (float("nan"),)], "c double")
    got = [r[0] for r in rows.select(S.nutriscore(F.col("c"))).collect()]
    assert got == ["A", "A", "B", "B", "C", "C", "D", "Falta Dato", "Falta Dato"]


def test_search_name(spark):
    names = ["Organic Hass Avocado", "Bag of Organic Bananas", "organic kale", "Apple Honeycrisp Organic", "\tOrganic Limes "]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(S.search_name(F.col("n"))).collect()]
    assert got == ["Hass Avocado", "Bag of  Bananas", "organic kale", "Apple Honeycrisp", "Limes"]


def test_weekday_hour_and_half_even(spark):
    row = spark.sql("SELECT timestamp_ntz'2026-12-01 23:05:00' AS ts").select(S.day_of_week(F.col("ts")), S.hour_of_day(F.col("ts"))).first()
    assert tuple(row) == (1, 23)
    shares = spark.createDataFrame([("a",)] * 1 + [("b",)] * 31 + [(None,)] * 5, "k string")
    got = {r["k"]: r["share"] for r in A.frequency_shares(shares, "k").collect()}
    assert got == {"a": 0.0312, "b": 0.9688}


def test_shelf_life_and_writeoff_day(spark):
    day = dt.date(2024, 3, 1)
    rows = spark.createDataFrame([(day, c) for c in (4, 16, 7, 13, 19, 3, None)], "d date, c int")
    got = [(r[0] - day).days for r in rows.select(S.expiry_date(F.col("d"), F.col("c"))).collect()]
    assert got == [7, 12, 30, 120, 45, 14, 14]
    assert rows.select(S.writeoff_day(F.col("d"))).first()[0] == dt.date(2024, 3, 4)


def test_strict_cast_raises(spark):
    with pytest.raises(PySparkException):
        J.cast_key(spark.createDataFrame([("x1",)], "product_id string")).collect()


def test_left_join_keeps_null_and_unknown_keys(spark):
    m = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "row_id int, product_id int")
    c = spark.createDataFrame([(10, "A", 1.0, 2.0, 3.0, 4)], "product_id long, nutriscore string, calories_100g double, proteins_100g double, carbs_100g double, category int")
    got = {r["row_id"]: r["nutriscore"] for r in J.enrich(m, c).collect()}
    assert got == {1: "A", 2: None, 3: None}


def test_lookups(spark):
    dim = spark.createDataFrame([(1, 0, "old"), (1, 1, "new"), (2, 0, "two")], "k int, seq int, name string")
    last = J.last_by_key(dim, "k", "seq", ["name"])
    rows = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    got = {r["k"]: r["name"] for r in J.lookup(rows, last, "k", {"name": "Unknown Product"}).collect()}
    assert got == {1: "new", 2: "two", 3: "Unknown Product"}
    assert J.mandatory_lookup(rows.filter("k < 3"), last, "k", "name").count() == 2
    with pytest.raises(PySparkException, match="no name for k 3"):
        J.mandatory_lookup(rows, last, "k", "name").collect()


def test_nutrient_last_duplicate_wins(spark):
    ref = spark.createDataFrame(
        [("Kale", 2, [(1008, 9.0)]), ("Kale", 1, [(1008, 1.0), (1003, 2.0), (1008, 3.0), (7, 8.0)])],
        "name_key string, rank int, nutrients array<struct<nutrientId:int,value:double>>",
    )
    p = spark.createDataFrame([(1, "Organic Kale"), (2, "Moon Dust")], "product_id long, product_name string")
    got = {r["product_id"]: (r["calories_100g"], r["proteins_100g"], r["carbs_100g"], r["nutriscore"]) for r in J.add_nutrition(p, ref).collect()}
    assert got == {1: (3.0, 2.0, None, "A"), 2: (None, None, None, "Falta Dato")}


def test_ledger_puts_in_first_within_the_hour(spark):
    rows = [
        movement(1, "IN", 3, TS(2024, 1, 1, 9, 40), dt.date(2024, 1, 8)),
        movement(2, "OUT", 1, TS(2024, 1, 1, 9, 10)),
        movement(3, "OUT", 2, TS(2024, 1, 2, 9, 0)),
    ]
    for hot in (10, 0):
        got = {r["row_id"]: r["balance"] for r in L.lot_ledger(log(spark, rows), hot_rows=hot).collect()}
        assert got == {1: 3, 2: 2, 3: 0}


def test_writeoff_on_the_third_day_after_expiry(spark):
    expiry = dt.date(2024, 1, 8)
    rows = [
        movement(1, "IN", 3, TS(2024, 1, 1, 9), expiry),
        movement(2, "OUT", 1, TS(2024, 1, 10, 9)),
        movement(3, "IN", 1, TS(2024, 1, 1, 9), expiry, stock="used"),
        movement(4, "OUT", 1, TS(2024, 1, 3, 9), stock="used"),
        movement(5, "IN", 1, TS(2024, 1, 11, 9), dt.date(2024, 1, 30), stock="fresh"),
    ]
    m = log(spark, rows)
    got = [(r["stock_id"], r["quantity"], r["timestamp"], r["classification"]) for r in L.expiry_writeoffs(m).collect()]
    assert got == [("s", 2, TS(2024, 1, 11, 23, 59, 59), "Forced_Waste")]
    before = L.expiry_writeoffs(m, F.lit(dt.date(2024, 1, 10)))
    assert before.count() == 0
    assert [r["stock_id"] for r in L.open_lots(m).collect()] == ["fresh"]
    log_all = L.movements_with_writeoffs(m.filter("event_type = 'IN'"), m.filter("event_type = 'OUT'"), L.expiry_writeoffs(m))
    assert log_all.count() == 6


def test_running_sums_split_equals_plain_with_null_and_hot_keys(spark):
    rows = [(i, None if i % 7 == 0 else ("hot" if i % 3 else f"k{i % 5}"), i % 4) for i in range(600)]
    df = spark.createDataFrame(rows, "row_id long, k string, v int")
    for current in (True, False):
        a = running_sums(df, ["k"], ["row_id"], {"s": F.col("v")}, current, hot_rows=10**6)
        b = running_sums(df, ["k"], ["row_id"], {"s": F.col("v")}, current, hot_rows=0)
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_session_gap_of_exactly_delta_stays(spark):
    t0 = TS(2024, 1, 1, 12)
    rows = [movement(1, "OUT", 1, t0), movement(2, "OUT", 1, t0 + dt.timedelta(seconds=900), product=8), movement(3, "OUT", 1, t0 + dt.timedelta(seconds=1801))]
    got = SE.sessions(log(spark, rows), "OUT").orderBy("session_no").collect()
    assert [(r["n_events"], r["n_products"]) for r in got] == [(2, 2), (1, 1)]
    assert got[0]["session_end"] == t0 + dt.timedelta(seconds=900)


def test_proximity_pairs_equal_brute_force(spark):
    import random

    random.seed(5)
    t0 = TS(2024, 1, 1)
    rows = [
        movement(i, "OUT", 1, t0 + dt.timedelta(seconds=random.choice([random.randint(0, 9000), 900, 1800])), household=i % 2, product=random.randint(1, 6))
        for i in range(160)
    ]
    want = {}
    for a in rows:
        for b in rows:
            if a[2] == b[2] and a[4] < b[4] and abs((a[8] - b[8]).total_seconds()) <= 900:
                want[a[4], b[4]] = want.get((a[4], b[4]), 0) + 1
    for hot in (10**6, 50, 0):
        got = {(r["product_a"], r["product_b"]): r["n_pairs"] for r in C.proximity_pairs(log(spark, rows), {"OUT": 900}, hot).collect()}
        assert got == want


def test_pairs_of_a_large_group_are_tiled(spark):
    rows = spark.createDataFrame([("big", i) for i in range(40)] + [("small", i) for i in (1, 2, 3)], "k string, item int")
    plain = C.pairs_within(rows, ["k"], "item").select("k", "item_a", "item_b").collect()
    tiled = C.pairs_within(rows, ["k"], "item", tile_items=7).select("k", "item_a", "item_b").collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, tiled))
    assert len(plain) == 40 * 39 // 2 + 3


def test_imputation(spark):
    rows = [(1, 10.0), (1, None), (1, 20.0), (2, None), (None, 5.0)]
    df = spark.createDataFrame([(i, c, v) for i, (c, v) in enumerate(rows)], "row_id int, category int, x double")
    got = [r["x"] for r in FT.impute_category_mean(df, ["x"]).orderBy("row_id").collect()]
    assert got == [10.0, 15.0, 20.0, 0.0, 0.0]


@pytest.mark.parametrize("hot", [10, 0])
def test_ordered_target_encoding(spark, hot):
    rows = [(0, "a", "OUT"), (1, "a", "IN"), (2, "b", "OUT"), (3, "a", "OUT")]
    df = spark.createDataFrame(rows, "row_id long, category string, event_type string")
    got = [r["category_encoded"] for r in FT.target_encode_ordered(df, hot_rows=hot).orderBy("row_id").collect()]
    assert got == pytest.approx([0.75, 0.875, 0.75, 1.75 / 3])
    unseen = spark.createDataFrame([("a",), ("b",), ("z",)], "category string")
    static = [r["category_encoded"] for r in FT.target_encode_static(df, unseen).orderBy("category").collect()]
    assert static == pytest.approx([(2 + 0.75) / 4, (1 + 0.75) / 2, 0.75])


def test_status_roll_up(spark):
    def state(errors):
        rows = [("c", str(i), "error", i >= errors) for i in range(4)] + [("d", "w", "warning", False)]
        return Q.status(spark.createDataFrame(rows, "component string, check string, severity string, passed boolean")).first()

    assert [state(e)["status"] for e in (0, 1, 2, 3)] == ["READY", "MOSTLY READY", "MOSTLY READY", "NOT READY"]
    assert state(0)["warnings"] == 1
    empty = spark.createDataFrame([], "component string, check string, severity string, passed boolean")
    assert Q.pass_rate(empty).first()["percentage"] == 0.0


def test_lot_integrity_of_clean_and_broken_lots(spark):
    clean = [movement(1, "IN", 2, TS(2024, 1, 1, 9), dt.date(2024, 1, 8)), movement(2, "OUT", 2, TS(2024, 1, 2, 9))]
    broken = [movement(3, "OUT", 1, TS(2024, 1, 2, 9), stock="ghost", label="Waste"), movement(4, "IN", 1, TS(2024, 1, 3, 9), dt.date(2024, 1, 8), product=9)]
    for rows, want in ((clean, 0), (clean + broken, 1)):
        m = log(spark, rows)
        got = {r["check"]: r["violations"] for r in Q.lot_integrity(m, L.lot_ledger(m)).collect()}
        assert set(got.values()) == {want}


def test_missing_table_raises(spark):
    with pytest.raises(T.MissingTable, match="no-such-table"):
        T.read_parquet(spark, "/tmp/no-such-table.parquet")


def test_csv_round_trip_and_nan(spark, tmp_path):
    m = log(spark, [movement(1, "IN", 2, TS(2024, 1, 1, 9, 30, 5), dt.date(2024, 1, 8))]).drop("row_id")
    T.write_csv(m, str(tmp_path / "m"))
    from larder import schemas

    assert T.read_csv(spark, str(tmp_path / "m"), schemas.MOVEMENTS).collect() == m.select(*schemas.MOVEMENTS.fieldNames()).collect()
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in schemas.nan_to_null(nan).collect()] == [None, 1.0]


def test_itemset_rules_keep_the_full_denominator(spark):
    rows = [("t1", "a"), ("t1", "b"), ("t2", "a"), ("t2", "b"), ("t3", "a"), ("t4", "rare")]
    got = {(r["antecedent"], r["consequent"]): r for r in C.itemset_rules(spark.createDataFrame(rows, "t string, i string"), "t", "i", 0.1, min_support=0.5).collect()}
    rule = got["a", "b"]
    assert (rule["support"], rule["confidence"], rule["lift"]) == pytest.approx((0.5, 2 / 3, (2 / 3) / 0.5))
