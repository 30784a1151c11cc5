"""Missing keys in sessions, digits of the inertia, repeated products, the shared folder, removed rounds."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from larder.functions import scalars as S
from larder.operators import components
from larder.operators import evaluation as E
from larder.operators import joins as J
from larder.operators import ledger as L
from larder.operators import reduction as R
from larder.operators import sessions as SE
from larder.plans import pipeline as P
from larder.session import cut, drop_cut, shared_dir
from tests.test_relational import TS, log, movement


def test_sessions_keep_missing_households_and_count_products(spark):
    rows = [
        movement(1, "OUT", 1, TS(2024, 1, 1, 9, 0), household=None, product=None),
        movement(2, "OUT", 1, TS(2024, 1, 1, 9, 5), household=None, product=4),
        movement(3, "OUT", 1, TS(2024, 1, 1, 9, 5), household=1, product=None),
    ]
    found = {r.household_id: (r.n_events, r.n_products) for r in SE.sessions(log(spark, rows), "OUT").collect()}
    assert found == {None: (2, 1), 1: (1, 0)}
    assert SE.assign_sessions(log(spark, rows), "OUT").count() == 3


def test_inertia_keeps_its_digits(spark):
    rows = [(1, [1e6]), (1, [1e6 + 0.001]), (2, [-1e6]), (2, [-1e6 + 0.001])]
    found = E.inertia(spark.createDataFrame(rows, "cluster_label int, features array<double>")).first()
    assert found.n_clusters == 2
    assert found.inertia == pytest.approx(1e-6, rel=1e-3)


def test_catalog_has_one_row_for_a_repeated_product(spark):
    m = log(spark, [movement(1, "IN", 1, TS(2024, 1, 1), product=7), movement(2, "IN", 1, TS(2024, 1, 1), product=8)])
    products = spark.createDataFrame([(7, "a", 1), (7, "b", 2)], "product_id long, product_name string, department_id int")
    reference = spark.createDataFrame([], "name_key string, rank int, nutrients array<struct<nutrientId:int,value:double>>")
    found = {r.product_id: (r.product_name, r.category) for r in J.build_catalog(m, products, reference).collect()}
    assert found == {7: ("b", 2), 8: ("Unknown Product", 0)}


def test_enrich_refuses_a_repeated_key(spark):
    m = log(spark, [movement(1, "IN", 1, TS(2024, 1, 1), product=7)])
    row = (7, "A", 1.0, 1.0, 1.0, 4)
    schema = "product_id long, nutriscore string, calories_100g double, proteins_100g double, carbs_100g double, category int"
    assert J.enrich(m, spark.createDataFrame([row], schema)).count() == 1
    with pytest.raises(PySparkException, match="not unique"):
        J.enrich(m, spark.createDataFrame([row, row], schema)).collect()


def test_only_the_sweep_forces_waste(spark):
    day = dt.date(2024, 1, 10)
    rows = spark.createDataFrame([("IN", day, day), ("OUT", day, day), ("OUT", day, dt.date(2024, 1, 9)), ("OUT", day, dt.date(2023, 1, 1))], "e string, d date, x date")
    got = [r[0] for r in rows.select(S.classify_movement(F.col("e"), F.col("d"), F.col("x"))).collect()]
    assert got == ["Purchase", "Consumption", "Waste", "Waste"]


def test_unset_shared_folder_is_refused_on_a_cluster():
    conf = {"spark.sql.warehouse.dir": "file:/warehouse"}
    def session(master, **more):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, *d: (conf | more).get(k, *d)), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))
    assert shared_dir(session("local[4]")) == "file:/warehouse/_scratch"
    assert shared_dir(session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared"})) == "hdfs:///shared"


def test_dropped_rounds_are_gone(spark):
    table = cut(spark.range(3))
    assert table.count() == 3
    drop_cut(table)
    with pytest.raises(PySparkException):
        spark.read.parquet(table._cut_path).count()


def test_components_of_a_hub_and_a_chain(spark):
    edges = [(0, k) for k in range(1, 60)] + [(k, k + 1) for k in range(100, 160)]
    nodes = spark.createDataFrame([(k,) for k in [*range(60), *range(100, 161), 500]], "node long")
    found = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long"), nodes, []).collect()}
    assert found == {**dict.fromkeys(range(60), 0), **dict.fromkeys(range(100, 161), 100), 500: 500}


def test_squared_distance_is_refused_by_the_fixed_gate(spark):
    rows = spark.createDataFrame([(1, [0.0])], "row_id long, features array<double>")
    with pytest.raises(ValueError, match="Euclidean"):
        P.choose_model(rows, 2, distance=E.SQUARED)


def test_projection_leaves_the_model_as_it_was(spark):
    rows = spark.createDataFrame([(k, [float(k), float(k % 3), -float(k)]) for k in range(-9, 10)], "row_id long, features array<double>")
    parts = R.fit_components(rows)
    before = parts.model.getOutputCol()
    R.project(rows, parts, 1).count()
    assert parts.model.getOutputCol() == before


def test_a_restocked_lot_is_written_off_once_per_term(spark):
    day = lambda n: dt.date(2024, 1, n)
    rows = [
        movement(1, "IN", 5, TS(2024, 1, 1, 9), day(3)),
        movement(2, "OUT", 1, TS(2024, 1, 6, 9)),  # on the write-off day: still counts
        movement(3, "IN", 2, TS(2024, 1, 10, 9), day(12)),
        movement(4, "IN", 1, TS(2024, 1, 14, 9), day(20)),  # in time: the term goes on
        movement(5, "OUT", 4, TS(2024, 1, 25, 9)),
        movement(6, "IN", 6, TS(2024, 1, 26, 9), day(30)),
    ]
    m = log(spark, rows)
    got = sorted((r.timestamp.day, r.quantity, r.expiry_date.day) for r in L.expiry_writeoffs(m).collect())
    assert got == [(6, 4, 3), (23, 3, 20)]
    assert [(r.stock_id, r.balance) for r in L.open_lots(m).collect()] == [("s", 2)]
    daily = sorted((r.day.day, r.kind, r.quantity) for r in L.daily_ledger(m).collect())
    assert daily == [(1, "balance", 5), (6, "balance", 4), (6, "write_off", 4), (10, "balance", 2), (14, "balance", 3), (23, "write_off", 3), (25, "balance", -4), (26, "balance", 2)]
