import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.functions import scalars as S
from larder.operators import clustering as K
from larder.operators import evaluation as E
from larder.operators import features as FT
from larder.operators import ledger as L
from larder.operators import reduction as R
from larder.plans import pipeline as P
from larder.streaming.ledger import STATE_STORE, ledger_stream
from larder.streaming.run import drain
from tests.test_density import frame, groups, labels_of
from tests.test_relational import log, movement


def test_tokens(spark):
    texts = ["100% Whole Wheat Bread", "Bag of Organic Bananas", "Half & Half", "Extra-Fancy Crème_x 7 a", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(S.tokens(F.col("t"))).collect()]
    assert got == [["100", "wheat", "bread"], ["bag", "organic", "bananas"], ["half", "half"], ["extra", "fancy", "crème_x"], []]


def test_text_weights_equal_the_definition(spark):
    names = [("red apple", 3), ("red red pear", 1), ("", 2), ("kiwi", 1)]
    rows = [n for n, c in names for _ in range(c)]
    inv = spark.createDataFrame([(i, n or None) for i, n in enumerate(rows)], "row_id long, product_name string")
    weights, vocab = FT.name_weights(inv, 3)
    assert vocab.terms == ["apple", "kiwi", "red"]
    n, df = 7, {"apple": 3, "kiwi": 1, "red": 4}
    idf = {t: np.log((1 + n) / (1 + d)) + 1 for t, d in df.items()}
    got = {r["name"]: r["txt"] for r in weights.collect()}
    norm = np.hypot(idf["apple"], idf["red"])
    assert got["red apple"] == pytest.approx([idf["apple"] / norm, 0, idf["red"] / norm])
    assert got["red red pear"] == pytest.approx([0, 0, 1])
    assert got[""] == [0, 0, 0]


def test_standardize_population_and_constant(spark):
    df = frame(spark, np.array([[1.0, 5.0], [2.0, 5.0], [4.0, 5.0]]))
    got = np.array([r["features"] for r in FT.standardize(df, "features", 2).orderBy("row_id").collect()])
    x = np.array([1.0, 2.0, 4.0])
    assert got[:, 0] == pytest.approx((x - x.mean()) / x.std())
    assert (got[:, 1] == 0).all()


def test_components_equal_numpy_and_svd(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5))
    x -= x.mean(axis=0)
    df = frame(spark, x)
    c = R.fit_components(df)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert c.variance == pytest.approx(values)
    assert c.ratio.sum() == pytest.approx(1.0)
    assert c.directions.T @ c.directions == pytest.approx(np.eye(5), abs=1e-9)
    svd = [r["variance"] for r in R.svd_variances(df, 5).orderBy("pc").collect()]
    assert svd == pytest.approx(list(values))
    n = R.components_for(c, 0.9)
    assert np.cumsum(values / values.sum())[n - 1] >= 0.9 and (n == 1 or np.cumsum(values / values.sum())[n - 2] < 0.9)
    got = np.array([r["pca"] for r in R.project(df, c, 2).orderBy("row_id").collect()])
    assert got == pytest.approx(x @ c.directions[:, :2])
    assert (c.directions[np.abs(c.directions).argmax(axis=0), range(5)] > 0).all()
    curve = [r["cumulative"] for r in R.scree(spark, c).orderBy("pc").collect()]
    assert curve[-1] == pytest.approx(1.0)
    energy = R.energy_table(R.scree(spark, c), 2).orderBy("pc").collect()
    assert [r["variance_pct"] for r in energy] == pytest.approx([round(v * 100, 2) for v in c.ratio[:2]], abs=0.011)
    names = [f"f{i}" for i in range(5)]
    load = {r["feature"]: r["norm"] for r in R.loadings(spark, c, names).collect()}
    assert sorted(load, key=load.get)[-1] == R.top_loadings(R.loadings(spark, c, names), 1).first()["feature"]


def test_threshold_not_reached_raises(spark):
    with pytest.raises(ValueError):
        R.components_for(R.Components(None, np.array([0.5, 0.2]), np.eye(2), np.ones(2), 1.0, 3), 0.9)


def test_kmeans_finds_separated_groups_and_inertia_agrees(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.1, size=(40, 2)) for c in ((0, 0), (9, 0), (0, 9))])
    sweep = K.kmeans_sweep(frame(spark, x), [2, 3, 4], restarts=2)
    best = E.best_model(sweep.results).first()
    assert best["params"] == "k=3"
    labels = sweep.labelled.select("row_id", "features", F.element_at("labels", 2).alias("cluster_label"))
    assert E.inertia(labels).first()["inertia"] == pytest.approx(best["metric"], rel=1e-6)
    nearest = K.assign_to_centres(frame(spark, x), np.array([[0, 0], [9, 0], [0, 9]]))
    assert (labels_of(nearest, len(x)) == np.repeat([0, 1, 2], 40)).all()


def test_mixture_bic():
    assert K.mixture_bic(-10.0, 2, 3, 100) == pytest.approx(20.0 + 19 * np.log(100))


def test_model_choice_rules(spark):
    rows = [
        (0, "K-Means", "k=2", 0.49, 1.0, 2, 0.0),
        (1, "DBSCAN", "a", 0.9, 0.0, 3, 0.7),
        (2, "DBSCAN", "b", 0.6, 0.0, 3, 0.3),
        (3, "DBSCAN", "c", 0.5, 0.0, 3, 0.1),
        (4, "GMM", "n=2", 0.95, 0.0, 2, 0.0),
        (5, "HDBSCAN", "d", 0.99, 0.0, 1, 0.0),
    ]
    table = spark.createDataFrame(rows, "trial_no int, paradigm string, params string, silhouette double, metric double, n_clusters long, noise_ratio double")
    one = {r["paradigm"]: (r["params"], r["silhouette"], r["winner"]) for r in E.model_comparison(table, 1).collect()}
    assert one["DBSCAN"] == ("b", 0.6, False) and one["GMM"][2] and one["HDBSCAN"][1] == -1.0
    two = {r["paradigm"]: (r["params"], r["winner"]) for r in E.model_comparison(table, 2).collect()}
    assert two == {"DBSCAN": ("c", True), "HDBSCAN": ("d", False)}


def test_model_choice_end_to_end(spark):
    x = groups(n=200, seed=8)
    choice = P.choose_model(frame(spark, x), 1, kmeans_grid=(3, 6), dbscan_grid=[(0.01, 5), (1.2, 5)], gmm_grid=(2,), restarts=1)
    assert choice.results.count() == 5
    assert choice.labels.count() == len(x)
    assert choice.results.filter("params LIKE 'eps=0.01%'").first()["silhouette"] is None


def test_stream_ledger_replay_equals_batch(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    rows, row_id = [], 0
    for lot in range(6):
        expiry = dt.date(2024, 1, 3 + lot)
        rows.append(movement(row_id, "IN", 4, day + dt.timedelta(hours=lot), expiry, stock=f"l{lot}"))
        row_id += 1
        for k in range(lot % 4):
            rows.append(movement(row_id, "OUT", 1, day + dt.timedelta(days=1 + k, hours=lot), stock=f"l{lot}"))
            row_id += 1
    last = dt.datetime(2024, 2, 1)
    m = log(spark, rows + [movement(row_id, "IN", 1, last, dt.date(2024, 3, 1), stock="late"), movement(row_id + 1, "IN", 1, last + dt.timedelta(days=2), dt.date(2024, 3, 1), stock="later")])
    for i, (lo, hi) in enumerate(((0, 8), (8, row_id), (row_id, row_id + 2))):
        m.filter(f"row_id >= {lo} AND row_id < {hi}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = drain(ledger_stream(stream, "1 day"), "test-ledger", STATE_STORE)
    offs = {(r["stock_id"], r["day"], r["quantity"]) for r in got.filter("kind = 'write_off'").collect()}
    want = {(r["stock_id"], r["timestamp"].date(), r["quantity"]) for r in L.expiry_writeoffs(m).collect()}
    assert offs == want and len(want) == 6
    ledger = L.lot_ledger(m.filter("stock_id NOT LIKE 'late%'"))
    ends = ledger.groupBy("stock_id", F.to_date("timestamp").alias("day")).agg(F.max_by("balance", F.struct("timestamp", "row_id")).alias("q"))
    batch = {(r["stock_id"], r["day"], r["q"]) for r in ends.collect()}
    streamed = {(r["stock_id"], r["day"], r["quantity"]) for r in got.filter("kind = 'balance' AND stock_id NOT LIKE 'late%'").collect()}
    assert streamed == batch
