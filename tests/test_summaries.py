"""Singular values by QR, and the vocabulary from sketches, against plainly written versions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import features as FT
from larder.operators import reduction as R


def frame(spark, x):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "row_id long, features array<double>")


@pytest.mark.parametrize("groups", [2, 32])
def test_small_singular_values_survive(spark, monkeypatch, groups):
    """Condition number 1e9: the squares of the smallest values are below what the covariance can hold."""
    monkeypatch.setattr(R, "QR_GROUPS", groups)
    monkeypatch.setattr(R, "QR_ROWS", 17)
    rng = np.random.default_rng(1)
    u, _ = np.linalg.qr(rng.standard_normal((300, 5)))
    v, _ = np.linalg.qr(rng.standard_normal((5, 5)))
    want = np.array([1e3, 10.0, 1.0, 1e-3, 1e-6])
    x = (u * want) @ v.T
    found = [r.singular_value for r in R.svd_variances(frame(spark, x).repartition(6), 5).orderBy("pc").collect()]
    assert found == pytest.approx(want.tolist(), rel=1e-6)
    by_product = np.sqrt(np.maximum(np.linalg.eigvalsh(x.T @ x)[::-1], 0.0))
    assert abs(by_product[-1] / want[-1] - 1) > 1e-3


def test_fewer_rows_than_columns(spark):
    x = np.random.default_rng(2).standard_normal((3, 6))
    found = [r.singular_value for r in R.svd_variances(frame(spark, x), 6).orderBy("pc").collect()]
    assert found == pytest.approx([*np.linalg.svd(x, compute_uv=False), 0, 0, 0])
    with pytest.raises(ValueError, match="no rows"):
        R.svd_variances(frame(spark, x).filter("row_id < 0"), 6)


def texts(n):
    rng = random.Random(5)
    names = [f"word{k}" for k in range(400)]
    return [" ".join(rng.choices(names, weights=[1 / (k + 1) for k in range(400)], k=rng.randint(0, 40))) for _ in range(n)] + ["", None]


@pytest.mark.parametrize("tracked,features", [(50_000, 20), (40, 10), (40, 300), (50_000, 1000)])
def test_terms_equal_plain_counts(spark, tracked, features):
    """With a sketch that holds all terms, and with one so small that its bound has to send most cases to the full count."""
    rows = texts(200)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    weights, v = FT.weigh_terms(docs, ["doc_id"], "text", features, tracked=tracked)
    split = [(t or "").split() for t in rows]
    total, holding = Counter(w for t in split for w in t), Counter(w for t in split for w in set(t))
    top = sorted(sorted(total, key=lambda w: (-total[w], w))[:features])
    assert v.terms == top and v.totals == [total[w] for w in top]
    idf = np.array([np.log((1 + len(rows)) / (1 + holding[w])) + 1 for w in top])
    assert np.allclose(v.idf, idf)
    for r in weights.collect():
        count = Counter(split[r.doc_id])
        x = np.array([count[w] for w in top]) * idf
        norm = np.sqrt((x * x).sum())
        assert np.allclose(r.txt, x / norm if norm else x)


def test_the_bound_holds(spark):
    rows = texts(300)
    total = Counter(w for t in rows for w in (t or "").split())
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(7)
    for tracked in (20, 60, 1000):
        terms, bound = FT.heavy_terms(docs, "text", 15, tracked)
        assert all(n <= bound for w, n in total.items() if w not in terms)


def test_no_terms(spark):
    docs = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    weights, v = FT.weigh_terms(docs, ["doc_id"], "text", 5)
    assert v.terms == [] and {r.doc_id: list(r.txt) for r in weights.collect()} == {1: [], 2: []}
    weights, v = FT.weigh_terms(docs.filter(F.lit(False)), ["doc_id"], "text", 5)
    assert v.terms == [] and weights.count() == 0
