"""The feature matrix lies in even parts and is scaled once for all its scans."""

import datetime as dt

from larder.operators import features as FT
from larder.plans import modeling as M

SMALL = "/root/testdata/sf0.001"


def stock(spark, n):
    """All rows but a few are of one category."""
    rows = [
        (k, "IN" if k % 3 else "OUT", dt.datetime(2024, 1, 1 + k % 28, k % 24), f"red item{k % 5}", 7 if k % 50 else 3, float(k % 11), float(k % 7), float(k % 5))
        for k in range(n)
    ]
    kinds = "row_id long, event_type string, timestamp timestamp_ntz, product_name string, category int, calories_100g double, proteins_100g double, carbs_100g double"
    return spark.createDataFrame(rows, kinds)


def test_a_large_category_is_dealt_out(spark):
    rows, key = stock(spark, 4000), "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        dealt, names = FT.raw_feature_matrix(rows, carry=["category"], part_rows=100)
        sizes = dealt.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    finally:
        spark.conf.set(key, before)
    assert sum(sizes) == 4000 and max(sizes) < 3000
    whole, same = FT.raw_feature_matrix(rows)
    assert names == same and dealt.columns == ["row_id", "category", "features"]
    assert {r.row_id: r.features for r in dealt.collect()} == {r.row_id: r.features for r in whole.collect()}
    assert {r.row_id: r.category for r in dealt.collect()} == {r.row_id: r.category for r in rows.collect()}


def test_the_matrix_that_components_scan_is_written_scaled(spark):
    matrix, _, names = M.reduced(spark, SMALL)
    assert matrix._cut_path and len(matrix.first()["features"]) == len(names)
