"""Dimension joins: enrichment, lookups with defaults, semi joins and the nutrient pivot.

No hint is given on sides that can grow; adaptive execution measures them, broadcasts the small ones and splits hot
keys of the shuffled ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import schemas
from larder.functions import scalars as S


def catalog_subset(catalog: DataFrame) -> DataFrame:
    """Only the columns that do not collide with the movement log."""
    return catalog.select(*schemas.CATALOG_SUBSET)


def cast_key(df: DataFrame, key: str = "product_id") -> DataFrame:
    """Strict cast: a value that is no 64-bit integer raises."""
    return df.withColumn(key, F.col(key).cast("bigint"))


def one_per_key(dim: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """The looked-up columns by key; fails the job when a key stands twice, as the join would repeat rows.

    The check is a filter, which no column pruning removes and which keeps the partitioning by key: the join needs no exchange of its own.
    """
    twice = F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string"))).cast("boolean")
    found = dim.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.first(c).alias(c) for c in cols], F.count(F.lit(1)).alias("_n"))
    return found.filter(F.when(F.col("_n") == 1, True).otherwise(twice)).drop("_n")


def enrich(movements: DataFrame, catalog: DataFrame) -> DataFrame:
    """Every movement with the nutrition columns of its product, NULL where the catalog has none."""
    dim = cast_key(catalog_subset(catalog))
    return cast_key(movements).join(one_per_key(dim, "product_id", [c for c in dim.columns if c != "product_id"]), "product_id", "left")


def keep_listed(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the list."""
    return df.join(ids.select(key), key, "left_semi")


def last_by_key(df: DataFrame, key: str, seq: str, cols: list[str]) -> DataFrame:
    """One row per key; the entry with the highest ``seq`` wins."""
    return df.groupBy(key).agg(F.max_by(F.struct(*cols), seq).alias("_last")).select(key, "_last.*")


def lookup(df: DataFrame, dim: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """Left join on a unique key with a default for each looked-up column."""
    found = df.join(one_per_key(dim, key, list(defaults)), key, "left")
    return found.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def mandatory_lookup(df: DataFrame, dim: DataFrame, key: str, col: str) -> DataFrame:
    """Left join that fails the job when a key has no entry."""
    missing = F.raise_error(F.concat(F.lit(f"no {col} for {key} "), F.col(key).cast("string")))
    marked = dim.select(key, col, F.lit(True).alias("_found"))
    joined = df.join(marked, key, "left")
    return joined.withColumn(col, F.when(F.col("_found"), F.col(col)).otherwise(missing)).drop("_found")


# Nutrient ids of the food database.
NUTRIENT_IDS = {"calories_100g": 1008, "proteins_100g": 1003, "carbs_100g": 1005}


def best_hits(reference: DataFrame) -> DataFrame:
    """The first-ranked record of each name, its nutrients turned into columns; the last duplicate wins."""
    best = reference.groupBy("name_key").agg(F.min_by("nutrients", "rank").alias("nutrients"))

    def last_value(nid: int):
        same = F.filter("nutrients", lambda n: n["nutrientId"] == nid)
        return F.try_element_at(same, F.lit(-1))["value"]

    return best.select("name_key", *[last_value(nid).alias(c) for c, nid in NUTRIENT_IDS.items()])


def add_nutrition(products: DataFrame, reference: DataFrame) -> DataFrame:
    """Products with calories, proteins and carbs of the best match for their name and the score; NULL if no hit."""
    named = products.withColumn("name_key", S.search_name(F.col("product_name")))
    joined = named.join(best_hits(reference), "name_key", "left")
    return joined.withColumn("nutriscore", S.nutriscore(F.col("calories_100g"))).drop("name_key")


def build_catalog(movements: DataFrame, products: DataFrame, reference: DataFrame) -> DataFrame:
    """Catalog of the products seen in the log: default name and department, then nutrition and score."""
    seen = movements.select("product_id").distinct()
    # Of repeated products the last one in the order of all columns wins, whatever the row order.
    listed = products.select("product_id", "product_name", F.col("department_id").alias("category"))
    named = lookup(
        seen,
        last_by_key(listed.withColumn("_seq", F.struct("product_name", "category")), "product_id", "_seq", ["product_name", "category"]),
        "product_id",
        {"product_name": "Unknown Product", "category": 0},
    )
    return add_nutrition(named, reference)
