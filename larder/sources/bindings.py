"""The inventory tables as views over the shared star schema and event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import scalars as S
from larder.session import scratch_path
from larder.sources.tables import read_parquet

# Brands without a catalog entry, and without a hit in the nutrition search.
NOT_LISTED = "Brand#3"
NOT_FOUND = "Brand#8"
DEPARTMENT_BY_TYPE = {"STANDARD": 4, "ECONOMY": 16, "MEDIUM": 7, "PROMO": 13, "SMALL": 19}
OTHER_DEPARTMENT = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_id, product_name, department_id, size, brand of every part."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        S.lookup_constant(F.col("p_type"), DEPARTMENT_BY_TYPE, OTHER_DEPARTMENT).alias("department_id"),
        F.col("p_size").alias("size"),
        F.col("p_brand").alias("brand"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = products(spark, sf_dir).filter(F.col("brand") != NOT_LISTED)
    key = F.col("product_id")
    calories = F.when(key % 10 != 3, key * F.lit(5.0))
    return p.select(
        F.when(key % 7 != 2, F.col("size") / F.lit(4.0)).alias("proteins_100g"),
        (key % 90).cast("double").alias("carbs_100g"),
        calories.alias("calories_100g"),
        "product_id",
        "product_name",
        F.col("department_id").alias("category"),
        S.nutriscore(calories).alias("nutriscore"),
    )


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN/OUT log from the event table."""
    return movements_from(table(spark, sf_dir, "events"), spark, sf_dir)


# The household of the row that closes a replay.
CLOSING = -1


def movement_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as a stream that replays a landed copy of it to its end.

    One more movement, of the household ``CLOSING`` and years after the last one, moves the watermark behind every open session and write-off
    day, so that what is still open comes out; ``without_closing`` removes what it leaves itself.
    """
    log = movements(spark, sf_dir)
    closing = log.agg(F.max("timestamp").alias("timestamp")).select(
        F.lit(-1).cast("bigint").alias("row_id"), F.lit(CLOSING).alias("household_id"), F.lit("closing").alias("stock_id"), F.lit("OUT").alias("event_type"),
        F.lit(0).alias("quantity"), (F.col("timestamp") + F.expr("INTERVAL 1000 DAYS")).alias("timestamp"),
    )
    # Sessions of either type are closed by a row of their own type.
    both = closing.unionByName(closing.withColumn("event_type", F.lit("IN")))
    landed = scratch_path(spark, "landing")
    log.unionByName(both, allowMissingColumns=True).write.parquet(landed)
    return spark.readStream.schema(log.schema).parquet(landed)


def without_closing(replayed: DataFrame) -> DataFrame:
    return replayed.filter(F.col("household_id") != CLOSING)


def movements_from(raw: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as movements, named after their part."""
    events = raw.select(
        F.col("event_id").alias("row_id"),
        F.col("event_id").cast("string").alias("event_id"),
        (F.col("user_id") % 10).cast("int").alias("household_id"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("product_id"),
        F.when(F.col("event_type").isin("purchase", "signup"), "IN").otherwise("OUT").alias("event_type"),
        (1 + F.col("event_id") % 3).cast("int").alias("quantity"),
        F.col("ts").alias("timestamp"),
    )
    names = products(spark, sf_dir).select(
        "product_id", "product_name", F.when(F.col("brand") != NOT_LISTED, F.col("department_id")).alias("department")
    )
    day = F.to_date("timestamp")
    out_expiry = F.date_add(day, (F.col("row_id") % 9 - 4).cast("int"))
    return (
        events.join(names, "product_id", "left")
        .withColumn("stock_id", F.concat_ws("-", "household_id", "product_id"))
        .withColumn(
            "expiry_date",
            F.when(F.col("event_type") == "IN", S.expiry_date(day, F.col("department"))).otherwise(out_expiry),
        )
        .withColumn("classification", S.classify_movement(F.col("event_type"), day, F.col("expiry_date")))
        .select(
            "row_id",
            "event_id",
            "household_id",
            "stock_id",
            "product_id",
            "product_name",
            "event_type",
            "quantity",
            "timestamp",
            "expiry_date",
            "classification",
        )
    )


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as (basket, item), repeats kept."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("basket"), F.col("l_partkey").alias("item")
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, 64 doubles, given label."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        F.col("embedding").cast("array<double>").alias("features"),
        F.col("label").alias("cluster_label"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id and all 64 coordinates, doubled: the density grids then reach from no neighbour to nearly all rows."""
    return embeddings(spark, sf_dir).select("row_id", F.transform("features", lambda x: x * 2.0).alias("features"))


def nutrition_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offline answers of the nutrition search: ranked hits by name, each with a list of (nutrientId, value)."""
    p = products(spark, sf_dir).filter(F.col("brand") != NOT_FOUND)
    key = F.col("product_id")
    entry = lambda nid, value: F.struct(F.lit(nid).alias("nutrientId"), value.cast("double").alias("value"))
    return p.select(
        S.search_name(F.col("product_name")).alias("name_key"),
        key.alias("rank"),
        F.array(
            entry(1008, key * 2.0),
            entry(1003, F.col("size") / F.lit(2.0)),
            entry(1008, key * 3.0),
            entry(1005, (key % 40) * 1.0),
            entry(2000, key * 1.0),
        ).alias("nutrients"),
    )
