"""Data-quality checks and their roll-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.operators.ledger import LOT, signed_quantity

# Fixed values.
DOMAINS = {
    "event_type": ("IN", "OUT"),
    "classification": ("Purchase", "Consumption", "Waste", "Forced_Waste"),
    "nutriscore": ("A", "B", "C", "D", "Falta Dato"),
}


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def observed_write(df: DataFrame, path: str, measures: Mapping[str, Column]) -> dict[str, object]:
    """Write a table and return what the aggregates ``measures`` of its rows are, taken in the tasks of that write: no scan of their own."""
    seen = Observation()
    df.observe(seen, *[c.alias(name) for name, c in measures.items()]).write.parquet(path)
    return seen.get


def profile_measures(df: DataFrame, domains: Mapping[str, Sequence[str]] = DOMAINS) -> dict[str, Column]:
    """Rows, nulls of every column and values outside the domains, as aggregates of one pass."""
    rows = {"rows": F.count(F.lit(1))}
    nulls = {f"nulls {c}": F.count_if(F.col(c).isNull()) for c in df.columns}
    return rows | nulls | {f"bad {c}": F.count_if(~F.col(c).isin(*values)) for c, values in domains.items()}


def profile_rows(spark: SparkSession, df: DataFrame, seen: Mapping[str, object], domains: Mapping[str, Sequence[str]] = DOMAINS) -> DataFrame:
    """(column, n_rows, nulls, null_share, bad) from observed measures; ``bad`` is NULL for a column without a domain. A row for each column."""
    n = seen["rows"]
    rows = [(c, n, seen[f"nulls {c}"], seen[f"nulls {c}"] / n if n else None, seen[f"bad {c}"] if c in domains else None) for c in df.columns]
    return spark.createDataFrame(rows, "column string, n_rows long, nulls long, null_share double, bad long")


def domain_checks(df: DataFrame, domains: Mapping[str, Sequence[str]] = DOMAINS) -> DataFrame:
    """Per column: values outside the domain and nulls, in one pass."""
    cols = list(domains)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        aggs.append(F.count_if(~F.col(c).isin(*domains[c])).alias(f"{c}_bad"))
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}_null"))
    once = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}_bad").alias("bad"), F.col(f"{c}_null").alias("nulls"))
            for c in cols]
    out = once.select("n_rows", F.inline(F.array(*rows)))
    share = F.when(F.col("n_rows") > 0, F.col("nulls").cast("double") / F.col("n_rows"))
    return out.select("column", "n_rows", "bad", "nulls", share.alias("null_share"))


def lot_integrity(movements: DataFrame, ledger: DataFrame) -> DataFrame:
    """Violation counts: waste rows of a lot never received, a lot with several products, a balance below zero."""
    is_in = F.col("event_type") == "IN"
    waste = F.col("classification").isin("Waste", "Forced_Waste")
    per_lot = movements.groupBy(*LOT).agg(
        F.count_if(is_in).alias("n_in"),
        F.count_if(waste).alias("n_waste"),
        F.min("product_id").alias("lo"),
        F.max("product_id").alias("hi"),
        F.sum(signed_quantity()).alias("balance"),
    )
    lots = per_lot.agg(
        F.coalesce(F.sum(F.when(F.col("n_in") == 0, F.col("n_waste"))), F.lit(0)).alias("waste_without_in"),
        F.count_if(F.col("lo") != F.col("hi")).alias("mixed_products"),
        F.count_if(F.col("balance") < 0).alias("lots_ending_negative"),
    ).unpivot([], ["waste_without_in", "mixed_products", "lots_ending_negative"], "check", "violations")
    below = ledger.agg(F.count_if(F.col("balance") < 0).alias("violations"))
    return lots.unionByName(below.select(F.lit("rows_below_zero").alias("check"), "violations"))


def check_row(component: str, check: str, severity: str, df: DataFrame, passed: Column) -> DataFrame:
    """One check result from a one-row aggregate."""
    return df.agg(passed.alias("passed")).select(
        F.lit(component).alias("component"), F.lit(check).alias("check"), F.lit(severity).alias("severity"), "passed"
    )


def known_row(spark: SparkSession, component: str, check: str, severity: str, passed: bool) -> DataFrame:
    """One check result from a measure that is known already."""
    return spark.createDataFrame([(component, check, severity, passed)], "component string, check string, severity string, passed boolean")


def union_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def status(checks: DataFrame) -> DataFrame:
    """READY without errors, MOSTLY READY below three, else NOT READY."""
    failed = ~F.col("passed")
    totals = checks.agg(
        F.count_distinct("component").alias("components"),
        F.count_if(failed & (F.col("severity") == "error")).alias("errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"),
    )
    state = (
        F.when(F.col("errors") == 0, "READY").when(F.col("errors") < 3, "MOSTLY READY").otherwise("NOT READY")
    )
    return totals.withColumn("status", state)


def component_status(checks: DataFrame) -> DataFrame:
    """Per component: whether all checks and whether any check passed."""
    return checks.groupBy("component").agg(
        F.bool_and("passed").alias("all_passed"), F.bool_or("passed").alias("any_passed")
    )


def pass_rate(checks: DataFrame) -> DataFrame:
    """Passed checks in percent, 0 when there are none."""
    share = F.avg(F.col("passed").cast("double")) * 100
    return checks.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        F.coalesce(share, F.lit(0.0)).alias("percentage"),
    )
