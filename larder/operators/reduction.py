"""Linear reduction: full PCA, variance curve, projection, loadings, and the same variances from a QR factorisation in a tree."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed value.
VARIANCE_KEPT = 0.90


@dataclass
class Components:
    """Fitted components; everything here is d x d at most."""

    model: object
    ratio: np.ndarray
    directions: np.ndarray
    signs: np.ndarray
    total_variance: float
    n_rows: int

    @property
    def variance(self) -> np.ndarray:
        return self.ratio * self.total_variance


def fit_components(df: DataFrame, features: str = "features") -> Components:
    """All components of a centred matrix (array column). Signs are fixed so that the largest loading is positive."""
    width = len(df.select(features).first()[0])
    items = [F.element_at(features, i + 1) for i in range(width)]
    stats = df.agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.var_samp(x) for x in items]).alias("v")
    ).first()
    vectors = df.select(array_to_vector(F.col(features)).alias("v"))
    model = PCA(k=width, inputCol="v", outputCol="pc").fit(vectors)
    directions = model.pc.toArray()
    strongest = np.abs(directions).argmax(axis=0)
    signs = np.where(directions[strongest, np.arange(width)] < 0, -1.0, 1.0)
    return Components(
        model, model.explainedVariance.toArray(), directions * signs, signs, float(sum(stats["v"])), stats["n"]
    )


def scree(spark: SparkSession, c: Components) -> DataFrame:
    """(pc, ratio, cumulative), one row per component."""
    rows = [(i + 1, float(r)) for i, r in enumerate(c.ratio)]
    table = spark.createDataFrame(rows, "pc int, ratio double")
    # As many rows as features, so one task for the running sum is enough.
    w = W.orderBy("pc").rowsBetween(W.unboundedPreceding, 0)
    return table.withColumn("cumulative", F.sum("ratio").over(w))


def energy_table(curve: DataFrame, first: int = 5) -> DataFrame:
    """Variance kept by the leading components, in percent with two digits."""
    percent = lambda c: F.bround(F.col(c) * 100, 2)
    return curve.filter(F.col("pc") <= first).select(
        "pc", percent("ratio").alias("variance_pct"), percent("cumulative").alias("cumulative_pct")
    )


def components_for(c: Components, share: float = VARIANCE_KEPT) -> int:
    """Fewest components that reach the share; fails when none does."""
    reached = np.nonzero(np.cumsum(c.ratio) >= share)[0]
    if reached.size == 0:
        raise ValueError(f"no number of components reaches {share}")
    return int(reached[0]) + 1


def first_reaching(curve: DataFrame, order: str, value: str, threshold: float) -> DataFrame:
    """Smallest ``order`` whose cumulative ``value`` reaches the threshold, from a table of shares."""
    w = W.orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    cumulative = curve.withColumn("cumulative", F.sum(value).over(w))
    found = F.min(F.when(F.col("cumulative") >= threshold, F.col(order)))
    return cumulative.agg(F.coalesce(found, F.raise_error(F.lit("threshold not reached")).cast("bigint")).alias("n"))


def project(df: DataFrame, c: Components, n: int, features: str = "features", out: str = "pca") -> DataFrame:
    """First n coordinates of every row. The model does not centre, so the input has to be centred."""
    scored = c.model.copy().setInputCol("_v").setOutputCol("_pc").transform(
        df.withColumn("_v", array_to_vector(F.col(features)))
    )
    signs = F.array(*[F.lit(float(s)) for s in c.signs[:n]])
    turned = F.zip_with(F.slice(vector_to_array("_pc"), 1, n), signs, lambda x, s: x * s)
    return scored.withColumn(out, turned).drop("_v", "_pc")


def loadings(spark: SparkSession, c: Components, names: list[str], n: int = 2) -> DataFrame:
    """Loadings of each feature on the first n components and their norm."""
    load = c.directions[:, :n] * np.sqrt(np.maximum(c.variance[:n], 0.0))
    norms = np.linalg.norm(load, axis=1)
    rows = [(name, *map(float, load[i]), float(norms[i])) for i, name in enumerate(names)]
    cols = ", ".join(f"l{i + 1} double" for i in range(n))
    return spark.createDataFrame(rows, f"feature string, {cols}, norm double")


def top_loadings(table: DataFrame, k: int = 6) -> DataFrame:
    return table.orderBy(F.desc("norm"), "feature").limit(k)


# Rows of a block that one factorisation takes, and factors that the driver puts together at most.
QR_ROWS, QR_GROUPS = 4096, 32


def triangular_factor(df: DataFrame, features: str = "features") -> tuple[np.ndarray, int]:
    """R of the QR factorisation of the whole matrix, and its number of rows, in one scan by a tree: of each block in a task, of what the task has so far
    stacked on the next block, of groups of tasks, and of these few on the driver.

    R has the singular values of the matrix. They are found without the product of the matrix with itself, in which the small ones drown.
    """

    def factor(batches):
        r, n = None, 0
        for pdf in batches:
            for at in range(0, len(pdf), QR_ROWS):
                x = np.array(pdf[features].iloc[at : at + QR_ROWS].tolist(), np.float64)
                n += len(x)
                r = np.linalg.qr(x if r is None else np.vstack([r, x]), mode="r")
        if r is not None:
            yield pd.DataFrame([{"r": r.tobytes(), "width": r.shape[1], "n": n}])

    def stacked(parts) -> np.ndarray:
        return np.linalg.qr(np.vstack([np.frombuffer(bytes(p), np.float64).reshape(-1, w) for p, w in parts]), mode="r")

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        r = stacked(zip(pdf["r"], pdf["width"], strict=True))
        return pd.DataFrame([{"r": r.tobytes(), "width": r.shape[1], "n": pdf["n"].sum()}])

    schema = "r binary, width int, n long"
    rows = df.select(F.col(features).alias(features))
    parts = rows.mapInPandas(factor, schema)
    if df.rdd.getNumPartitions() > QR_GROUPS:
        parts = parts.groupBy(F.pmod(F.spark_partition_id(), F.lit(QR_GROUPS)).alias("g")).applyInPandas(group, schema)
    found = parts.collect()  # QR_GROUPS rows at most, each of a factor
    if not found:
        raise ValueError("no rows to factorise")
    return stacked((p["r"], p["width"]) for p in found), sum(p["n"] for p in found)


def svd_variances(df: DataFrame, k: int, features: str = "features") -> DataFrame:
    """Singular values of the centred matrix and squared / (n - 1): the component variances by another route than the covariance."""
    r, n = triangular_factor(df, features)
    values = np.zeros(r.shape[1])
    found = np.linalg.svd(r, compute_uv=False)
    values[: len(found)] = found
    rows = [(i + 1, float(s), float(s * s / (n - 1))) for i, s in enumerate(values[:k])]
    return df.sparkSession.createDataFrame(rows, "pc int, singular_value double, variance double")
