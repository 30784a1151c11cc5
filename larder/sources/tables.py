"""Reading and writing tables, JSON documents, feature names and matrices."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import schemas


class MissingTable(FileNotFoundError):
    """An upstream table is not there; the message names the path."""


def _load(reader, path: str) -> DataFrame:
    try:
        return reader.load(path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise MissingTable(f"missing table: {path}") from err
        raise


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format("parquet")
    return schemas.nan_to_null(_load(reader.schema(schema) if schema else reader, path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header row; pass a schema for large files (without one an extra pass infers the types)."""
    reader = spark.read.format("csv").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return schemas.nan_to_null(_load(reader, path))


def head(df: DataFrame, n: int) -> DataFrame:
    """First rows for a look at the shape of a table."""
    return df.limit(n)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def read_patterns(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nested JSON document -> (hour share by text key, one row per product)."""
    reader = spark.read.format("json").schema(schemas.PATTERNS).option("multiLine", True)
    doc = _load(reader, path)
    hours = doc.select(F.explode("distribucion_horas").alias("hour", "share"))
    products = doc.select(F.inline("top_50_productos"))
    return hours, products


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def feature_names_table(spark: SparkSession, names: list[str]) -> DataFrame:
    """Names of the matrix columns with their 1-based position; as many rows as there are features."""
    return spark.createDataFrame(list(enumerate(names, start=1)), "pos int, name string")


def write_matrix(df: DataFrame, path: str) -> None:
    """Keyed matrix or label table: row_id plus one array or label column."""
    if "row_id" not in df.columns:
        raise ValueError("a matrix is stored with its row_id")
    write_parquet(df, path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    return _load(spark.read.format("parquet"), path)
