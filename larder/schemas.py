"""Column contracts of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names and types of the tables' columns, and the keys of the patterns document.
MOVEMENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("household_id", T.IntegerType()),
        T.StructField("stock_id", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("expiry_date", T.DateType()),
        T.StructField("classification", T.StringType()),
    ]
)

PATTERNS = T.StructType(
    [
        T.StructField("distribucion_horas", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField(
            "top_50_productos",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("product_id", T.LongType()),
                        T.StructField("product_name", T.StringType()),
                        T.StructField("department_id", T.IntegerType()),
                    ]
                )
            ),
        ),
    ]
)

CATALOG_SUBSET = ["product_id", "nutriscore", "calories_100g", "proteins_100g", "carbs_100g", "category"]
NUTRIENTS = ["calories_100g", "proteins_100g", "carbs_100g"]


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of a missing value: NaN becomes NULL at every source boundary."""

    def clean(field: T.StructField) -> Column:
        col = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(col), col).alias(field.name)
        return col

    return df.select(*[clean(f) for f in df.schema.fields])
