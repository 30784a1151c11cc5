"""Run a stream to the end of what is there and hand back the result as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from larder.session import scratch_path

STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"


def drain(stream: DataFrame, name: str, state_store: str | None = None) -> DataFrame:
    """Process everything available into a Parquet table in the shared folder and read it.

    ``state_store`` names the provider a stateful processor needs; it is set while the query runs.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(STATE_STORE_CONF)
    if state_store:
        spark.conf.set(STATE_STORE_CONF, state_store)
    try:
        started = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", scratch_path(spark, f"{name}-progress"))
            .trigger(availableNow=True)
            .start(path)
        )
        started.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE_CONF, before)
    return spark.read.schema(stream.schema).parquet(path)
