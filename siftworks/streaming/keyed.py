"""Streams that let each key pass once: what was seen is in the state, so neither the output nor a history is read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_seen(stream: DataFrame, keys: list[str], time: str | None = None, expiry: str | None = None) -> DataFrame:
    """The first row of each key. expiry: for how long after its time a key is remembered; for ever if not given. Which of a batch's
    rows with one key passes isn't defined, so rows should be told by their keys."""
    if expiry is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(time, expiry).dropDuplicatesWithinWatermark(keys)


def run_new_keys(spark: SparkSession, source: str, schema: StructType, keys: list[str], out: str, checkpoint: str, time: str | None = None, expiry: str | None = None) -> None:
    """Appends to out the rows of a folder's new files whose keys no file before had, and ends. The state lies in RocksDB: it grows
    with the keys on the executors' disks, and its changes go to the checkpoint, not all of it."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        stream = first_seen(spark.readStream.schema(schema).parquet(source), keys, time, expiry)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
