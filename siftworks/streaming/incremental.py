"""Incremental runs as streams: what was processed is in the checkpoint, so nothing is computed twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def run_once(spark: SparkSession, source: str, schema: StructType, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, partition_by: str | None = None, timeout: int | None = None) -> None:
    """Processes the files of a folder that no run before has, appends the result, and ends. Late files are taken, however old.

    timeout: seconds after which the run is stopped between batches; the next goes on from there.
    """
    stream = transform(spark.readStream.schema(schema).parquet(source))
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    query = (writer.partitionBy(partition_by) if partition_by else writer).start()
    if not query.awaitTermination(timeout) if timeout else query.awaitTermination():
        query.stop()


def run_dates(spark: SparkSession, source: str, schema: StructType, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """As run_once, but whole dates (dt) are replaced: for sources that hand out a date anew when it was bad."""

    def write(batch: DataFrame, _: int) -> None:
        transform(batch).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(out)

    spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
