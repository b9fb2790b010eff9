"""What the operators share: the shared folder, lineage cuts and reading tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.session import cut, scratch, shared_dir  # noqa: F401  (the operators' names for them; on a cluster the folder has to be set)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(df: DataFrame, most: int = 1 << 20) -> DataFrame:
    """For joins: broadcast up to a number of rows (of a few numbers each), else left to Spark, which shuffles both sides.

    df is counted, so it should be cut or cheap."""
    return F.broadcast(df) if df.count() <= most else df


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, share: int = 1024) -> DataFrame:
    """rows joined with groups, which has one row for each key and the number of rows that have it.

    Keys that have one row in `share` or more (there are `share` of them at most) are broadcast, so that no task gets all rows
    of one; the others meet by a shuffle. Both should be cut or cheap; rows without a key (null) are left out."""
    least = F.lit(max(2, -(-(groups.agg(F.sum(size)).first()[0] or 0) // share)))
    hot, cold = groups.where(F.col(size) >= least), groups.where(F.col(size) < least)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def forget(spark: SparkSession, path: str) -> None:
    """Removes a folder of scratch()."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def settle(df: DataFrame, what: str = "step") -> tuple[DataFrame, str]:
    """df written to the shared folder and read again, and its path: for loops, which forget() what they no longer need.

    Unlike a checkpoint's, its size is known, so that joins with small tables are planned as such, and estimates don't multiply
    from round to round."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def listed(spark: SparkSession, rows: list[tuple], columns: dict[str, pa.DataType]) -> DataFrame:
    """A few rows of the driver's as a table. By way of Arrow no Python worker has to pass them on."""
    values = list(zip(*rows, strict=True)) or [()] * len(columns)
    return spark.createDataFrame(pa.table({name: pa.array(x, kind) for (name, kind), x in zip(columns.items(), values, strict=True)}))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
