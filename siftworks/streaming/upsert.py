"""Tables by date into which late rows are merged by key.

A batch brings rows of any dates. Of each date that it touches old and new rows are merged: of those with the same key the latest
counts, by an order column, else the batch's. The merged date is written as a version of its own, data/batch=<id>/dt=<date>, and the
batch's commit, written last, says which dates it has replaced. Readers take of each date the version of the last commit: they see all
of a batch or nothing of it, and a batch that failed half-way, or comes again, makes no difference: it writes the same folders anew,
and once committed it does nothing. Dates that a batch doesn't touch are neither read nor written.

Defined cases: rows without a date are kept under the null date; null keys are keys like others; without an order column, or where it
is equal or null on both sides, the batch's row counts and of its own the greatest; an empty batch only commits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftworks.session import cut, remove, there

MAX_DATES = 1 << 20
#: The folder of rows without a date, as Spark names it.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


class DatedTable:
    """A table at a path. schema: of its rows, dt (date) among them; key: columns that tell rows of a date apart; order: a column that
    grows with later versions of a row."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: list[str], order: str | None = None):
        self.spark, self.path, self.key, self.order = spark, path, key, order
        self.columns = [f.name for f in schema.fields]
        self.stored = T.StructType([*(f for f in schema.fields if f.name != "dt"), T.StructField("batch", T.LongType()), T.StructField("dt", T.DateType())])

    def commits(self) -> DataFrame:
        """dt, batch: all that were ever made; a batch without rows has none."""
        if not there(self.spark, f"{self.path}/commits"):
            return self.spark.createDataFrame([], "dt date, batch long")
        return self.spark.read.schema("dt date, batch long").parquet(f"{self.path}/commits")

    def committed(self, batch: int) -> bool:
        return there(self.spark, f"{self.path}/commits/batch={batch}/_SUCCESS")

    def versions(self) -> DataFrame:
        """dt, batch: the version of each date that counts."""
        return self.commits().groupBy("dt").agg(F.max("batch").alias("batch"))

    def rows(self, dates: DataFrame | None = None) -> DataFrame:
        """The rows as of the last commit; of some dates only, if these are given (dt)."""
        if not there(self.spark, f"{self.path}/data"):
            return self.spark.createDataFrame([], self.stored).select(self.columns)
        wanted = self.versions()
        if dates is not None:
            wanted = wanted.join(dates, wanted["dt"].eqNullSafe(dates["dt"]), "left_semi")
        wanted = cut(wanted).select(F.col("dt").alias("__dt"), F.col("batch").alias("__batch"))
        if wanted.count() <= MAX_DATES:  # a row for each date
            wanted = F.broadcast(wanted)
        held = self.spark.read.schema(self.stored).parquet(f"{self.path}/data")
        return held.join(wanted, (held["batch"] == F.col("__batch")) & held["dt"].eqNullSafe(F.col("__dt")), "left_semi").select(self.columns)

    def upsert(self, batch: DataFrame, number: int) -> None:
        """Merges a batch. number: grows from batch to batch; a number that was committed is passed over."""
        if self.committed(number):
            return
        new = cut(batch.select(self.columns))
        dates = cut(new.select("dt").distinct())
        latest = [*([F.col(self.order)] if self.order else []), F.col("__new")]
        both = self.rows(dates).withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
        whole = F.struct(*[F.col(c) for c in self.columns])
        others = [F.to_json(F.col(c)) if isinstance(new.schema[c].dataType, T.MapType | T.VariantType) else F.col(c) for c in self.columns]
        best = both.groupBy("dt", *[c for c in self.key if c != "dt"]).agg(F.max_by(whole, F.struct(*latest, *others)).alias("row"))
        merged = best.select("row.*").withColumn("dt", F.col("dt"))
        merged.write.mode("overwrite").partitionBy("dt").parquet(f"{self.path}/data/batch={number}")
        dates.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={number}")

    def vacuum(self) -> int:
        """Removes versions that no longer count, for when no reader holds them, and returns how many."""
        every, last = self.commits(), self.versions().select(F.col("dt").alias("day"), F.col("batch").alias("last"))
        old = every.join(last, F.col("dt").eqNullSafe(F.col("day"))).where("batch < last").select("batch", F.coalesce(F.date_format("dt", "yyyy-MM-dd"), F.lit(NO_DATE)))
        folders = [f"{self.path}/data/batch={batch}/dt={dt}" for batch, dt in old.collect()]  # one for each date and batch
        gone = [x for x in folders if there(self.spark, x)]
        for x in gone:
            remove(self.spark, x)
        return len(gone)


def run_upserts(spark: SparkSession, source: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame], into: DatedTable, checkpoint: str) -> None:
    """Merges the files of a folder that no run before has, and ends. The stream's batch numbers are the table's."""
    stream = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(lambda batch, number: into.upsert(transform(batch), number))
    stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
