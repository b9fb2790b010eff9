"""The history of tried keys, kept so that a run needn't shuffle it.

A table in Parquet, bucketed and sorted by key. A run reduces its candidates to distinct keys (partial sums first, so a key in a third
of the rows costs a row per task), deals these out by the history's buckets, and meets it in a sort-merge anti-join that reads it as it
lies. A bit filter of the candidates stands in the history's scan, so that of many years' keys only the few that may match are sorted
and compared. What is new is appended: a file for each bucket and run; compact() makes one sorted file of each again.

<path>/history.json names the number of buckets and the folder that counts; it is replaced as a whole, so readers see the table before
or after a compaction, never both. A history is opened with the buckets that it has, whatever is asked for.

Defined cases: a null key is never pending and never kept; repeated keys count once, with the first run that brought them (by name);
an empty history lets everything pass.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.operators.membership import membership
from siftworks.session import cut, read_small, remove, write_small


class History:
    """Keys (as strings) and the run that brought them. buckets: of a new one; about 128 MB each is a good size."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.name = spark, path, ""
        held = read_small(spark, f"{path}/history.json")
        if held is None:
            held = json.dumps({"buckets": int(buckets), "folder": "data-0"})
            write_small(spark, f"{path}/history.json", held)
        self._take(json.loads(held))

    def _take(self, held: dict) -> None:
        self.close()
        self.buckets, self.folder, self.name = held["buckets"], held["folder"], f"history_{uuid.uuid4().hex}"
        self._table(self.name, self.folder)

    def _table(self, name: str, folder: str) -> None:
        at = f"{self.path}/{folder}".replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {name} (key STRING, run STRING) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{at}'")

    def close(self) -> None:
        """Forgets the table's name; its files stay."""
        if self.name:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def keys(self) -> DataFrame:
        self.spark.sql(f"REFRESH TABLE {self.name}")
        return self.spark.table(self.name)

    def pending(self, candidates: DataFrame, key: str) -> DataFrame:
        """key: the distinct keys that the history doesn't hold."""
        distinct = cut(candidates.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key")).distinct())
        return self.unseen(distinct)

    def unseen(self, distinct: DataFrame) -> DataFrame:
        """As pending(), for distinct keys that are cut or cheap."""
        test = membership(distinct, "key")
        held = self.keys() if test is None else self.keys().where(test(F.col("key")))
        return distinct.repartition(self.buckets, "key").join(held.select("key").hint("merge"), "key", "left_anti")

    def rows_pending(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows whose key the history doesn't hold, with all their columns."""
        todo = self.pending(rows, key).withColumnRenamed("key", "__pending")
        return rows.join(todo, F.col(key).cast("string") == F.col("__pending"), "left_semi")

    def add(self, tried: DataFrame, key: str, run: str) -> None:
        """Appends the keys that are new."""
        new = cut(self.pending(tried, key))  # the table that is written to is read no more
        new.select("key", F.lit(run).alias("run")).repartition(self.buckets, "key").write.insertInto(self.name)

    def compact(self) -> None:
        """One sorted file for each bucket, in a folder that takes the place of what there was. One writer at a time."""
        folder, name = f"data-{uuid.uuid4().hex}", f"history_{uuid.uuid4().hex}"
        self._table(name, folder)
        once = self.keys().groupBy("key").agg(F.min("run").alias("run"))  # by bucket, without a shuffle
        once.write.insertInto(name)
        self.spark.sql(f"DROP TABLE {name}")
        old = self.folder
        held = {"buckets": self.buckets, "folder": folder}
        write_small(self.spark, f"{self.path}/history.json", json.dumps(held))
        self._take(held)
        remove(self.spark, f"{self.path}/{old}")
