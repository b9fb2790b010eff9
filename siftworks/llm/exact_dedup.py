"""Exact deduplication against a persistent digest index (DataFrame operations only).

The index is a Parquet table bucketed and sorted by digest. A batch is reduced to one row per digest (partial sums before
the shuffle, so a text that fills a third of the rows costs a row per task). Only these rows are dealt out by the index's buckets
and meet it in sort-merge joins that read it without a shuffle: an anti-join finds what is new and appends it, a left join what
stands for each text. The answers go back to the rows of the batch, those of the most frequent texts by a broadcast. Texts never
leave the scan: only their digests are moved.

Defined cases: a null text counts as empty; a null doc_id never wins unless all ids of its group are null; rows that repeat
both doc_id and text are one document and get the same answer; an empty batch appends nothing; other columns are ignored. Of
equal texts the largest doc_id of the batch that brought them first stays: what later batches bring changes neither it nor the
size of its group. An index keeps the number of buckets it was made with, whatever is asked for when it is opened again; a folder
with data but without the index's own record (index.json) is refused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm.common import cut, forget, join_groups, partitions, scratch, text_or_empty
from siftworks.session import read_small, there, write_small

SCHEMA = "digest string, keep_id bigint, group_size bigint"


def digest_of(text: Column) -> Column:
    return F.sha2(text, 256)


class DigestIndex:
    """A digest table at a path: opened if there, else made. buckets: of a new one; about 128 MB each is a good size.

    <path>/index.json says how many buckets it has and in which folder the data are; it is replaced as a whole by compact()."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.name = spark, path.rstrip("/"), ""
        held = read_small(spark, f"{self.path}/index.json")
        if held is None:
            if there(spark, self.path):
                raise ValueError(f"{path} has no index.json, so the number of its buckets isn't known")
            held = json.dumps({"buckets": int(buckets), "folder": "digests"})
            write_small(spark, f"{self.path}/index.json", held)
        self._take(json.loads(held))

    def _take(self, held: dict) -> None:
        self.close()
        self.buckets, self.folder = held["buckets"], held["folder"]
        self.name = self._table(self.folder)

    def _table(self, folder: str) -> str:
        name, at = f"digests_{uuid.uuid4().hex}", f"{self.path}/{folder}".replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {name} ({SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{at}'")
        return name

    def entries(self) -> DataFrame:
        self.spark.sql(f"REFRESH TABLE {self.name}")
        return self.spark.table(self.name)

    def dealt(self, groups: DataFrame) -> DataFrame:
        """Rows (one per digest) where their buckets are, so that the index needs no shuffle."""
        return groups.repartition(self.buckets, "digest")

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Those of the groups (one row per digest) that the index doesn't hold."""
        return self.dealt(groups).join(self.entries().hint("merge"), "digest", "left_anti")

    def found(self, groups: DataFrame) -> DataFrame:
        """digest, rows (of the batch), and keep_id and group_size as the index has them, or of the batch if it has none."""
        held = self.entries().select("digest", F.struct("keep_id", "group_size").alias("held"))
        own = F.struct("keep_id", "group_size")
        joined = self.dealt(groups).join(held.hint("merge"), "digest", "left")
        return joined.select("digest", F.col("group_size").alias("rows"), F.coalesce("held", own).alias("g")).select("digest", "rows", "g.*")

    def add(self, groups: DataFrame) -> None:
        """Appends what is new. A digest that the index holds keeps its first entry."""
        self.unseen(groups).select("digest", "keep_id", "group_size").write.insertInto(self.name)

    def compact(self) -> None:
        """One sorted file for each bucket again, after many batches. The new folder takes the old one's place in one step."""
        folder = f"digests-{uuid.uuid4().hex}"
        name = self._table(folder)
        self.entries().groupBy("digest").agg(F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size")).write.insertInto(name)
        self.spark.sql(f"DROP TABLE {name}")
        old, held = self.folder, {"buckets": self.buckets, "folder": folder}
        write_small(self.spark, f"{self.path}/index.json", json.dumps(held))
        self._take(held)
        forget(self.spark, f"{self.path}/{old}")

    def close(self) -> None:
        """Forgets the table's name; its files stay."""
        if self.name:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def groups_of(digests: DataFrame) -> DataFrame:
    return digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Adds the batch to the index and returns, per row: doc_id, keep_id, group_size, kept, text_sha256.

    keep_id is the document that stands for the text: of those that came in its first batch, the one with the largest doc_id.
    The result doesn't read the index any more.
    """
    digests = cut(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest_of(text_or_empty()).alias("digest")))
    groups = cut(groups_of(digests))
    found = cut(index.found(groups))
    index.add(groups)
    return join_groups(digests, found, "digest", "rows").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


def exact_dedup(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """deduplicate() over a new index in the shared folder, whose files stay."""
    spark = docs.sparkSession
    index = DigestIndex(spark, scratch(spark, "digests"), buckets or max(8, partitions(spark)))
    try:
        return deduplicate(docs, index)
    finally:
        index.close()
