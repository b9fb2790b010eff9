"""A corpus pipeline: the stages in order, each over all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm import decontaminate, mixing, sharding, simhash, toxicity
from siftworks.llm.common import scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what a model fitted on the labelled rows of docs calls toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs.select(COLUMNS), model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that with the smallest doc_id. Shingles of five words, similarity 0.8."""
    return simhash.one_of_each(docs.select(COLUMNS))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark window."""
    return decontaminate.without_contaminated(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs.select(COLUMNS), carry=("text", "lang", "n_chars"))
    copies = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    return mixed.where("copies > 0").select("*", copies).select(COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard of each row."""
    return sharding.shard(docs.select(COLUMNS))


STAGES = [("toxicity", reject_toxic), ("near_dedup", drop_near_duplicates), ("decontamination", drop_benchmark_passages), ("mixing", mix_sources), ("sharding", shard)]

#: The first stage (a fitted model) can't be put into SQL; tests/llm checks the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
