"""Mixing sources to target weights by capped water-filling.

Each source's share of the total is in proportion to its weight. A source whose share is above max_epochs times its size is
clamped there, and what it leaves is dealt to the others by weight, until none is above. With the level L = (total left) /
(weights left) a source is clamped if its cap is below L times its weight, so each round needs two sums over the table of
sources and the driver only holds L. Then every document is taken floor(target / size) times, and those first in a seeded
order once more, until the target's rest is reached: the words taken differ from the target by half of one document at most.

The seeded order is that of a hash of doc_id and text. It is cut by a histogram of 4096 ranges per source; of the one range in
which the cut falls, rows at one place of the order (repeated rows) are first reduced to a number. So a source, or a row, that
fills a third of the table never meets in one task. If the cut falls within repeated rows, only as many of them as it needs are
taken once more: they are numbered within their partitions and shifted by what the partitions before hold.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; a null doc_id sorts as 'null', rows
without one by their texts; repeated rows count each for itself, and which of them are taken makes no difference (but for carried
columns in which they differ); an empty table gives no rows; sources without words have target 0; columns of docs that aren't carried are ignored, whatever their names.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.llm.common import cut, partitions, text_or_empty

WORDS = r"[^\x20\x09-\x0D]+"
MAX_BROADCAST_SOURCES = 100_000
ADDED = ("size", "source_size", "target", "copies", "taken")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORDS)).cast("bigint")


def seeded_key(doc_id: Column, text: Column, seed: int) -> Column:
    """Hex digits that order the documents of a source; the same in any run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(text)))


def cycle_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Adds weight: the cycle's numbers by the order of the sources (one row each), null last.

    Sources are numbered within ranges and shifted by what the ranges before hold, so that no task has to number all.
    """
    order = [F.col("source").isNull(), F.col("source")]
    ranged = cut(sources.repartitionByRange(partitions(sources.sparkSession), *order)).withColumn("__at", F.spark_partition_id())
    counts = ranged.groupBy("__at").agg(F.count(F.lit(1)).alias("__rows"))  # a row for each range
    before = counts.select("__at", (F.sum("__rows").over(W.orderBy("__at")) - F.col("__rows")).alias("__shift"))
    number = F.row_number().over(W.partitionBy("__at").orderBy(*order)) - 1 + F.col("__shift")
    numbered = ranged.join(F.broadcast(before), "__at").withColumn("__number", number % len(cycle))
    return numbered.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (F.col("__number") + 1).cast("int")).cast("bigint")).drop("__at", "__shift", "__number")


def water_fill(sources: DataFrame, max_epochs: int = 3) -> DataFrame:
    """sources: one row each with source_size and weight (whole numbers). Adds target (double)."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap = (F.col("source_size") * max_epochs).cast("decimal(38,0)")
    left, weights = total, sources.agg(F.sum("weight")).first()[0] or 0
    above = F.lit(False)
    while weights:
        above = cap * F.lit(weights).cast("decimal(18,0)") < F.lit(left).cast("decimal(20,0)") * F.col("weight").cast("decimal(10,0)")
        got = sources.agg(F.sum(F.when(above, F.col("source_size") * max_epochs)), F.sum(F.when(~above, F.col("weight")))).first()
        level = Fraction(left, weights)
        left, weights = total - (got[0] or 0), got[1] or 0
        if not weights or Fraction(left, weights) == level:
            break
    share = F.lit(float(left)) * F.col("weight").cast("double") / F.lit(float(weights or 1))
    return sources.withColumn("target", F.when(above, (F.col("source_size") * max_epochs).cast("double")).otherwise(share))


def mix(docs: DataFrame, max_epochs: int = 3, cycle: tuple[int, ...] = (1, 2, 3), seed: int = 42, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target (its source's), copies and taken (words, repeats counted).

    carry: other columns of docs to keep along (for a pipeline's stage; they are moved with the rows). One that is named as a column
    that is added, or as one of the operator's own (__...), is left out.
    """
    names = ["doc_id", "source", *(c for c in dict.fromkeys(carry) if c not in ("doc_id", "source", *ADDED) and not c.startswith("__"))]
    keyed = docs.select(*names, n_words(text_or_empty()).alias("__size"), seeded_key(F.col("doc_id"), text_or_empty(), seed).alias("__key"))
    keyed = keyed.withColumn("__source", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))).withColumn("__range", F.substring("__key", 1, 3))
    light = cut(keyed.select("source", "__source", "__range", "__key", "__size", "doc_id"))
    sources = cut(cycle_weights(light.groupBy("__source").agg(F.first("source").alias("source"), F.sum("__size").alias("source_size")), cycle))
    sources = cut(
        water_fill(sources, max_epochs)
        .withColumn("__whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint"))
        .withColumn("__rest", F.col("target") - F.col("__whole") * F.col("source_size"))
    )
    ranges = light.groupBy("__source", "__range").agg(F.sum("__size").alias("__sum"))
    upto = F.sum("__sum").over(W.partitionBy("__source").orderBy("__range"))
    crossing = F.col("__before") + F.col("__sum") >= F.col("__rest")
    cuts = ranges.withColumn("__before", upto - F.col("__sum")).join(small(sources.select("__source", "__rest")), "__source").where(crossing).groupBy("__source").agg(F.min(F.struct("__range", "__before")).alias("__cut"))
    plan = sources.join(cuts, "__source", "left").select("__source", "source_size", "target", "__whole", "__rest", F.col("__cut.__range").alias("__at"), F.col("__cut.__before").alias("__base"))
    plan = cut(plan)
    # the places of the range of the cut, each once with its number of rows
    places = light.join(small(plan), "__source").where(F.col("__range") == F.col("__at")).groupBy("__source", "__key").agg(F.first("__size").alias("__size"), F.count(F.lit(1)).alias("__rows"), F.first("__base").alias("__base"), F.first("__rest").alias("__rest"))
    before = F.col("__base") + F.sum(F.col("__size") * F.col("__rows")).over(W.partitionBy("__source").orderBy("__key").rowsBetween(W.unboundedPreceding, 0)) - F.col("__size") * F.col("__rows")
    # what is taken once more is a beginning of the order: the words before a row, and half of its own, are not above the rest
    room = F.when(F.col("__size") > 0, F.floor((F.col("__rest") - before) / F.col("__size") + 0.5)).when(before <= F.col("__rest"), F.col("__rows")).otherwise(0)
    taken = places.withColumn("__once", F.greatest(F.least(room, F.col("__rows")), F.lit(0)).cast("bigint")).where("__once > 0")
    last = taken.groupBy("__source").agg(F.max(F.struct("__key", "__once", "__rows")).alias("__last"))
    plan = cut(plan.join(last, "__source", "left").select("__source", "source_size", "target", "__whole", "__at", "__last.*"))
    plan = plan.withColumnRenamed("__key", "__cut")

    rows = (keyed if carry else light).join(small(plan), "__source")
    at_cut = F.col("__at").isNotNull() & F.coalesce(F.col("__key") == F.col("__cut"), F.lit(False))
    more = F.col("__at").isNull() | (F.col("__range") < F.col("__at")) | ((F.col("__range") == F.col("__at")) & F.coalesce(F.col("__key") <= F.col("__cut"), F.lit(False)))
    rows = rows.withColumn("__more", more)
    if not plan.where("__once < __rows").isEmpty():  # the cut falls within repeated rows of some source
        split = at_cut & (F.col("__once") < F.col("__rows"))
        rows = rows.where(~split).unionByName(first_of(cut(rows.where(split))))
    copies = F.least(F.col("__whole") + F.col("__more").cast("bigint"), F.lit(max_epochs).cast("bigint"))
    return rows.select(*names, F.col("__size").alias("size"), "source_size", "target", copies.alias("copies"), (copies * F.col("__size")).alias("taken"))


def first_of(rows: DataFrame) -> DataFrame:
    """rows (cut): repeated rows of each source. Sets __more for the first __once of each."""
    rows = rows.withColumn("__part", F.spark_partition_id())
    counts = rows.groupBy("__source", "__part").agg(F.count(F.lit(1)).alias("__n"))  # a row for each source and partition
    counts = counts.withColumn("__shift", F.sum("__n").over(W.partitionBy("__source").orderBy("__part")) - F.col("__n")).drop("__n")
    number = F.row_number().over(W.partitionBy("__source", "__part").orderBy("__key")) + F.col("__shift")
    return rows.join(counts, ["__source", "__part"]).withColumn("__more", number <= F.col("__once")).drop("__part", "__shift")


def small(sources: DataFrame) -> DataFrame:
    """For joins by source: broadcast up to a number of rows, else left to Spark, which splits the rows of a common source."""
    return F.broadcast(sources) if sources.count() <= MAX_BROADCAST_SOURCES else sources
