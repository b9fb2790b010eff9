"""Sharding by extendible hashing (DataFrame operations only).

A row's key is the first 60 bits of an MD5 over its doc_id and text. The directory is indexed by the leading bits: a bucket
above the byte limit splits on its next bit, others stay. Sizes are summed once per 12 bits (partial sums first, 4096 rows for
each bucket still too large), all depths between are sums of those, and only rows of buckets still too large go on to the next
12 bits. Rows alike in all 60 bits (repeated rows) are dealt out by number: position within their partition plus what the
partitions before hold, over checkpointed rows, so that a row that fills a third of the table doesn't meet in one task.

Defined cases: a null text has 0 bytes; a null doc_id is keyed as 'null'; a row above the limit gets a shard of its own,
marked oversize; an empty table gives no shards; other columns ride along unless they clash with those in ADDED.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.llm.common import cut, join_groups, text_or_empty

BITS, STEP = 60, 12
LIMIT = 64 << 20
#: A table that would give fewer shards than this at the limit gets a lower one: its bytes divided by this.
FEWEST = 40
#: For a directory of up to so many leaves, at so many depths, rows find theirs by a broadcast.
BROADCAST_LEAVES, BROADCAST_DEPTHS = 1 << 20, 16
ADDED = ("n_bytes", "depth", "shard", "shard_bytes", "oversize", "__key", "__rows", "__depth", "__prefix", "__address", "__at", "__n", "__max", "__base", "__total", "__each", "__part")


def key_bits() -> Column:
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.md5(text_or_empty()))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint")


def prefix(key: Column, depth: int) -> Column:
    return F.shiftright(key, BITS - depth)


def directory(keyed: DataFrame, limit: int) -> DataFrame:
    """keyed: __key, n_bytes. The leaves: __depth, __prefix, shard_bytes. Those at depth 60 may be above the limit."""
    leaves, rows, level = None, keyed, 0
    while True:
        cells = cut(rows.groupBy(prefix(F.col("__key"), level + STEP).alias("__cell")).agg(F.sum("n_bytes").alias("__bytes")))
        depths = F.explode(F.sequence(F.lit(level), F.lit(level + STEP))).alias("__depth")
        up = cells.select(depths, "__cell", "__bytes").withColumn("__prefix", F.expr(f"shiftright(__cell, {level + STEP} - __depth)"))
        sums = up.groupBy("__depth", "__prefix").agg(F.sum("__bytes").alias("shard_bytes"))
        parents = sums.where(F.col("shard_bytes") > limit).select((F.col("__depth") + 1).alias("__depth"), F.col("__prefix").alias("__parent"))
        opened = sums.withColumn("__parent", F.shiftright("__prefix", 1)).join(parents, ["__depth", "__parent"], "left_semi").drop("__parent")
        reached = sums.where(F.col("__depth") == level) if level == 0 else sums.limit(0)
        reached = cut(reached.unionByName(opened.select(reached.columns)))
        last = level + STEP >= BITS
        done = reached if last else reached.where((F.col("shard_bytes") <= limit) | (F.col("__depth") < level + STEP))
        done = done.where((F.col("shard_bytes") <= limit) | (F.col("__depth") == BITS))
        leaves = done if leaves is None else leaves.unionByName(done)
        over = reached.where((F.col("__depth") == level + STEP) & (F.col("shard_bytes") > limit))
        if last or over.isEmpty():
            return cut(leaves)
        rows = rows.withColumn("__cell", prefix(F.col("__key"), level + STEP)).join(over.select(F.col("__prefix").alias("__cell")), "__cell", "left_semi").drop("__cell")
        level += STEP


def with_leaves(rows: DataFrame, keyed: DataFrame, leaves: DataFrame) -> DataFrame:
    """rows with depth, shard and shard_bytes of their leaves. keyed: __key of the rows.

    A row has an address at each depth in use, of which one is a leaf. A small directory is brought to the rows. Else, or where repeated
    rows have drawn it out over many depths, each distinct key finds its leaf and the rows meet it by key: frequent keys by a broadcast."""
    depths = sorted(r[0] for r in leaves.select("__depth").distinct().collect()) or [0]  # 61 at most
    bits = F.when(F.col("__depth") == 0, F.lit("b")).otherwise(F.concat(F.lit("b"), F.expr("lpad(conv(__prefix, 10, 2), __depth, '0')")))
    named = leaves.select("__depth", "__prefix", F.col("__depth").alias("depth"), bits.alias("shard"), "shard_bytes")
    address = F.explode(F.array(*[F.struct(F.lit(d).alias("__depth"), prefix(F.col("__key"), d).alias("__prefix")) for d in depths])).alias("__address")
    meet = lambda df: df.select("*", address).select("*", "__address.*").drop("__address")
    if len(depths) <= BROADCAST_DEPTHS and leaves.count() <= BROADCAST_LEAVES:
        return meet(rows).join(F.broadcast(named), ["__depth", "__prefix"]).drop("__depth", "__prefix")
    each = keyed.groupBy("__key").agg(F.count(F.lit(1)).alias("__rows"))
    return join_groups(rows, cut(meet(each).join(named, ["__depth", "__prefix"]).drop("__depth", "__prefix")), "__key", "__rows").drop("__rows")


def shard(docs: DataFrame, limit: int = LIMIT, fewest: int = FEWEST) -> DataFrame:
    """The rows of docs (but for columns named as those added) with n_bytes, depth, shard, shard_bytes and oversize.

    shard: 'b' and the bits of the key that index its bucket; for rows alike in all bits also '.' and a number. limit: bytes of a shard
    at most; less where the table would not give `fewest` shards (0: never).
    """
    kept = [c for c in docs.columns if c not in ADDED]
    rows = docs.select(*kept, F.octet_length(text_or_empty()).cast("bigint").alias("n_bytes"), key_bits().alias("__key"))
    keyed = cut(rows.select("__key", "n_bytes"))
    if fewest:
        limit = min(limit, -(-(keyed.agg(F.sum("n_bytes")).first()[0] or 0) // fewest))
    leaves = directory(keyed, limit)
    found = with_leaves(rows, keyed, leaves)
    if leaves.where((F.col("__depth") == BITS) & (F.col("shard_bytes") > limit)).isEmpty():
        return found.select(*kept, "n_bytes", "depth", "shard", "shard_bytes", (F.col("shard_bytes") > limit).alias("oversize"))
    found = cut(found).withColumn("__at", F.spark_partition_id())
    alike = (F.col("depth") == BITS) & (F.col("shard_bytes") > limit)
    same = found.where(alike)
    counts = same.groupBy("__key", "__at").agg(F.count(F.lit(1)).alias("__n"), F.max("n_bytes").alias("__max"))
    by_key = W.partitionBy("__key")
    counts = counts.withColumn("__base", F.sum("__n").over(by_key.orderBy("__at")) - F.col("__n")).withColumn("__total", F.sum("__n").over(by_key)).withColumn("__each", F.greatest(F.lit(1), F.floor(F.lit(limit) / F.max("__max").over(by_key))))
    number = F.col("__base") + F.row_number().over(W.partitionBy("__key", "__at").orderBy("n_bytes")) - 1
    same = same.join(counts, ["__key", "__at"]).withColumn("__part", F.floor(number / F.col("__each")))
    size = F.least(F.col("__each"), F.col("__total") - F.col("__part") * F.col("__each")) * F.col("n_bytes")
    same = same.withColumn("shard", F.concat("shard", F.lit("."), F.col("__part").cast("string"))).withColumn("shard_bytes", size.cast("bigint"))
    out = [*kept, "n_bytes", "depth", "shard", "shard_bytes"]
    return found.where(~alike).select(out).unionByName(same.select(out)).withColumn("oversize", F.col("shard_bytes") > limit)
