"""How far a run is: counts beside the rows, without a pass of their own where Spark can take them along."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


def counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """The same rows, and counts taken while they pass: rows, and one for each condition. Read them (.get) after an action."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in conditions.items()]), seen


def cardinalities(candidates: DataFrame, tried: DataFrame, key: str) -> DataFrame:
    """One row: total (distinct candidates), tried (distinct keys tried, candidates or not) and left (candidates not tried)."""
    sides = candidates.select(key, F.lit(1).alias("side")).unionByName(tried.select(key, F.lit(2).alias("side"))).where(F.col(key).isNotNull())
    keys = sides.groupBy(key).agg(F.bit_or("side").alias("side"))
    here, there = F.col("side").bitwiseAND(1) > 0, F.col("side").bitwiseAND(2) > 0
    return keys.agg(F.count_if(here).alias("total"), F.count_if(there).alias("tried"), F.count_if(here & ~there).alias("left"))


def pace(done: Column, total: Column, elapsed: Column) -> Column:
    """percent done (one decimal) and the whole seconds left at the pace so far; null while nothing is done."""
    left = F.floor(elapsed / F.nullif(done, F.lit(0)) * (total - done)).cast("bigint")
    share = F.when(total == 0, F.lit(100.0)).otherwise(F.round(done / F.nullif(total, F.lit(0)) * 100, 1))
    return F.struct(share.alias("percent"), left.alias("seconds_left"))


class Progress(StreamingQueryListener):
    """Tells each batch's number, input rows and rows a second of the session's streams. Register it with spark.streams.addListener."""

    def __init__(self, tell: Callable[[str], None] = print):
        self.tell = tell

    def onQueryStarted(self, event) -> None:
        self.tell(f"stream {event.id}: started")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.tell(f"stream {p.id}: batch {p.batchId}, {p.numInputRows} rows, {p.processedRowsPerSecond or 0:.1f} a second")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.tell(f"stream {event.id}: ended" + (f" by {event.exception}" if event.exception else ""))
