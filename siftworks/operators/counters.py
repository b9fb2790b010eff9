"""Counters over all runs: each run leaves exact sums and sketches of its distinct keys, and these are merged instead of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A sketch has 2^LG registers; its estimate's relative standard error is about 1.04 / sqrt(2^LG).
LG = 12


def summary(rows: DataFrame, by: list[Column | str], sums: dict[str, Column], keys: dict[str, Column]) -> DataFrame:
    """A row for each group: rows (their number), sums as named, and for each of keys a sketch of its distinct values."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(n) for n, c in sums.items()], *[F.hll_sketch_agg(c, LG).alias(n) for n, c in keys.items()])


def merged(summaries: DataFrame, by: list[Column | str], sums: list[str], keys: list[str]) -> DataFrame:
    """Summaries of several runs as one. Sketches stay sketches, so that what is merged can be merged again."""
    return summaries.groupBy(*by).agg(*[F.sum(n).alias(n) for n in ("rows", *sums)], *[F.hll_union_agg(n).alias(n) for n in keys])


def estimated(summaries: DataFrame, keys: list[str]) -> DataFrame:
    """With the number of distinct values in place of each sketch."""
    return summaries.withColumns({n: F.hll_sketch_estimate(n) for n in keys})


def error_of(lg: int = LG) -> float:
    """Three standard errors of an estimate, as a share."""
    return 3 * 1.04 / 2 ** (lg / 2)
