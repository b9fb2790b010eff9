"""What is still to be done: keys that weren't tried, and dates whose archive is missing or stale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks import rules
from siftworks.functions.text import strip


def clean_keys(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct, without white space around them, without blank ones."""
    return lines.select(strip(F.col(column)).alias(column)).where(F.col(column) != "").dropDuplicates([column])


def pending(candidates: DataFrame, tried: DataFrame, key: str) -> DataFrame:
    """Rows whose key wasn't tried. Tried, not emitted: else what gave nothing would be tried forever."""
    return candidates.join(tried.select(key).distinct(), key, "left_anti")


def file_date(name: Column) -> Column:
    """The first calendar date in a file's name; null if there is none, or no such day."""
    return F.try_to_date(F.regexp_extract(name, r"\d{4}-\d{2}-\d{2}", 0), "yyyy-MM-dd")


def backlog(dates: DataFrame, archive: DataFrame) -> DataFrame:
    """dates: dt; archive: dt, head (the first characters of what was written). Dates to do, oldest first."""
    head = F.substring("head", 1, rules.HEAD_LENGTH)
    stale = F.col("head").isNull() | F.contains(head, F.lit(rules.STALE_MARK)) | (F.length(head) < rules.STALE_LENGTH)
    return dates.where("dt is not null").select("dt").distinct().join(archive, "dt", "left").where(stale).select("dt").orderBy("dt")
