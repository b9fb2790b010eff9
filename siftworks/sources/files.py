"""Files as tables, and tables as files. All go through Spark's readers, so any store that Spark reads will do."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks import rules
from siftworks.functions.text import any_of
from siftworks.operators.incremental import clean_keys, file_date

CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def domain_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, and dt by the file's name."""
    return spark.read.text(path).select("value", file_date(F.col("_metadata.file_name")).alias("dt"))


def key_set(spark: SparkSession, path: str) -> DataFrame:
    return clean_keys(spark.read.text(path))


def file_dates(spark: SparkSession, path: str) -> DataFrame:
    """Distinct dates of the folder's .txt files, sorted."""
    names = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"))
    return names.where(F.endswith(F.lower("name"), F.lit(".txt"))).select(file_date(F.col("name")).alias("dt")).where("dt is not null").distinct().orderBy("dt")


def leads_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All columns are strings; none are inferred. A field that is quoted and empty is an empty text, one with nothing in it is null."""
    schema = ", ".join(f"`{c}` string" for c in columns or rules.LEAD_COLUMNS)
    return spark.read.options(**CSV, nullValue="\0").schema(schema).csv(path)


def heads(spark: SparkSession, path: str) -> DataFrame:
    """dt and the first characters of each file."""
    return spark.read.text(path, wholetext=True).select(file_date(F.col("_metadata.file_name")).alias("dt"), F.substring("value", 1, rules.HEAD_LENGTH).alias("head"))


def zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """first_members() of a folder's files."""
    return first_members(spark.read.format("binaryFile").load(path).select("path", "content"))


def first_members(archives: DataFrame) -> DataFrame:
    """archives: path, content. Returns path, member, value, error: the lines of each ZIP file's first member.

    A file that is no ZIP gives one row with error; HtmlPage if a server sent a page instead. An archive without members gives
    IndexError, null content TypeError.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["path", "member", "value", "error"]
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    if content[:512].lstrip().lower().startswith((b"<!doctype html", b"<html")):
                        raise HtmlPage
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        member = archive.namelist()[0]
                        with archive.open(member) as lines:
                            text = io.TextIOWrapper(lines, "utf-8", errors="replace")
                            while block := text.readlines(1 << 20):
                                yield pd.DataFrame([(name, member, x.rstrip("\r\n"), None) for x in block], columns=columns)
                except Exception as e:
                    yield pd.DataFrame([(name, None, None, type(e).__name__)], columns=columns)

    return archives.select("path", "content").mapInPandas(run, "path string, member string, value string, error string")


class HtmlPage(Exception):
    """A page where an archive was asked for."""


class _Index(HTMLParser):
    """Rows of the first table: the cells' texts and the first link."""

    def __init__(self):
        super().__init__()
        self.rows: list[tuple[list[str], str | None]] = []
        self.tables = 0
        self.done = self.cell = False

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables += 1
        if self.done or not self.tables:
            return
        if tag == "tr":
            self.rows.append(([], None))
        elif self.rows and tag == "td":
            self.rows[-1][0].append("")
            self.cell = True
        elif self.rows and tag == "a" and self.rows[-1][1] is None and (href := dict(attrs).get("href")):
            self.rows[-1] = (self.rows[-1][0], href)

    def handle_endtag(self, tag):
        if tag == "table" and self.tables:
            self.tables -= 1
            self.done = self.done or not self.tables
        elif tag == "td":
            self.cell = False

    def handle_data(self, data):
        if self.cell and not self.done and self.rows and self.rows[-1][0]:
            self.rows[-1][0][-1] += data


def index_links(spark: SparkSession, path: str, root: str) -> DataFrame:
    """links_in() of a saved index page."""
    return links_in(spark.read.text(path, wholetext=True), root)


def links_in(pages: DataFrame, root: str) -> DataFrame:
    """pages: value. dt (as text) and href of each row of an index page that has three cells, begins with a date and has a link."""

    @F.pandas_udf("array<struct<dt: string, href: string>>")
    def rows_of(pages: pd.Series) -> pd.Series:
        out = []
        for page in pages:
            index = _Index()
            index.feed(page or "")
            out.append([{"dt": cells[0].strip(), "href": href} for cells, href in index.rows if len(cells) >= 3 and href])
        return pd.Series(out)

    rows = pages.select(F.explode(rows_of("value")).alias("r")).select("r.*")
    rows = rows.where(F.col("dt").rlike(r"^\d{4}-\d{2}-\d{2}") & ~any_of(F.lower("href"), rules.LINK_DENIED))
    return rows.select(F.substring("dt", 1, 10).alias("dt"), F.when(F.startswith("href", F.lit("http")), F.col("href")).otherwise(F.concat(F.lit(root), F.col("href"))).alias("href"))


def write_lines(df: DataFrame, path: str, column: str = "value") -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Each task writes its own file with a header; no lock is needed."""
    df.write.mode("append").options(**CSV, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_dates(df: DataFrame, path: str) -> None:
    """One folder per dt; only the dates at hand are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)
