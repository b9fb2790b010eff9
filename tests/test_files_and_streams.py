import zipfile

from pyspark.sql import functions as F

from siftworks.sources import files
from siftworks.streaming.incremental import run_dates, run_once


def test_text_and_dates(spark, tmp_path):
    (tmp_path / "domains-2024-01-05.txt").write_text("a.com\n\n b.com \na.com\n")
    (tmp_path / "domains-2024-02-30.txt").write_text("c.com\n")
    assert sorted(r[0] for r in files.key_set(spark, str(tmp_path)).collect()) == ["a.com", "b.com", "c.com"]
    assert [str(r[0]) for r in files.file_dates(spark, str(tmp_path)).collect()] == ["2024-01-05"]
    assert {str(r["dt"]) for r in files.domain_lines(spark, str(tmp_path)).collect()} == {"2024-01-05", "None"}
    assert files.heads(spark, str(tmp_path)).where("dt is not null").first()["head"].startswith("a.com")


def test_zip_takes_the_first_member(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.txt", "one\ntwo")
        z.writestr("y.txt", "three")
    (tmp_path / "b.zip").write_bytes(b"PK broken")
    got = files.zip_lines(spark, str(tmp_path)).collect()
    assert sorted(r["value"] for r in got if r["value"]) == ["one", "two"] and [r["error"] for r in got if r["error"]] == ["BadZipFile"]


def test_csv_round_trip(spark, tmp_path):
    rows = [("a.com", 'say "hi", there', "two\nlines"), ("b.com", None, "")]
    files.append_csv(spark.createDataFrame(rows, "Domain string, Title string, Page_Text string"), str(tmp_path / "out"))
    got = {r["Domain"]: r for r in files.leads_csv(spark, str(tmp_path / "out"), ["Domain", "Title", "Page_Text"]).collect()}
    assert got["a.com"]["Title"] == 'say "hi", there' and got["a.com"]["Page_Text"] == "two\nlines"


def test_index_page(spark, tmp_path):
    page = "<table><tr><th>h</th></tr><tr><td> 2024-01-05 </td><td>x</td><td><a href='/get/1'>z</a></td></tr><tr><td>2024-01-06</td><td>y</td><td><a href='/Contact'>c</a></td></tr><tr><td>2024-01-07</td><td><a href='http://h/2'>z</a></td></tr><tr><td>2024-01-08</td><td></td><td><a href='http://h/3'>z</a></td></tr></table><table><tr><td>2024-01-09</td><td></td><td><a href='/no'>z</a></td></tr></table>"
    (tmp_path / "index.html").write_text(page)
    got = files.index_links(spark, str(tmp_path), "http://root").collect()
    assert [tuple(r) for r in got] == [("2024-01-05", "http://root/get/1"), ("2024-01-08", "http://h/3")]


def test_dates_are_replaced_one_by_one(spark, tmp_path):
    out = str(tmp_path / "out")
    files.write_dates(spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "dt string, n int"), out)
    files.write_dates(spark.createDataFrame([("2024-01-02", 3)], "dt string, n int"), out)
    assert sorted((str(r["dt"]), r["n"]) for r in spark.read.parquet(out).collect()) == [("2024-01-01", 1), ("2024-01-02", 3)]


def test_a_second_run_adds_nothing(spark, tmp_path):
    rows = spark.range(10).withColumn("dt", F.lit("2024-01-01"))
    rows.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        run_once(spark, str(tmp_path / "in"), rows.schema, lambda df: df, str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    run_dates(spark, str(tmp_path / "in"), rows.schema, lambda df: df, str(tmp_path / "days"), str(tmp_path / "state2"))
    assert spark.read.parquet(str(tmp_path / "days")).count() == 10
